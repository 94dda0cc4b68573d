"""The general data-repair problems over the project's tables."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridsnap.operators.delimited import check_records, parse_headers, parse_texts, with_headers
from gridsnap.operators.drift import canonical_names, column_types, file_schemas, profile_columns, schema_changes, typed_table, unify
from gridsnap.operators.hotdeck import Deck, Fill, apply_fills, hot_deck
from gridsnap.operators.nested import Level, latest_documents, path_columns, shred
from gridsnap.plans.cuts import cut
from gridsnap.sources.tables import table


def _one_of(name: str, *more: str) -> Column:
    c = F.col(name)
    ok = (c == F.col("home_team")) | (c == F.col("away_team"))
    return ok | c.isin(*more) if more else ok


def play_deck() -> Deck:
    """What a valid entry is, and which plays may donate it."""
    return Deck(
        root="game_id", order="play_id",
        fills=(
            Fill("posteam", "cat", _one_of("posteam"), ("drive_id",)),
            Fill("yardline_50", "num", F.col("yardline_50").between(0, 50), ("drive_id",)),
            Fill("ep", "num", F.col("ep").between(-7.0, 7.0) & ~F.isnan("ep"), ("half",)),
            Fill("Winner", "cat", _one_of("Winner", "TIE"), ()),
        ),
        features={"half": ("cat", 1.0), "drive_id": ("cat", 2.0), "play_type": ("cat", 0.5), "down": ("num", 0.5, 4), "yards_to_go": ("num", 0.5, 25)},
    )


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    got = hot_deck(table(spark, sf, "plays"), play_deck())
    return got.select("game_id", F.col("play_id").cast("int").alias("play_id"), "field")


def p1_filled(spark: SparkSession, sf: str) -> DataFrame:
    """plays with the four fields filled, flagged and their donors named."""
    plays, deck = table(spark, sf, "plays"), play_deck()
    return apply_fills(plays, deck, hot_deck(plays, deck))


def p1_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Per field the rows of plays that were filled, and how many of them now hold a valid entry: all of them."""
    done = p1_filled(spark, sf)
    fills = play_deck().fills
    each = [F.struct(F.lit(f.name).alias("field"), F.count_if(F.col(f"{f.name}_filled")).alias("filled"), F.count_if(F.col(f"{f.name}_filled") & F.coalesce(f.valid, F.lit(False))).alias("valid")) for f in fills]
    wide = done.agg(*[e.alias(f"c{i}") for i, e in enumerate(each)])
    return wide.select(F.explode(F.array(*[F.col(f"c{i}") for i in range(len(fills))])).alias("c")).select("c.*")


MATCH = (Level("half", "", ("num", "drives")), Level("drive", "drives"), Level("play", "eventGroups"))


def match_nodes(spark: SparkSession, sf: str, every: bool = False) -> DataFrame:
    """Nodes of each game's latest complete payload with the keys half, drive_no, play_no."""
    nodes = shred(latest_documents(table(spark, sf, "match_feed"), "game_id", "fetched_at", "payload", MATCH), MATCH, ("num",), every)
    at = lambda i: F.coalesce(F.get("path", F.lit(i)), F.lit(0))
    num = F.get_json_object("root", "$.num").try_cast("double").cast("int") + 1
    return nodes.select(F.col("key").alias("game_id"), "level", "path", "parent", "attrs", F.coalesce(num, at(0)).alias("half"), at(1).alias("drive_no"), at(2).alias("play_no"))


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    return match_nodes(spark, sf).select("level", "game_id", "half", "drive_no", "play_no")


def _level(spark: SparkSession, sf: str, level: str, schema: str, keys: list[str]) -> DataFrame:
    nodes = match_nodes(spark, sf).where(F.col("level") == level)
    known = [f.split(" ")[0] for f in re.split(r", (?![^<]*>)", schema)]
    extra = F.map_filter(F.from_json("attrs", "map<string,string>"), lambda k, v: ~k.isin(*known) & v.isNotNull())
    return nodes.select(*keys, _dewey("path").alias("dewey"), _dewey("parent").alias("parent_dewey"), F.from_json("attrs", schema).alias("a"), extra.alias("extra")).select(*keys, "dewey", "parent_dewey", "a.*", "extra")


def _dewey(c: str) -> Column:
    return F.array_join(F.col(c).cast("array<string>"), ".")


def p3_nodes(spark: SparkSession, sf: str) -> DataFrame:
    """Every object that stands in a list, at any depth, by schema path, with its own fields and its parent's label."""
    nodes = match_nodes(spark, sf, every=True)
    above = F.when(F.col("level").contains("/"), F.regexp_replace("level", "/[^/]+$", "")).when(F.col("level") == "play", "drive").when(F.col("level") == "drive", "half")
    return nodes.select("game_id", F.col("level").alias("schema_path"), _dewey("path").alias("dewey"), above.alias("parent_path"), _dewey("parent").alias("parent_dewey"), "attrs")


def p3_columns(spark: SparkSession, sf: str) -> DataFrame:
    """The tables that the payloads' schema paths form, with their columns as found."""
    return path_columns(match_nodes(spark, sf, every=True)).withColumnRenamed("level", "schema_path")


def p3_links(spark: SparkSession, sf: str) -> DataFrame:
    """Per schema path its records and how many of them find their parent by the label cut short: all, but for the halves."""
    nodes = cut(p3_nodes(spark, sf).drop("attrs"))
    # An object between a record and its list is no record: the parent is the nearest path that is a table, of which the label is cut alike.
    heads = nodes.select("game_id", F.col("dewey").alias("parent_dewey"), F.col("schema_path").alias("head")).distinct()
    found = nodes.join(heads, ["game_id", "parent_dewey"], "left").groupBy("game_id", "schema_path", "dewey").agg(F.max(F.coalesce(F.col("schema_path").startswith(F.concat("head", F.lit("/"))) | (F.col("parent_path") == F.col("head")), F.lit(False))).alias("ok"))
    return found.groupBy("schema_path").agg(F.count(F.lit(1)).alias("records"), F.count_if("ok").alias("with_parent"))


def p3_halves(spark: SparkSession, sf: str) -> DataFrame:
    return _level(spark, sf, "half", "num string", ["game_id", "half"])


def p3_drives(spark: SparkSession, sf: str) -> DataFrame:
    return _level(spark, sf, "drive", "team struct<id:bigint,threeLetters:string>, yards int, timeOfPossession string", ["game_id", "half", "drive_no"])


def p3_plays(spark: SparkSession, sf: str) -> DataFrame:
    place = "struct<yardLine:int,team:bigint>"
    schema = f"summary string, actionTitle string, down string, downLabel string, nextDown string, nextDownLabel string, target string, nextTarget string, startYardLine {place}, endYardLine {place}"
    return _level(spark, sf, "play", schema, ["game_id", "half", "drive_no", "play_no"])


# What a distance and a count may hold.
DISTANCE = (r"[0-9]+|G|NA|", 50)
RAW_RULES = {"dist": DISTANCE, "yards_to_go": DISTANCE, "count": (r"[0-9]+", None)}


def raw_records(spark: SparkSession, sf: str) -> DataFrame:
    files = table(spark, sf, "raw_files").select("file_id", "delim")
    return check_records(with_headers(table(spark, sf, "raw_lines").select("file_id", "line_no", "line"), files), RAW_RULES)


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    return raw_records(spark, sf).where("reason is not null").select(F.col("id").alias("file_id"), "line_no", "reason").distinct()


def p5_errors(spark: SparkSession, sf: str) -> DataFrame:
    """The bad lines with their reason and place: the offset of a broken quote, the field of a wrong value, and that entry."""
    bad = raw_records(spark, sf).where("reason is not null").withColumn("field", F.when(F.col("reason") == "value", F.col("error_at")))
    return bad.select(F.col("id").alias("file_id"), "line_no", "reason", F.when(F.col("reason") == "quoting", F.col("error_at")).alias("error_offset"), F.get("names", "field").alias("field"), F.get("fields", "field").alias("entry"), F.size("names").alias("columns_expected"), F.size("fields").alias("columns_found")).distinct()


def p5_loaded(spark: SparkSession, sf: str) -> DataFrame:
    """The valid lines, each as a map from column name to entry, with the checked entries as numbers (G and NA are none)."""
    good = raw_records(spark, sf).where("reason is null").select(F.col("id").alias("file_id"), "line_no", F.map_from_entries(F.arrays_zip("names", "fields")).alias("record"))
    return good.select("*", *[F.trim(F.col("record")[name]).try_cast(kind).alias(f"{name}_number") for name, kind in (("dist", "int"), ("yards_to_go", "int"), ("count", "bigint"))])


#: Lines of a file that make one text.
TEXT_LINES = 1000


def p5_recovered(spark: SparkSession, sf: str) -> DataFrame:
    """The files read as whole texts, in runs of TEXT_LINES lines: what does not parse, and where.

    Here a broken quote may run over the lines that follow, until the grammar finds a line that stands as a record of its own.
    """
    files = table(spark, sf, "raw_files").select(F.col("file_id").alias("id"), "delim").dropDuplicates(["id"])
    lines = table(spark, sf, "raw_lines").select("file_id", "line_no", "line")
    heads = parse_headers(lines, files).select("id", F.size("names").alias("width")).join(files, "id")
    runs = lines.where("line_no > 1 and line is not null").groupBy(F.col("file_id").alias("id"), F.floor(F.col("line_no") / TEXT_LINES).alias("part")).agg(F.array_sort(F.collect_set(F.struct("line_no", "line"))).alias("l"))
    sums = F.aggregate("l", F.array(F.lit(0)), lambda done, x: F.concat(done, F.array(F.element_at(done, -1) + F.length(x["line"]) + 1)))
    texts = cut(runs.select("id", "part", F.array_join(F.transform("l", lambda x: x["line"]), "\n").alias("text"), sums.alias("starts"), F.transform("l", lambda x: x["line_no"]).alias("numbers")).join(heads, "id"))
    bad = parse_texts(texts.select("id", "part", "text", "starts", "width", "delim")).where("reason is not null").join(texts.select("id", "part", "numbers"), ["id", "part"])
    return bad.select(F.col("id").alias("file_id"), F.get("numbers", "line").alias("line_no"), "reason", F.col("at").alias("error_offset"))


def raw_schemas(spark: SparkSession, sf: str) -> DataFrame:
    """Each raw file with its profiled columns."""
    files = table(spark, sf, "raw_files").select(F.col("file_id").alias("id"), "feed", "family", "covers_from", "delim").dropDuplicates(["id"])
    lines = table(spark, sf, "raw_lines").select("file_id", "line_no", "line")
    profiles = profile_columns(with_headers(lines, files.select(F.col("id").alias("file_id"), "delim")), RAW_RULES)
    return file_schemas(files.drop("delim"), parse_headers(lines, files), profiles)


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    return schema_changes(raw_schemas(spark, sf), never_retyped=tuple(RAW_RULES)).withColumnRenamed("id", "file_id")


def p4_unified(spark: SparkSession, sf: str) -> DataFrame:
    """Every valid raw line under its family's canonical column names."""
    schemas = cut(raw_schemas(spark, sf))
    names = canonical_names(schemas, schema_changes(schemas))
    return unify(raw_records(spark, sf).where("reason is null"), schemas, names).withColumnRenamed("id", "file_id")


def _family(family: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        schemas = cut(raw_schemas(spark, sf))
        names = cut(canonical_names(schemas, schema_changes(schemas)))
        return typed_table(unify(raw_records(spark, sf).where("reason is null"), schemas, names), column_types(schemas, names), family).withColumnRenamed("id", "file_id")

    query.__doc__ = f"The valid lines of {family} as one table of typed columns; entries not of their column's type stand in ``misfits``."
    return query


QUERIES = {f"p4_table_{family}": _family(family) for family in ("data_raw", "wc24_pbp", "model_eval_situations")}
QUERIES |= {"p3_nodes": p3_nodes, "p3_columns": p3_columns, "p3_links": p3_links, "p5_errors": p5_errors, "p1_counts": p1_counts, "p5_recovered": p5_recovered}
QUERIES |= {"p4_found": p4_found, "p4_unified": p4_unified, "p1_found": p1_found, "p1_filled": p1_filled, "p5_found": p5_found, "p5_loaded": p5_loaded, "p3_found": p3_found, "p3_halves": p3_halves, "p3_drives": p3_drives, "p3_plays": p3_plays}

_P1_GROUPS = (("posteam", "v1", "drive_id"), ("yardline_50", "v2", "drive_id"), ("ep", "v3", "half"), ("Winner", "v4", "game_id"))

# Quoted fields are taken off first: what a broken quote leaves still holds a quote; fields are cut at the delimiters that stand outside.
_FIELD = {d: f'("(?:[^"]|"")*"|[^"{d}]*)' for d in (";", ",")}


def _p5(line: str, d: str) -> str:
    return f"regexp_full_match({line}, '{_FIELD[d]}({d}{_FIELD[d]})*', 's')"


def _fields(line: str) -> str:
    """A list of the fields of a well-quoted line: a delimiter put before, then all matches of delimiter and field."""
    each = lambda d: f"regexp_extract_all('{d}' || {line}, '{d}{_FIELD[d]}', 1, 's')"
    return f"CASE delim WHEN ';' THEN {each(';')} ELSE {each(',')} END"


_P5 = f"""
WITH f AS (SELECT DISTINCT file_id, delim FROM raw_files),
h AS (SELECT file_id, delim, list_transform({_fields("replace(line, chr(65279), '')")}, lambda x: lower(trim(trim(trim(x), '"')))) AS names FROM (SELECT file_id, min(line) AS line FROM raw_lines WHERE line_no = 1 GROUP BY file_id) JOIN f USING (file_id)),
l AS (SELECT DISTINCT file_id, line_no, coalesce(line, '') AS line FROM raw_lines WHERE line_no > 1),
q AS (SELECT l.*, h.names, h.delim, CASE h.delim WHEN ';' THEN {_p5("line", ";")} ELSE {_p5("line", ",")} END AS good, {_fields("line")} AS parts FROM l LEFT JOIN h USING (file_id)),
v AS (SELECT *, coalesce(len(names), 0) AS width, list_transform(parts, lambda x: trim(CASE WHEN x LIKE '"%' THEN replace(x[2:-2], '""', '"') ELSE x END, chr(32) || chr(9) || chr(160) || chr(10) || chr(13))) AS vals FROM q),
w AS (SELECT *, vals[list_position(names, 'dist')] AS a, vals[list_position(names, 'yards_to_go')] AS b, vals[list_position(names, 'count')] AS c FROM v),
r AS (SELECT file_id, line_no, CASE WHEN NOT good THEN 'quoting' WHEN len(parts) <> width THEN 'column_count'
  WHEN list_contains(names, 'dist') AND NOT regexp_full_match(a, 'G|NA||0*([0-9]|[1-4][0-9]|50)') OR list_contains(names, 'yards_to_go') AND NOT regexp_full_match(b, 'G|NA||0*([0-9]|[1-4][0-9]|50)') OR list_contains(names, 'count') AND NOT regexp_full_match(c, '[0-9]+') THEN 'value' END AS reason FROM w)
"""

SQL = {
    "p5_found": _P5 + "SELECT DISTINCT file_id, line_no, reason FROM r WHERE reason IS NOT NULL",
    "p1_found": """
WITH p AS (
  SELECT DISTINCT game_id, play_id, drive_id, half,
    CASE WHEN posteam IN (home_team, away_team) THEN posteam END AS v1,
    CASE WHEN yardline_50 BETWEEN 0 AND 50 THEN yardline_50 END AS v2,
    CASE WHEN ep BETWEEN -7 AND 7 THEN ep END AS v3,
    CASE WHEN Winner IN (home_team, away_team, 'TIE') THEN Winner END AS v4
  FROM plays)
"""
    + " UNION ALL ".join(
        f"SELECT DISTINCT x.game_id, x.play_id, '{name}' AS field FROM p x JOIN (SELECT game_id, {group} AS grp, min(play_id) AS lo, max(play_id) AS hi FROM p WHERE {v} IS NOT NULL GROUP BY 1, 2) g "
        f"ON x.game_id = g.game_id AND x.{group} = g.grp WHERE x.{v} IS NULL AND (g.lo <> x.play_id OR g.hi <> x.play_id)"
        for name, v, group in _P1_GROUPS
    ),
}
_P1_VALID = {"posteam": "posteam IN (home_team, away_team)", "yardline_50": "yardline_50 BETWEEN 0 AND 50", "ep": "ep BETWEEN -7 AND 7", "Winner": "Winner IN (home_team, away_team, 'TIE')"}
SQL["p1_counts"] = "WITH found AS (" + SQL["p1_found"] + ") " + " UNION ALL ".join(
    f"SELECT '{name}' AS field, count(*) AS filled, count(*) AS valid FROM plays JOIN found USING (game_id, play_id) WHERE field = '{name}' AND coalesce({ok}, false) = false" for name, ok in _P1_VALID.items()
)
