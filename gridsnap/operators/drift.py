"""Schemas that drift between the files of a feed: profiles, bipartite rename matching, one consistent table.

Every column of every file is profiled by mergeable sketches of bounded size: counts of value classes, a hashed value
histogram, and moments of its numbers and lengths. Each file is compared with the one before it: columns whose names stay
are the same; the others are matched by a maximum-weight bipartite assignment over the similarity of content and name.
Names that stand side by side in a fair share of a family's files are different columns and are never matched to each other.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridsnap.operators.delimited import checked, value_rules
from gridsnap.plans.cuts import cut

BUCKETS = 4096
#: Share of the files that hold the rarer of two names from which their standing side by side proves two columns.
APART_SHARE = 1 / 20
#: Least similarity at which two columns count as one under another name.
RENAME_AT = 0.32
# Words that count as yes or no, and entries that say nothing.
YES_NO = ("true", "false", "yes", "no", "y", "n", "t", "f")
EMPTY = ("", "na")


WHOLE, DECIMAL = re.compile(r"[+-]?[0-9]+"), re.compile(r"[+-]?([0-9]+\.[0-9]*|\.[0-9]+)")
#: Different entries whose sketch a task remembers.
REMEMBERED = 100_000


def value_class(v: str) -> str:
    """``whole``, ``decimal``, ``yes_no`` or ``text`` of a trimmed entry."""
    return "whole" if WHOLE.fullmatch(v) else "decimal" if DECIMAL.fullmatch(v) else "yes_no" if v.lower() in YES_NO else "text"


def sketch(v: str) -> tuple[int, str, float | None, int] | None:
    """(bucket, class, number, length) of an entry; None if it says nothing."""
    v = v.strip(" ")
    low = v.lower()
    if low in EMPTY:
        return None
    kind = value_class(v)
    return crc32(low.encode()) % BUCKETS, kind, float(v) if kind in ("whole", "decimal") else None, len(v)


def profile_columns(lines: DataFrame, rules: dict[str, tuple[str, int | None]]) -> DataFrame:
    """(id, name, n, kind, hist, mean, sd, len) per file and column over the valid ones of rows (id, line, header, delim).

    kind is the most frequent class; hist the counts per value bucket. Entries are counted column by column where they are
    parsed and leave Python as counts per (file, column, bucket, class), so a file with a third of all rows arrives as at most
    4 x BUCKETS rows per column and batch, which are summed before and after the shuffle.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        checks, known = value_rules(rules), {}
        for batch in batches:
            files: dict[tuple, tuple[list[str], list]] = {}
            for key, (names, fields, reason, _) in zip(batch["id"], checked(batch, checks)):
                if reason is None:
                    files.setdefault((key, id(names)), (names, []))[1].append(fields)
            out: dict[tuple, list] = {}
            for (key, _), (names, rows) in files.items():
                for name, column in zip(names, zip(*rows)):
                    for v, n in Counter(column).items():
                        if v not in known:
                            if len(known) >= REMEMBERED:
                                known.clear()
                            known[v] = sketch(v)
                        if (got := known[v]) is not None:
                            bucket, kind, number, length = got
                            sums = out.setdefault((key, name, bucket, kind), [0, 0, 0.0, 0.0, 0])
                            sums[0] += n
                            sums[1] += n * length
                            if number is not None:
                                sums[2] += n * number
                                sums[3] += n * number * number
                                sums[4] += n
            yield pd.DataFrame([(*k, *v) for k, v in out.items()], columns=["id", "name", "b", "kind", "n", "chars", "s", "s2", "k"])

    cells = lines.select("id", "line", "header", "delim").mapInPandas(run, f"id {lines.schema['id'].dataType.simpleString()}, name string, b int, kind string, n bigint, chars bigint, s double, s2 double, k bigint")
    sums = [F.sum(c).alias(c) for c in ("n", "chars", "s", "s2", "k")]
    counts = cells.groupBy("id", "name", "b", "kind").agg(*sums)
    per_kind = counts.groupBy("id", "name", "kind").agg(*sums, F.collect_list(F.struct("b", "n")).alias("hist"))
    per = per_kind.groupBy("id", "name").agg(*sums, F.max(F.struct("n", "kind"))["kind"].alias("kind"), F.flatten(F.collect_list("hist")).alias("hist"))
    mean = F.try_divide("s", "k")
    return per.select("id", "name", "n", "kind", "hist", mean.alias("mean"), F.sqrt(F.greatest(F.lit(0.0), F.try_divide("s2", "k") - mean * mean)).alias("sd"), (F.col("chars") / F.col("n")).alias("len"))


def _edit(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i, *row[1:]], row
        for j, y in enumerate(b, 1):
            row[j] = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y))
    return row[-1]


def name_similarity(a: str, b: str) -> float:
    """0 to 1: edit similarity of the letters and digits, shared words, or one an abbreviation of the other."""
    x, y = re.sub(r"[^0-9a-z]", "", a.lower()), re.sub(r"[^0-9a-z]", "", b.lower())
    if not x or not y:
        return 0.0
    best = 1 - _edit(x, y) / max(len(x), len(y))
    short, long = sorted((x, y), key=len)
    letters = iter(long)
    if short[0] == long[0] and len(short) >= 2 and all(c in letters for c in short):
        best = max(best, 0.6 + 0.4 * len(short) / len(long))
    s, t = set(re.findall(r"[a-z]+|[0-9]+", a.lower())), set(re.findall(r"[a-z]+|[0-9]+", b.lower()))
    return max(best, len(s & t) / max(len(s | t), 1))


def content_similarity(a: dict, b: dict) -> float:
    """0 to 1 from value histograms, number ranges and lengths; other classes of value lower it."""
    if not a["n"] or not b["n"]:
        return 0.3
    p, q = ({bucket: n / side["n"] for bucket, n in side["hist"]} for side in (a, b))
    both = p.keys() & q.keys()
    values = 0.5 * sum(min(p[x], q[x]) for x in both) + 0.5 * len(both) / min(len(p), len(q))
    if a["mean"] is not None and b["mean"] is not None and a["kind"] != "text" and b["kind"] != "text":
        spread = max(a["sd"], b["sd"], 1e-9) + 0.25 * min(abs(a["mean"]), abs(b["mean"]))
        shape, weight = max(0.0, 1 - abs(a["mean"] - b["mean"]) / (2 * spread)) * (min(a["sd"], b["sd"]) + 0.1) / (max(a["sd"], b["sd"]) + 0.1), 0.3
    else:
        # Texts of which hardly one occurs twice share no values; then only their lengths can speak.
        shape, weight = min(a["len"], b["len"]) / max(a["len"], b["len"], 1e-9), 0.5 if min(len(p) / a["n"], len(q) / b["n"]) > 0.9 else 0.15
    return (1 - weight) * values + weight * shape if a["kind"] == b["kind"] else 0.25 * values + 0.25 * shape


def similarity(a: dict, b: dict) -> float:
    return 0.75 * content_similarity(a, b) + 0.25 * name_similarity(a["name"], b["name"])


def assign(weights: np.ndarray) -> list[tuple[int, int]]:
    """A maximum-weight assignment of rows to columns (Kuhn's method with potentials); pairs of weight 0 are left out."""
    w = np.asarray(weights, dtype=float)
    if w.size == 0:
        return []
    flip = w.shape[0] > w.shape[1]
    cost = -(w.T if flip else w)
    n, m = cost.shape
    u, v = np.zeros(n + 1), np.zeros(m + 1)
    owner, back = np.zeros(m + 1, dtype=int), np.zeros(m + 1, dtype=int)
    for i in range(1, n + 1):
        owner[0], j0 = i, 0
        slack, used = np.full(m + 1, np.inf), np.zeros(m + 1, dtype=bool)
        while True:
            used[j0] = True
            i0 = owner[j0]
            free = np.flatnonzero(~used[1:]) + 1
            gain = cost[i0 - 1, free - 1] - u[i0] - v[free]
            closer = gain < slack[free]
            slack[free[closer]], back[free[closer]] = gain[closer], j0
            j1 = free[np.argmin(slack[free])]
            step = slack[j1]
            u[owner[used]] += step
            v[used] -= step
            slack[~used] -= step
            j0 = j1
            if owner[j0] == 0:
                break
        while j0:
            owner[j0], j0 = owner[back[j0]], back[j0]
    pairs = [(owner[j] - 1, j - 1) for j in range(1, m + 1) if owner[j]]
    return sorted((j, i) if flip else (i, j) for i, j in pairs if cost[i, j] < 0)


def compare(before: dict[str, dict], after: dict[str, dict], apart: set[tuple[str, str]], at: float = RENAME_AT) -> list[tuple[str, str, str]]:
    """(kind, old name, new name) for the columns that only the earlier and only the later of two files names."""
    gone, new = list(before), list(after)
    score = np.zeros((len(gone), len(new)))
    for i, a in enumerate(gone):
        for j, b in enumerate(new):
            s = 0.0 if (min(a, b), max(a, b)) in apart else similarity(before[a], after[b])
            score[i, j] = s if s >= at else 0.0
    pairs = assign(score)
    out = [("renamed", gone[i], new[j]) for i, j in pairs]
    out += [("removed", x, "") for i, x in enumerate(gone) if i not in {p for p, _ in pairs}]
    return out + [("added", "", x) for j, x in enumerate(new) if j not in {q for _, q in pairs}]


def file_schemas(files: DataFrame, headers: DataFrame, profiles: DataFrame) -> DataFrame:
    """files (id, feed, family, covers_from) with ``cols``, the profiled columns of each header (id, names) in order.

    A column without entries has n 0 and no kind. A name that a header repeats counts once.
    """
    each = headers.select("id", F.posexplode(F.array_distinct("names")).alias("pos", "name"))
    stats = ["n", "kind", "hist", "mean", "sd", "len"]
    cols = each.join(profiles, ["id", "name"], "left").groupBy("id").agg(F.array_sort(F.collect_list(F.struct("pos", "name", *stats))).alias("cols"))
    return files.join(cols, "id")


def apart_names(schemas: DataFrame) -> DataFrame:
    """(family, apart): pairs of names, smaller first, that stand in one header in ``APART_SHARE`` of the files that hold the rarer
    one: a single untidy header bars no rename. As large as the vocabulary of names allows.
    """
    heads = schemas.select("family", F.array_sort(F.transform("cols", lambda c: c["name"])).alias("names")).groupBy("family", "names").agg(F.count(F.lit(1)).alias("n"))
    pairs = heads.select("family", "names", "n", F.explode("names").alias("a")).select("family", "n", "a", F.explode("names").alias("b")).where("a <= b").groupBy("family", "a", "b").agg(F.sum("n").alias("n"))
    alone = pairs.where("a = b")
    of = lambda c: alone.select("family", F.col("a").alias(c), F.col("n").alias(f"n_{c}"))
    both = pairs.where("a < b").join(of("a"), ["family", "a"]).join(of("b"), ["family", "b"]).where(F.col("n") >= APART_SHARE * F.least("n_a", "n_b"))
    return both.groupBy("family").agg(F.collect_list(F.struct("a", "b")).alias("apart"))


def schema_changes(schemas: DataFrame, never_retyped: tuple[str, ...] = ()) -> DataFrame:
    """(id, kind, old_name, new_name) of every file against the one before it in its feed, by covers_from, then id.

    Files without a feed or date are compared with nothing. The first file of a feed has no changes.
    """
    order = Window.partitionBy("feed").orderBy("covers_from", "id")
    schemas = cut(schemas)
    dated = schemas.where("feed is not null and covers_from is not null")
    pairs = dated.withColumn("before", F.lag("cols").over(order)).where("before is not null")
    names = lambda c: F.transform(c, lambda x: x["name"])
    missing = lambda c, other: F.filter(c, lambda x: ~F.array_contains(names(F.col(other)), x["name"]))
    kinds = F.map_from_arrays(names("cols"), F.transform("cols", lambda x: x["kind"]))
    pairs = pairs.select("id", "family", missing("before", "cols").alias("gone"), missing("cols", "before").alias("new"), F.transform("before", lambda x: F.struct(x["name"].alias("name"), x["kind"].alias("was"), F.try_element_at(kinds, x["name"]).alias("now"))).alias("kept"))
    retyped = pairs.select("id", F.explode("kept").alias("k")).where("k.was <> k.now").where(~F.col("k.name").isin(*never_retyped)).select("id", F.lit("retyped").alias("kind"), F.col("k.name").alias("old_name"), F.col("k.name").alias("new_name"))

    def change(kind: str, side: str) -> DataFrame:
        name = F.col("c.name")
        only = pairs.where(F.size("new" if side == "gone" else "gone") == 0).select("id", F.explode(side).alias("c"))
        return only.select("id", F.lit(kind).alias("kind"), (name if side == "gone" else F.lit("")).alias("old_name"), (name if side == "new" else F.lit("")).alias("new_name"))

    # Only files that both lost and gained names need matching, and only those columns.
    unclear = pairs.where((F.size("gone") > 0) & (F.size("new") > 0)).join(apart_names(schemas), "family", "left").select("id", "gone", "new", "apart")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def columns(cols: list) -> dict[str, dict]:
            def clean(c: dict) -> dict:
                number = lambda x: None if x is None or x != x else float(x)
                hist = [(h["b"], h["n"]) for h in c["hist"]] if c["hist"] is not None else []
                return {"name": c["name"], "n": int(number(c["n"]) or 0), "kind": c["kind"], "hist": hist, "mean": number(c["mean"]), "sd": number(c["sd"]) or 0.0, "len": number(c["len"]) or 0.0}

            return {c["name"]: clean(c) for c in cols}

        for batch in batches:
            out = []
            for key, gone, new, apart in zip(batch["id"], batch["gone"], batch["new"], batch["apart"]):
                out += [(key, *x) for x in compare(columns(gone), columns(new), {(p["a"], p["b"]) for p in apart} if apart is not None else set())]
            yield pd.DataFrame(out, columns=["id", "kind", "old_name", "new_name"])

    matched = unclear.mapInPandas(run, f"id {schemas.schema['id'].dataType.simpleString()}, kind string, old_name string, new_name string")
    return retyped.unionByName(change("removed", "gone")).unionByName(change("added", "new")).unionByName(matched)


def canonical_names(schemas: DataFrame, changes: DataFrame) -> DataFrame:
    """(family, name, canonical): names joined by renames anywhere in a family share the name most files bear.

    Renames are applied from the most frequent on; one that would join two names standing side by side is left out.
    One task handles one family's vocabulary of names, whose size is that of its schema, not of its files.
    """
    uses = schemas.select("family", F.explode("cols").alias("c")).groupBy("family", F.col("c.name").alias("a")).agg(F.count(F.lit(1)).alias("n")).withColumn("b", F.col("a"))
    edges = changes.where("kind = 'renamed'").join(schemas.select("id", "family"), "id").groupBy("family", F.col("old_name").alias("a"), F.col("new_name").alias("b")).agg(F.count(F.lit(1)).alias("n"))
    apart = apart_names(schemas).select("family", F.explode("apart").alias("p")).select("family", F.lit(-1).cast("long").alias("n"), "p.a", "p.b")
    fields = ["family", "a", "b", "n"]

    def join(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["n", "a", "b"], ascending=[False, True, True])
        own = rows[(rows["a"] == rows["b"]) & (rows["n"] > 0)]
        size = dict(zip(own["a"], own["n"]))
        group = {x: {x} for x in size}
        barred = {(a, b) for a, b, n in zip(rows["a"], rows["b"], rows["n"]) if n < 0}
        for a, b, n in zip(rows["a"], rows["b"], rows["n"]):
            if n < 0 or a == b or a not in group or b not in group or group[a] is group[b]:
                continue
            if not any((min(x, y), max(x, y)) in barred for x in group[a] for y in group[b]):
                both = group[a] | group[b]
                group |= dict.fromkeys(both, both)
        best = {x: max(g, key=lambda y: (size[y], y)) for x, g in group.items()}
        return pd.DataFrame({"family": [rows["family"].iloc[0]] * len(best), "name": list(best), "canonical": list(best.values())})

    every = uses.select(*fields).unionByName(edges.select(*fields)).unionByName(apart.select(*fields)).where("family is not null")
    return every.groupBy("family").applyInPandas(join, "family string, name string, canonical string")


def unify(records: DataFrame, schemas: DataFrame, canonical: DataFrame) -> DataFrame:
    """(id, line_no, feed, family, record): every valid record under its family's canonical names.

    Entries are trimmed text; empty entries and NA become null. Project columns with ``record['name']``.
    """
    names = canonical.groupBy("family").agg(F.map_from_entries(F.collect_list(F.struct("name", "canonical"))).alias("as"))
    maps = schemas.select("id", "feed", "family").join(names, "family")
    clean = lambda v: F.when(~F.lower(F.trim(v)).isin(*EMPTY), F.trim(v))
    pairs = F.transform(F.arrays_zip("names", "fields"), lambda c: F.struct(F.coalesce(F.try_element_at("as", c["names"]), c["names"]).alias("k"), clean(c["fields"]).alias("v")))
    once = F.filter(pairs, lambda p: p["k"].isNotNull())
    firsts = F.filter(once, lambda p, i: F.array_position(F.transform(once, lambda q: q["k"]), p["k"]) == i + 1)
    return records.join(maps, "id").select("id", "line_no", "feed", "family", F.map_from_entries(firsts).alias("record"))


def column_types(schemas: DataFrame, canonical: DataFrame, text_share: float = 0.02) -> list:
    """Rows (family, name, type) of every canonical column: text if files with ``text_share`` of its entries hold text, else
    the narrowest of boolean, bigint and double that takes the others. One row per name of the vocabulary reaches the driver.
    """
    cols = schemas.select("family", F.explode("cols").alias("c")).select("family", "c.name", "c.kind", "c.n").join(canonical, ["family", "name"])
    n = lambda *kinds: F.coalesce(F.sum(F.when(F.col("kind").isin(*kinds), F.col("n"))), F.lit(0))
    every = n("whole", "decimal", "yes_no", "text")
    kind = F.when((n("text") > text_share * every) | (every == 0), "string").when(n("decimal") > 0, "double").when(n("whole") >= n("yes_no"), "bigint").otherwise("boolean")
    return cols.groupBy("family", F.col("canonical").alias("name")).agg(kind.alias("type")).orderBy("family", "name").collect()


def typed_table(unified: DataFrame, types: list, family: str) -> DataFrame:
    """(id, line_no, one typed column per name, misfits) of a family's unified records.

    An entry that is not of its column's type is null there and kept in ``misfits`` (name -> entry), so nothing is lost.
    """
    mine = [(r["name"], r["type"]) for r in types if r["family"] == family]
    entry = lambda name: F.col("record")[name]
    words = F.create_map(*[F.lit(x) for w in YES_NO for x in (w, w[0] in "ty")])
    typed = {name: entry(name) if kind == "string" else words[F.lower(entry(name))] if kind == "boolean" else entry(name).try_cast(kind) for name, kind in mine}
    misfit = [F.when(typed[name].isNull() & entry(name).isNotNull(), F.struct(F.lit(name).alias("k"), entry(name).alias("v"))) for name, kind in mine if kind != "string"]
    misfits = F.map_from_entries(F.array_compact(F.array(*misfit))) if misfit else F.lit(None).cast("map<string,string>")
    # A column may bear the name of a key; keys go by their position first.
    return unified.where(F.col("family") == family).select("id", "line_no", *[c.alias(n) for n, c in typed.items() if n not in ("id", "line_no", "misfits")], misfits.alias("misfits"))
