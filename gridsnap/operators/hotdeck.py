"""Nearest-neighbour hot-deck filling of missing entries from similar records of the same group.

Records are hashed into blocks of (root key, time cell) and compared on mixed features:

1. *Near*: a time cell spans ``cell`` consecutive order values. Every missing entry is compared with the valid entries of its own
   group in its cell and the two beside it, so no record within ``cell`` of it is out of sight, by a Gower-type distance over the
   mixed features both records show plus their gap in order. A block holds at most ``cell`` different donors however large the root
   group is; a root with a third of all rows is spread over as many blocks as it has cells.
2. *Group*: entries without a donor there look into cells that grow level by level, each offering the first and last donor of
   every cell below, so that no block grows and the nearest donors before and after are always compared.

The ``k`` closest donate their weighted majority (categorical) or weighted median (numeric) value, and are named.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridsnap.plans.cuts import cut


@dataclass(frozen=True)
class Fill:
    """One field to fill.

    name: the column. kind: ``cat`` or ``num``. valid: a condition on the frame's columns that a usable entry meets
    (null counts as no). within: columns that, with the root, make the group donors must share.
    """

    name: str
    kind: str
    valid: Column
    within: tuple[str, ...] = ()


@dataclass(frozen=True)
class Deck:
    """root and order identify a record; features: name -> (``cat``, weight) or (``num``, weight, scale)."""

    root: str
    order: str
    fills: tuple[Fill, ...]
    features: dict[str, tuple] = field(default_factory=dict)
    cell: int = 32
    k: int = 5


def _group_key(f: Fill, deck: Deck) -> Column:
    """Text key of the field's group below the root; null if any part is null."""
    parts = [F.col(c).cast("string") for c in f.within]
    return F.concat(F.lit(""), *[F.concat(p, F.lit("|")) for p in parts])


def _records(df: DataFrame, deck: Deck) -> DataFrame:
    """One narrow row per input row: root, order, cell, features f0.., groups g0.., valid entries v0.. (null if missing)."""
    kinds = {"cat": "string", "num": "double"}
    cols = [F.col(deck.root).alias("r"), F.col(deck.order).cast("long").alias("o")]
    cols += [F.col(n).cast(kinds[s[0]]).alias(f"f{i}") for i, (n, s) in enumerate(deck.features.items())]
    for i, f in enumerate(deck.fills):
        cols += [_group_key(f, deck).alias(f"g{i}"), F.when(f.valid, F.col(f.name).cast(kinds[f.kind])).alias(f"v{i}")]
    out = df.select(*cols).where(F.col("r").isNotNull() & F.col("o").isNotNull())
    return out.withColumn("cell", F.floor(F.col("o") / deck.cell))


def _distance(deck: Deck) -> Column:
    """Gower-type distance of ``x`` and ``d``; a feature missing on either side drops out of numerator and denominator."""
    num, den = [], []
    for i, spec in enumerate(deck.features.values()):
        a, b, w = F.col(f"x.f{i}"), F.col(f"d.f{i}"), float(spec[1])
        gap = (a != b).cast("double") if spec[0] == "cat" else F.least(F.abs(a - b) / F.lit(float(spec[2])), F.lit(1.0))
        num.append(F.coalesce(gap * w, F.lit(0.0)))
        den.append(F.when(gap.isNotNull(), w).otherwise(0.0))
    num.append(F.abs(F.col("x.o") - F.col("d.o")) / F.lit(float(deck.cell)))
    den.append(F.lit(1.0))
    return reduce(lambda p, q: p + q, num) / reduce(lambda p, q: p + q, den)


def _near(df: DataFrame, deck: Deck) -> DataFrame:
    """A row (r, o, i, g, donors) per missing entry with a known group; donors: the k closest of its cell and the two beside it, maybe none.

    A record is filed as a donor in its own cell only; the few that lack an entry also visit the cells beside it, and what
    they find there is put together by their key.
    """
    rows = _records(df, deck)
    names = [c for c in rows.columns if c not in ("r", "cell")]
    lacks = lambda s, i: s[f"v{i}"].isNull() & s[f"g{i}"].isNotNull()
    every = range(len(deck.fills))
    missing = reduce(lambda p, q: p | q, [F.col(f"v{i}").isNull() & F.col(f"g{i}").isNotNull() for i in every])
    filed = rows.select("*", missing.alias("lacks"), F.explode(F.when(missing, F.array(F.lit(0), F.lit(-1), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("step"))
    # collect_set drops repeated rows on the map side already; donors are bounded by the cell's width, visitors by two cells'.
    record = F.struct(*names)
    blocks = filed.groupBy("r", (F.col("cell") + F.col("step")).alias("at")).agg(F.collect_set(F.when(F.col("step") == 0, record)).alias("recs"), F.collect_set(F.when(F.col("lacks"), record)).alias("x")).where("size(x) > 0")
    # A null donor keeps a recipient that finds nobody.
    pairs = blocks.select("r", "at", F.explode("x").alias("x"), "recs").select("r", "at", "x", F.explode(F.concat("recs", F.array(F.lit(None)))).alias("d"))

    def match(i: int) -> Column:
        own = F.col("d.o").isNull() | ((F.col(f"x.g{i}") == F.col(f"d.g{i}")) & F.col(f"d.v{i}").isNotNull() & (F.col("x.o") != F.col("d.o")))
        return lacks(F.col("x"), i) & own

    def found(i: int) -> Column:
        return F.when(match(i), F.struct(F.lit(i).alias("i"), F.col(f"x.g{i}").alias("g"), F.col(f"d.v{i}").cast("string").alias("v")))

    # Matches are built, and distances taken, only of pairs that share a group one of them lacks an entry of.
    each = pairs.where(reduce(lambda p, q: p | q, [match(i) for i in every]))
    each = each.select("r", "at", F.col("x.o").alias("o"), F.array_compact(F.array(*[found(i) for i in every])).alias("ms"), F.when(F.col("d.o").isNotNull(), F.struct(_distance(deck).alias("dist"), F.col("d.o").alias("donor"))).alias("d"))
    each = each.select("r", "at", "o", "d", F.explode("ms").alias("m"))
    each = each.select("r", "at", "o", F.col("m.i").alias("i"), F.col("m.g").alias("g"), F.when(F.col("d").isNotNull(), F.struct("d.dist", "d.donor", "m.v")).alias("d"))
    closest = lambda lists: F.slice(F.array_sort(lists), 1, deck.k)
    here = each.groupBy("r", "at", "o", "i", "g").agg(closest(F.collect_list("d")).alias("donors"))
    return here.groupBy("r", "o", "i", "g").agg(closest(F.flatten(F.collect_list("donors"))).alias("donors"))


#: Most entries without a near donor whose keys and groups are sent to every task; beyond, their records are found by a shuffle.
BROADCAST_ENTRIES = 100_000


def _far(rows: DataFrame, rest: DataFrame, deck: Deck) -> DataFrame:
    """Donors of the entries ``rest`` (r, o, i, g) that their own and the neighbouring cells lack.

    Level by level cells grow ``cell`` times as wide. A cell offers, of every cell of the level below and every group, the
    first and the last donor, so it holds at most 2 x ``cell`` of them and the nearest before and after a recipient are among them. An entry
    is settled at the first level at which it finds a donor in its cell or those beside it.
    """
    many = rest.count()
    if not many:
        return rest.select("r", "o", "i", "g", F.expr("cast(array() as array<struct<dist:double,donor:bigint,v:string>>)").alias("donors"))
    small = lambda df: F.broadcast(df) if many <= BROADCAST_ENTRIES else df
    groups, keys = small(rest.select("r", "i", "g").distinct()), small(rest.select("r", "o").distinct())
    features = [f"f{i}" for i in range(len(deck.features))]
    each = F.explode(F.array_compact(F.array(*[F.when(F.col(f"v{i}").isNotNull() & F.col(f"g{i}").isNotNull(), F.struct(F.lit(i).alias("i"), F.col(f"g{i}").alias("g"), F.col(f"v{i}").cast("string").alias("v"))) for i in range(len(deck.fills))]))).alias("m")
    donors = rows.select("r", "o", *features, each).select("r", "o", *features, "m.*").join(groups, ["r", "i", "g"], "left_semi")
    wants = rest.join(rows.select("r", "o", *features).join(keys, ["r", "o"], "left_semi").dropDuplicates(["r", "o"]), ["r", "o"])
    ends = donors.agg(F.min("o").alias("lo"), F.max("o").alias("hi")).first()
    reach = max(abs(ends["lo"] or 0), abs(ends["hi"] or 0))
    width, out = deck.cell, None
    held = lambda w: donors.groupBy("r", "i", "g", F.floor(F.col("o") / w).alias("c")).agg(F.min(F.struct("o", "v", *features)).alias("lo"), F.max(F.struct("o", "v", *features)).alias("hi"))
    while True:
        donors = cut(held(width).select("r", "i", "g", F.explode(F.array_distinct(F.array("lo", "hi"))).alias("d")).select("r", "i", "g", "d.*"))
        width *= deck.cell
        near = wants.withColumn("c", F.explode(F.array(*[F.floor(F.col("o") / width) + s for s in (-1, 0, 1)]))).alias("x").join(donors.withColumn("c", F.floor(F.col("o") / width)).alias("d"), ["r", "i", "g", "c"]).where("x.o <> d.o")
        found = near.groupBy("r", F.col("x.o").alias("o"), "i", "g").agg(F.slice(F.array_sort(F.collect_list(F.struct(_distance(deck).alias("dist"), F.col("d.o").alias("donor"), F.col("d.v").alias("v")))), 1, deck.k).alias("donors"))
        found = cut(found)
        out = found if out is None else out.unionByName(found)
        # Three cells of a width beyond every order value hold all donors.
        if width > reach:
            return out
        wants = cut(wants.join(found.select("r", "o", "i"), ["r", "o", "i"], "left_anti"))
        if wants.isEmpty():
            return out


def _vote(deck: Deck) -> Column:
    """The donors' weighted majority or weighted median value as text; weights 1/(0.05 + distance); ties go to the closest."""
    cats = [i for i, f in enumerate(deck.fills) if f.kind == "cat"]
    w = lambda d: 1.0 / (d["dist"] + 0.05)
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, d: s + w(d))
    votes = F.transform("donors", lambda d: F.struct(total(F.filter("donors", lambda e: e["v"] == d["v"])).alias("w"), (-d["dist"]).alias("n"), d["v"].alias("v")))
    ranked = F.array_sort(F.transform("donors", lambda d: F.struct(d["v"].cast("double").alias("n"), w(d).alias("w"), d["v"].alias("v"))))
    zero = F.struct(F.lit(0.0).alias("s"), F.lit(None).cast("string").alias("v"))
    half = total(F.col("donors")) / 2
    median = F.aggregate(ranked, zero, lambda s, d: F.struct((s["s"] + d["w"]).alias("s"), F.when(s["v"].isNull() & (s["s"] + d["w"] >= half), d["v"]).otherwise(s["v"]).alias("v")))["v"]
    return F.when(F.col("i").isin(cats), F.array_max(votes)["v"]).otherwise(median)


def hot_deck(df: DataFrame, deck: Deck) -> DataFrame:
    """Fill values for every missing entry that other records of its group support.

    Returns one row (root, order, field, value text, source ``near`` or ``group``, donors array of order values) per
    record and field. An entry is missing if it is null, NaN or not ``valid``; it is filled if a record of the same
    group with another order value holds a valid one. Records whose root, order or group column is null are left alone:
    they belong to no group. Repeated rows count once; if rows of one key disagree, a key whose any row lacks the entry
    is a recipient. Ties between values go to the closest donor, then to the larger text. Input columns may have
    any other names; empty input gives an empty result.
    """
    near = cut(_near(df, deck))
    rest = near.where("size(donors) = 0").select("r", "o", "i", "g")
    far = _far(_records(df, deck), rest, deck)
    named = lambda df, source: df.select("r", "o", "i", _vote(deck).alias("value"), F.lit(source).alias("source"), F.transform("donors", lambda d: d["donor"]).alias("donors"))
    names = F.array(*[F.lit(f.name) for f in deck.fills])
    out = named(near.where("size(donors) > 0"), "near").unionByName(named(far, "group"))
    return out.select(F.col("r").alias(deck.root), F.col("o").alias(deck.order), F.element_at(names, F.col("i") + 1).alias("field"), "value", "source", "donors")


def apply_fills(df: DataFrame, deck: Deck, fills: DataFrame) -> DataFrame:
    """``df`` with filled columns, a ``<name>_filled`` flag and ``<name>_donors`` for each field; other entries untouched.

    A frame that already has columns of those names gets them replaced. If rows of one key disagree, only those that lack the
    entry are filled.
    """
    lacks = lambda f: ~F.coalesce(f.valid, F.lit(False))
    any_ = reduce(lambda p, q: p | q, [lacks(f) for f in deck.fills])
    types = {s.name: s.dataType for s in df.schema.fields}
    wide = fills.groupBy(F.col(deck.root).alias("__r"), F.col(deck.order).alias("__o")).agg(
        *[F.max(F.when(F.col("field") == f.name, F.struct("value", "donors"))).alias(f"__{f.name}") for f in deck.fills]
    )
    out = df.where(any_).join(wide, (F.col(deck.root) == F.col("__r")) & (F.col(deck.order).cast("long") == F.col("__o")), "left")
    new = {}
    for f in deck.fills:
        got = F.when(lacks(f), F.col(f"__{f.name}"))
        value = got["value"] if isinstance(types[f.name], T.StringType) else (F.round(got["value"].cast("double")) if isinstance(types[f.name], T.IntegralType) else got["value"]).cast(types[f.name])
        new |= {f.name: F.when(got.isNotNull(), value).otherwise(F.col(f.name)), f"{f.name}_filled": got.isNotNull(), f"{f.name}_donors": got["donors"]}
    out = out.withColumns(new).drop("__r", "__o", *[f"__{f.name}" for f in deck.fills])
    # Rows that hold every entry, most of a table, pass by the join.
    whole = {f"{f.name}_filled": F.lit(False) for f in deck.fills} | {f"{f.name}_donors": F.lit(None).cast("array<bigint>") for f in deck.fills}
    return out.unionByName(df.where(~any_).withColumns(whole))
