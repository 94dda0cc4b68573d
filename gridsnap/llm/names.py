"""Variant spellings of typed names: which rows are one person, which spellings are one club.

People and clubs go through one pipeline. Every token is filed, within its block (the team), in a symmetric-delete
neighbourhood index: under what is left of its first ``PREFIX`` letters without up to two of them, so tokens within a small
edit distance meet under a common key without comparing all pairs. Entries that hold tokens so close, or that stand for one
name, and whose other tokens may begin alike, are candidates, which leaves out no pair that the judge accepts; it aligns their
tokens by an optimal assignment that permits typing errors, initials, abbreviations and nicknames. Accepted pairs form components, contracted block by block and, where a block is
spread over several tasks, by repeated joins; inside a component, rows that cannot be one (other club and other number, or two
established names) are found among all its pairs and kept apart by merging in the order of evidence.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridsnap.llm.text import fold
from gridsnap.operators.drift import assign
from gridsnap.plans.cuts import cut

# Particles, titles and suffixes of names; words of clubs that name no club; empty entries.
PARTICLES = frozenset("van von de del della der den di da du dos al el la le ter ten bin ibn zu".split())
GLUED = re.compile(rf"\b({'|'.join(x for p in sorted(PARTICLES) for x in (p, p.capitalize()))})(?=([^\W\d_])\w)")
TITLES = frozenset("jr sr ii iii iv mr mrs ms dr captain capt".split())
CLUB_WORDS = frozenset("club flag football team verein klub of the ev".split())
CLUB_MARKS = frozenset("fc ff sc sv tsv afc ffc".split())
NO_CLUB = ("", "-", "--", "n/a", "na", "none", "null", "nil", "no club", "unattached", "free agent", "unknown", "?", "no team", "without club", "independent", "tbd", "x", ".")
#: Share of the rows from which a token counts as a name of its own, so that two of them are two people.
NAME_SHARE = 1 / 400
#: Share of the entries from which a token counts as one that serves everyone.
COMMON_SHARE = 1 / 1000
#: A token close to another is a name of its own if the block holds both repeatedly, the rarer at least so often.
RIVAL_SHARE = 1 / 5
#: Mark of a club's initials in the index.
INITIALS = "\u00a7"
#: Share of a nickname's quoted uses from which a full name counts as one it stands for.
FORM_SHARE = 1 / 50
#: Letters of a token that the index files; edits beyond them are found by what stands before.
PREFIX = 8


def distance(a: str, b: str, most: int = 3) -> int:
    """Edit distance with swaps of neighbours as one edit; ``most`` + 1 if it is larger."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    two, one = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            d = min(one[j] + 1, row[j - 1] + 1, one[j - 1] + (x != y))
            if two is not None and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, two[j - 2] + 1)
            row.append(d)
        if min(row) > most:
            return most + 1
        two, one = one, row
    return min(one[-1], most + 1)


def edits_allowed(token: str) -> int:
    return 0 if len(token) < 3 else 1 if len(token) < 5 else 2


def deletes(token: str, most: int | None = None) -> set[str]:
    """The token's first letters, and what is left of them without up to ``most`` (by default: as its length allows).

    Two tokens at most ``most`` edits apart share such a key whatever their lengths: of the letters that the prefixes do not
    share, neither side has more than there are edits.
    """
    out = layer = {token[:PREFIX]}
    for _ in range(edits_allowed(token) if most is None else most):
        layer = {t[:i] + t[i + 1 :] for t in layer if len(t) > 1 for i in range(len(t))}
        out = out | layer
    return out


def name_keys(token: str) -> set[str]:
    """Index keys of a token: of the whole, closed up, and of each part of a double name. Initials of clubs are filed as they are."""
    if token.startswith(INITIALS):
        return {token}
    parts = token.split("-")
    return set().union(*(deletes(p) for p in {"".join(parts), *(p for p in parts if len(p) > 3 and len(parts) > 1)}))


def person_tokens(name: str | None) -> tuple[list[str], str]:
    """(tokens, quoted nickname or ''): given names first, without titles, particles and marks; double names keep a hyphen.

    ``Last, First`` is turned round; initials stay as single letters.
    """
    if not name:
        return [], ""
    name = GLUED.sub(lambda m: f"{m[1]} " if m[2].isupper() else m[1], name)
    quoted = re.search(r"[\"“”'‘’]([^\"“”'‘’]{2,})[\"“”'‘’](?=\s)", name)
    nick = re.sub(r"[^\w]", "", fold(quoted[1])) if quoted else ""
    if quoted:
        name = name.replace(quoted[0], " ")
    name = re.sub(r"\([^()]*\)|[*#]", " ", name)
    # What follows a dash is a remark, if a whole name stands before it.
    before = re.split(r"\s-\s", name)[0]
    name = before if len(before.split()) > 1 else name
    if "," in name:
        last, _, first = name.partition(",")
        name = f"{first} {last}" if fold(first).strip(" .") not in TITLES else last
    tokens = [re.sub(r"[^\w-]|[_0-9]", "", t).strip("-") for t in re.split(r"[\s.]+", fold(name))]
    return [t for t in tokens if t and t not in PARTICLES and t not in TITLES], nick


def club_tokens(club: str | None) -> tuple[list[str], bool]:
    """(tokens, whether they are mere initials) of a club's spelling without words like FC; initials are one token."""
    if not club:
        return [], False
    spaced = re.sub(r"(?<=[a-zà-ÿ])(?=[A-Z][a-zà-ÿ])", " ", re.sub(r"[(),/_\-]", " ", club))
    raw = [t for t in spaced.split() if re.search(r"\w", t)]
    tokens = [re.sub(r"[\W_]", "", fold(t)) for t in raw]
    every = [(r, t) for r, t in zip(raw, tokens) if t]
    named = [(r, t) for r, t in every if t not in CLUB_WORDS] or every
    kept = [(r, t) for r, t in named if t not in CLUB_MARKS] or named
    if len(kept) == 1:
        r, t = kept[0]
        return [t], len(t) <= 4 and (r.isupper() or "." in r.strip(".") or len(t) <= 2)
    if kept and all(len(t) == 1 for _, t in kept):
        return ["".join(t for _, t in kept)], True
    return [t for _, t in kept], False


def _best(grid: list[list[float]]) -> tuple[int, ...]:
    """The partner of each row in a maximum-weight assignment of rows to columns; there are no more rows than columns."""
    n, m = len(grid), len(grid[0])
    if n * m > 12:
        # Every pair weighs something, so that the assignment is complete.
        return tuple(j for _, j in assign(np.asarray(grid) + 1e-6))
    return max(itertools.permutations(range(m), n), key=lambda places: sum(grid[i][j] for i, j in enumerate(places)))


def token_match(a: dict, b: dict, apart: bool = True) -> float:
    """0 to 1: the same token 1, a typing error less, a nickname, abbreviation or initial still less.

    a and b: t (the token), known (a full name for certain), forms (names it may stand for), shorts (short forms of it). With
    ``apart`` two known names are two names even if one edit apart, and so are names of two letters.
    """
    parts = a["t"].split("-"), b["t"].split("-")
    x, y = "".join(parts[0]), "".join(parts[1])
    if x == y:
        return 1.0
    if (len(parts[0]) > 1) != (len(parts[1]) > 1) and any(len(min(p, q, key=len)) >= 4 and distance(p, q, 1) <= 1 for p in parts[0] for q in parts[1]):
        return 0.8
    if set(a["forms"]) & set(b["forms"]):
        return 0.85
    short, long = sorted((x, y), key=len)
    if len(short) == 1:
        return 0.55 if any(f[0] == short for f in (long, *a["forms"], *b["forms"]) if len(f) > 1) else 0.0
    two = apart and a["known"] and b["known"]
    d = distance(x, y, 2)
    if not two and d <= (1 if len(short) <= 4 else 2) and d < len(short) - (1 if apart else 0):
        return 0.92 if d == 1 else 0.8
    if len(short) >= 3 and len(long) > len(short) and (long.startswith(short) or long.endswith(short)):
        return 0.7
    near = next((f for f in (*a["forms"], *b["forms"]) if f not in (x, y) and distance(f, y if f in a["forms"] else x, 1) <= 1), None)
    if near and not two:
        return 0.75
    # A short form mistyped.
    return 0.75 if any(len(s) > (3 if apart else 2) and len(other) > 2 and distance(s, other, 1) <= 1 for shorts, other in ((a["shorts"], y), (b["shorts"], x)) for s in shorts) else 0.0


def rivals(x: dict, y: dict) -> bool:
    """Whether the block's entries use both tokens repeatedly and none far less, so that neither is a typing error of the other."""
    few, many = sorted((x["n"], y["n"]))
    return few > 1 and few >= RIVAL_SHARE * many and ("-" in x["t"]) == ("-" in y["t"]) and not set(x["forms"]) & set(y["forms"])


def same_person(a: list[dict], b: list[dict], agree: bool = False) -> tuple[float, str]:
    """(score, rel) of two names' tokens: score above 0 if they may be one person; rel ``apart`` if they are surely two, ``far``
    if their surnames differ by more than one typing error.

    The longest token is the surname and must agree up to typing errors, one of two letters exactly; of the others the shorter
    name's must all find a partner under the best assignment, initials of middle names apart. Given names that do not match
    are a conflict only if both are known names: one of them may else be a short form that the table of aliases lacks.
    agree: the numbers agree, so two known names one edit apart may be a typing error. Close surnames of which each stands in
    several entries of the block (n) are one only if the numbers or other rare names agree.
    """
    if not a or not b:
        return 0.0, ""
    if len(a) > len(b):
        a, b = b, a
    grid = [[token_match(x, y, not agree) for y in b] for x in a]
    chosen = _best([[g * (1 + len(x["t"]) / 50) for g in row] for x, row in zip(a, grid)])
    matched = [(x, b[j], grid[i][j]) for i, (x, j) in enumerate(zip(a, chosen))]
    shorter = lambda m: min(len(m[0]["t"]), len(m[1]["t"]))
    surname = max(matched, key=lambda m: (m[2] >= (0.8 if shorter(m) > 2 else 1.0)) * max(len(m[0]["t"]), len(m[1]["t"])))
    if surname[2] < (0.8 if shorter(surname) > 2 else 1.0) or shorter(surname) < 2:
        return 0.0, ""
    close = [m for m in matched if m[2] >= 0.8 and shorter(m) > 1 and not (m[0]["common"] and m[1]["common"])]
    if not agree and surname[2] < 1.0 and all(rivals(*m[:2]) for m in (surname, *close)):
        return 0.0, ""
    far = "far" if surname[2] < 0.9 and "-" not in surname[0]["t"] + surname[1]["t"] else ""
    others = [m for m in matched if m is not surname]
    # A name that serves everyone says nothing against two entries if what should be the surname found no partner.
    mere = surname[0]["common"] and surname[1]["common"]
    full = [m for m in others if len(m[0]["t"]) > 1 and len(m[1]["t"]) > 1]
    if any(m[2] == 0 and len(m[0]["t"]) > 1 and len(m[1]["t"]) > 1 for m in others):
        sure = all(m[0]["known"] and m[1]["known"] for m in full if m[2] == 0)
        return 0.0, "apart" if sure and not mere else ""
    if any(m[2] == 0 for m in others):
        both = all(len(m[0]["t"]) == 1 and len(m[1]["t"]) == 1 for m in others if m[2] == 0)
        given = [m for m in others if m[2] > 0]
        # Initials that differ: of middle names if a given name agrees, which weighs little, else of the given name itself.
        if given and max(m[2] for m in given) >= 0.8:
            return 0.8 * surname[2] * max(m[2] for m in given), far
        return 0.0, "apart" if (both or not given) and not mere else ""
    if not others:
        return 0.0, ""
    unpaired = [y for j, y in enumerate(b) if j not in chosen]
    # A half of a double name that the other name writes with a hyphen is no name of its own.
    halves = [p for t in (*a, *b) if "-" in t["t"] for p in t["t"].split("-")]
    if any(len(y["t"]) > 1 and not any(distance(y["t"], p, 1) <= 1 for p in halves) for y in unpaired) and not full:
        return 0.0, ""
    return surname[2] * max(m[2] for m in others), far


def same_club(a: list[dict], a_initials: bool, b: list[dict], b_initials: bool) -> tuple[str, int] | None:
    """(``strong``, 0) for two full spellings of one club, (``a`` or ``b``, edits) where that one may be short for the other, else None.

    Two different words that each serve many clubs are no typing error of each other.
    """
    known = {t["t"] for t in (*a, *b) if t["known"]}
    a, b = [t["t"] for t in a], [t["t"] for t in b]

    def edits(x: str, y: str) -> int | None:
        if x == y:
            return 0
        short = len(min(x, y, key=len))
        d = 3 if short < 4 or (x in known and y in known) else distance(x, y, 2)
        return d if d <= (1 if short < 7 else 2) else None

    near = lambda x, y: edits(x, y) is not None
    if a_initials or b_initials:
        if a_initials and b_initials:
            return ("strong", 0) if a[0] == b[0] else None
        (short, long), side = ((a, b), "a") if a_initials else ((b, a), "b")
        return (side, 0) if len(long) > 1 and short[0] == "".join(t[0] for t in long) else None
    if len(a) == 1 or len(b) == 1:
        if len(a) == len(b):
            return ("strong", 0) if (edits(a[0], b[0]) or 0) <= 1 and near(a[0], b[0]) else None
        (short, long), side = ((a, b), "a") if len(a) == 1 else ((b, a), "b")
        if near(short[0], "".join(long)):
            return "strong", 0
        fit = min((d for t in long if (d := edits(short[0], t)) is not None), default=None)
        return None if fit is None else (side, fit)
    if len(a) != len(b):
        return ("strong", 0) if near("".join(a), "".join(b)) else None
    cut_short = lambda x, y: x != y and (x.startswith(y) or y.startswith(x))
    places = _best([[1.0 if near(x, y) else 0.01 if cut_short(x, y) else 0.0 for y in b] for x in a])
    odd = [(x, b[j]) for x, j in zip(a, places) if not near(x, b[j])]
    if not odd:
        return "strong", 0
    if len(odd) == 1 and cut_short(*odd[0]):
        return "a" if len(odd[0][0]) < len(odd[0][1]) else "b", sum(edits(x, b[j]) or 0 for x, j in zip(a, places))
    return ("strong", 0) if min(len(t) for pair in odd for t in pair) > 2 and distance("".join(a), "".join(b), 1) <= 1 else None


def index_entries(kind: str, tokens: list[dict], initials: bool) -> list[tuple[str, list[str], list[str]]]:
    """(token, left marks, right marks) under which an entry looks for others; two entries meet where close tokens share a mark.

    The marks of a token say how each other token begins and ends, with the names it may stand for; the first letters are also
    filed loosely (any of three), as they may be mistyped. Of tokens that match, one mark at least is the same, so every token is
    filed under the marks of all others: only a person's initials are not, as no surname is one. A club's single words and
    initials meet full spellings on marks of their own, so that full spellings that share a word do not meet there.
    """
    words = [t["t"] for t in tokens]
    if kind == "C" and (initials or len(words) == 1):
        return [(INITIALS + words[0] if initials else words[0], ["1", "3"], ["2", "3"])]
    out: dict[str, tuple[set, set]] = {}
    for i, t in enumerate(words):
        if kind == "P" and len(t) == 1:
            continue
        pair = out.setdefault(t, (set(), set()))
        for j, other in enumerate(tokens):
            if j != i:
                names = {other["t"], *other["forms"], *(other["t"].split("-") if kind == "P" else ())}
                whole = other["t"].replace("-", "")
                marks = {f[0] for f in names if f} | ({"$" + whole[-3:]} if len(whole) > 2 else set()) | {"~" + c for f in (*names, *other["shorts"]) for c in f[:3]}
                pair[0].update(marks)
                pair[1].update(marks)
    if kind == "C":
        for t in words:
            pair = out.setdefault(t, (set(), set()))
            pair[0].add("2")
            pair[1].add("1")
        for t in ("".join(words), INITIALS + "".join(t[0] for t in words)):
            pair = out.setdefault(t, (set(), set()))
            pair[0].update("2" if t.startswith(INITIALS) else "23")
            pair[1].update("1" if t.startswith(INITIALS) else "13")
    return [(t, sorted(left), sorted(right)) for t, (left, right) in out.items() if left or right]


def components(edges: DataFrame) -> DataFrame:
    """(id, comp) of every id on an edge (blk, a, b): the least id reachable over edges.

    Edges are gathered by block as far as adaptive execution finds fit (a large block is spread over tasks) and contracted
    in each task; only if an id then has several roots, rounds of neighbour minima and label jumps follow. The driver sees
    one flag per round.
    """

    def contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[str, str] = {}

        def root(x: str) -> str:
            while parent.setdefault(x, x) != x:
                parent[x] = x = parent[parent[x]]
            return x

        for batch in batches:
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
                a, b = root(a), root(b)
                if a != b:
                    parent[max(a, b)] = min(a, b)
        ids = list(parent)
        for at in range(0, len(ids), 10_000):
            part = ids[at : at + 10_000]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), pa.array([root(x) for x in part], pa.string())], ["id", "comp"])

    stars = edges.select("blk", "a", "b").hint("rebalance", "blk").mapInArrow(contract, "id string, comp string")
    labels = cut(stars.groupBy("id").agg(F.min("comp").alias("comp"), F.max("comp").alias("other")))
    if labels.where("comp <> other").isEmpty():
        return labels.select("id", "comp")
    # min and max link all roots of an id only in pairs; every star edge is kept for the rounds.
    return spread(cut(stars.select(F.col("id").alias("a"), F.col("comp").alias("b"))))


def spread(edges: DataFrame) -> DataFrame:
    """(id, comp) over edges (a, b) by repeated joins: each round takes the neighbours' least label, then the label's label."""
    both = cut(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels, moved = both.groupBy(F.col("a").alias("id")).agg(F.min(F.least("a", "b")).alias("comp")), True
    while moved:
        near = both.join(labels, F.col("b") == F.col("id")).groupBy(F.col("a").alias("n")).agg(F.min("comp").alias("low"))
        step = labels.join(near, F.col("id") == F.col("n")).select("id", F.col("comp").alias("was"), F.least("comp", "low").alias("comp"))
        old = labels.select(F.col("id").alias("r"), F.col("comp").alias("rc"))
        jump = cut(step.join(old, F.col("comp") == F.col("r"), "left").select("id", "was", F.least("comp", F.coalesce("rc", "comp")).alias("comp")))
        moved = not jump.where("was <> comp").isEmpty()
        labels = jump.select("id", "comp")
    return labels


def parsed(entries: DataFrame) -> DataFrame:
    """Rows (kind, block, node, text, number, c) with their text's tokens and mark: a nickname, or ``initials`` of a club."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            got = [person_tokens(x) if kind == "P" else club_tokens(x) for kind, x in zip(batch["kind"], batch["text"])]
            mark = [m if isinstance(m, str) else "initials" if m else "" for _, m in got]
            yield batch[["kind", "block", "node", "number", "c"]].assign(tokens=[t for t, _ in got], mark=mark)

    return entries.mapInPandas(run, "kind string, block string, node string, number bigint, c string, tokens array<string>, mark string")


def token_table(entries: DataFrame, aliases: DataFrame, totals: dict[str, int]) -> DataFrame:
    """(kind, t, common, known, forms, shorts) per token: whether it serves everyone (given names stand before others, clubs' mascots
    last), whether it is a full name for certain, the names it may stand for and its short forms.

    Nicknames quoted inside full names add to the table of aliases, each with the full names that hold ``FORM_SHARE`` of its uses.
    totals: the number of entries of each kind. Known are the full forms of the table of aliases and tokens whose share of the
    entries, less two standard errors, reaches ``NAME_SHARE``; common those that reach ``COMMON_SHARE`` and stand mostly in that
    place. A rare short form or typing error does not get there as the table grows; if in doubt a token is not common, and is
    looked for everywhere.
    """
    places = entries.select("kind", F.size("tokens").alias("k"), F.posexplode("tokens").alias("pos", "t"))
    there = F.when(F.col("kind") == "P", F.col("pos") < F.col("k") - 1).otherwise((F.col("k") > 1) & (F.col("pos") == F.col("k") - 1))
    nothing = [F.lit(None).cast("string").alias("form"), F.lit(None).cast("string").alias("short"), F.lit(None).cast("bigint").alias("c"), F.lit(False).alias("full")]
    uses = places.groupBy("kind", "t").agg(F.count(F.lit(1)).alias("n"), F.sum(there.cast("bigint")).alias("place")).select("kind", "t", "n", "place", *nothing)
    quoted = entries.where("kind = 'P' and mark <> '' and size(tokens) > 1 and length(tokens[0]) > 1").groupBy(F.col("mark").alias("t"), F.get("tokens", F.lit(0)).alias("form")).agg(F.count(F.lit(1)).alias("c"))
    extra = lambda df, c, full: df.select(F.lit("P").alias("kind"), "t", F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("place"), "form", "short", c.alias("c"), full.alias("full"))
    none = F.lit(None).cast("string")
    table = extra(aliases.withColumn("short", none), F.lit(None).cast("bigint"), F.lit(False)).unionByName(extra(aliases.select(F.col("form").alias("t"), none.alias("form"), F.col("t").alias("short")), F.lit(None).cast("bigint"), F.lit(True)))
    rows = uses.unionByName(table).unionByName(extra(quoted.withColumn("short", none), F.col("c"), F.lit(False))).groupBy("kind", "t")
    rows = rows.agg(F.sum("n").alias("n"), F.sum("place").alias("place"), F.max("full").alias("full"), F.sum("c").alias("all"), F.collect_set("short").alias("shorts"), F.collect_set(F.when(F.col("form").isNotNull(), F.struct("form", "c"))).alias("f")).where("n > 0")
    forms = F.transform(F.filter("f", lambda x: x["c"].isNull() | (x["c"] >= FORM_SHARE * F.col("all"))), lambda x: x["form"])
    share = F.col("place") / F.col("n")
    sure = (F.col("n") - 2 * F.sqrt("n")) / F.when(F.col("kind") == "P", totals.get("P", 1)).otherwise(totals.get("C", 1))
    common, known = (share - 1 / F.sqrt("n") >= 0.5) & (sure >= COMMON_SHARE), F.col("full") | (sure >= NAME_SHARE)
    return rows.select("kind", "t", common.alias("common"), known.alias("known"), F.array_distinct(F.concat(forms, F.array("t"))).alias("forms"), "shorts")


FACTS = "kind string, block string, blk bigint, node string, number bigint, c string, mark string, toks array<struct<t:string,common:boolean,known:boolean,forms:array<string>,shorts:array<string>,n:bigint>>, keys array<struct<t:string,l:array<string>,r:array<string>>>"


def with_facts(entries: DataFrame, table: DataFrame) -> DataFrame:
    """Entries with what is known of their tokens, in order, with the number n of the block's entries that hold each, and their index entries."""
    cells = entries.select("kind", "block", "node", "number", "c", "mark", "tokens", F.posexplode("tokens").alias("pos", "t"))
    first = (F.array_position("tokens", F.col("t")) == F.col("pos") + 1).cast("bigint")
    cells = cells.withColumn("n", F.sum(first).over(Window.partitionBy("kind", "block", "t"))).join(table, ["kind", "t"])
    cells = cells.groupBy("node").agg(*[F.first(x).alias(x) for x in ("kind", "block", "number", "c", "mark")], F.array_sort(F.collect_list(F.struct("pos", "t", "common", "known", "forms", "shorts", "n"))).alias("toks"))
    cells = cells.withColumn("blk", F.xxhash64("kind", "block"))

    def file_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            for r in rows:
                r["keys"] = [{"t": t, "l": left, "r": right} for t, left, right in index_entries(r["kind"], r["toks"], r["mark"] == "initials")]
            yield pa.RecordBatch.from_pylist(rows, schema)

    schema = pa.schema([("kind", pa.string()), ("block", pa.string()), ("blk", pa.int64()), ("node", pa.string()), ("number", pa.int64()), ("c", pa.string()), ("mark", pa.string()), ("toks", pa.list_(pa.struct([("t", pa.string()), ("common", pa.bool_()), ("known", pa.bool_()), ("forms", pa.list_(pa.string())), ("shorts", pa.list_(pa.string())), ("n", pa.int64())]))), ("keys", pa.list_(pa.struct([("t", pa.string()), ("l", pa.list_(pa.string())), ("r", pa.list_(pa.string()))])))])
    return cells.mapInArrow(file_, FACTS)


def close_tokens(facts: DataFrame) -> DataFrame:
    """(blk, t, want): different tokens of one block that the judges of pairs may take for one, both ways: within the edits that
    they accept, or with a name that both may stand for.
    """
    tokens = facts.select("blk", F.explode("keys.t").alias("t")).where(~F.col("t").startswith(INITIALS)).distinct()

    def file_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [list(name_keys(t)) for t in batch.column("t").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("blk"), batch.column("t"), pa.array(keys, pa.list_(pa.string()))], ["blk", "t", "keys"])

    filed = tokens.mapInArrow(file_, "blk bigint, t string, keys array<string>").select("blk", "t", F.explode("keys").alias("key")).select(F.xxhash64("blk", "key").alias("h"), "blk", "t")
    x, y = filed.alias("x"), filed.alias("y")
    plain = lambda c: F.replace(F.col(c), F.lit("-"), F.lit(""))
    edits = F.levenshtein(plain("x.t"), plain("y.t"), 4)  # -1 beyond four
    letters = lambda c: F.array_sort(F.split(plain(c), ""))
    # Two swaps of neighbours, two edits here, are four there; they keep the letters.
    near = (F.abs(F.length(plain("x.t")) - F.length(plain("y.t"))) <= 2) & (edits >= 0) & ((edits <= 3) | (letters("x.t") == letters("y.t"))) | (F.col("x.t").contains("-") != F.col("y.t").contains("-"))
    pairs = x.join(y, (F.col("x.h") == F.col("y.h")) & (F.col("x.blk") == F.col("y.blk")) & (F.col("x.t") < F.col("y.t")) & near).select(F.col("x.blk").alias("blk"), F.col("x.t").alias("t"), F.col("y.t").alias("want"))
    forms = facts.where("kind = 'P'").select("blk", F.explode("toks").alias("k")).where("length(k.t) > 1").select("blk", F.col("k.t").alias("t"), F.explode("k.forms").alias("form")).distinct()
    alike = forms.where("form <> t").join(forms.withColumnRenamed("t", "want"), ["blk", "form"]).where("t <> want")
    pairs = pairs.unionByName(alike.select("blk", F.least("t", "want").alias("t"), F.greatest("t", "want").alias("want"))).distinct()
    return pairs.select("blk", F.explode(F.array(F.struct("t", "want"), F.struct(F.col("want").alias("t"), F.col("t").alias("want")))).alias("p")).select("blk", "p.t", "p.want")


def candidate_pairs(facts: DataFrame) -> DataFrame:
    """(a, b), a < b: nodes of one block that hold the same or close tokens under a common mark."""
    held = facts.select("blk", "node", F.explode("keys").alias("k"))
    left = held.select("blk", F.col("k.t").alias("t"), "node", F.col("k.l").alias("l"))
    there = left.join(close_tokens(facts), ["blk", "t"]).select("blk", F.col("want").alias("t"), "node", "l").unionByName(left)
    there = there.select("blk", "t", F.col("node").alias("i"), F.explode("l").alias("m"))
    here = held.select("blk", F.col("k.t").alias("t"), F.col("node").alias("j"), F.explode("k.r").alias("m"))
    return there.join(here, ["blk", "t", "m"]).where("i <> j").select(F.least("i", "j").alias("a"), F.greatest("i", "j").alias("b")).distinct()


def judged(facts: DataFrame, pairs: DataFrame, foes: bool = False) -> DataFrame:
    """(kind, blk, a, b, score, rel, numbers, ca, cb) of the pairs (a, b) that may be one or are surely two; with ``foes`` also of people whose numbers differ.

    People: score and rel as same_person gives them; numbers 1 if they agree, -1 if they differ, 0 if one is
    missing; ca, cb their clubs. Clubs: rel and, as score, the edits of same_club.
    """
    side = lambda k: facts.select(F.col("node").alias(k), "kind" if k == "a" else F.lit(0), "blk" if k == "a" else F.lit(0), *[F.col(c).alias(f"{c}{k}") for c in ("toks", "number", "c", "mark", "block")]).drop("0")
    pairs = pairs.join(side("a"), "a").join(side("b"), "b").where("blocka = blockb").drop("blocka", "blockb")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for r in batch.to_pylist():
                if r["kind"] == "C":
                    fit = same_club(r["toksa"], r["marka"] == "initials", r["toksb"], r["markb"] == "initials")
                    if fit:
                        out.append(("C", r["blk"], r["a"], r["b"], float(fit[1]), fit[0], 0, None, None))
                    continue
                numbers = 0 if r["numbera"] is None or r["numberb"] is None else 1 if r["numbera"] == r["numberb"] else -1
                score, rel = same_person(r["toksa"], r["toksb"], numbers == 1)
                if score > 0 or rel == "apart" or (foes and numbers == -1):
                    out.append(("P", r["blk"], r["a"], r["b"], score, rel, numbers, r["ca"], r["cb"]))
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out) if out else [[]] * 9, kinds)], names)

    names = ["kind", "blk", "a", "b", "score", "rel", "numbers", "ca", "cb"]
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.string(), pa.int32(), pa.string(), pa.string()]
    return pairs.mapInArrow(judge, "kind string, blk bigint, a string, b string, score double, rel string, numbers int, ca string, cb string")


def club_groups(facts: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, club, sure): every spelling's club, named by a node of it.

    Full spellings of one club are linked directly. A short form (initials, one word, or a word cut short) joins the only club
    of its block it fits with the fewest edits; if it fits none or several it stays alone and ``sure`` is false. Full spellings cut short go first, to
    the only spelling they fit that is no short form itself.
    """
    clubs = facts.where("kind = 'C'").select("node", ((F.size("toks") > 1)).alias("full"))
    comp = components(edges.where("kind = 'C' and rel = 'strong'"))
    label = cut(clubs.join(comp.select(F.col("id").alias("node"), "comp"), "node", "left").select("node", "full", F.coalesce("comp", "node").alias("comp")))
    weak = edges.where("kind = 'C' and rel <> 'strong'").select(F.col("score").alias("q"), F.when(F.col("rel") == "a", F.col("a")).otherwise(F.col("b")).alias("short"), F.when(F.col("rel") == "a", F.col("b")).otherwise(F.col("a")).alias("long"))
    of, to = label.select(F.col("node").alias("short"), F.col("comp").alias("of"), "full"), label.where("full").select(F.col("node").alias("long"), F.col("comp").alias("to"))
    fits = cut(weak.join(of, "short").join(to, "long").where("of <> to").groupBy("of", "to", "full").agg(F.min("q").alias("q")))
    # The one club among those fitted with the fewest edits.
    only = lambda df: df.groupBy("of").agg(F.min(F.struct("q", "to"))["to"].alias("to"), F.max(F.struct(-F.col("q"), F.col("to").alias("to")))["to"].alias("high")).where("to = high").drop("high")
    whole = fits.where("full")
    first = only(whole.join(whole.select(F.col("of").alias("to")).distinct(), "to", "left_anti"))
    second = only(fits.join(first.select(F.col("of").alias("to"), F.col("to").alias("on")), "to", "left").select("of", "q", F.coalesce("on", "to").alias("to")).where("of <> to"))
    last = second.join(second.select(F.col("of").alias("to"), F.col("to").alias("on")), "to", "left").select(F.col("of").alias("comp"), F.coalesce("on", "to").alias("to"))
    return cut(label.join(last, "comp", "left").select("node", F.coalesce("to", "comp").alias("club"), (F.col("full") | F.col("to").isNotNull()).alias("sure")))


def person_groups(facts: DataFrame, edges: DataFrame, clubs: DataFrame) -> DataFrame:
    """(node, person) of the nodes on edges; two rows that differ in both number and club never share a group."""
    sure = clubs.where("sure")
    club = lambda k: sure.select(F.col("node").alias(f"c{k}"), F.col("club").alias(f"k{k}"))
    other = (F.col("numbers") == -1) & F.coalesce(F.col("ka") != F.col("kb"), F.lit(False))
    # Names alone do not part rows of one number; two known names part rows of one club, where relatives play together.
    no = other | ((F.col("rel") == "apart") & (F.col("numbers") < 1))
    gain = F.when(F.col("numbers") == 1, 0.6).otherwise(0.0) + F.when(F.col("ka") == F.col("kb"), 0.3).otherwise(0.0)
    # Surnames two typing errors apart need the number or the club to agree.
    weak = (F.col("rel") == "far") & (F.col("numbers") < 1) & ~F.coalesce(F.col("ka") == F.col("kb"), F.lit(False))
    score = F.when(no, -1.0).when(weak, 0.0).when(F.col("score") > 0, F.col("score") + gain).otherwise(0.0)
    weighed = lambda df: df.join(club("a"), "ca", "left").join(club("b"), "cb", "left").select("blk", "a", "b", score.alias("score")).where("score <> 0")
    people = edges.where("kind = 'P'")
    linked = cut(weighed(people))
    comp = cut(components(linked.where("score > 0")))
    # What the index did not bring together may be parted too, if others link it.
    a, b = comp.select(F.col("id").alias("a"), "comp"), comp.select(F.col("id").alias("b"), "comp")
    rest = a.join(b, "comp").where("a < b").select("a", "b").join(people.select("a", "b"), ["a", "b"], "left_anti")
    linked = linked.unionByName(weighed(judged(facts, rest, foes=True)))
    inside = linked.join(a, "a").select("comp", "score", "a", "b", (F.col("score") > 0).alias("ok"))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # One component after the other streams by: those who may not be one, then the links from the strongest on.
        at, group, foes = None, {}, {}
        out: list[tuple[str, str]] = []

        def close() -> None:
            out.extend((x, min(g)) for x, g in group.items() if len(g) > 1)
            group.clear()
            foes.clear()

        for batch in batches:
            for comp, a, b, ok in zip(*(batch.column(c).to_pylist() for c in ("comp", "a", "b", "ok"))):
                if comp != at:
                    close()
                    at = comp
                if not ok:
                    foes.setdefault(a, set()).add(b)
                    foes.setdefault(b, set()).add(a)
                    continue
                x, y = (group.setdefault(n, {n}) for n in (a, b))
                if x is y:
                    continue
                if len(x) < len(y):
                    x, y = y, x
                if not any(foes.get(n, empty) & x for n in y):
                    x |= y
                    group.update(dict.fromkeys(y, x))
            if len(out) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*out)], ["node", "person"])
                out.clear()
        close()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*out)], ["node", "person"])

    empty: frozenset = frozenset()
    ordered = inside.repartition("comp").sortWithinPartitions("comp", "ok", F.desc("score"), "a", "b").select("comp", "a", "b", "ok")
    return ordered.mapInArrow(merge, "node string, person string")


def is_no_club(club: Column) -> Column:
    return club.isNull() | F.lower(F.trim(club)).isin(*NO_CLUB)


def linked_pairs(groups: DataFrame) -> DataFrame:
    """(kind, team, key_a, key_b), key_a < key_b as text: all pairs of each group (kind, team, group, key)."""
    x, y = groups.withColumnRenamed("key", "key_a"), groups.withColumnRenamed("key", "key_b")
    return x.join(y, ["kind", "team", "group"]).where("key_a < key_b").select("kind", "team", "key_a", "key_b")


def roster_groups(roster: DataFrame, aliases: DataFrame, team: str = "Team", key: str = "Player ID", name: str = "Name", number: str = "Uniform Number", club: str = "Club") -> DataFrame:
    """(kind, team, key, group): every id (kind ``person``) and every spelling of a club (``club``) with its group.

    Repeated rows count once; if an id has several rows, the least speaks for it. Ids that agree in team, name, number and
    club are one entry from the start, so that copies cost no pairs; where the name is a single word and the number is missing, or the name
    is empty, they are not taken for one. Entries that say there is no club, and nulls, are no clubs and differ from none; null teams
    or ids link nothing. Other columns are ignored.
    """
    c = lambda n: F.col(f"`{n}`")
    node = lambda *parts: F.md5(F.concat_ws("\u0001", *[F.coalesce(F.col(p).cast("string"), F.lit("\u0002")) for p in parts]))
    rows = roster.where(c(team).isNotNull() & c(key).isNotNull()).groupBy(c(team).cast("string").alias("block"), c(key).cast("string").alias("key"))
    rows = rows.agg(F.min(F.struct(c(name).alias("name"), c(number).cast("bigint").alias("number"), c(club).alias("club"))).alias("r")).select("block", "key", "r.*")
    says = F.col("name").rlike(r"\p{L}") & (F.col("number").isNotNull() | F.col("name").rlike(r"\p{L}.*[\s,.]+.*\p{L}"))
    rows = rows.withColumns({"club": F.when(~is_no_club(F.col("club")), F.col("club")), "own": F.when(~F.coalesce(says, F.lit(False)), F.col("key"))})
    rows = rows.withColumn("node", node("block", "name", "number", "club", "own"))
    people = rows.groupBy("node").agg(*[F.first(x).alias(x) for x in ("block", "name", "number", "club")])
    people = people.select(F.lit("P").alias("kind"), "block", "node", F.col("name").alias("text"), "number", F.when(F.col("club").isNotNull(), node("block", "club")).alias("c"))
    spellings = roster.where(c(team).isNotNull() & ~is_no_club(c(club))).select(c(team).cast("string").alias("block"), c(club).alias("club")).distinct().withColumn("node", node("block", "club"))
    entries = people.unionByName(spellings.select(F.lit("C").alias("kind"), "block", "node", F.col("club").alias("text"), F.lit(None).cast("bigint").alias("number"), F.lit(None).cast("string").alias("c")))
    entries = cut(parsed(entries))
    short = aliases.select(F.lower("short_form").alias("t"), F.lower("full_form").alias("form")).where("t is not null and form is not null").distinct()
    totals = {r["kind"]: r["count"] for r in entries.groupBy("kind").count().collect()}
    facts = cut(with_facts(entries, token_table(entries, short, totals)))
    edges = cut(judged(facts, candidate_pairs(facts)))
    clubs = club_groups(facts, edges)
    persons = person_groups(facts, edges, clubs)
    people = rows.select(F.lit("person").alias("kind"), F.col("block").alias("team"), "key", "node").join(persons, "node", "left").select("kind", "team", "key", F.coalesce("person", "node").alias("group"))
    named = spellings.select(F.lit("club").alias("kind"), F.col("block").alias("team"), F.col("club").alias("key"), "node").join(clubs, "node", "left").select("kind", "team", "key", F.coalesce("club", "node").alias("group"))
    return people.unionByName(named)


def roster_links(roster: DataFrame, aliases: DataFrame, **columns: str) -> DataFrame:
    """(kind, team, key_a, key_b): all pairs of each group of roster_groups."""
    return linked_pairs(cut(roster_groups(roster, aliases, **columns)))
