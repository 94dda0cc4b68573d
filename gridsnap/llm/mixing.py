"""Mixing sources to target weights by weighted fair queueing.

Every copy of every document gets a virtual finish time: the tokens its source has sent up to and with it, divided by the
source's share. Serving in this order keeps all sources at their shares at every prefix, so the mixture is the prefix of
the queue that fits the budget. Nothing is ever ordered in one task: documents of a source are shuffled by a hash, cut
into hash slices, and running totals are taken slice by slice (totals per slice first, then inside each slice); the
queue is range-partitioned by finish time in the same way.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridsnap.plans.cuts import cut

TOKENIZERS = "/opt/tokenizers"
#: Rows per slice aimed at; a slice is ordered in one task.
SLICE_ROWS = 20_000


def token_counts(documents: DataFrame, columns: list[str], text: str = "text", folder: str = TOKENIZERS, ranks_file: str = "byte_bpe_50k.tiktoken", pattern: str | None = None) -> DataFrame:
    """``columns`` of the documents and ``tokens``, the whole text's length in tokens of a public byte-level BPE; null counts 0.

    The vocabulary is read once per Python worker from ``folder`` and never copied. ``pattern`` splits words; by
    default the folder's own.
    """
    kept = documents.select(*columns, F.col(text).alias("__text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import runpy

        import tiktoken

        split = pattern or runpy.run_path(f"{folder}/__init__.py")["PATTERN"]
        with open(f"{folder}/{ranks_file}", "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        coder = tiktoken.Encoding("own", pat_str=split, mergeable_ranks=ranks, special_tokens={})
        for batch in batches:
            texts = [x if isinstance(x, str) else "" for x in batch["__text"]]
            yield batch[columns].assign(tokens=[len(x) for x in coder.encode_ordinary_batch(texts, num_threads=1)])

    return kept.mapInPandas(run, schema + ", tokens bigint")


def _running(df: DataFrame, keys: list[str], slice_: str, order: list[Column], value: str, into: str) -> DataFrame:
    """``df`` with the running sum of ``value`` within ``keys``, slice by slice; ``slice_`` is monotone in ``order``."""
    sums = df.groupBy(*keys, slice_).agg(F.sum(value).alias("__s"))
    # One row per slice: their number is the rows over SLICE_ROWS, so that one task's window orders 5 million slices at most for
    # each 10^11 documents or copies.
    before = sums.withColumn("__b", F.coalesce(F.sum("__s").over(Window.partitionBy(*keys).orderBy(slice_).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("__s")
    inside = F.sum(value).over(Window.partitionBy(*keys, slice_).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return df.join(before, [*keys, slice_]).withColumn(into, F.col("__b") + inside).drop("__b")


def source_totals(counted: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, share, repeats, docs, tokens, longest) of every target source: one row per target."""
    have = counted.where("tokens > 0").groupBy("source").agg(F.count(F.lit(1)).alias("docs"), F.sum("tokens").alias("tokens"), F.max("tokens").alias("longest"))
    repeats = F.max(F.greatest(F.coalesce("max_repeats", F.lit(1)), F.lit(0)))
    wanted = targets.where("source is not null and target_share > 0").groupBy("source").agg(F.max("target_share").alias("share"), repeats.alias("repeats"))
    return wanted.join(have, "source").where("repeats > 0")


class Queue:
    """The arithmetic of the queue over the sources' totals: shares scaled to 1, supply, and how far it is served."""

    def __init__(self, totals: list, budget: int | None) -> None:
        whole = sum(t["share"] for t in totals)
        self.share = {t["source"]: t["share"] / whole for t in totals}
        self.supply = {t["source"]: t["tokens"] * t["repeats"] for t in totals}
        full = min((int(self.supply[s] / self.share[s]) for s in self.share), default=0)
        self.budget = full if budget is None else budget
        # A queue served to finish time f has sent at most served(f) tokens, and less by no more than one document per source.
        self.last = self._time(self.budget + sum(t["longest"] for t in totals))

    def served(self, f: float) -> float:
        return sum(min(self.share[s] * f, self.supply[s]) for s in self.share)

    def _time(self, tokens: float) -> float:
        ends = sorted(self.supply[s] / self.share[s] for s in self.share)
        for end in ends:
            if self.served(end) >= tokens:
                open_ = [s for s in self.share if self.supply[s] / self.share[s] >= end]
                return end - (self.served(end) - tokens) / sum(self.share[s] for s in open_)
        return ends[-1] if ends else 0.0


def mix(counted: DataFrame, targets: DataFrame, budget: int | None = None, seed: int = 7, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """The chosen copies (doc_id, source, tokens, pass, finish, position) of documents (doc_id, source, tokens).

    targets: (source, target_share, max_repeats); shares of the sources that have tokens are scaled to 1. pass counts a
    document's copies from 1 to max_repeats, which limits how often it is used in all. position is the running number of
    tokens in the queue; copies are taken while it stays within ``budget``, by default the most at which every source can
    hold its share. A larger budget gives an exhausted source's place to the others. Documents of no target source, with a
    null source or without tokens are not used; repeated doc_ids are documents of their own. Ties in finish time
    go by source, doc_id and pass. The driver sees one row per target source, never documents.
    """
    counted = cut(counted.select("doc_id", "source", "tokens"))
    totals = source_totals(counted, targets).collect()
    queue = Queue(totals, budget)
    plan = counted.sparkSession.createDataFrame(
        [(t["source"], queue.share[t["source"]], t["tokens"], max(1, -(-t["docs"] // slice_rows)), min(t["repeats"], int(queue.last * queue.share[t["source"]] / t["tokens"]) + 1)) for t in totals],
        "source string, share double, all_tokens bigint, slices bigint, passes int",
    )
    docs = counted.where("tokens > 0").join(F.broadcast(plan), "source")
    # The hash is the shuffle; its top part gives the slice, so slices follow the hash order.
    docs = docs.withColumn("rank", F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("doc_id")), 1))
    docs = docs.withColumn("slice", F.least(F.floor(F.col("rank") / F.lit(2.0**63) * F.col("slices")), F.col("slices") - 1))
    docs = _running(docs, ["source"], "slice", [F.col("rank"), F.col("doc_id")], "tokens", "sent")
    copies = docs.select("*", F.explode(F.sequence(F.lit(1), F.col("passes"))).alias("pass"))
    copies = copies.withColumn("finish", ((F.col("pass") - 1) * F.col("all_tokens") + F.col("sent")) / F.col("share")).where(F.col("finish") <= queue.last)
    expected = sum(t["docs"] * min(t["repeats"], queue.last * queue.share[t["source"]] / t["tokens"]) for t in totals)
    bins = max(1, round(expected / slice_rows))
    copies = copies.withColumns({"bin": F.least(F.floor(F.col("finish") / F.lit(max(queue.last, 1e-9)) * bins), F.lit(bins - 1)), "queue": F.lit(1)})
    order = [F.col("finish"), F.col("source"), F.col("doc_id"), F.col("pass")]
    return _running(copies, ["queue"], "bin", order, "tokens", "position").where(F.col("position") <= queue.budget).select("doc_id", "source", "tokens", "pass", "finish", "position")


def shares(chosen: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, target_share, documents, copies, tokens, actual_share) of every target source."""
    got = chosen.groupBy("source").agg(F.sum((F.col("pass") == 1).cast("long")).alias("documents"), F.count(F.lit(1)).alias("copies"), F.sum("tokens").alias("tokens"))
    out = targets.groupBy("source").agg(F.max("target_share").alias("target_share")).join(got, "source", "left").na.fill(0, ["documents", "copies", "tokens"])
    return out.withColumn("actual_share", F.coalesce(F.col("tokens") / F.nullif(F.sum("tokens").over(Window.partitionBy()), F.lit(0)), F.lit(0.0)))
