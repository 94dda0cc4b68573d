"""Queries of the language-model problems."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridsnap.llm.leaks import find_leaks, removal_spans
from gridsnap.llm.mixing import mix, shares, token_counts
from gridsnap.llm.names import roster_groups, roster_links
from gridsnap.llm.residue import with_residue
from gridsnap.plans.cuts import cut
from gridsnap.sources.tables import table


def p8_found(spark: SparkSession, sf: str) -> DataFrame:
    return with_residue(table(spark, sf, "documents").select("doc_id", "text")).where("residue is not null").select("doc_id")


def p8_clean(spark: SparkSession, sf: str) -> DataFrame:
    """The corpus without residue."""
    return with_residue(table(spark, sf, "documents")).where("residue is null").drop("residue")


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    return roster_links(table(spark, sf, "team_roster_old"), table(spark, sf, "name_aliases"))


def p2_members(spark: SparkSession, sf: str) -> DataFrame:
    """Every player id and every spelling of a club with the group it belongs to."""
    return roster_groups(table(spark, sf, "team_roster_old"), table(spark, sf, "name_aliases"))


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    return find_leaks(table(spark, sf, "documents"), table(spark, sf, "benchmark")).select("doc_id", "item_id").distinct()


def p6_spans(spark: SparkSession, sf: str) -> DataFrame:
    """The character spans to remove from each leaking document."""
    return removal_spans(find_leaks(table(spark, sf, "documents"), table(spark, sf, "benchmark")))


def p7_mixture(spark: SparkSession, sf: str) -> DataFrame:
    """The chosen documents and how often each is used, at the largest budget that holds every share."""
    counted = token_counts(table(spark, sf, "documents"), ["doc_id", "source"])
    chosen = mix(counted, table(spark, sf, "mix_targets"))
    return chosen.groupBy("doc_id", "source", "tokens").agg(F.count(F.lit(1)).cast("int").alias("repeats"))


def p7_shares(spark: SparkSession, sf: str) -> DataFrame:
    """Target and actual shares of the mixture."""
    targets = table(spark, sf, "mix_targets")
    return shares(mix(token_counts(table(spark, sf, "documents"), ["doc_id", "source"]), targets), targets)


def p7_capped(spark: SparkSession, sf: str) -> DataFrame:
    """Target and actual shares at a budget of as many tokens as the corpus holds: scarce sources are used up at their most
    repeats, and the others take their place.
    """
    targets = table(spark, sf, "mix_targets")
    counted = cut(token_counts(table(spark, sf, "documents"), ["doc_id", "source"]))
    budget = counted.agg(F.sum("tokens")).first()[0] or 0
    return shares(mix(counted, targets, budget), targets)


QUERIES = {"p7_capped": p7_capped, "p2_found": p2_found, "p2_members": p2_members, "p6_found": p6_found, "p6_spans": p6_spans, "p7_mixture": p7_mixture, "p7_shares": p7_shares, "p8_found": p8_found, "p8_clean": p8_clean}
SQL: dict[str, str] = {}
