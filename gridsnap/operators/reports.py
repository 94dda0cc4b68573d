"""Reports over plays."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def mean_by(df: DataFrame, group: str, value: str, into: str) -> DataFrame:
    return df.groupBy(group).agg(F.round(F.avg(value), 6).alias(into))


def with_success(df: DataFrame) -> DataFrame:
    """Each play's success: epa of 0 or more; none for null."""
    return df.withColumn("success", F.when(F.col("epa") >= 0, 1).otherwise(0))


def running_success(df: DataFrame) -> DataFrame:
    """success, and of its home team's plays so far (by game and place): successes, plays, success_rate to six places, halves up.

    In two steps, as a team may have played a large share of all games: totals per game, summed over the team's games (one row
    a game), then the running sum inside each game. The rate is rounded in whole numbers, so it is exact.
    """
    rows = with_success(df)
    game = Window.partitionBy("game_id").orderBy("index").rowsBetween(Window.unboundedPreceding, 0)
    team = Window.partitionBy("home_team").orderBy("game_id").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("home_team", "game_id").agg(F.sum("success").alias("s"), F.count(F.lit(1)).alias("n"))
    before = totals.select("game_id", *[F.coalesce(F.sum(c).over(team), F.lit(0)).alias(f"{c}0") for c in ("s", "n")])
    out = rows.withColumns({"s": F.sum("success").over(game), "n": F.count(F.lit(1)).over(game)}).join(before, "game_id")
    out = out.withColumns({"successes": F.col("s") + F.col("s0"), "plays": F.col("n") + F.col("n0")}).drop("s", "n", "s0", "n0")
    return out.withColumn("success_rate", F.expr("(successes * 2000000 + plays) div (2 * plays)") / F.lit(1e6))


def last_plays(df: DataFrame) -> DataFrame:
    """The rows whose play_id is the largest of all; the maximum is a one-row aggregate."""
    return df.join(F.broadcast(df.agg(F.max("play_id").alias("__top"))), F.col("play_id") == F.col("__top")).drop("__top")


def wp_curve(df: DataFrame) -> DataFrame:
    """Both win probabilities over time, scores marked at the side that made them."""
    what = F.when((F.col("touchdown") == 1) | (F.col("def_touchdown") == 1), "TD").when(F.col("safety") == 1, "Safety")
    label = lambda side: F.when(F.col("scoring_play_team") == F.col(side), what)
    return df.select("game_id", "play_id", "game_seconds_remaining", "home_wp", "away_wp", label("home_team").alias("home_label"), label("away_team").alias("away_label"))


def situation_counts(df: DataFrame, distance: str) -> DataFrame:
    """Plays per down and distance (or field half) with a text key, sorted by both; rows with either missing have no key."""
    counts = df.groupBy("down", distance).agg(F.count(F.lit(1)).alias("count"))
    return counts.withColumn("situation", F.concat(F.col("down").cast("string"), F.lit(" & "), F.col(distance).cast("string"))).orderBy("down", distance)


def try_rates(df: DataFrame) -> DataFrame:
    """Attempts (known results of one-point tries), good ones of either kind and their rate by distance."""
    good = F.coalesce(F.sum("one_point_conv_success"), F.lit(0)) + F.coalesce(F.sum("two_point_conv_success"), F.lit(0))
    counts = df.where("down = 0").groupBy("yards_to_go").agg(F.count("one_point_conv_success").alias("attempts"), good.alias("good"))
    return counts.withColumn("rate", F.round(F.try_divide("good", "attempts"), 6))


def head(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The first n rows by the given order."""
    return df.orderBy(*order).limit(n)


def null_counts(df: DataFrame) -> DataFrame:
    """(column, nulls) from one aggregate."""
    names = df.columns
    wide = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in names])
    return wide.select(F.explode(F.map_from_arrays(F.array(*[F.lit(c) for c in names]), F.array(*[F.col(f"`{c}`") for c in names]))).alias("column", "nulls"))
