"""Order-dependent play columns. All windows share the game as their partition, so one exchange serves a whole chain."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridsnap.functions.plays import add_events, clean_yardage, extract_players, points_of, scoring_team
from gridsnap.plans.order import Order, flag, other_team

WORKING = ("drive_id_half", "play_id_drive", "posteam_id", "start_yard_line", "start_half_team", "end_yard_line", "end_half_team", "row_order")


def add_row_order(df: DataFrame) -> DataFrame:
    """The place of each play in its game, oldest first, for feeds that list drives and plays newest first."""
    from pyspark.sql import Window

    w = Window.partitionBy("game_id").orderBy("half", F.desc("drive_id_half"), F.desc("play_id_drive"))
    return df.withColumn("row_order", F.row_number().over(w).cast("bigint"))


def add_play_ids(df: DataFrame) -> DataFrame:
    """play_id 1..n, drive_id as a count of changes of the drive's number, half_end.

    The first play takes the second's drive (a first drive of one play shares the number of the next), the only play 1.
    """
    o = Order()
    before = F.lag("drive_id_half").over(o.game)
    out = df.withColumns({"play_id": F.row_number().over(o.game).cast("bigint"), "turn": F.when(before.isNotNull(), (before != F.col("drive_id_half")).cast("int"))})
    out = out.withColumn("count", F.when(F.col("play_id") > 1, o.total("turn") + 1))
    out = out.withColumn("drive_id", F.coalesce("count", o.lead("count"), F.lit(1)).cast("bigint")).drop("turn", "count")
    return out.withColumn("half_end", flag((F.col("play_id") == F.max("play_id").over(o.all_half)) | (F.col("play_id") == F.max("play_id").over(o.all_game))))


def correct_possession(df: DataFrame) -> DataFrame:
    """posteam and defteam: swapped in a drive up to and with its last defensive touchdown; and those of the next play."""
    o = Order()
    last = F.max(F.when(F.col("def_touchdown") == 1, F.col("play_id"))).over(o.all_drive)
    out = df.withColumn("posteam", F.when(F.col("play_id") <= last, other_team("posteam_id")).otherwise(F.col("posteam_id")))
    out = out.withColumn("defteam", other_team("posteam"))
    return out.withColumns({"posteam_after": o.lead("posteam"), "defteam_after": o.lead("defteam")})


def add_scores(df: DataFrame, credit_defense: bool = True) -> DataFrame:
    """scoring_play_team, points, running scores with the current play, and the difference for the offence."""
    o = Order()
    out = df.withColumn("scoring_play_team", scoring_team(credit_defense))
    out = out.withColumns({"home_team_points": points_of("home_team"), "away_team_points": points_of("away_team")})
    out = out.withColumns({"home_team_score": o.total("home_team_points"), "away_team_score": o.total("away_team_points")})
    mine = F.when(F.col("posteam") == F.col("home_team"), F.col("home_team_score")).when(F.col("posteam") == F.col("away_team"), F.col("away_team_score"))
    theirs = F.when(F.col("posteam") == F.col("home_team"), F.col("away_team_score")).when(F.col("posteam") == F.col("away_team"), F.col("home_team_score"))
    out = out.withColumns({"posteam_score": mine, "defteam_score": theirs})
    return out.withColumn("score_differential", F.col("posteam_score") - F.col("defteam_score"))


def clean_plays(raw: DataFrame) -> DataFrame:
    """The whole chain from raw feed rows to canonical plays."""
    out = extract_players(raw)
    for step in (add_row_order, add_play_ids, add_events, correct_possession, clean_yardage, add_scores):
        out = step(out)
    return out.withColumn("index", F.col("row_order")).drop(*WORKING)


def games(df: DataFrame, order: str = "row_order") -> DataFrame:
    """(game_id, home_team, away_team): the first and the second different team to possess the ball; away null if there is one."""
    first = df.where("posteam is not null").groupBy("game_id", "posteam").agg(F.min(order).alias("at"))
    both = first.groupBy("game_id").agg(F.slice(F.array_sort(F.collect_list(F.struct("at", "posteam"))), 1, 2).alias("t"))
    return both.select("game_id", F.get("t", F.lit(0))["posteam"].alias("home_team"), F.get("t", F.lit(1))["posteam"].alias("away_team"))
