"""The two charted sources, brought to the canonical play schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridsnap.functions.plays import DEFENCE, OFFENCE, any_of, distance_bucket
from gridsnap.operators.sequence import add_scores
from gridsnap.plans.order import Order, flag, other_team


def _with_games(df: DataFrame) -> DataFrame:
    """Home and away team, the first and second to possess the ball, on the exchange that the later windows share."""
    whole = Window.partitionBy("game_id").orderBy("row_order").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    out = df.withColumn("home_team", F.first("posteam", ignorenulls=True).over(whole))
    out = out.withColumn("away_team", F.first(F.when(F.col("posteam") != F.col("home_team"), F.col("posteam")), ignorenulls=True).over(whole))
    return out.where("home_team is not null").withColumn("defteam", other_team("posteam"))


def _gained(o: Order) -> Column:
    """Yards to the next play of the game; none after a try, a failed fourth down or a fourth-down safety."""
    stop = (F.col("down") == 0) | ((F.col("down") == 4) & ((F.col("complete_pass") == 0) | (F.col("safety") == 1)))
    return F.when(stop, 0).otherwise(o.lead("yardline_50") - F.col("yardline_50"))


def _positions(df: DataFrame) -> DataFrame:
    half = F.when(F.col("yardline_50") < 25, 0).otherwise(1)
    return df.withColumns({"yardline_50_simple": half, "yards_to_go_simple": distance_bucket(F.col("yards_to_go"))})


def _tail(df: DataFrame, credit_defense: bool) -> DataFrame:
    o = Order()
    out = add_scores(df.withColumn("scoring_play", flag(any_of(OFFENCE + DEFENCE))), credit_defense)
    out = out.withColumn("yards_gained", _gained(o))
    return out.withColumns({"first_down": flag((F.col("yardline_50") < 25) & (F.col("yards_gained") > F.col("yards_to_go"))), "index": F.col("row_order")})


def charted_by_result(df: DataFrame) -> DataFrame:
    """Plays charted with one text RESULT (all columns text): flags by what the text contains; defensive scores earn no points."""
    o, res = Order(), F.col("RESULT")
    has = lambda w: F.coalesce(res.contains(w), F.lit(False))
    out = _with_games(df).withColumns({"down": F.col("DN").cast("int"), "yards_to_go": F.col("DIST").cast("int"), "yardline": F.col("YARD LN").cast("int"), **{c: F.col(c).cast("int") for c in ("yardline_50", "play_id", "drive_id", "half")}})
    out = _positions(out).withColumns({"posteam_after": o.lead("posteam"), "yardline_50_after": o.lead("yardline_50")})
    out = out.withColumn("play_type", F.when(has("Rush"), "run").when(has("Penalty"), "no_play").when(has("KNEEL"), "qb_kneel").when(F.col("down") == 0, "extra_point").otherwise("pass"))
    throws = F.col("play_type").isin("pass", "extra_point", "no_play")
    moved = (F.col("yardline_50_after") != F.col("yardline_50")) & (F.col("posteam_after") == F.col("posteam"))
    out = out.withColumns(
        {
            "sack": flag(has("Sack")), "interception": flag(has("Interception")),
            "complete_pass": F.when(throws & has("Complete"), 1).when(throws & (res == "Incomplete"), 0).when(moved, 1).otherwise(0),
            "touchdown": flag(has("TD") & ~has("Def")), "def_touchdown": flag(has("Def TD")), "penalty": flag(has("Penalty")), "safety": flag(has("Safety")),
            "one_point_conv_success": flag((res == "Good") & (F.col("down") == 0) & (F.col("yardline_50") == 45)),
            "two_point_conv_success": flag((res == "Good") & (F.col("down") == 0) & (F.col("yardline_50") == 40)),
            "defensive_two_point_conv": flag(has("Def TD") & (F.col("down") == 0)),
        }
    )
    return _tail(out, credit_defense=False)


def charted_by_columns(df: DataFrame) -> DataFrame:
    """Plays charted with a column per event: a defensive touchdown also stays a touchdown of the offence."""
    ints = {"play_id": "play_id", "complete_pass": "complete_pass", "interception": "interception", "touchdown": "touchdown", "point_after": "point_after", "down": "Down", "yards_to_go": "Distance", "yardline_50": "Spot", "drive_id": "Drive", "half": "Quarter"}
    out = _with_games(df).withColumns({k: F.col(v).cast("int") for k, v in ints.items()})
    out = out.withColumn("point_after_success", F.when(F.col("point_after_success") == "NA", "0").otherwise(F.col("point_after_success")).cast("int"))
    out = _positions(out)
    good = (F.col("point_after_success") == 1) & (F.col("point_after") == 1)
    out = out.withColumns(
        {
            "def_touchdown": flag((F.col("interception") == 1) & (F.col("touchdown") == 1)), "safety": flag(F.col("IsSafety")),
            "one_point_conv_success": flag(good & (F.col("yardline_50") == 45)), "two_point_conv_success": flag(good & (F.col("yardline_50") == 40)),
            "defensive_two_point_conv": flag((F.col("interception") == 1) & (F.col("touchdown") == 1) & (F.col("point_after") == 1)),
        }
    )
    return _tail(out, credit_defense=True)
