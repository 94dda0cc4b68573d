"""Expected points and win probability: preparation of plays, and the differences between them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridsnap.plans.order import Order, flag

# Expected points of a try from five and from ten yards.
TRY_5, TRY_10 = 0.5, 0.92


def _ends(df: DataFrame) -> DataFrame:
    o = Order("index")
    out = df.withColumn("half_end", flag(F.col("index") == F.max("index").over(o.all_half)))
    return out.withColumn("game_end", flag((F.col("half_end") == 1) & (F.col("half") == 2)))


def prepare_ep(df: DataFrame) -> DataFrame:
    """The next score of the half for the possessing team, and its drive; scores carried forward within the game."""
    o = Order("index")
    one = lambda c: F.col(c) == 1
    event = (
        F.when(one("touchdown") | one("def_touchdown"), "Touchdown").when(one("safety"), "Safety").when(one("one_point_conv_success"), "Extra_Point")
        .when(one("two_point_conv_success"), "Two_Point_Conversion").when(one("half_end") & (F.col("scoring_play") == 0), "No_Score")
    )
    out = _ends(df).withColumns({"scoring_event": event, "score_drive": F.when(one("scoring_play"), F.col("drive_id")), "start_posteam": F.when(F.col("play_id") == 1, F.col("posteam"))})
    out = out.withColumns(
        {
            "scoring_play_team": o.after("scoring_play_team", half=True), "scoring_event": o.after("scoring_event", half=True), "score_drive": o.after("score_drive", half=True),
            "posteam_score": o.before("posteam_score"), "defteam_score": o.before("defteam_score"), "start_posteam": o.before("start_posteam"),
        }
    )
    own, other = F.col("posteam") == F.col("scoring_play_team"), F.col("posteam") != F.col("scoring_play_team")
    is_ = lambda v: F.col("scoring_event") == v
    score = F.when(is_("No_Score"), "No_Score").when(own, F.col("scoring_event"))
    score = score.when(other & is_("Extra_Point"), "Opp_Two_Point_Conversion").when(other, F.concat(F.lit("Opp_"), "scoring_event"))
    out = out.withColumn("Next_Score_Half", score)
    return out.withColumns({"Drive_Score_Half": F.when(F.col("Next_Score_Half") == "No_Score", F.col("drive_id")).otherwise(F.col("score_drive")), "max_play_id": F.max("play_id").over(o.all_half)})


def prepare_wp(df: DataFrame) -> DataFrame:
    """A synthetic clock: the plays of a half share its 1200 seconds evenly; score difference against time left."""
    o = Order("index")
    out = _ends(df).withColumns({"play_id_half": o.total(F.lit(1), half=True), "n": F.count(F.lit(1)).over(o.all_half)})
    out = out.withColumn("play_time", F.when(F.col("play_id_half") == 1, 0.0).otherwise(F.lit(1200.0) / F.col("n")))
    out = out.withColumn("half_seconds_remaining", 1200.0 - (F.col("play_id_half") - 1) * F.lit(1200.0) / F.col("n")).drop("n")
    out = out.withColumn("game_seconds_remaining", F.when(F.col("half") == 2, F.col("half_seconds_remaining")).otherwise(2400.0 - o.total("play_time")))
    out = out.withColumn("elapsed_share", (2400.0 - F.col("game_seconds_remaining")) / 2400.0)
    out = out.withColumn("Diff_Time_Ratio", F.col("score_differential") / F.exp(-4.0 * F.col("elapsed_share")))
    start = F.when(F.col("play_id") == 1, F.col("posteam"))
    # Only a game's first play knows who started: every other play gets 1.
    return out.withColumns({"start_posteam": start, "receive_2h_ko": F.when(start == F.col("posteam"), 0).otherwise(1)})


def _signed(side: str, value: str, team: str = "posteam") -> Column:
    return F.when(F.col(team) == F.col(side), F.col(value)).otherwise(-F.col(value))


def add_ep(df: DataFrame) -> DataFrame:
    """ep from the five probabilities, epa of each play and running totals of both teams.

    The rules for epa are one CASE, the strongest first: ends of halves and games, safeties, defensive and failed tries,
    good tries, touchdowns, then the difference to the next play.
    """
    o = Order("index")
    exp = 2 * F.col("Safety_Prob") + 6 * F.col("Touchdown_Prob") - 2 * F.col("Opp_Safety_Prob") - 6 * F.col("Opp_Touchdown_Prob")
    out = df.withColumn("ExpPts", exp).withColumns({"ep": o.after("ExpPts"), "tmp_posteam": o.after("posteam")})
    out = out.withColumn("home_ep", _signed("home_team", "ep", "tmp_posteam"))
    step = o.lead("home_ep") - F.col("home_ep")
    out = out.withColumn("home_epa", F.when(F.col("interception") == 1, -step).otherwise(step))
    one = lambda c: F.col(c) == 1
    ep, team, down0 = F.col("ep"), F.col("scoring_play_team"), F.col("down") == 0
    first_half_over = one("half_end") & (F.col("half") == 1)
    out = out.withColumn(
        "epa",
        F.when(one("game_end") | first_half_over, None)
        .when(one("half_end") & (F.col("scoring_play") == 0) & F.col("play_type").isNotNull(), -ep)
        .when(one("safety") & (team == F.col("posteam")), 2 - ep)
        .when(one("safety") & (team == F.col("defteam")), -2 - ep)
        .when(one("defensive_two_point_conv"), -2 - ep)
        .when(down0 & (F.col("yards_to_go") > 5) & (F.col("two_point_conv_success") == 0), -TRY_10)
        .when(down0 & (F.col("yards_to_go") <= 5) & (F.col("one_point_conv_success") == 0), -TRY_5)
        .when(one("two_point_conv_success"), 2 - TRY_10)
        .when(one("one_point_conv_success"), 1 - TRY_5)
        .when(one("touchdown") & (team == F.col("posteam")), 6 - ep)
        .when(one("touchdown") & team.isNotNull(), -6 - ep)
        .otherwise(_signed("home_team", "home_epa", "tmp_posteam")),
    )
    out = out.withColumn("ep", F.when(one("game_end") | first_half_over, None).otherwise(ep))
    out = out.withColumns({f"{s}_epa": F.coalesce(_signed(s, "epa"), F.lit(0.0)) for s in ("home_team", "away_team")})
    return out.withColumns({"total_home_epa": o.total("home_team_epa"), "total_away_epa": o.total("away_team_epa")}).drop("tmp_posteam")


def add_wp(df: DataFrame) -> DataFrame:
    """Both teams' win probability, the change by each play, and running totals (null where the summand is)."""
    o = Order("index")
    out = df.withColumns({"wp": o.after("wp"), "tmp_posteam": o.after("posteam")})
    home, away = F.col("home_team_score"), F.col("away_team_score")
    final = F.when(home > away, 1.0).when(away > home, 0.0).when(home == away, 0.5)
    mine = F.when(F.col("tmp_posteam") == F.col("home_team"), F.col("wp")).otherwise(1 - F.col("wp"))
    out = out.withColumn("home_wp", F.when(F.col("game_end") == 1, final).otherwise(mine))
    out = out.withColumns({"away_wp": 1 - F.col("home_wp"), "def_wp": 1 - F.col("wp"), "home_wpa": o.lead("home_wp") - F.col("home_wp")})
    out = out.withColumn("wpa", F.when(F.col("game_end") == 1, None).otherwise(_signed("home_team", "home_wpa", "tmp_posteam")))
    for s in ("home", "away"):
        change = F.when(F.col("posteam") == F.col(f"{s}_team"), F.col("wpa")).otherwise(-F.col("wpa"))
        out = out.withColumns({f"{s}_wp_post": F.col(f"{s}_wp") + change, f"{s}_team_wpa": F.coalesce(change, F.lit(0.0))})
    post = {f"total_{s}_wp": F.when(F.col(f"{s}_wp_post").isNotNull(), o.total(f"{s}_wp_post")) for s in ("home", "away")}
    return out.withColumns(post | {f"total_{s}_wpa": o.total(f"{s}_team_wpa") for s in ("home", "away")}).drop("tmp_posteam")
