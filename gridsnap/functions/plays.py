"""Row-wise play columns: text captures, event flags, distances, scoring."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridsnap.plans.order import flag

# What is captured from a play's summary. Letters are Unicode letters.
PERSON = r"#(\d+)\s+[\p{L}\p{N}_]+\s[\p{L}\p{N}_]+"
CAPTURES = {
    "passer": PERSON + r"\s+pass",
    "receiver": "pass complete to " + PERSON,
    "rusher": PERSON + r"\s+rush",
    "tackle_player": "tackled by " + PERSON,
    "interception_player": "pass intercepted to " + PERSON,
    "sack_player": "sacked by " + PERSON,
    "play_result": "(rush|complete|incomplete|touchdown|first down|intercepted|sack|fumble|good|miss|timeout)",
    "penalty_word": "(penalty)",
    "safety_word": "(safety)",
}


def extract_players(df: DataFrame, summary: str = "summary") -> DataFrame:
    """The nine captures of a summary; null where the text is null or holds none."""
    return df.withColumns({name: F.nullif(F.regexp_extract(summary, pattern, 1), F.lit("")) for name, pattern in CAPTURES.items()})


def distance_bucket(c: Column) -> Column:
    """1 to 5 by steps of five yards, 0 for null."""
    out = F.when(c.isNull(), 0)
    for top, bucket in ((5, 1), (10, 2), (15, 3), (20, 4)):
        out = out.when(c <= top, bucket)
    return out.otherwise(5)


def add_events(df: DataFrame) -> DataFrame:
    """Play type and event flags from the captures, the label of the down and the action's title."""
    pat, result = F.coalesce(F.col("down_desc").contains("PAT"), F.lit(False)), F.col("play_result")
    passes = ["complete", "incomplete", "sack", "intercepted", "good", "miss"]
    is_ = lambda v: flag(result == v)
    raw = df.withColumns(
        {
            "down": F.when(pat, 0).otherwise(F.col("down")),
            "play_type": F.when(result == "rush", "rush").when(result.isin(*passes), "pass").when((result == "timeout") | result.isNull(), "no_play"),
            "complete_pass": is_("complete"), "interception": is_("intercepted"), "raw_td": flag(F.col("action_title") == "Touchdown"),
            "point_after": flag(pat), "point_after_success": is_("good"),
            "penalty": flag(F.col("penalty_word").isNotNull()), "safety": flag(F.col("safety_word").isNotNull()),
        }
    )
    on = lambda *names: F.lit(True) if not names else (F.col(names[0]) == 1) & on(*names[1:])
    out = raw.withColumns(
        {
            "def_touchdown": flag(on("interception", "raw_td")),
            "one_point_conv_success": flag(on("point_after_success", "point_after") & (F.col("down_desc") == "PAT 5 yards")),
            "two_point_conv_success": flag(on("point_after_success", "point_after") & (F.col("down_desc") == "PAT 10 yards")),
            "defensive_two_point_conv": flag(on("point_after", "interception", "raw_td")),
        }
    )
    out = out.withColumn("touchdown", F.when((F.col("def_touchdown") == 1) | (F.col("point_after") == 1), 0).otherwise(F.col("raw_td"))).drop("raw_td", "penalty_word", "safety_word")
    return out.withColumn("scoring_play", flag(any_of(OFFENCE + DEFENCE)))


OFFENCE = ("touchdown", "one_point_conv_success", "two_point_conv_success")
DEFENCE = ("def_touchdown", "defensive_two_point_conv", "safety")
# Points of a scoring play, the first that applies.
POINTS = (("touchdown", 6), ("def_touchdown", 6), ("one_point_conv_success", 1), ("two_point_conv_success", 2), ("defensive_two_point_conv", 2), ("safety", 2))


def any_of(names: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for n in names:
        out = out | (F.col(n) == 1)
    return out


def scoring_team(credit_defense: bool = True) -> Column:
    """The offence for its own scores, the defence for the others; null else."""
    out = F.when(any_of(OFFENCE), F.col("posteam"))
    return out.when(any_of(DEFENCE), F.col("defteam")) if credit_defense else out


def points_of(side: str) -> Column:
    """Points of ``side`` on the play: 0 on a game's first play, null where it did not score."""
    value = F.coalesce(*[F.when(F.col(n) == 1, v) for n, v in POINTS])
    return F.when(F.col("play_id") == 1, 0).when(F.col("scoring_play_team") == F.col(side), value)


def clean_yardage(df: DataFrame) -> DataFrame:
    """Field position of the possessing team, yards gained, distances as numbers, buckets and first downs.

    A distance is a whole number, G (goal), empty or null; anything else raises.
    """
    from_home = lambda line, half: F.when(F.col(half) == F.col("away_team"), 50 - F.col(line)).otherwise(F.col(line))
    out = df.withColumns({"y": from_home("start_yard_line", "start_half_team"), "z": from_home("end_yard_line", "end_half_team")})
    turned = lambda c: F.when(F.col("posteam") == F.col("home_team"), F.col(c)).when(F.col("posteam") == F.col("away_team"), 50 - F.col(c)).otherwise(0)
    out = out.withColumns({"yardline_50": turned("y"), "yardline_50_after": turned("z")})

    def yards(c: str, line: str, pat: bool) -> Column:
        text = F.col(c)
        number = F.when(text.isNull() | (text == ""), None)
        if pat:
            number = number.when(F.col("down_desc") == "PAT 5 yards", 5).when(F.col("down_desc") == "PAT 10 yards", 10)
        return F.when(text == "G", 50 - F.col(line)).otherwise(number.otherwise(text.cast("int")))

    out = out.withColumns({"yards_gained": F.col("yardline_50_after") - F.col("yardline_50"), "yards_to_go": yards("yards_to_go", "yardline_50", True), "yards_to_go_after": yards("yards_to_go_after", "yardline_50_after", False)})
    return out.withColumns({"yards_to_go_simple": distance_bucket(F.col("yards_to_go")), "first_down": flag((F.col("yardline_50") < 25) & (F.col("yards_gained") > F.col("yards_to_go")))}).drop("y", "z")
