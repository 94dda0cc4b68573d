"""The events table read as a play log: one game per user, one play per event, in the forms of the three sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The text RESULT by ranges of k, and the summary that goes with it.
RESULTS = ((30, "Rush"), (55, "Complete"), (75, "Incomplete"), (80, "Complete, TD"), (83, "Interception"), (85, "Interception, Def TD"), (89, "Sack"), (91, "Penalty"), (92, "Sack, Safety"), (96, "Good"), (99, "No Good"))
SUMMARIES = (
    (30, " Jörg Müller rush for 3 yards, tackled by #7 Ånn Öst"), (55, " Jörg Müller pass complete to #12 Äke Öst for 4 yards"), (75, " Jörg Müller pass incomplete"),
    (80, " Jörg Müller pass complete to #12 Äke Öst for 9 yards, touchdown"), (83, " Jörg Müller pass intercepted to #5 Ola Ek"), (85, " Jörg Müller pass intercepted to #5 Ola Ek returned for a touchdown"),
    (89, " Jörg Müller sacked by #9 Eva Lind for a loss of 3"), (91, " penalty on the defense"), (92, " Jörg Müller sacked by #9 Eva Lind, safety"), (96, " Jörg Müller pass try is good"), (99, " Jörg Müller conversion try, miss"),
)


def _by_range(ranges: tuple) -> Column:
    return F.coalesce(*[F.when(F.col("k") < top, v) for top, v in ranges])


def play_log(events: DataFrame) -> DataFrame:
    """e, g, k, p (place in the game), n (its plays), and what all sources share."""
    ev = events.select(F.col("event_id").alias("e"), F.col("user_id").alias("g"), "event_type", F.get_json_object("props", "$.k").cast("int").alias("k"))
    w = Window.partitionBy("g").orderBy("e")
    out = ev.withColumns({"p": F.row_number().over(w).cast("bigint"), "n": F.count(F.lit(1)).over(Window.partitionBy("g"))})
    home, away = F.concat(F.lit("H"), (F.col("g") % 8).cast("string")), F.concat(F.lit("A"), (F.col("g") % 7).cast("string"))
    drive = F.floor((F.col("p") - 1) / 6)
    return out.withColumns({"row_order": F.col("e") + 1, "game_id": F.col("g"), "half": F.when(F.col("p") <= F.floor(F.col("n") / 2), 1).otherwise(2), "d": drive, "h": home, "a": away, "team": F.when(drive % 2 == 0, home).otherwise(away), "try": F.col("k").between(92, 98)})


def feed_rows(events: DataFrame) -> DataFrame:
    """Raw rows of the match feed: drives and plays numbered newest first."""
    log, k, e = play_log(events), F.col("k"), F.col("e")
    to_go = F.when(F.col("try"), "x").when(k % 10 == 3, "G").when(k % 10 == 7, "").when(k != 50, (k % 25 + 1).cast("string"))
    return log.select(
        "game_id", "half", (100 - F.col("d")).alias("drive_id_half"), (10 - (F.col("p") - 1) % 6).alias("play_id_drive"), F.col("team").alias("posteam_id"), F.concat(F.lit("#"), k.cast("string"), _by_range(SUMMARIES)).alias("summary"),
        F.when(k.between(75, 79) | k.between(83, 84), "Touchdown").when(F.col("try"), "PAT").otherwise("Play").alias("action_title"), ((F.col("p") - 1) % 4 + 1).cast("int").alias("down"),
        F.when(F.col("try"), F.when(k % 2 == 0, "PAT 5 yards").otherwise("PAT 10 yards")).otherwise(F.concat(((F.col("p") - 1) % 4 + 1).cast("string"), F.lit(" & "), (k % 25 + 1).cast("string"))).alias("down_desc"),
        to_go.alias("yards_to_go"), F.when(k % 5 == 0, "G").otherwise((e % 20 + 1).cast("string")).alias("yards_to_go_after"),
        ((7 * e + k) % 25).cast("int").alias("start_yard_line"), F.when(e % 2 == 0, F.col("h")).otherwise(F.col("a")).alias("start_half_team"), ((7 * e + 3 * k) % 25).cast("int").alias("end_yard_line"), F.when((e + k) % 2 == 0, F.col("h")).otherwise(F.col("a")).alias("end_half_team"),
        F.col("h").alias("home_team"), F.col("a").alias("away_team"),
    )


def result_rows(events: DataFrame) -> DataFrame:
    """Rows charted with a text RESULT; all but the order as text."""
    log, k = play_log(events), F.col("k")
    text = lambda c: c.cast("string")
    spot = F.when(F.col("try"), F.when(k % 2 == 0, 45).otherwise(40)).otherwise((7 * F.col("e") + k) % 50)
    return log.select(
        "row_order", "game_id", text(F.col("p")).alias("play_id"), text(F.col("half")).alias("half"), text(F.col("d") + 1).alias("drive_id"), F.col("team").alias("posteam"),
        text(F.when(F.col("try"), 0).otherwise((F.col("p") - 1) % 4 + 1)).alias("DN"), text(F.when(F.col("try"), F.when(k % 2 == 0, 5).otherwise(10)).otherwise(k % 25 + 1)).alias("DIST"),
        text(spot).alias("YARD LN"), text(spot).alias("yardline_50"), _by_range(RESULTS).alias("RESULT"), F.col("event_type").alias("OFF FORM"),
    )


def column_rows(events: DataFrame) -> DataFrame:
    """Rows charted with a column per event, as text but for IsSafety."""
    b, res = result_rows(events), F.col("RESULT")
    bit = lambda w: F.when(res.contains(w), "1").otherwise("0")
    return b.select(
        "row_order", "game_id", "posteam", "play_id", bit("Complete").alias("complete_pass"), bit("Interception").alias("interception"), bit("TD").alias("touchdown"), F.when(F.col("DN") == "0", "1").otherwise("0").alias("point_after"),
        F.when(res == "Good", "1").when(F.col("DN") == "0", "0").otherwise("NA").alias("point_after_success"), F.col("DN").alias("Down"), F.col("DIST").alias("Distance"), F.col("yardline_50").alias("Spot"), F.col("drive_id").alias("Drive"), F.col("half").alias("Quarter"),
        F.coalesce(res.contains("Safety"), F.lit(False)).alias("IsSafety"),
    )
