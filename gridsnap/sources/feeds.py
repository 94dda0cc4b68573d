"""Landed JSON documents of the match and team services as rows. Fetching is left to whatever lands them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridsnap.operators.nested import Level, shred

LEVELS = (Level("half", "", ("num", "drives")), Level("drive", "drives"), Level("play", "eventGroups"))
PLACE = "struct<yardLine:int,team:bigint>"
PLAY = f"summary string, actionTitle string, down int, downLabel string, nextDown int, nextDownLabel string, target string, nextTarget string, startYardLine {PLACE}, endYardLine {PLACE}"
DRIVE = "team struct<id:bigint,threeLetters:string>, yards int, timeOfPossession string"
HEADER = (
    "series struct<id:string,region:string,level:string,seasonName:string,phase:string,groupId:string,groupName:string>, streams array<struct<url:string>>, "
    "home struct<id:string>, away struct<id:string>, result struct<details:struct<points_total_home:int,points_total_away:int>>"
)
PLAYERS = "array<struct<id:bigint,name:string,players:array<struct<id:bigint,name:string,uniform_number:int,position:string,club:string>>>>"


def match_rows(documents: DataFrame) -> DataFrame:
    """One raw play row per play of (game_id, drives, header), two JSON texts a game.

    Halves count from num + 1, drives and plays from 1 in the order delivered (newest first). Absent header fields get 0 or
    ``Unknown``, an absent result 0 : 0, an absent team ``Unknown``, absent lines and their halves 0; games of which either document cannot be read give no rows. gender carries the series id.
    """
    head = documents.select("game_id", F.from_json("header", HEADER).alias("m")).where("m is not null and (m.home is not null or m.away is not null or m.series is not null)")
    nodes = shred(documents.select(F.col("game_id").alias("key"), F.col("drives").alias("payload")), LEVELS, carry=("num",))
    half = F.get_json_object("root", "$.num").try_cast("double").cast("int") + 1
    drives = nodes.where("level = 'drive'").select("key", F.col("path").alias("parent"), F.from_json("attrs", DRIVE).alias("d"))
    plays = nodes.where("level = 'play'").select("key", "parent", "path", half.alias("half"), F.from_json("attrs", PLAY).alias("p"))
    rows = plays.join(drives, ["key", "parent"]).join(head, F.col("key") == F.col("game_id"))
    series = lambda f, default="0": F.coalesce(F.col(f"m.series.{f}"), F.lit(default))
    text = lambda f, default: F.coalesce(F.col(f).cast("string"), F.lit(default))
    zero = lambda f: F.coalesce(F.col(f), F.lit(0))
    return rows.select(
        series("seasonName").alias("season"), series("id").alias("competition_id"), series("region").alias("competition_name"), series("level").alias("competition_league"), series("id").alias("gender"), "game_id",
        series("phase").alias("game_type"), series("groupId").alias("game_group_id"), series("groupName").alias("game_group"), F.coalesce("half", F.col("path")[0]).alias("half"),
        F.col("path")[1].alias("drive_id_half"), F.col("path")[2].alias("play_id_drive"), text("d.team.id", "Unknown").alias("posteam_id"), text("d.team.threeLetters", "Unknown").alias("posteam_abb"),
        F.col("p.summary").alias("summary"), F.col("p.actionTitle").alias("action_title"), F.col("p.down").alias("down"), F.col("p.downLabel").alias("down_desc"), F.col("p.nextDown").alias("down_after"), F.col("p.nextDownLabel").alias("down_after_desc"),
        F.col("p.target").alias("yards_to_go"), F.col("p.nextTarget").alias("yards_to_go_after"), F.col("d.yards").alias("yards"), zero("p.startYardLine.yardLine").alias("start_yard_line"), text("p.startYardLine.team", "0").alias("start_half_team"),
        zero("p.endYardLine.yardLine").alias("end_yard_line"), text("p.endYardLine.team", "0").alias("end_half_team"), F.col("d.timeOfPossession").alias("possession_time"),
        F.coalesce("m.home.id", F.lit("Unknown")).alias("home_team"), F.coalesce("m.away.id", F.lit("Unknown")).alias("away_team"),
        F.coalesce("m.result.details.points_total_home", F.lit(0)).alias("home_score"), F.coalesce("m.result.details.points_total_away", F.lit(0)).alias("away_score"), F.coalesce(F.get("m.streams", F.lit(0))["url"], F.lit("Unknown")).alias("stream_url"),
    )


def team_players(documents: DataFrame, payload: str = "payload") -> DataFrame:
    """One row per player of the first team of each JSON text; texts that cannot be read give none."""
    team = F.get(F.from_json(payload, PLAYERS), F.lit(0))
    rows = documents.select(team.alias("t")).select(F.col("t.id").alias("team_id"), F.col("t.name").alias("Team"), F.explode("t.players").alias("p"))
    return rows.select("team_id", "Team", F.col("p.id").alias("Player ID"), F.col("p.name").alias("Name"), F.col("p.uniform_number").alias("Uniform Number"), F.col("p.position").alias("Position"), F.col("p.club").alias("Club"))
