"""Queries over the play sequences: cleaning, possession, scores, expected points, win probability and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridsnap.functions import plays as fp
from gridsnap.operators import expected, families, model, reports, sequence
from gridsnap.plans.cuts import cut, scratch
from gridsnap.sources import delimited_files as files
from gridsnap.sources import feeds, playlog
from gridsnap.sources.tables import table

KEY = ("game_id", "play_id")
#: What counting, scoring and the reports on expected points need of a prepared play.
EP_COLUMNS = (*KEY, "index", "half", "drive_id", "home_team", "away_team", "posteam", "defteam", "down", "yards_to_go", "yards_to_go_simple", "yardline_50", "yardline_50_simple", "play_type", "penalty", "interception", "touchdown", "safety", "one_point_conv_success", "two_point_conv_success", "defensive_two_point_conv", "scoring_play", "scoring_play_team", "half_end", "game_end", "score_differential", "Next_Score_Half", "Drive_Score_Half", "OFF FORM")
#: The game that is scored by models of all others.
HELD_OUT = 35
FLAGS = ("complete_pass", "interception", "touchdown", "def_touchdown", "one_point_conv_success", "two_point_conv_success", "defensive_two_point_conv", "safety", "scoring_play")


def feed(spark: SparkSession, sf: str) -> DataFrame:
    return sequence.clean_plays(playlog.feed_rows(table(spark, sf, "events")))


def charted(spark: SparkSession, sf: str) -> DataFrame:
    return families.charted_by_result(playlog.result_rows(table(spark, sf, "events")))


def prepared(spark: SparkSession, sf: str) -> DataFrame:
    return expected.prepare_ep(expected.prepare_wp(charted(spark, sf)))


def with_ep(spark: SparkSession, sf: str) -> DataFrame:
    # The chain of windows runs once; counting and scoring read its narrow result.
    rows = cut(prepared(spark, sf).select(*EP_COLUMNS))
    return expected.add_ep(model.score_ep(rows, model.ep_counts(rows)))


def ep_training(spark: SparkSession, sf: str) -> DataFrame:
    """The columns that train an expected-points model, of all games but the one held out."""
    frame = model.ep_frame(prepared(spark, sf).where(F.col("game_id") != HELD_OUT))
    return frame.select(*KEY, "label", *model.EP_FEATURES, "Total_W_Scaled")


def with_wp(spark: SparkSession, sf: str) -> DataFrame:
    return expected.add_wp(model.score_wp(prepared(spark, sf)))


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, 6) for n in names})


def _select(source, *names: str, rounded: tuple[str, ...] = ()):
    return lambda spark, sf: _rounded(source(spark, sf).select(*KEY, *names, *rounded), *rounded)


def clean_distinct(spark: SparkSession, sf: str) -> DataFrame:
    """plays with repeated rows once."""
    return table(spark, sf, "plays").drop("index", "ingested_at").distinct()


def regex_extract(spark: SparkSession, sf: str) -> DataFrame:
    return fp.extract_players(clean_distinct(spark, sf).select(*KEY, "summary")).drop("summary")


def sort_mixed(spark: SparkSession, sf: str) -> DataFrame:
    return sequence.add_row_order(playlog.feed_rows(table(spark, sf, "events"))).select("game_id", "half", "drive_id_half", "play_id_drive", "row_order")


def union_diagonal(spark: SparkSession, sf: str) -> DataFrame:
    a, b = feed(spark, sf).select(*KEY, "play_type", "first_down", "down_desc"), charted(spark, sf).select(F.col("game_id"), F.col("play_id").cast("bigint").alias("play_id"), "play_type", "first_down", "sack", F.col("OFF FORM").alias("form"))
    for f in a.schema.fields:
        if f.name in b.columns and b.schema[f.name].dataType != f.dataType:
            raise TypeError(f"{f.name}: {f.dataType} and {b.schema[f.name].dataType}")
    return a.unionByName(b, allowMissingColumns=True)


def narrow_ints(df: DataFrame) -> DataFrame:
    """All 64-bit integer columns as 32-bit ones; values beyond raise."""
    return df.withColumns({f.name: F.col(f.name).cast("int") for f in df.schema.fields if f.dataType.simpleString() == "bigint"})


CSV = ("game_id", "play_id", "DN", "DIST", "RESULT")


def csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Plays written as delimited text, headed, all strings, and read again."""
    where = scratch(spark, "csv")
    files.write_delimited(playlog.result_rows(table(spark, sf, "events")).select(*CSV), where)
    return files.read_text_columns(spark, where).withColumns({c: F.col(c).cast("bigint") for c in CSV[:4]})


def scan_csv_all_string(spark: SparkSession, sf: str) -> DataFrame:
    """The same file read as text alone."""
    where = scratch(spark, "csv")
    files.write_delimited(playlog.result_rows(table(spark, sf, "events")).select(*CSV), where)
    return files.read_text_columns(spark, where, names=list(CSV))


def scan_csv_typed(spark: SparkSession, sf: str) -> DataFrame:
    """A comma-separated file read with types, one of them overridden."""
    where = scratch(spark, "csv")
    files.write_delimited(playlog.result_rows(table(spark, sf, "events")).select(*CSV), where, ",")
    return files.read_typed(spark, where, {"game_id": "bigint", "play_id": "bigint", "DN": "int", "DIST": "int", "RESULT": "string"}, overrides={"DN": "string"})


def scan_csv_glob(spark: SparkSession, sf: str) -> DataFrame:
    """Files of three different headers read by one pattern, each by its own names."""
    where, rows = scratch(spark, "csv"), playlog.result_rows(table(spark, sf, "events"))
    for part, names in enumerate((("game_id", "play_id", "DN"), ("play_id", "game_id", "DIST", "DN"), ("RESULT", "DN", "game_id", "play_id"))):
        files.write_delimited(rows.where(F.col("game_id") % 3 == part).select(*names), f"{where}/{part}")
    return files.read_many(spark, f"{where}/*").select(*CSV).withColumns({c: F.col(c).cast("bigint") for c in CSV[:4]})


def games_home_away(spark: SparkSession, sf: str) -> DataFrame:
    return sequence.games(playlog.result_rows(table(spark, sf, "events")))


def dsf_plays(spark: SparkSession, sf: str) -> DataFrame:
    out = families.charted_by_columns(playlog.column_rows(table(spark, sf, "events")))
    return out.select(*KEY, *FLAGS, "scoring_play_team", "home_team_score", "away_team_score", "yards_gained", "first_down")


def ep_weights(spark: SparkSession, sf: str) -> DataFrame:
    out = model.ep_frame(prepared(spark, sf)).select(*KEY, "label", "down0", "down1", "down2", "down3", "down4", "Total_W_Scaled")
    return _rounded(out, "Total_W_Scaled")


def wp_labels(spark: SparkSession, sf: str) -> DataFrame:
    return model.wp_frame(prepared(spark, sf)).select(*KEY, "Winner", "label")


def ep_model_cells(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(model.ep_cells(model.ep_counts(prepared(spark, sf))), *[f"{n}_Prob" for n in model.CLASSES])


def epa_by_form(spark: SparkSession, sf: str) -> DataFrame:
    return reports.mean_by(with_ep(spark, sf).where("yards_to_go_simple = 2"), "OFF FORM", "epa", "epa").withColumnRenamed("OFF FORM", "form")


def success_rate_cum(spark: SparkSession, sf: str) -> DataFrame:
    # Both steps of the running sum read the narrow rows, not the whole chain twice.
    rows = cut(with_ep(spark, sf).select(*KEY, "home_team", "index", "epa"))
    return reports.running_success(rows).select(*KEY, "home_team", "success", "successes", "plays", "success_rate")


def success_rate_last(spark: SparkSession, sf: str) -> DataFrame:
    return reports.last_plays(success_rate_cum(spark, sf))


def success_by_form(spark: SparkSession, sf: str) -> DataFrame:
    rows = reports.with_success(with_ep(spark, sf)).where("posteam = 'H3' and yards_to_go_simple = 2 and penalty = 0")
    return reports.mean_by(rows, "OFF FORM", "success", "success").withColumnRenamed("OFF FORM", "form")


def wp_curve(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(reports.wp_curve(with_wp(spark, sf)), "game_seconds_remaining", "home_wp", "away_wp")


def situation_counts(spark: SparkSession, sf: str) -> DataFrame:
    return reports.situation_counts(clean_distinct(spark, sf), "yards_to_go")


def situation_counts_bucket(spark: SparkSession, sf: str) -> DataFrame:
    return reports.situation_counts(clean_distinct(spark, sf), "yards_to_go_simple")


def situation_counts_field(spark: SparkSession, sf: str) -> DataFrame:
    return reports.situation_counts(charted(spark, sf), "yardline_50_simple")


def head_plays(spark: SparkSession, sf: str) -> DataFrame:
    """The first hundred charted plays by key."""
    return reports.head(charted(spark, sf).select(*KEY, "posteam", "down", "yards_to_go", "play_type"), 100, *KEY)


def pat_rate(spark: SparkSession, sf: str) -> DataFrame:
    return reports.try_rates(clean_distinct(spark, sf))


def null_counts(spark: SparkSession, sf: str) -> DataFrame:
    return reports.null_counts(clean_distinct(spark, sf))


def distance_hist(spark: SparkSession, sf: str) -> DataFrame:
    return clean_distinct(spark, sf).where("yards_to_go is not null").groupBy("yards_to_go").agg(F.count(F.lit(1)).alias("plays"))


def heldout_game_ep(spark: SparkSession, sf: str) -> DataFrame:
    """One game scored by expected points of all other games."""
    rows = prepared(spark, sf)
    counts = model.ep_counts(rows.where(F.col("game_id") != HELD_OUT))
    scored = expected.add_ep(model.score_ep(rows.where(F.col("game_id") == HELD_OUT), counts))
    return _rounded(scored.select(*KEY, "ep", "epa"), "ep", "epa")


def null_counts_frame(spark: SparkSession, sf: str) -> DataFrame:
    return reports.null_counts(ep_training(spark, sf).drop(*KEY))


def training_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The training frame without rows that lack anything."""
    return _rounded(ep_training(spark, sf).na.drop(), "Total_W_Scaled")


def ep_trained_quality(spark: SparkSession, sf: str) -> DataFrame:
    """Settings tried, best first by log loss on held-out plays, and the quality of the best one's refit on all rows, saved and loaded again."""
    frame = cut(ep_training(spark, sf).na.drop())
    tried = model.search_ep(frame, [(3, 10), (5, 20)])
    where = scratch(spark, "model")
    model.save_model(model.train_ep(frame, *tried[0][:2]), where)
    final = model.evaluate(model.trained_ep(frame, model.load_model(where)), [F.col(f"{n}_Prob") for n in model.CLASSES], F.col("Total_W_Scaled"))
    rows = spark.createDataFrame([("held_out", *t) for t in tried], "rows_used string, depth int, trees int, log_loss double")
    return rows.unionByName(final.select(F.lit("all").alias("rows_used"), F.lit(tried[0][0]).alias("depth"), F.lit(tried[0][1]).alias("trees"), "log_loss"))


def ep_importances(spark: SparkSession, sf: str) -> DataFrame:
    frame = ep_training(spark, sf).na.drop()
    return spark.createDataFrame(model.importances(model.train_ep(frame, 4, 10), model.EP_FEATURES), "feature string, importance double")


def wp_trained(spark: SparkSession, sf: str) -> DataFrame:
    """Win probability of the held-out game by boosted trees trained on all other games, with what follows from it."""
    rows = prepared(spark, sf)
    fitted = model.train_wp(model.wp_frame(rows.where(F.col("game_id") != HELD_OUT)), 3, 5)
    return expected.add_wp(model.trained_wp(rows.where(F.col("game_id") == HELD_OUT), fitted)).select(*KEY, "wp", "home_wp", "wpa")


def wp_trained_quality(spark: SparkSession, sf: str) -> DataFrame:
    """Log loss and accuracy of boosted trees on a held-out fifth of the plays."""
    train, test = model.held_out(cut(model.wp_frame(prepared(spark, sf)).select(*KEY, "label", *model.WP_FEATURES)))
    return model.evaluate(model.trained_wp(test, model.train_wp(train, 3, 5)), [1 - F.col("wp"), F.col("wp")])


def heldout_game(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(with_wp(spark, sf).where(F.col("game_id") == HELD_OUT).select(*KEY, "home_wp", "wpa"), "home_wp", "wpa")


def half_ends(spark: SparkSession, sf: str) -> DataFrame:
    """The half and game ends of the clean plays, as the last play_id of each."""
    return table(spark, sf, "plays").groupBy("game_id", "half").agg(F.max("play_id").alias("play_id"))


def match_documents(spark: SparkSession, sf: str) -> DataFrame:
    """(game_id, drives, header): the play log as the two JSON documents of each game; lines at 7 are left out."""
    rows = playlog.feed_rows(table(spark, sf, "events")).withColumn("d", 101 - F.col("drive_id_half"))
    place = lambda line, team: F.struct(F.col(line).alias("yardLine"), F.conv(F.substring(team, 2, 1), 10, 10).cast("bigint").alias("team"))
    play = F.struct("summary", F.col("action_title").alias("actionTitle"), "down", F.col("down_desc").alias("downLabel"), F.col("yards_to_go").alias("target"), F.col("yards_to_go_after").alias("nextTarget"), F.when(F.col("start_yard_line") != 7, place("start_yard_line", "start_half_team")).alias("startYardLine"), place("end_yard_line", "end_half_team").alias("endYardLine"))
    drives = rows.groupBy("game_id", "home_team", "away_team", "half", "d").agg(F.transform(F.array_sort(F.collect_list(F.struct("play_id_drive", play.alias("play")))), lambda x: x["play"]).alias("eventGroups"), F.first("posteam_id").alias("team"))
    drive = F.struct(F.struct(F.col("team").alias("threeLetters")).alias("team"), "eventGroups")
    halves = drives.groupBy("game_id", "home_team", "away_team", "half").agg(F.transform(F.array_sort(F.collect_list(F.struct("d", drive.alias("v")))), lambda x: x["v"]).alias("drives"))
    games = halves.groupBy("game_id", "home_team", "away_team").agg(F.array_sort(F.collect_list(F.struct((F.col("half") - 1).alias("num"), "drives"))).alias("halves"))
    header = F.struct(F.struct(F.col("home_team").alias("id")).alias("home"), F.struct(F.col("away_team").alias("id")).alias("away"))
    return games.select("game_id", F.to_json("halves").alias("drives"), F.to_json(header).alias("header"))


def json_flatten(spark: SparkSession, sf: str) -> DataFrame:
    return feeds.match_rows(match_documents(spark, sf)).select("game_id", "half", "posteam_abb", "summary", "action_title", "down", "down_desc", "yards_to_go", "start_yard_line", "home_team", "away_team", "home_score", "stream_url")


def roster_flatten(spark: SparkSession, sf: str) -> DataFrame:
    """Rosters packed into one document per team and taken apart again."""
    rows = table(spark, sf, "team_roster_old").distinct()
    player = F.struct(F.col("Player ID").alias("id"), F.col("Name").alias("name"), F.col("Uniform Number").alias("uniform_number"), F.col("Position").alias("position"), F.col("Club").alias("club"))
    packed = rows.groupBy("Team").agg(F.collect_list(player).alias("players")).select(F.to_json(F.array(F.struct(F.length("Team").cast("bigint").alias("id"), F.col("Team").alias("name"), "players"))).alias("payload"))
    return feeds.team_players(packed)


def text_cast(spark: SparkSession, sf: str) -> DataFrame:
    """Distances as text, nulls kept."""
    return clean_distinct(spark, sf).select(*KEY, F.col("yards_to_go").cast("string").alias("yards_to_go"), F.col("yards_to_go_after").cast("string").alias("yards_to_go_after"))


def drop_cols(spark: SparkSession, sf: str) -> DataFrame:
    """Canonical plays without the working columns; one that is absent is no error."""
    return feed(spark, sf).drop(*sequence.WORKING).select("game_id", "play_id", "index", "passer", "receiver")


QUERIES = {
    "json_flatten": json_flatten, "roster_flatten": roster_flatten, "text_cast": text_cast, "drop_cols": drop_cols,
    "regex_extract": regex_extract, "sort_mixed": sort_mixed, "union_diagonal": union_diagonal, "csv_roundtrip": csv_roundtrip,
    "cast_selector": lambda s, d: narrow_ints(sort_mixed(s, d).select("game_id", "row_order")),
    "play_ids": _select(feed, "drive_id", "half", "half_end"), "event_flags": _select(feed, "down", "play_type", "point_after", "point_after_success", "penalty", *FLAGS),
    "posteam_correction": _select(feed, "posteam", "defteam", "posteam_after", "defteam_after"),
    "yardage": _select(feed, "yardline_50", "yardline_50_after", "yards_gained", "yards_to_go", "yards_to_go_after", "yards_to_go_simple", "first_down"),
    "running_score": _select(feed, "scoring_play_team", "home_team_points", "away_team_points", "home_team_score", "away_team_score", "posteam_score", "defteam_score", "score_differential"),
    "games_home_away": games_home_away,
    "hudl_plays": _select(charted, "defteam", "down", "yards_to_go", "yardline_50_simple", "yards_to_go_simple", "posteam_after", "play_type", "sack", "penalty", *FLAGS, "scoring_play_team", "home_team_score", "away_team_score", "score_differential", "yards_gained", "first_down"),
    "dsf_plays": dsf_plays, "half_ends": half_ends,
    "next_score": _select(prepared, "half_end", "game_end", "start_posteam", "Next_Score_Half", "Drive_Score_Half", "max_play_id"),
    "clock": _select(prepared, "receive_2h_ko", rounded=("half_seconds_remaining", "game_seconds_remaining", "elapsed_share", "Diff_Time_Ratio")),
    "ep_weights": ep_weights, "wp_labels": wp_labels, "ep_model_cells": ep_model_cells,
    "epa": _select(with_ep, rounded=("ep", "epa", "home_team_epa", "away_team_epa")), "epa_totals": _select(with_ep, rounded=("total_home_epa", "total_away_epa")),
    "wpa": _select(with_wp, rounded=("wp", "home_wp", "away_wp", "def_wp", "wpa", "home_wp_post", "away_wp_post")), "wpa_totals": _select(with_wp, rounded=("total_home_wp", "total_away_wp", "total_home_wpa", "total_away_wpa")),
    "epa_by_form": epa_by_form, "success_rate_cum": success_rate_cum, "success_rate_last": success_rate_last, "success_by_form": success_by_form, "wp_curve": wp_curve,
    "scan_csv_all_string": scan_csv_all_string, "scan_csv_typed": scan_csv_typed, "scan_csv_glob": scan_csv_glob, "situation_counts_field": situation_counts_field, "head_plays": head_plays,
    "heldout_game_ep": heldout_game_ep, "null_counts_frame": null_counts_frame, "training_rows": training_rows,
    "ep_trained_quality": ep_trained_quality, "ep_importances": ep_importances, "wp_trained": wp_trained, "wp_trained_quality": wp_trained_quality,
    "situation_counts": situation_counts, "situation_counts_bucket": situation_counts_bucket, "pat_rate": pat_rate, "null_counts": null_counts, "distance_hist": distance_hist, "heldout_game": heldout_game,
}
