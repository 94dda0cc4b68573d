from pyspark.sql import functions as F

from gridsnap.functions.plays import extract_players
from gridsnap.operators import expected, families, model, reports, sequence
from gridsnap.queries import reference
from gridsnap.sources import feeds, playlog


def test_all_queries_against_sql(compare):
    from gridsnap.queries.reference_sql import SQL

    for name, sql in SQL.items():
        left, right = compare(reference.QUERIES[name], sql, 1)
        assert left == right, name
    trained = {"ep_trained_quality", "ep_importances", "wp_trained", "wp_trained_quality"}
    assert set(reference.QUERIES) == set(SQL) | trained


def raw(spark, plays):
    """plays: (half, drive, play, team, summary, action, down label), newest first by number."""
    cols = "game_id int, half int, drive_id_half int, play_id_drive int, posteam_id string, summary string, action_title string, down int, down_desc string, yards_to_go string, yards_to_go_after string, start_yard_line int, start_half_team string, end_yard_line int, end_half_team string, home_team string, away_team string"
    return spark.createDataFrame([(1, h, d, p, t, s, a, 1, lab, "G", "", 10, "H", 12, "A", "H", "A") for h, d, p, t, s, a, lab in plays], cols)


def clean(spark, plays):
    return {r["play_id"]: r for r in sequence.clean_plays(raw(spark, plays)).collect()}


def test_single_play_first_drive_and_half_boundary(spark):
    got = clean(spark, [(1, 9, 1, "H", "x rush", "Play", "1"), (1, 8, 2, "A", "rush", "Play", "1"), (1, 8, 1, "A", "rush", "Play", "1"), (2, 8, 1, "H", "rush", "Play", "1")])
    assert [got[i]["drive_id"] for i in (1, 2, 3, 4)] == [2, 2, 2, 2] and [got[i]["half_end"] for i in (1, 2, 3, 4)] == [0, 0, 1, 1]
    assert clean(spark, [(1, 1, 1, "H", None, "Play", "1")])[1]["drive_id"] == 1


def test_defensive_touchdown_turns_the_drive_up_to_it(spark):
    td = "#1 Ana Öst pass intercepted to #2 Bo Åk returned for a touchdown"
    got = clean(spark, [(1, 2, 2, "A", "rush", "Play", "1"), (1, 2, 1, "A", "rush", "Play", "1"), (1, 1, 3, "H", "rush", "Play", "1"), (1, 1, 2, "H", td, "Touchdown", "1"), (1, 1, 1, "H", "#3 Cy Ek pass try is good", "PAT", "PAT 5 yards")])
    assert [got[i]["posteam"] for i in (1, 2, 3, 4, 5)] == ["A", "A", "A", "A", "H"]
    assert got[4]["def_touchdown"] == 1 and got[4]["touchdown"] == 0 and got[4]["scoring_play_team"] == "H" and got[4]["home_team_points"] == 6
    assert got[5]["one_point_conv_success"] == 1 and got[5]["home_team_score"] == 7 and got[5]["score_differential"] == 7


def test_touchdown_on_the_first_play_counts_nothing(spark):
    got = clean(spark, [(1, 1, 2, "H", "pass complete, touchdown", "Touchdown", "1"), (1, 1, 1, "H", "rush", "Play", "1")])
    assert got[1]["touchdown"] == 1 and got[2]["home_team_score"] == 0


def test_captures(spark):
    df = spark.createDataFrame([("#7 Jörg Müller pass incomplete", 1), (None, 2), ("", 3), ("x" * 300_000 + " rush", 4)], "summary string, passer_x int")
    got = {r["passer_x"]: r for r in extract_players(df).collect()}
    assert got[1]["passer"] == "7" and got[1]["play_result"] == "incomplete" and got[2]["play_result"] is None and got[3]["passer"] is None and got[4]["play_result"] == "rush"


def test_interleaved_games_do_not_touch(spark):
    ev = spark.createDataFrame([(i, 10 + i % 2, "a", '{"k": %d}' % ((i * 37) % 100)) for i in range(120)], "event_id bigint, user_id bigint, event_type string, props string")
    both = families.charted_by_result(playlog.result_rows(ev))
    one = families.charted_by_result(playlog.result_rows(ev.where("user_id = 10")))
    assert sorted(map(str, both.where("game_id = 10").collect())) == sorted(map(str, one.collect()))
    again = families.charted_by_result(playlog.result_rows(ev.repartition(7)))
    assert sorted(map(str, both.collect())) == sorted(map(str, again.collect()))


def test_invariants(spark):
    sf = "/root/testdata/sf0.001"
    wp = reference.with_wp(spark, sf)
    assert wp.where(F.abs(F.col("home_wp") + F.col("away_wp") - 1) > 1e-9).count() == 0
    assert wp.where("game_end = 1 and wpa is not null").count() == 0
    ep = reference.with_ep(spark, sf)
    assert ep.where("(game_end = 1 or (half_end = 1 and half = 1)) and epa is not null").count() == 0
    assert ep.where(F.abs(F.col("Touchdown_Prob") + F.col("Opp_Touchdown_Prob") + F.col("Safety_Prob") + F.col("Opp_Safety_Prob") + F.col("No_Score_Prob") - 1) > 1e-9).count() == 0


def test_empty_tables(spark):
    ev = spark.createDataFrame([], "event_id bigint, user_id bigint, event_type string, props string")
    rows = expected.prepare_ep(expected.prepare_wp(families.charted_by_result(playlog.result_rows(ev))))
    assert expected.add_ep(model.score_ep(rows, model.ep_counts(rows))).count() == 0 and model.ep_frame(rows).count() == 0 and sequence.clean_plays(playlog.feed_rows(ev)).count() == 0
    assert reports.null_counts(ev).where("nulls <> 0").count() == 0


def test_feeds(spark):
    doc = '[{"num":0,"drives":[{"team":{"id":5,"threeLetters":"ABC"},"eventGroups":[{"summary":"a"},{"summary":"b"}]}]}]'
    df = spark.createDataFrame([(1, doc, '{"home":{"id":"5"},"result":null}'), (2, "oops", '{"home":{"id":"5"}}'), (3, doc, "oops"), (4, None, None)], "game_id int, drives string, header string")
    got = feeds.match_rows(df).collect()
    assert [(r["game_id"], r["half"], r["drive_id_half"], r["play_id_drive"], r["summary"]) for r in sorted(got, key=str)] == [(1, 1, 1, 1, "a"), (1, 1, 1, 2, "b")]
    assert got[0]["start_yard_line"] == 0 and got[0]["end_half_team"] == "0" and got[0]["posteam_abb"] == "ABC"
    bare = spark.createDataFrame([(1, '[{"num":0,"drives":[{"eventGroups":[{"startYardLine":{"yardLine":3}}]}]}]', '{"home":{"id":"5"}}')], "game_id int, drives string, header string")
    one = feeds.match_rows(bare).first()
    assert (one["posteam_id"], one["posteam_abb"], one["start_yard_line"], one["start_half_team"], one["end_yard_line"]) == ("Unknown", "Unknown", 3, "0", 0)
    assert got[0]["away_team"] == "Unknown" and got[0]["home_score"] == 0 and got[0]["season"] == "0" and got[0]["stream_url"] == "Unknown"
    team = spark.createDataFrame([('[{"name":"T","players":[{"id":1,"name":"x"},{"id":2}]},{"name":"U","players":[{"id":3}]}]',), ("no",), (None,)], "payload string")
    assert [r["Player ID"] for r in feeds.team_players(team).collect()] == [1, 2]


def test_trained_models(spark):
    rows = reference.prepared(spark, "/root/testdata/sf0.001")
    frame = model.ep_frame(rows)
    train, test = model.held_out(frame)
    assert train.count() + test.count() == frame.count() and test.count() > 0
    scored = model.trained_ep(frame, model.train_ep(train, depth=3, trees=5))
    assert scored.where(F.abs(F.col("Touchdown_Prob") + F.col("Opp_Touchdown_Prob") + F.col("Safety_Prob") + F.col("Opp_Safety_Prob") + F.col("No_Score_Prob") - 1) > 1e-6).count() == 0
    fitted = model.train_wp(model.wp_frame(rows), depth=2, rounds=3)
    wp = model.trained_wp(model.wp_frame(rows), fitted)
    assert wp.where("wp < 0 or wp > 1 or wp is null").count() == 0 and wp.count() > 0


def test_evaluation_by_hand(spark):
    import math

    df = spark.createDataFrame([(0, 0.5, 0.5, 1.0), (1, 0.25, 0.75, 3.0), (0, 0.0, 1.0, 0.0), (None, 0.1, 0.9, 1.0), (1, None, None, 1.0)], "label int, a double, b double, w double")
    got = model.evaluate(df, [F.col("a"), F.col("b")], F.col("w")).first()
    assert got["rows"] == 3 and abs(got["log_loss"] + (math.log(0.5) + 3 * math.log(0.75)) / 4) < 1e-12 and got["accuracy"] == 1.0
    assert model.evaluate(df.limit(0), [F.col("a"), F.col("b")]).first()["rows"] == 0


def test_model_lifecycle(spark):
    sf = "/root/testdata/sf0.001"
    quality = reference.ep_trained_quality(spark, sf).collect()
    assert [r["rows_used"] for r in quality] == ["held_out", "held_out", "all"] and all(0 < r["log_loss"] < 1.7 for r in quality) and quality[0]["log_loss"] <= quality[1]["log_loss"]
    shares = [r["importance"] for r in reference.ep_importances(spark, sf).collect()]
    assert abs(sum(shares) - 1) < 1e-9 and shares == sorted(shares, reverse=True)
    assert reference.wp_trained_quality(spark, sf).first()["accuracy"] > 0.5


def test_running_success_by_hand(spark):
    rows = [("H", 2, 1, 0.5), ("H", 1, 1, -1.0), ("H", 1, 2, 0.0), ("K", 3, 1, None), ("H", 2, 2, None)]
    got = {(r["game_id"], r["index"]): (r["successes"], r["plays"], r["success_rate"]) for r in reports.running_success(spark.createDataFrame(rows, "home_team string, game_id int, index int, epa double")).collect()}
    assert got == {(1, 1): (0, 1, 0.0), (1, 2): (1, 2, 0.5), (2, 1): (2, 3, 0.666667), (2, 2): (2, 4, 0.5), (3, 1): (0, 1, 0.0)}


def test_delimited_files(spark, tmp_path):
    import pytest

    from gridsnap.sources import delimited_files as files

    (tmp_path / "a.csv").write_text('x;"y"\n1;"a;b"\n;""\n')
    (tmp_path / "b.csv").write_text("y;z\nc;3\n")
    (tmp_path / "c.csv").write_text("x;y\n5;d\n")
    got = sorted(map(tuple, files.read_many(spark, f"{tmp_path}/*.csv").select("x", "y", "z").collect()), key=str)
    assert got == sorted([("1", "a;b", None), (None, None, None), (None, "c", "3"), ("5", "d", None)], key=str)
    assert files.read_typed(spark, f"{tmp_path}/b.csv", {"y": "string", "z": "int"}, ";").first()["z"] == 3
    with pytest.raises(Exception):
        files.read_typed(spark, f"{tmp_path}/b.csv", {"y": "int", "z": "int"}, ";").collect()


def test_tries_count_each_flag_alone(spark):
    df = spark.createDataFrame([(0, 5, 1, None), (0, 5, None, 1), (0, 5, 0, 0), (1, 5, 1, 1)], "down int, yards_to_go int, one_point_conv_success int, two_point_conv_success int")
    assert [tuple(r) for r in reports.try_rates(df).collect()] == [(5, 2, 2, 1.0)]



def test_flags_on_a_stream(spark, tmp_path):
    from gridsnap.streaming.flags import play_flags

    sf = "/root/testdata/sf0.001"
    rows = playlog.feed_rows(spark.read.parquet(f"{sf}/events.parquet")).select("game_id", "summary", "action_title", "down", "down_desc")
    rows.write.parquet(str(tmp_path / "in"))
    stream = play_flags(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in")))
    query = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    query.awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(map(str, got.collect())) == sorted(map(str, play_flags(rows).collect()))
