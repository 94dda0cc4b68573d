from pyspark.sql import functions as F

from gridsnap.operators.hotdeck import Deck, Fill, apply_fills, hot_deck
from gridsnap.queries.problems import QUERIES, SQL

SCHEMA = "game bigint, play int, drive int, team string, yard double, f0 string, cell string, r int"


def deck(**more):
    return Deck("game", "play", (Fill("team", "cat", F.col("team").isin("A", "B"), ("drive",)), Fill("yard", "num", F.col("yard").between(0, 50), ())), {"drive": ("cat", 1.0)}, cell=4, **more)


def rows(spark, data):
    return spark.createDataFrame([(*r, "x", "y", 1) for r in data], SCHEMA)


def fills(spark, data):
    return {(r["game"], r["play"], r["field"]): (r["value"], r["source"]) for r in hot_deck(rows(spark, data), deck()).collect()}


def test_near_and_group_donors(spark):
    data = [(1, 1, 1, "A", 10.0), (1, 2, 1, None, 99.0), (1, 3, 2, "B", float("nan")), (1, 20, 1, " ", 12.0), (1, 21, 3, None, None)]
    got = fills(spark, data)
    assert got[1, 2, "team"] == ("A", "near") and got[1, 20, "team"] == ("A", "group")
    assert (1, 21, "team") not in got  # nobody else in its drive
    assert got[1, 3, "yard"][0] == "10.0" and got[1, 2, "yard"][0] == "10.0"
    assert float(got[1, 21, "yard"][0]) == 12.0


def test_nulls_in_keys_are_left_alone_and_empty_table(spark):
    data = [(None, 1, 1, None, None), (1, None, 1, None, None), (1, 1, None, None, 5.0), (1, 2, None, "A", 5.0)]
    assert fills(spark, data) == {}
    assert hot_deck(rows(spark, []), deck()).count() == 0


def test_repeated_rows_count_once_and_do_not_donate_to_themselves(spark):
    data = [(1, 1, 1, None, 1.0)] * 3 + [(1, 2, 1, "B", 1.0)] * 2 + [(1, 3, 1, "A", 1.0), (1, 4, 1, "A", 1.0)]
    assert hot_deck(rows(spark, data), deck()).count() == 1
    assert fills(spark, [(1, 1, 1, None, 1.0), (1, 1, 1, None, 1.0)]) == {}


def test_ties_go_to_the_closest(spark):
    assert fills(spark, [(1, 4, 1, None, 1.0), (1, 5, 1, "B", 1.0), (1, 7, 1, "A", 1.0)])[1, 4, "team"][0] == "B"


def test_long_texts_and_untouched_entries(spark):
    long = "A" * 200_000
    df = rows(spark, [(1, 1, 1, long, 1.0), (1, 2, 1, "A", None)])
    out = {r["play"]: r for r in apply_fills(df, deck(), hot_deck(df, deck())).collect()}
    assert out[1]["team"] == "A" and out[1]["team_filled"] and out[1]["team_donors"] == [2]
    assert out[2]["yard"] == 1.0 and out[2]["yard_filled"] and not out[2]["team_filled"] and out[2]["f0"] == "x"


def test_against_sql(compare):
    left, right = compare(QUERIES["p1_found"], SQL["p1_found"])
    assert left == right


def test_same_under_other_partitioning(spark):
    data = [(g, p, p // 3, None if p % 5 == 0 else "AB"[p % 2], None if p % 7 == 0 else float(p % 50)) for g in range(3) for p in range(40)]
    a = sorted(map(tuple, hot_deck(rows(spark, data), deck()).drop("donors").collect()))
    b = sorted(map(tuple, hot_deck(rows(spark, data[::-1]).repartition(9), deck()).drop("donors").collect()))
    assert a == b and a


def test_neighbouring_cells_and_nearest_donors_far_away(spark):
    deck = Deck("game", "play", (Fill("yard", "num", F.col("yard").between(0, 50), ("drive",)),))
    data = [(1, p, 1, v) for p, v in [(1, 5), (2, 5), (3, 5), (31, 40), (32, None)]] + [(2, p, 1, v) for p, v in [(1, 5), (2, 9), (3, 20), (200, None)]]
    data += [(3, p, 1, v) for p, v in [(5, 1), (40_000, 7), (2_000_000, None), (5_000_000, 30), (9_000_000, 50)]] + [(4, 7, 1, None), (4, 7, 1, None)]
    got = {r["game"]: r for r in hot_deck(spark.createDataFrame(data, "game int, play int, drive int, yard int"), deck).collect()}
    assert got[1]["source"] == "near" and 31 in got[1]["donors"] and float(got[1]["value"]) == 40
    # Of a far cell the last and the first donor are offered; the closest comes first and decides.
    assert got[2]["source"] == "group" and got[2]["donors"] == [3, 1] and float(got[2]["value"]) == 20
    assert got[3]["source"] == "group" and got[3]["donors"][0] == 40_000 and set(got[3]["donors"]) <= {5, 40_000, 5_000_000, 9_000_000} and 4 not in got


def test_donors_beyond_the_edge_of_a_cell_outvote_one_far_inside(spark):
    deck = Deck("game", "play", (Fill("team", "cat", F.col("team").isin("A", "B"), ("drive",)),))
    data = [(1, p, 1, v) for p, v in [(2, "A"), (31, None), (32, "B"), (33, "B"), (34, "B")]]
    got = hot_deck(spark.createDataFrame(data, "game int, play int, drive int, team string"), deck).collect()
    assert [(r["value"], r["donors"][0]) for r in got] == [("B", 32)]


def test_groups_beyond_the_broadcast_bound(spark, monkeypatch):
    from gridsnap.operators import hotdeck

    data = [(g, p, 1, None if p == 1 else 7) for g in range(5) for p in (1, 900)]
    df = spark.createDataFrame(data, "game int, play int, drive int, yard int")
    deck = Deck("game", "play", (Fill("yard", "num", F.col("yard").between(0, 50), ("drive",)),))
    want = sorted(map(str, hot_deck(df, deck).collect()))
    monkeypatch.setattr(hotdeck, "BROADCAST_ENTRIES", 0)
    assert sorted(map(str, hot_deck(df, deck).collect())) == want and len(want) == 5


def test_masked_values_come_back(spark):
    """Known entries are hidden; the filled ones must be near them: far better than the most frequent value or the overall median."""
    from gridsnap.queries.problems import play_deck
    from gridsnap.sources.tables import table

    plays = table(spark, "/root/testdata/sf0.01", "plays").select("game_id", "play_id", "drive_id", "half", "home_team", "away_team", "play_type", "down", "yards_to_go", "posteam", "yardline_50", "ep", "Winner")
    hide = F.pmod(F.xxhash64("game_id", "play_id"), F.lit(17)) == 0
    names = ("posteam", "yardline_50", "ep", "Winner")
    masked = plays.withColumns({n: F.when(~hide, F.col(n)) for n in names})
    got = hot_deck(masked, play_deck()).select("game_id", "play_id", "field", "value")
    deck = play_deck()
    true = plays.where(hide).select("game_id", "play_id", F.explode(F.array_compact(F.array(*[F.when(f.valid, F.struct(F.lit(f.name).alias("field"), F.col(f.name).cast("string").alias("true"))) for f in deck.fills]))).alias("t")).select("game_id", "play_id", "t.*").distinct()
    both = true.join(got, ["game_id", "play_id", "field"]).withColumn("off", F.abs(F.col("true").try_cast("double") - F.col("value").try_cast("double")))
    seen = {r["field"]: r for r in both.groupBy("field").agg(F.count(F.lit(1)).alias("n"), F.avg((F.col("true") == F.col("value")).cast("double")).alias("same"), F.median("off").alias("off")).collect()}
    print({k: (v["n"], v["same"], v["off"]) for k, v in seen.items()})
    assert all(v["n"] > 100 for v in seen.values())
    assert seen["Winner"]["same"] > 0.97 and seen["posteam"]["same"] > 0.9 and seen["yardline_50"]["off"] < 8 and seen["ep"]["off"] < 1.5
