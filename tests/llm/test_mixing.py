from gridsnap.llm.mixing import Queue, mix, shares, token_counts


def run(spark, docs, targets, **more):
    d = spark.createDataFrame(docs, "doc_id bigint, source string, tokens bigint, share double, pass int")
    t = spark.createDataFrame(targets, "source string, target_share double, max_repeats int")
    out = mix(d, t, **more)
    return out.collect(), {r["source"]: r for r in shares(out, t).collect()}


def test_shares_repeats_and_budget(spark):
    docs = [(i, "big", 7 + i % 5, 0.0, 0) for i in range(900)] + [(1000 + i, "small", 10, 0.0, 0) for i in range(30)] + [(5000, None, 10, 0.0, 0), (5001, "other", 10, 0.0, 0), (5002, "big", None, 0.0, 0), (5003, "big", 0, 0.0, 0)]
    targets = [("big", 0.75, 1), ("small", 0.25, 3), ("none", 0.5, 2), (None, 0.1, 1)]
    rows, got = run(spark, docs, targets, slice_rows=50)
    assert abs(got["small"]["actual_share"] - 0.25) < 0.01 and got["none"]["tokens"] == 0
    assert max(r["pass"] for r in rows) == 3 and max(r["position"] for r in rows) <= 30 * 10 * 3 / 0.25
    again, _ = run(spark, docs[::-1], targets, slice_rows=400)
    assert sorted((r["doc_id"], r["pass"]) for r in rows) == sorted((r["doc_id"], r["pass"]) for r in again)
    rows, _ = run(spark, docs, targets, budget=1000, slice_rows=50)
    total = sum(r["tokens"] for r in rows)
    assert 1000 - 12 < total <= 1000 and sorted(r["position"] for r in rows)[-1] == total
    rows, got = run(spark, docs, targets, budget=10**9)
    assert got["small"]["copies"] == 90 and got["big"]["copies"] == 900


def test_against_one_queue(spark):
    docs = [(i, "ab"[i % 2], 1 + i % 9, 0.0, 0) for i in range(200)]
    rows, _ = run(spark, docs, [("a", 0.3, 2), ("b", 0.7, 1)], slice_rows=20)
    order = sorted(rows, key=lambda r: (r["finish"], r["source"], r["doc_id"], r["pass"]))
    total = 0
    for r in order:
        total += r["tokens"]
        assert r["position"] == total


def test_empty_and_same_ids(spark):
    assert run(spark, [], [("a", 1.0, 1)])[0] == []
    assert run(spark, [(1, "a", 3, 0.0, 0)], [])[0] == []
    rows, got = run(spark, [(1, "a", 3, 0.0, 0)] * 4, [("a", 1.0, 1)])
    assert got["a"]["copies"] == 4 and sorted(r["position"] for r in rows) == [3, 6, 9, 12]


def test_queue_arithmetic():
    q = Queue([{"source": "a", "share": 1.0, "tokens": 10, "repeats": 1, "longest": 0}, {"source": "b", "share": 1.0, "tokens": 100, "repeats": 1, "longest": 0}], None)
    assert q.budget == 20 and q.last == 20.0 and q._time(60) == 100.0 and q._time(10**6) == 200.0


def test_tokens_of_whole_texts(spark):
    df = spark.createDataFrame([(1, "Hello world"), (2, None), (3, ""), (4, "word " * 50_000)], "doc_id int, text string")
    got = {r["doc_id"]: r["tokens"] for r in token_counts(df, ["doc_id"]).collect()}
    assert got[1] == 2 and got[2] == got[3] == 0 and got[4] >= 50_000
