import json

from gridsnap.operators.nested import Level, dewey_nodes, find_roots, latest_documents, path_columns, shred

LEVELS = (Level("half", "", ("num", "drives")), Level("drive", "drives"), Level("play", "eventGroups"))


def nodes(spark, docs):
    df = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "key int, payload string")
    return [(r["key"], r["level"], tuple(r["path"]), tuple(r["parent"])) for r in shred(df, LEVELS).collect()]


def test_paths_keep_places_and_parents(spark):
    doc = [None, {"num": 0, "drives": {"eventGroups": [{"a": 1}, None, {"a": 2}]}}, {"num": 1, "drives": None}]
    assert nodes(spark, [json.dumps(doc)]) == [(0, "half", (2,), ()), (0, "half", (3,), ()), (0, "drive", (2, 1), (2,)), (0, "play", (2, 1, 1), (2, 1)), (0, "play", (2, 1, 3), (2, 1))]


def test_wrappings(spark):
    halves = [{"num": 0, "drives": json.dumps([{"eventGroups": json.dumps({"x": 1})}])}]
    for doc in (halves, {"data": halves}, {"match": {"id": 1, "halves": halves}, "meta": {}}, json.dumps(halves), [[halves]]):
        assert [p for *_, p, _ in nodes(spark, [json.dumps(doc)])] == [(1,), (1, 1), (1, 1, 1)], doc
    assert find_roots({"error": "x"}, ("num",)) is None and find_roots([], ("num",)) is None


def test_bad_empty_null_and_long_documents(spark):
    assert nodes(spark, ["", "{", "<html>", "null", "[NaN]", '{"a": 1}']) == []
    assert nodes(spark, [None]) == [] and nodes(spark, []) == []
    deep = "[" * 100_000
    assert nodes(spark, [deep]) == []
    wide = json.dumps([{"num": 0, "drives": [{"eventGroups": [{"s": "x" * 100}] * 30_000}]}])
    assert len(nodes(spark, [wide])) == 30_002


def test_latest_complete_document_wins(spark):
    good, better = json.dumps([{"num": 0}]), json.dumps([{"num": 0}, {"num": 1}])
    data = [(1, 1, good, "k"), (1, 2, better, "k"), (1, 2, better, "k"), (1, 3, better[:-3], "k"), (1, 4, "Too many calls", "k"), (2, 1, None, "k"), (None, 1, good, "k"), (3, None, good, "k"), (4, 1, good, "k"), (4, 1, better, "k")]
    df = spark.createDataFrame(data, "g int, at int, doc string, key string")
    got = {r["key"]: r["payload"] for r in latest_documents(df, "g", "at", "doc", LEVELS).collect()}
    assert got == {1: better, 4: max(good, better)}


def test_nodes_of_a_list_of_one():
    assert [p for _, p, _ in dewey_nodes([{"num": 0, "drives": [{"eventGroups": {}}]}], LEVELS)] == [[1], [1, 1], [1, 1, 1]]


def test_lists_at_any_depth_are_tables_of_their_own(spark):
    play = {"s": 1, "officials": [{"role": "x", "notes": [{"n": 1}, None, {"n": 2}]}], "box": {"a": 1, "marks": [{"m": 5}]}, "tags": [1, 2], "empty": []}
    doc = json.dumps([{"num": 0, "extra": json.dumps([{"e": 1}]), "drives": [{"eventGroups": [None, play]}]}])
    df = spark.createDataFrame([(1, doc)], "key int, payload string")
    got = {(r["level"], tuple(r["path"])): (tuple(r["parent"]), json.loads(r["attrs"])) for r in shred(df, LEVELS, every=True).collect()}
    assert got == {
        ("half", (1,)): ((), {"num": 0}), ("half/extra", (1, 1)): ((1,), {"e": 1}), ("drive", (1, 1)): ((1,), {}), ("play", (1, 1, 2)): ((1, 1), {"s": 1, "box": {"a": 1}, "tags": [1, 2], "empty": []}),
        ("play/officials", (1, 1, 2, 1)): ((1, 1, 2), {"role": "x"}), ("play/officials/notes", (1, 1, 2, 1, 1)): ((1, 1, 2, 1), {"n": 1}), ("play/officials/notes", (1, 1, 2, 1, 3)): ((1, 1, 2, 1), {"n": 2}), ("play/box/marks", (1, 1, 2, 1)): ((1, 1, 2), {"m": 5}),
    }
    cols = {(r["level"], r["column"]): (r["kind"], r["rows"]) for r in path_columns(shred(df, LEVELS, every=True)).collect()}
    assert cols["play/officials/notes", "n"] == ("whole", 2) and cols["play", "box"] == ("object", 1) and cols["play", "tags"] == ("list", 1) and cols["play/officials", "role"] == ("text", 1)


def test_every_record_finds_its_parent_and_extra_fields_stay(spark):
    from gridsnap.queries.problems import QUERIES

    sf = "/root/testdata/sf0.001"
    links = {r["schema_path"]: r for r in QUERIES["p3_links"](spark, sf).collect()}
    assert links["half"]["with_parent"] == 0 and {"drive", "play", "play/officials/notes"} <= set(links)
    assert all(r["records"] == r["with_parent"] for path, r in links.items() if path != "half")
    assert sum(r["records"] for path, r in links.items() if path in ("half", "drive", "play")) == QUERIES["p3_found"](spark, sf).count()
    plays = QUERIES["p3_plays"](spark, sf)
    assert plays.where("size(extra) > 0").count() > 0 and "officials" in {k for r in plays.where("size(extra) > 0").collect() for k in r["extra"]}
