import itertools

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from gridsnap.operators import drift
from gridsnap.operators.delimited import check_records, parse_headers, with_headers


@given(st.integers(1, 4), st.integers(1, 5), st.integers(0, 10_000))
@settings(max_examples=60, deadline=None)
def test_assignment_is_best(n, m, seed):
    w = np.random.default_rng(seed).integers(0, 9, (n, m)).astype(float)
    got = sum(w[i, j] for i, j in drift.assign(w))
    small = w if n <= m else w.T
    best = max(sum(small[i, p[i]] for i in range(small.shape[0])) for p in itertools.permutations(range(small.shape[1]), small.shape[0]))
    assert got == best


def test_names():
    assert drift.name_similarity("touchdown", "td") > 0.6 and drift.name_similarity("pos_team", "posteam") == 1.0
    assert drift.name_similarity("half", "weather") < 0.4 and drift.name_similarity("", "a") == 0.0


def changes(spark, feeds):
    lines, files, fid = [], [], 0
    for feed, versions in feeds.items():
        for day, (header, *rows) in enumerate(versions):
            fid += 1
            files.append((fid, feed, "fam", day, ";"))
            lines += [(fid, 1, header), *[(fid, i, r) for i, r in enumerate(rows, 2)]]
    f = spark.createDataFrame(files, "id int, feed string, family string, covers_from int, delim string")
    ln = spark.createDataFrame(lines, "file_id int, line_no int, line string")
    rows = with_headers(ln, f.withColumnRenamed("id", "file_id").select("file_id", "delim"))
    rec = check_records(rows, {}).where("reason is null")
    sch = drift.file_schemas(f.drop("delim"), parse_headers(ln, f), drift.profile_columns(rows, {}))
    return sch, rec, drift.schema_changes(sch)


def test_changes_and_one_table(spark):
    body = [f"{i % 4};{'AB'[i % 2]}{i % 3};{i}" for i in range(40)]
    feeds = {"f": [["down;team;n", *body], ["n;DN_NO;team", *[f"{r.split(';')[2]};{r.split(';')[0]};{r.split(';')[1]}" for r in body]], ["n;dn_no;weather", *[f"{i}.5;{i % 4};{['rain', 'sun'][i % 2]}" for i in range(40)]]], "g": [["down;team;n"], ["down;team;n;empty", "1;A;;NA"]]}
    sch, rec, got = changes(spark, feeds)
    rows = sorted((r["id"], r["kind"], r["old_name"], r["new_name"]) for r in got.collect())
    assert rows == [(2, "renamed", "down", "dn_no"), (3, "added", "", "weather"), (3, "removed", "team", ""), (3, "retyped", "n", "n"), (5, "added", "", "empty")]
    canon = drift.canonical_names(sch, got)
    assert {r["canonical"] for r in canon.where("name in ('down', 'dn_no')").collect()} == {"down"}
    one = {(r["id"], r["line_no"]): r["record"] for r in drift.unify(rec, sch, canon).collect()}
    assert one[2, 2] == {"n": "0", "down": "0", "team": "A0"} and one[5, 2] == {"down": "1", "team": "A", "n": None, "empty": None}


def test_names_that_stood_together_are_never_matched(spark):
    row = [f"{'AB'[i % 2]};{'BA'[i % 2]};{i}" for i in range(30)]
    _, _, got = changes(spark, {"f": [["posteam;defteam;n", *row]], "g": [["defteam;n", *["A;1", "B;2"] * 15], ["posteam;n", *["A;1", "B;2"] * 15]]})
    assert sorted((r["kind"], r["old_name"], r["new_name"]) for r in got.collect()) == [("added", "", "posteam"), ("removed", "defteam", "")]


def test_empty(spark):
    _, _, got = changes(spark, {"f": [["a;b"]]})
    assert got.count() == 0


def test_one_untidy_header_bars_no_rename(spark):
    body = [f"{i % 4};{'AB'[i % 2]}{i % 3}" for i in range(30)]
    many = {f"g{k}": [["down;team", *body], ["dn_no;team", *body]] for k in range(25)}
    _, _, got = changes(spark, many | {"odd": [["down;dn_no;team", *[f"1;2;A{i}" for i in range(5)]]]})
    assert {(r["kind"], r["old_name"], r["new_name"]) for r in got.collect()} == {("renamed", "down", "dn_no")} and got.count() == 25


def test_typed_tables_keep_misfits(spark):
    a = ["n;flag;x;t;e", *[f"{i};{'yes' if i % 2 else 'no'};{i}.5;word{i};" for i in range(30)], "oops;maybe;;NA;"]
    sch, rec, got = changes(spark, {"f": [a, ["t;n", "u;7"]]})
    canon = drift.canonical_names(sch, got)
    types = drift.column_types(sch, canon)
    assert {r["name"]: r["type"] for r in types} == {"n": "bigint", "flag": "boolean", "x": "double", "t": "string", "e": "string"}
    out = {(r["id"], r["line_no"]): r for r in drift.typed_table(drift.unify(rec, sch, canon), types, "fam").collect()}
    assert (out[1, 3]["n"], out[1, 3]["flag"], out[1, 3]["x"], out[1, 3]["t"], out[1, 3]["misfits"]) == (1, True, 1.5, "word1", {})
    assert out[1, 32]["n"] is None and out[1, 32]["misfits"] == {"n": "oops", "flag": "maybe"} and out[2, 2]["n"] == 7 and out[2, 2]["x"] is None
