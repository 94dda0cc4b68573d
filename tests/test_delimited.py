import csv
import io

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gridsnap.operators.delimited import Broken, check_records, header_names, parse_record, parse_text, parse_texts, value_rules, with_headers
from gridsnap.queries.problems import RAW_RULES


@given(st.lists(st.text(alphabet='ab",;\n é', max_size=6), min_size=1, max_size=5), st.sampled_from([",", ";"]))
@settings(max_examples=200, deadline=None)
def test_round_trip(fields, delim):
    line = delim.join('"' + f.replace('"', '""') + '"' for f in fields)
    assert parse_record(line, delim) == fields
    out = io.StringIO()
    csv.writer(out, delimiter=delim, lineterminator="").writerow(fields)
    if "\r" not in out.getvalue():
        assert parse_record(out.getvalue(), delim) == fields


@pytest.mark.parametrize("line,at", [('a;"b', 2), ('a;b"c', 3), ('a;"b"x;c', 4), (' "a";b', 1), ('a;"b" ;c', 4), ('"a""', 0)])
def test_broken_quotes_are_located(line, at):
    with pytest.raises(Broken) as e:
        parse_record(line, ";")
    assert e.value.at == at


def test_recovery_at_validated_anchors():
    text = '1,2\n3,"x\n4,5\nbad\n6,7\n\n8,"a\nb"\n'
    got = list(parse_text(text, ",", 2))
    assert [f for _, f, e in got if e is None] == [["1", "2"], ["4", "5"], ["6", "7"], ["8", "a\nb"]]
    assert [(text[o], r) for _, f, e in got if e for o, r in [e]] == [('"', "quoting"), ("b", "column_count")]


def test_values():
    ok = value_rules(RAW_RULES)
    assert all(ok["dist"](x) for x in ("0", "50", " 7 ", "G", "NA", "", " ", "007"))
    assert not any(ok["dist"](x) for x in ("51", "-1", "1.0", "٧", "g", "n.a.", "9" * 5000))
    assert ok["count"]("123456789") and not ok["count"]("") and not ok["count"]("NA")


def test_headers():
    assert header_names('﻿"Game_ID"; play_id ;"OFF FORM"', ";") == ["game_id", "play_id", "off form"]


def test_rows(spark):
    files = spark.createDataFrame([(1, ";", "x"), (1, ";", "x"), (2, ",", "y"), (3, ";", "z")], "file_id int, delim string, feed string")
    data = [(1, 1, "a;DIST"), (1, 2, "q;5"), (1, 2, "q;5"), (1, 3, 'q;"5'), (1, 4, "q"), (1, 5, "q;x"), (1, 6, None), (1, 7, "é;" + "0" * 100_000), (2, 1, '"a","count"'), (2, 2, '"x,y",3'), (3, 2, "no;header"), (None, 2, "a")]
    lines = spark.createDataFrame(data, "file_id int, line_no int, line string")
    got = {(r["id"], r["line_no"]): r["reason"] for r in check_records(with_headers(lines, files), RAW_RULES).collect()}
    assert got == {(1, 2): None, (1, 3): "quoting", (1, 4): "column_count", (1, 5): "value", (1, 6): "column_count", (1, 7): None, (2, 2): None, (3, 2): "column_count", (None, 2): "column_count"}
    assert check_records(with_headers(lines.limit(0), files), RAW_RULES).count() == 0


def test_found_lines_against_sql(compare):
    from gridsnap.queries.problems import QUERIES, SQL

    for name in ("p5_found", "p1_counts"):
        left, right = compare(QUERIES[name], SQL[name], 1)
        assert left == right and left, name


def test_whole_texts(spark):
    text = '1,2\n3,"x\n4,5\nbad\n6,7\n8,"a\nb"'
    starts = [0] + [i + 1 for i, c in enumerate(text) if c == "\n"]
    df = spark.createDataFrame([(1, 0, text, starts, 2, ","), (2, 0, None, None, 2, ","), (3, 0, "", [0], 2, None)], "id int, part int, text string, starts array<int>, width int, delim string")
    got = sorted((r["line"], tuple(r["fields"] or ()), r["reason"], r["at"]) for r in parse_texts(df).collect())
    assert got == [(0, ("1", "2"), None, None), (1, (), "quoting", 19), (2, ("4", "5"), None, None), (3, ("bad",), "column_count", 0), (4, ("6", "7"), None, None), (5, ("8", "a\nb"), None, None)]


def test_errors_have_their_place(spark):
    from gridsnap.queries.problems import QUERIES

    sf = "/root/testdata/sf0.001"
    rows = QUERIES["p5_errors"](spark, sf).collect()
    assert {r["reason"] for r in rows} == {"quoting", "column_count", "value"}
    assert all((r["error_offset"] is not None) == (r["reason"] == "quoting") and (r["field"] is not None) == (r["reason"] == "value") for r in rows)
    whole = {(r["file_id"], r["line_no"]) for r in QUERIES["p5_recovered"](spark, sf).collect()}
    assert whole and whole & {(r["file_id"], r["line_no"]) for r in rows if r["reason"] == "quoting"}
