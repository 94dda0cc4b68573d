"""Delimited records that fail to parse: an error-recovering recursive-descent grammar.

    text   := record (NEWLINE record)*
    record := field (DELIM field)*
    field  := quoted | bare
    quoted := '"' (any character but '"', or '""')* '"'     followed by DELIM or the record's end
    bare   := any characters but '"', DELIM and NEWLINE

A rule that fails reports where and why. Over a whole text the parser then skips to the next line start that is a
validated anchor, a record of the header's width without a broken quote, so that one broken quote costs one
record and not the rest of the file. Over rows that are one record each, the row is the anchor.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BOM = "﻿"


class Broken(Exception):
    """A quote that opens or closes where the grammar has none; ``at`` is its offset."""

    def __init__(self, at: int) -> None:
        super().__init__(at)
        self.at = at


class RecordParser:
    """Recursive descent over ``text``; ``lines``: a bare line break ends a record (else it is part of a bare field)."""

    def __init__(self, text: str, delim: str, lines: bool = False) -> None:
        self.text, self.delim, self.at, self.lines = text, delim, 0, lines

    def _ends(self, at: int) -> bool:
        return at >= len(self.text) or (self.lines and self.text[at] in "\r\n")

    def quoted(self) -> str:
        parts, start = [], self.at
        self.at += 1
        while True:
            close = self.text.find('"', self.at)
            if close < 0:
                raise Broken(start)
            parts.append(self.text[self.at : close])
            self.at = close + 1
            if not self.text.startswith('"', self.at):
                break
            parts.append('"')
            self.at += 1
        if not self._ends(self.at) and not self.text.startswith(self.delim, self.at):
            raise Broken(close)
        return "".join(parts)

    def bare(self) -> str:
        stops = [i for c in (self.delim, *("\r\n" if self.lines else "")) if (i := self.text.find(c, self.at)) >= 0]
        end = min(stops, default=len(self.text))
        quote = self.text.find('"', self.at, end)
        if quote >= 0:
            raise Broken(quote)
        value, self.at = self.text[self.at : end], end
        return value

    def record(self) -> list[str]:
        fields = []
        while True:
            fields.append(self.quoted() if self.text.startswith('"', self.at) else self.bare())
            if self._ends(self.at):
                return fields
            self.at += len(self.delim)


def parse_record(text: str, delim: str) -> list[str]:
    """The fields of a text that is one record; raises Broken."""
    return text.split(delim) if '"' not in text else RecordParser(text, delim).record()


def parse_text(text: str, delim: str, width: int) -> Iterator[tuple[int, list[str] | None, tuple[int, str] | None]]:
    """(start offset, fields or None, (error offset, reason) or None) of every record of a whole text.

    After a broken quote the next record starts at the next line start from which a record of ``width`` fields parses
    on its own; the text between belongs to the broken record. Empty lines are no records.
    """
    at, n = 0, len(text)
    starts = [m.end() for m in re.finditer(r"\r\n|\r|\n", text)]
    k = 0

    def anchor(at: int) -> bool:
        p = RecordParser(text, delim, lines=True)
        p.at = at
        try:
            return len(p.record()) == width
        except Broken:
            return False

    while at < n:
        if text[at] in "\r\n":
            at += 1
            continue
        p = RecordParser(text, delim, lines=True)
        p.at = at
        try:
            fields = p.record()
            yield at, fields, None if len(fields) == width else (at, "column_count")
            at = p.at
        except Broken as e:
            yield at, None, (e.at, "quoting")
            while k < len(starts) and starts[k] <= at:
                k += 1
            while k < len(starts) and not anchor(starts[k]):
                k += 1
            at = starts[k] if k < len(starts) else n


def parse_texts(texts: DataFrame) -> DataFrame:
    """Parse rows (id, part, text, starts, width, delim) of whole texts, each a bounded run of a file's lines.

    One row per record: id, part, line (which of ``starts``, the offsets at which lines begin, the record begins in), fields
    (null where the quoting is broken), reason (null, ``quoting`` or ``column_count``), at (offset of the error from that line's
    start, maybe in a later one). Broken records end at the next validated anchor. A null text holds no records.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for key, part, text, starts, width, delim in zip(*(batch[c] for c in ("id", "part", "text", "starts", "width", "delim"))):
                starts = list(starts) if starts is not None else []
                for offset, fields, error in parse_text(text, delim or ",", int(width)) if isinstance(text, str) else ():
                    line = bisect_right(starts, offset) - 1
                    out.append((key, part, line, fields, error[1] if error else None, error[0] - starts[line] if error else None))
            got = pd.DataFrame(out, columns=["id", "part", "line", "fields", "reason", "at"])
            yield got.assign(at=pd.array(got["at"], dtype="Int32"))

    kinds = {c: texts.schema[c].dataType.simpleString() for c in ("id", "part")}
    return texts.mapInPandas(run, f"id {kinds['id']}, part {kinds['part']}, line int, fields array<string>, reason string, at int")


def header_names(line: str, delim: str) -> list[str]:
    """Column names of a header: lower case, without byte-order mark, outer quotes and outer blanks."""
    line = line.removeprefix(BOM)
    try:
        names = parse_record(line, delim)
    except Broken:
        names = line.split(delim)
    return [x.strip().removeprefix(BOM).strip('"').strip().lower() for x in names]


Rules = dict[str, Callable[[str], bool]]


def _matches(pattern: str, most: int | None) -> Callable[[str], bool]:
    shape = re.compile(pattern)

    def ok(value: str) -> bool:
        value = value.strip()
        if not shape.fullmatch(value):
            return False
        digits = value.lstrip("0") or "0"
        return most is None or not value.isdigit() or (len(digits) <= len(str(most)) and int(digits) <= most)

    return ok


def value_rules(spec: dict[str, tuple[str, int | None]]) -> Rules:
    """Rules per column name from (pattern of the trimmed value, largest number or None)."""
    return {name: _matches(*how) for name, how in spec.items()}


def checked(batch: pd.DataFrame, checks: Rules) -> Iterator[tuple[list[str], list[str] | None, str | None, int | None]]:
    """(names, fields, reason, place) of every row (line, header, delim) of a batch; rows of one header share its names."""
    heads: dict[tuple, tuple] = {}
    for line, header, delim in zip(batch["line"], batch["header"], batch["delim"]):
        head = heads.get((header, delim))
        if head is None:
            names = header_names(header, delim or ",") if isinstance(header, str) else []
            head = heads[header, delim] = names, [(i, checks[x]) for i, x in enumerate(names) if x in checks]
        names, tests = head
        fields, reason, place = None, None, None
        try:
            fields = parse_record(line if isinstance(line, str) else "", delim or ",")
            if len(fields) != len(names):
                reason = "column_count"
            else:
                place = next((i for i, ok in tests if not ok(fields[i])), None)
                reason = None if place is None else "value"
        except Broken as e:
            reason, place = "quoting", e.at
        yield names, fields, reason, place


def check_records(lines: DataFrame, rules: dict[str, tuple[str, int | None]]) -> DataFrame:
    """Parse rows (id, line_no, line, header, delim) that hold one record each.

    Returns id, line_no, names (the header's), fields (null if the quoting is broken), reason (null for a valid record) and
    error_at (offset of the syntax error, place of the field for ``value``). The first reason that applies counts:
    ``quoting``; ``column_count``, also where there is no header; ``value``, a column of ``rules`` with an entry
    that its rule refuses. A null line is an empty one. Repeated rows give repeated results. Header and delimiter are parsed once
    per file and batch; the work is linear in the text.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        checks = value_rules(rules)
        for batch in batches:
            got = list(checked(batch, checks))
            names, fields, reasons, places = ([x[i] for x in got] for i in range(4))
            yield pd.DataFrame({"id": batch["id"], "line_no": batch["line_no"], "names": names, "fields": fields, "reason": reasons, "error_at": pd.array(places, dtype="Int32")})

    kinds = {c: lines.schema[c].dataType.simpleString() for c in ("id", "line_no")}
    return lines.select("id", "line_no", "line", "header", "delim").mapInPandas(run, f"id {kinds['id']}, line_no {kinds['line_no']}, names array<string>, fields array<string>, reason string, error_at int")


def with_headers(lines: DataFrame, files: DataFrame, file_id: str = "file_id") -> DataFrame:
    """Rows (id, line_no, line, header, delim, and the files' other columns) below each file's header line.

    The header is the smallest text at line_no 1. Files are one row each and their headers too, so the joins are on a
    unique right side: a file with a third of all lines splits over tasks by adaptive skew handling.
    """
    heads = lines.where("line_no = 1 and line is not null").groupBy(F.col(file_id).alias("id")).agg(F.min("line").alias("header"))
    info = files.dropDuplicates([file_id]).withColumnRenamed(file_id, "id").join(heads, "id", "left")
    return lines.where("line_no > 1").select(F.col(file_id).alias("id"), "line_no", "line").join(info, "id", "left")


def parse_headers(lines: DataFrame, files: DataFrame) -> DataFrame:
    """(id, names) of each file (id, delim) with a header line, the smallest text at line_no 1."""
    heads = lines.where("line_no = 1 and line is not null").groupBy(F.col("file_id").alias("id")).agg(F.min("line").alias("header"))

    @F.pandas_udf("array<string>")
    def names(header: pd.Series, delim: pd.Series) -> pd.Series:
        return pd.Series([header_names(h, d or ",") for h, d in zip(header, delim)])

    return heads.join(files.select("id", "delim"), "id").select("id", names("header", "delim").alias("names"))
