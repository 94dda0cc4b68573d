"""Deeply nested JSON records to flat, linked tables by Dewey labels.

Every node that stands in a list of records gets an ordinal path: its place in its list, after the path of its parent
(``2.1.5`` = fifth play of the first drive of the second half). A parent's key is the path without its last ordinal, so
links need no join and no generated ids. Nodes are grouped by schema path into tables: the levels named for a document, and below
and beside them every other field that holds a list of objects, at any depth, under the path where it was found
(``play/officials/notes``). A document is parsed where it lies, one per row: nothing is gathered, and the work is linear in the text.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


COLUMNS = ["key", "level", "path", "parent", "attrs", "root"]


@dataclass(frozen=True)
class Level:
    """A table: its name, the field of the parent that holds its records, and fields one of which marks a root record."""

    name: str
    field: str
    marks: tuple[str, ...] = ()


def _strict(text: object) -> object:
    """The JSON value of ``text``, or ValueError; NaN and Infinity are not JSON."""
    if not isinstance(text, str):
        raise ValueError("no text")

    def no(token: str) -> None:
        raise ValueError(token)

    return json.loads(text, parse_constant=no)


def _opened(value: object) -> object:
    """A value that is itself JSON text of a list or an object, parsed; anything else as it is."""
    while isinstance(value, str) and value.lstrip()[:1] in ("[", "{"):
        try:
            value = _strict(value)
        except (ValueError, RecursionError):
            return value
    return value


def _elements(value: object) -> list:
    """The places of a list of records: a single object is a list of one, a list alone inside a list is that list."""
    value = _opened(value)
    while isinstance(value, list) and len(value) == 1 and isinstance(_opened(value[0]), list):
        value = _opened(value[0])
    return value if isinstance(value, list) else [value] if isinstance(value, dict) else []


def find_roots(document: object, marks: tuple[str, ...]) -> list | None:
    """The list of root records in a document however it is wrapped, or None if it holds none.

    A root record is an object with one of the ``marks``. Wrapping objects are searched breadth first, in the order
    of their fields.
    """
    layer = [_opened(document)]
    while layer:
        below = []
        for value in layer:
            items = _elements(value)
            if any(isinstance(r := _opened(x), dict) and any(m in r for m in marks) for x in items):
                return items
            if isinstance(value, dict):
                below += [o for v in value.values() if isinstance(o := _opened(v), (dict, list))]
            elif isinstance(value, list):
                below += [o for v in value if isinstance(o := _opened(v), (dict, list))]
        layer = below
    return None


def dewey_nodes(roots: list, levels: tuple[Level, ...]) -> Iterator[tuple[int, list[int], dict]]:
    """(depth, ordinal path, record) of each record, parents first; null and other non-objects keep their place."""
    stack = [(0, [], roots)]
    while stack:
        depth, path, items = stack.pop()
        for place, item in enumerate(items, 1):
            record = _opened(item)
            if not isinstance(record, dict):
                continue
            label = [*path, place]
            yield depth, label, record
            if depth + 1 < len(levels):
                stack.append((depth + 1, label, _elements(record.get(levels[depth + 1].field))))


def split_lists(record: dict, skip: str | None = None) -> tuple[dict, list[tuple[str, list]]]:
    """(own fields, lists of objects by their path below the record); ``skip`` is a field that is a level of its own."""
    own: dict = {}
    lists: list[tuple[str, list]] = []
    for name, value in record.items():
        opened = _opened(value)
        if name == skip:
            continue
        if isinstance(opened, list) and any(isinstance(_opened(x), dict) for x in opened):
            lists.append((name, opened))
        elif isinstance(opened, dict):
            own[name], inner = split_lists(opened)
            lists += [(f"{name}/{path}", items) for path, items in inner]
        else:
            own[name] = value
    return own, lists


def path_nodes(name: str, label: list[int], record: dict, skip: str | None) -> Iterator[tuple[str, list[int], dict]]:
    """(schema path, ordinal path, own fields) of a record and of everything in its lists of objects, parents first.

    Ordinals count within one list; lists of one record differ by their schema path.
    """
    stack = [(name, label, record, skip)]
    while stack:
        name, label, record, skip = stack.pop()
        try:
            own, lists = split_lists(record, skip)
        except RecursionError:
            own, lists = {k: v for k, v in record.items() if k != skip}, []
        yield name, label, own
        stack += [(f"{name}/{path}", [*label, place], opened, None) for path, items in lists for place, item in enumerate(items, 1) if isinstance(opened := _opened(item), dict)]


def is_document(payload: Column, levels: tuple[Level, ...]) -> Column:
    """True where the text is complete, valid JSON that holds root records."""
    marks = levels[0].marks

    @F.pandas_udf("boolean")
    def check(texts: pd.Series) -> pd.Series:
        def good(text: object) -> bool:
            try:
                return find_roots(_strict(text), marks) is not None
            except (ValueError, RecursionError):
                return False

        return texts.map(good).astype(bool)

    return check(payload)


def latest_documents(df: DataFrame, key: str, at: str, payload: str, levels: tuple[Level, ...]) -> DataFrame:
    """The latest complete document per key as (key, payload); ties in time go to the larger text.

    Documents without key or time are no candidates. The maximum is combined map-side, so many fetches of one key
    reach a reducer as one row per input task.
    """
    ok = df.select(F.col(key).alias("key"), F.col(at).alias("at"), F.col(payload).alias("payload")).where("key is not null and at is not null and payload is not null")
    ok = ok.where(is_document(F.col("payload"), levels))
    return ok.groupBy("key").agg(F.max(F.struct("at", "payload")).alias("m")).select("key", F.col("m.payload").alias("payload"))


def shred(documents: DataFrame, levels: tuple[Level, ...], carry: tuple[str, ...] = (), every: bool = False) -> DataFrame:
    """All nodes of (key, payload) documents: key, level, path (array<int>), parent (path without its last), attrs (JSON).

    With ``every``, lists of objects inside the records of the levels are nodes too, and their level is the schema path from
    the level's name on. attrs holds the record's own fields without those that are tables of their own. root holds the ``carry`` fields of the
    node's root record, so that keys kept there reach every level without a join. Invalid documents give no rows.
    """
    marks, names = levels[0].marks, [x.name for x in levels]
    inner = [levels[i + 1].field if i + 1 < len(levels) else None for i in range(len(levels))]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out: list[tuple] = []
            for key, text in zip(batch["key"], batch["payload"]):
                try:
                    roots = find_roots(_strict(text), marks)
                except (ValueError, RecursionError):
                    continue
                kept: dict[int, str] = {}
                for depth, path, record in dewey_nodes(roots or [], levels):
                    if depth == 0:
                        kept[path[0]] = json.dumps({k: record.get(k) for k in carry}, ensure_ascii=False)
                    if every:
                        nodes = path_nodes(names[depth], path, record, inner[depth])
                    else:
                        nodes = [(names[depth], path, {k: v for k, v in record.items() if k != inner[depth]})]
                    out += [(key, name, label, label[:-1], json.dumps(attrs, ensure_ascii=False), kept[path[0]]) for name, label, attrs in nodes]
                if len(out) >= 20000:
                    yield pd.DataFrame(out, columns=COLUMNS)
                    out = []
            yield pd.DataFrame(out, columns=COLUMNS)

    return documents.select("key", "payload").mapInPandas(run, f"key {documents.schema['key'].dataType.simpleString()}, level string, path array<int>, parent array<int>, attrs string, root string")


def path_columns(nodes: DataFrame) -> DataFrame:
    """(level, column, kind, rows) of the tables that nodes (level, attrs) form: every field found, with its kinds of value.

    kind is ``object``, ``list``, ``whole``, ``decimal``, ``yes_no`` or ``text``; nulls count under none. Counted map-side.
    """
    cells = nodes.select("level", F.explode(F.from_json("attrs", "map<string,string>")).alias("column", "v")).where("v is not null")
    kind = F.when(F.col("v").startswith("{"), "object").when(F.col("v").startswith("["), "list").when(F.col("v").rlike("^-?[0-9]+$"), "whole").when(F.col("v").rlike(r"^-?[0-9]+\.[0-9]+$"), "decimal").when(F.col("v").isin("true", "false"), "yes_no").otherwise("text")
    return cells.groupBy("level", "column", kind.alias("kind")).agg(F.count(F.lit(1)).alias("rows"))
