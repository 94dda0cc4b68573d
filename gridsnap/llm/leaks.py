"""Held-out test items inside a corpus: phrase search in an FM-index per shard, then alignment of the passages.

A shard is a run of documents of bounded size inside one partition. Its words become one sequence, indexed by an FM-index; all
phrases of all items are searched backwards at once, their occurrences located, and grouped by document and item. How long
an item's phrases are, and how many of them a leak must keep, follows from its length: half its words, in two passages of which
one word in eight is changed wherever that hurts most, still hold that many. Groups with enough of them are aligned word by
word, which decides. There is no shuffle, and every word of every document is indexed.
"""

from __future__ import annotations

import difflib
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridsnap.llm.fmindex import FMIndex
from gridsnap.llm.text import fold

#: Longest phrase searched for.
PHRASE = 5
#: Words of an index; memory is about 150 bytes a word.
SHARD_WORDS = 400_000
#: Largest text of the items that driver and tasks hold at a time, in bytes; more items are sent, and searched for, in several parts.
ITEM_BYTES = 16_000_000
#: Words of an item below which nothing is a borrowing: "a few words".
FEW = 5
TAG = re.compile(r"</?[A-Za-z][^<>]*>|&[A-Za-z][A-Za-z0-9]*;|&#[0-9]+;|&#[xX][0-9A-Fa-f]+;")
WORD = re.compile(r"[^\W_](?:[^\W_]|[\u0300-\u036f])*")
PLAIN = re.compile(r"[a-z0-9]+")


def _bare(text: str) -> str:
    return TAG.sub(lambda m: " " * len(m[0]), text) if "<" in text or "&" in text else text


def words_of(text: str | None) -> list[str]:
    """Folded words; markup, punctuation and entities separate them."""
    if not text:
        return []
    text = _bare(text)
    return PLAIN.findall(text.lower()) if text.isascii() else [fold(w) for w in WORD.findall(text)]


def places_of(text: str) -> list[tuple[int, int]]:
    """Where the words of words_of stand."""
    return [m.span() for m in WORD.finditer(_bare(text))]


def phrase_plan(length: int) -> tuple[int, int]:
    """(words of a phrase, different phrases of an item that a leak keeps at least) for an item of ``length`` words.

    Half the words in two passages, one in eight changed, keep ``half - 2 (p - 1) - p changes`` phrases of p words at least. The
    longest phrase of which some are kept is taken; half of their number is asked for, as the rate is "about" one in eight.
    """
    half = -(-length // 2)
    changes = -(-half // 8)
    kept = lambda p: half - 2 * (p - 1) - p * changes
    size = next((p for p in range(PHRASE, 1, -1) if kept(p) > 0), min(2, length))
    return size, max(1, kept(size) // 2)


def passages(item: list[str], doc: list[str], hits: list[tuple[int, int]], size: int = PHRASE) -> list[tuple[int, int, int, int, int]]:
    """Aligned passages (item from, item to, doc from, doc to, words equal) around hits (doc place, item place) of phrases of ``size``.

    Hits on nearby diagonals belong together, as far as words dropped or added may shift them; each group is aligned locally and cut where more than six words differ.
    """
    out, group = [], []
    slack = 8 + len(item) // 8

    def close() -> None:
        p0, p1 = min(p for p, _ in group), max(p for p, _ in group) + size
        q0, q1 = min(q for _, q in group), max(q for _, q in group) + size
        a0, b0 = max(0, q0 - slack), max(0, p0 - slack)
        a, b = item[a0 : q1 + slack], doc[b0 : p1 + slack]
        blocks = [x for x in difflib.SequenceMatcher(None, a, b, autojunk=False).get_matching_blocks() if x.size >= 2]
        run: list = []
        for x in [*blocks, None]:
            if run and (x is None or x.a - run[-1].a - run[-1].size > 6 or x.b - run[-1].b - run[-1].size > 6):
                out.append((a0 + run[0].a, a0 + run[-1].a + run[-1].size, b0 + run[0].b, b0 + run[-1].b + run[-1].size, sum(y.size for y in run)))
                run = []
            run.append(x)

    for hit in sorted(hits, key=lambda h: (h[0] - h[1], h)):
        at = hit[0] - hit[1]
        if group and (at - group[-1][0] + group[-1][1] > 4 or at - group[0][0] + group[0][1] > slack):
            close()
            group = []
        group.append(hit)
    if group:
        close()
    return out


def leak_of(item: list[str], doc: list[str], hits: list[tuple[int, int]], share: float = 0.5) -> list[tuple[int, int]] | None:
    """Word spans of the document that hold at least ``share`` of the item in one or two passages, or None.

    A passage has three equal words at least, and more the longer the item is; both together have ``FEW``.
    """
    least = max(3, len(item) // 24)
    good = sorted((p for p in set(passages(item, doc, hits, phrase_plan(len(item))[0])) if p[4] >= least and p[4] >= 0.7 * max(p[1] - p[0], p[3] - p[2])), key=lambda p: (-p[4], p))
    # Of all passages over the same words of the item, where the first ends and the last begins says whether one stands beside another passage.
    ends: dict[tuple[int, int], int] = {}
    starts: dict[tuple[int, int], int] = {}
    for p in good:
        ends[p[:2]] = min(p[3], ends.get(p[:2], p[3]))
        starts[p[:2]] = max(p[2], starts.get(p[:2], p[2]))
    long = lambda x: x[1] - x[0]
    parts = sorted(ends, key=long, reverse=True)
    best, pairs = 0, defaultdict(set)
    for i, x in enumerate(parts):
        for y in parts[i:]:
            if long(x) + long(y) < best:
                break
            covered = long(x) + long(y) - max(0, min(x[1], y[1]) - max(x[0], y[0]))
            if covered >= best and (x is y or ends[x] <= starts[y] or ends[y] <= starts[x]):
                if covered > best:
                    best, pairs = covered, defaultdict(set)
                pairs[x].add(y)
                pairs[y].add(x)
    if not best or best < max(share * len(item), min(FEW, len(item))):
        return None
    # The first passage with a partner; no passage before it has one, so its partner is not before it.
    first = next(i for i, x in enumerate(good) if any(y == x[:2] or ends[y] <= x[2] or x[3] <= starts[y] for y in pairs.get(x[:2], ())))
    x = good[first]
    y = next(y for y in good[first:] if y[:2] in pairs[x[:2]] and (x is y or x[3] <= y[2] or y[3] <= x[2]))
    return sorted({(x[2], x[3]), (y[2], y[3])})


class Shard:
    """The words of some documents as one indexed sequence; 1 separates documents."""

    def __init__(self, docs: list[list[str]], step: int = 16) -> None:
        self.docs = docs
        self.vocabulary = {w: i + 2 for i, w in enumerate(dict.fromkeys(w for d in docs for w in d))}
        self.sizes = np.array([len(d) + 1 for d in docs], dtype=np.int64)
        self.ends = np.cumsum(self.sizes)
        text = np.ones(int(self.sizes.sum()), dtype=np.int64)
        for d, end in zip(docs, self.ends):
            text[end - 1 - len(d) : end - 1] = [self.vocabulary[w] for w in d]
        self.index = FMIndex(text, step)


class Probe:
    """All phrases of a set of items, and the search of a shard for them."""

    def __init__(self, items: list[tuple[int, list[str]]]) -> None:
        self.items = items
        places = defaultdict(list)
        self.least = []
        for k, (_, words) in enumerate(items):
            size, least = phrase_plan(len(words))
            self.least.append(least)
            for q in range(len(words) - size + 1):
                places[tuple(words[q : q + size])].append((k, q))
        self.by_length = defaultdict(list)
        for phrase, where in places.items():
            if phrase:
                # Phrases of one length are searched together.
                self.by_length[len(phrase)].append((phrase, where))

    def hits(self, shard: Shard) -> dict[tuple[int, int], list[tuple[int, int]]]:
        """Hits (doc place, item place) by (document, item) of every phrase in a shard."""
        hits: dict[tuple[int, int], list[tuple[int, int]]] = defaultdict(list)
        vocabulary = shard.vocabulary
        for phrases in self.by_length.values():
            known = [(p, where) for p, where in phrases if all(w in vocabulary for w in p)]
            if not known:
                continue
            lo, hi = shard.index.search(np.array([[vocabulary[w] for w in p] for p, _ in known], dtype=np.int64))
            counts = hi - lo
            which = np.repeat(np.arange(len(known)), counts)
            rows = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(lo, counts)
            at = shard.index.locate(rows)
            doc = np.searchsorted(shard.ends, at, side="right")
            place = at - (shard.ends[doc] - shard.sizes[doc])
            for w, d, p in zip(which.tolist(), doc.tolist(), place.tolist()):
                for k, q in known[w][1]:
                    hits[d, k].append((p, q))
        return hits

    def find(self, shard: Shard) -> Iterator[tuple[int, int, list[tuple[int, int]]]]:
        """(document, item index, word spans) of every leak."""
        for (d, k), hits in sorted(self.hits(shard).items()):
            if len({q for _, q in hits}) >= self.least[k]:
                spans = leak_of(self.items[k][1], shard.docs[d], hits)
                if spans:
                    yield d, k, spans


def _parts(items: DataFrame, most: int) -> list:
    """The items (i, t) as broadcast lists (item, words), each of texts of about ``most`` bytes; the driver holds one at a time."""
    sc, out, part, size = items.sparkSession.sparkContext, [], [], 0
    for r in items.distinct().toLocalIterator():
        words = words_of(r["t"])
        if words:
            part.append((r["i"], words))
            size += len(r["t"].encode())
        if size >= most:
            out.append(sc.broadcast(part))
            part, size = [], 0
    return [*out, sc.broadcast(part)] if part else out


def find_leaks(documents: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text", shard_words: int = SHARD_WORDS) -> DataFrame:
    """(doc_id, item_id, spans): every document that holds at least half an item's words, with the character spans to remove.

    Case, punctuation, spacing, accents and markup do not matter; up to about one word in eight of a passage may
    differ. Null and empty texts hold nothing; items of one or two words are never found, as a few words are no borrowing;
    repeated rows give repeated results.
    A text longer than a shard is a shard of its own. Each shard is indexed once and searched for all items, in parts of
    ITEM_BYTES: driver and tasks hold one part at a time however many items there are.
    """
    wanted = items.select(F.col(item_id).alias("i"), F.col(text).alias("t")).where("i is not null and t is not null")
    docs = documents.select(F.col(doc_id).alias("d"), F.col(text).alias("t")).where("t is not null")
    kinds = docs.schema["d"].dataType.simpleString(), wanted.schema["i"].dataType.simpleString()
    parts = _parts(wanted, ITEM_BYTES)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys, texts, words, total, probes = [], [], [], 0, {}

        def flush() -> pd.DataFrame:
            out, shard = [], Shard(words if parts else [])
            for n, part in enumerate(parts):
                probe = probes.get(n) or Probe(part.value)
                if len(parts) == 1:
                    probes[n] = probe
                else:
                    vars(part).pop("_value", None)
                for d, k, spans in probe.find(shard):
                    at = places_of(texts[d])
                    out.append((keys[d], probe.items[k][0], [{"from": at[x][0], "to": at[y - 1][1]} for x, y in spans]))
            return pd.DataFrame(out, columns=["doc_id", "item_id", "spans"])

        for batch in batches:
            for key, value in zip(batch["d"], batch["t"]):
                found = words_of(value)
                if total and total + len(found) > shard_words:
                    yield flush()
                    keys, texts, words, total = [], [], [], 0
                keys.append(key)
                texts.append(value)
                words.append(found)
                total += len(found)
        yield flush()

    return docs.mapInPandas(run, f"doc_id {kinds[0]}, item_id {kinds[1]}, spans array<struct<from:int,to:int>>")


def removal_spans(leaks: DataFrame) -> DataFrame:
    """(doc_id, spans): per document the union of all its leaks' spans, merged where they touch or overlap."""
    spans = F.array_sort(F.flatten(F.collect_set("spans")))
    merged = F.aggregate(
        "all",
        F.expr("cast(array() as array<struct<from:int,to:int>>)"),
        lambda done, x: F.when(
            (F.size(done) > 0) & (F.element_at(done, -1)["to"] >= x["from"]),
            F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(F.element_at(done, -1)["from"].alias("from"), F.greatest(F.element_at(done, -1)["to"], x["to"]).alias("to")))),
        ).otherwise(F.concat(done, F.array(x))),
    )
    return leaks.groupBy("doc_id").agg(spans.alias("all")).select("doc_id", merged.alias("spans"))
