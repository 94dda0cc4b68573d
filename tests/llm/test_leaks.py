import itertools
import random

from gridsnap.llm import leaks as L

ITEM = "while the seventh marker slipped a left footed runner from the harbour side throws a second forward pass where the old fence had fallen because its snap was early and nobody from the gantry objects which team takes the ball and at which down"
OTHER = "after a long pause the quiet captain drops his red belt behind nine lamps although twelve scorers wait for some lost umbrella beside another meadow until rain stops"


def found(spark, docs, items, **more):
    d = spark.createDataFrame(docs, "doc_id bigint, text string, item_id int")
    i = spark.createDataFrame(items, "item_id bigint, text string, doc_id int")
    return {(r["doc_id"], r["item_id"]) for r in L.find_leaks(d, i, **more).collect()}


def test_cases(spark):
    words = ITEM.split()
    rng = random.Random(4)
    noisy = [w if k % 8 else rng.choice(["zzz", "", w + " qq"]) for k, w in enumerate(words)]
    half = " ".join(words[: len(words) // 2 + 1])
    docs = [
        (1, "intro. " + ITEM.upper().replace(" ", ",  ") + " end", 0), (2, " ".join(noisy), 0), (3, "x y z " + half + " more text", 0),
        (4, " ".join(words[: len(words) // 3]), 0), (5, " ".join(words[30:44]) + " filler " * 40 + " ".join(words[:14]), 0), (6, "<p>" + ITEM.replace("runner", "<b>rúnner</b>") + "</p>", 0),
        (7, None, 0), (8, "", 0), (9, "word " * 200_000 + ITEM, 0), (10, "nothing here of that kind at all", 0), (1, "intro. " + ITEM, 0),
    ]
    items = [(1, ITEM, 0), (2, OTHER, 0), (3, None, 0), (4, "", 0), (5, "...", 0)]
    assert found(spark, docs, items) == {(d, 1) for d in (1, 2, 3, 5, 6, 9)}
    assert found(spark, docs, items, shard_words=50) == {(d, 1) for d in (1, 2, 3, 5, 6, 9)}


def test_items_in_parts_and_empty_tables(spark, monkeypatch):
    docs, items = [(1, OTHER, 0), (2, ITEM, 0)], [(1, ITEM, 0), (2, OTHER, 0)]
    monkeypatch.setattr(L, "ITEM_BYTES", 200)
    assert found(spark, docs, items) == {(2, 1), (1, 2)}
    assert found(spark, [], items) == set() and found(spark, docs, []) == set()


def test_spans_merge(spark):
    rows = [(1, 1, [(0, 10), (20, 30)]), (1, 2, [(8, 15)]), (2, 1, [(3, 4)])]
    df = spark.createDataFrame(rows, "doc_id int, item_id int, spans array<struct<from:int,to:int>>")
    got = {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in L.removal_spans(df).collect()}
    assert got == {1: [(0, 15), (20, 30)], 2: [(3, 4)]}


def test_phrase_search_against_scan():
    rng = random.Random(1)
    docs = [[rng.choice("abc") for _ in range(rng.randrange(30))] for _ in range(20)]
    items = [(k, [rng.choice("abc") for _ in range(n)]) for k, n in enumerate((1, 2, 5, 9, 12, 16, 26, 40))]
    want = {}
    for d, doc in enumerate(docs):
        for k, (_, item) in enumerate(items):
            n = L.phrase_plan(len(item))[0]
            hits = sorted((p, q) for q in range(len(item) - n + 1) for p in range(len(doc) - n + 1) if doc[p : p + n] == item[q : q + n])
            if hits:
                want[d, k] = hits
    got = {key: sorted(hits) for key, hits in L.Probe(items).hits(L.Shard(docs)).items()}
    assert got == want


def test_phrase_plan_holds_in_the_worst_case():
    for length in range(6, 200):
        size, least = L.phrase_plan(length)
        half = -(-length // 2)
        changes = -(-half // 8)
        # Two passages of any sizes, changed words anywhere: what is left unbroken holds the phrases asked for.
        for first in range(3, half // 2 + 1):
            for some in range(changes + 1):
                runs = []
                for words, n in ((first, some), (half - first, changes - some)):
                    kept = words - n
                    runs += [kept // (n + 1) + (i < kept % (n + 1)) for i in range(n + 1)]
                assert sum(max(0, r - size + 1) for r in runs) >= least, (length, first, some)


def words(n, seed=0):
    return [f"w{seed}x{i}" for i in range(n)]


def leaked(item, doc):
    return bool(list(L.Probe([(1, item)]).find(L.Shard([words(90, 7) + doc + words(80, 8)]))))


def test_short_items_and_two_short_passages():
    gap = words(40, 9)
    for size, cuts in ((12, [6]), (9, [5]), (20, [6, 6]), (26, [7, 7]), (26, [8, 6])):
        item = words(size)
        doc = [w for n, at in zip(cuts, (0, size - cuts[-1])) for w in [*item[at : at + n], *gap]]
        assert leaked(item, doc), (size, cuts)
        assert not leaked(item, doc[: cuts[0] - 1 if len(cuts) == 1 else cuts[0]]), (size, cuts)
    item = words(16)
    assert leaked(item, [*item[:5], "zz", *item[6:11], "yy", *item[12:]]) and leaked(item, item[:3] + ["q"] + item[4:9])
    assert leaked(words(4), words(4)) and not leaked(words(6), words(3)) and leaked(["one"], ["one"]) is False


def best_share(item, doc):
    """Brute force: most item words in at most two exact passages of three words or more."""
    runs = {(q, n) for q in range(len(item)) for p in range(len(doc)) for n in range(3, len(item) - q + 1) if doc[p : p + n] == item[q : q + n]}
    cover = [set(range(q, q + n)) for q, n in runs]
    return max((len(a | b) for a in cover for b in cover), default=0) / len(item)


def test_short_items_against_brute_force():
    rng = random.Random(3)
    for _ in range(150):
        item = words(rng.randrange(10, 30))
        a, b = sorted(rng.sample(range(len(item) + 1), 2))
        c, d = sorted(rng.sample(range(len(item) + 1), 2))
        doc = item[a:b] + words(30, 5) + item[c:d]
        # Passages that touch or overlap in the item are one, and what lies between may be read as changed.
        share = best_share(item, doc)
        if share >= 0.5:
            assert leaked(item, doc), (len(item), a, b, c, d)
        elif share < 0.4:
            assert not leaked(item, doc), (len(item), a, b, c, d)


def test_long_tags_are_markup(spark):
    tag = '<a href="' + "x" * 900 + '">'
    assert found(spark, [(1, ITEM.replace(" runner", f" {tag}run</a>ner"), 0), (2, ITEM.replace(" ", f" {tag} "), 0)], [(1, ITEM, 0)]) == {(1, 1), (2, 1)}


def test_a_passage_finds_its_partner_however_often_the_other_stands(monkeypatch):
    r, a, s, b, gap = (words(n, k) for n, k in ((3, 11), (4, 12), (3, 13), (4, 14), (10, 15)))
    item = [*r, *a, *s, *gap, *s, *b, *r]
    # The two first copies of one half share words with the other half, the third has room beside it.
    both = [*r, *a, *s, *b, *r, *a, *s]
    assert leaked(item, [*both, *words(40, 16), *r, *a, *s]) and not leaked(item, both)
    rng = random.Random(8)
    for _ in range(300):
        cuts = [sorted(rng.sample(range(25), 2)) for _ in range(4)]
        some = []
        for _ in range(rng.randrange(1, 14)):
            x, y = rng.choice(cuts)
            at = rng.randrange(60)
            some.append((x, y, at, at + y - x, y - x))
        monkeypatch.setattr(L, "passages", lambda *_, some=some: some)
        good = [p for p in some if p[4] >= 3]
        most = max((len(set(range(*x[:2])) | set(range(*y[:2]))) for x in good for y in good if x is y or x[3] <= y[2] or y[3] <= x[2]), default=0)
        got = L.leak_of(words(30), [], [])
        assert (got is not None) == (most >= 15)
        if got:
            of = [[p for p in good if p[2:4] == span] for span in got]
            assert max(len(set().union(*(range(*p[:2]) for p in ps))) for ps in itertools.product(*of)) == most and all(x[1] <= y[0] for x, y in itertools.pairwise(got))
