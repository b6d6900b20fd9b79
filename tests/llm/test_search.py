"""Ranked search against a naive one that scores every document."""

import math
import re
from collections import Counter, defaultdict

import pytest

from passagemill.llm import search

TERM = re.compile(search.TERM)
UPPER = str.maketrans(search._UPPER, search._LOWER)


def terms(text):
    return TERM.findall((text or "").translate(UPPER))


def brute(docs, items, k=10):
    """``(item, rank, doc, score)`` of plain Python over all documents."""
    bags = [(d, Counter(terms(t))) for d, t in docs]
    bags = [(d, b) for d, b in bags if b]
    big_n, big_l = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    asked = defaultdict(set)
    for i, t in items:
        asked[i] |= set(terms(t))
    out = []
    for i, words in asked.items():
        scored = []
        for d, b in bags:
            m = 10 + 90 * sum(b.values()) * big_n // big_l
            score = sum(math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[w] + 1))) * (10**9 * b[w] // (1000 * b[w] + 8 * m)) for w in words if w in b)
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        out += [(i, rank, d, -s) for rank, (s, _, _, d) in enumerate(sorted(scored, key=lambda x: x[:3])[:k], 1)]
    return out


def rows(found):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in found.collect()), key=repr)


def tables(spark, docs, items):
    return (
        spark.createDataFrame([(d, t, 1, "x") for d, t in docs], "doc_id long, text string, item_id int, term string").repartition(3),
        spark.createDataFrame([(i, t, 5) for i, t in items], "item_id long, text string, doc_id int"),
    )


DOCS = [
    (1, "The cat sat on the mat"), (2, "the CAT sat"), (3, "dog"), (4, None), (5, ""), (6, "Éa cat's É-cat ÉA"), (7, "the CAT, sat!"),
    (8, "unrelated words entirely"), (9, "the cat sat"), (9, "the cat sat"), (None, "the cat sat"), (10, "-- !!"), (11, "mat " * 3000 + "rare"),
    (-5, "sat cat the"), (12, "日本語 cat 日本語"), (13, "x" * 70000 + " cat"),
]
ITEMS = [(1, "the cat"), (2, "a Mat, a RARE mat"), (3, None), (4, ""), (5, "日本語 éa"), (6, "nothing matches"), (1, "sat"), (None, "dog mat"), (7, "the cat")]


@pytest.mark.parametrize("k", [1, 3, 10])
def test_against_brute_force(spark, k):
    """Ties, copies, null and repeated ids, empty texts, clashing columns."""
    docs, items = tables(spark, DOCS, ITEMS)
    found = rows(search.lexical_search(docs, items, k))
    assert found == sorted(brute(DOCS, ITEMS, k), key=repr)
    assert {3, 4, 6}.isdisjoint(r[0] for r in found)


def test_more_copies_than_places_and_many_partitions(spark):
    """A class of 500 copies, and tied classes that interleave by id."""
    docs = [(i, "common words here" if i % 2 else f"common {'here words' if i % 4 else 'words here'}") for i in range(1000)] + [(i, f"filler{i}") for i in range(1000, 2000)]
    given, items = tables(spark, docs, [(1, "common here"), (2, "words filler1500")])
    assert rows(search.lexical_search(given.repartition(17), items)) == sorted(brute(docs, [(1, "common here"), (2, "words filler1500")]), key=repr)


def test_blocks_of_items_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(search, "BLOCK_PAIRS", 3)
    monkeypatch.setattr(search, "_CELLS", 7)
    docs, items = tables(spark, DOCS, ITEMS)
    assert search._blocks(items.selectExpr("item_id", "explode(split(text, ' ')) as term")) > 1
    assert rows(search.lexical_search(docs, items)) == sorted(brute(DOCS, ITEMS), key=repr)


def test_empty_tables(spark):
    docs, items = tables(spark, DOCS, ITEMS)
    for d, i in ((docs.limit(0), items), (docs, items.limit(0)), (docs.filter("doc_id = 4"), items)):
        found = search.lexical_search(d, i)
        assert found.collect() == [] and found.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]


def test_slices_cut_no_term(monkeypatch):
    monkeypatch.setattr(search, "_SLICE", 5)
    raw = "Ab cdefGHIJ ÉÉÉÉ k, lm".encode()
    assert b"".join(search._slices(raw)) == raw
    n, counts = search.bag_of(raw, {b"cdefghij": 0, "ÉÉÉÉ".encode(): 1, b"lm": 2})
    assert n == 5 and counts == {b"cdefghij": 1, "ÉÉÉÉ".encode(): 1, b"lm": 1}
