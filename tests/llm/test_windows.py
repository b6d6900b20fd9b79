"""Repeated windows (words and bytes) against brute force."""

import random

import pytest

from passagemill.llm import windows as win
from passagemill.llm.countmin_dedup import countmin_dedup
from passagemill.llm.suffix_dedup import suffix_dedup


def brute(rows, words, k):
    """(tokens, removed, spans, kept) per row."""
    first, all_tokens = {}, []
    for doc, text in rows:
        raw = (text or "").encode()
        tokens = raw.split() if words else raw
        all_tokens.append(tokens)
        for i in range(len(tokens) - k + 1):
            key = tuple(tokens[i : i + k])
            if doc is not None:
                first[key] = min(first.get(key, doc), doc)
    out = []
    for (doc, _), tokens in zip(rows, all_tokens):
        gone = [False] * len(tokens)
        for i in range(len(tokens) - k + 1):
            if doc is not None and first[tuple(tokens[i : i + k])] < doc:
                gone[i : i + k] = [True] * k
        kept = [t for t, g in zip(tokens, gone) if not g]
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(tokens), sum(gone), spans, b" ".join(kept).decode() if words else bytes(kept)))
    return out


def texts(seed, n=120):
    rng = random.Random(seed)
    words = ["a", "bb", "çé", "dd.", "e", "ffff", "☃"]
    passages = [" ".join(rng.choices(words, k=rng.randint(8, 60))) for _ in range(6)]
    rows = []
    for i in range(n):
        parts = [rng.choice(passages) if rng.random() < 0.5 else " ".join(rng.choices(words, k=rng.randint(0, 40))) for _ in range(rng.randint(0, 5))]
        rows.append((rng.choice([i, i, i, None, 3]), rng.choice([" ", "\n", "  \t"]).join(parts)))
    rows += [rows[5], rows[9], (None, None), (500, ""), (501, None), (502, " \n"), (503, "x " * 3000), (504, "x " * 3000), (2, rows[20][1])]
    return rows


@pytest.mark.parametrize("common", [2, 4096])
@pytest.mark.parametrize("words", [True, False])
def test_against_brute_force(spark, monkeypatch, words, common):
    monkeypatch.setattr(win, "CHUNK_BYTES", 2000)
    monkeypatch.setattr(win, "BLOCK_ANCHORS", 200)
    monkeypatch.setattr(win, "PART_TOKENS", 500)
    monkeypatch.setattr(win, "COMMON", common)
    rows = texts(common)
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumnsRenamed({"doc_id": "key"}).selectExpr("key as doc_id", "text", "key as chunk", "'x' as t1")
    if words:
        found = countmin_dedup(df, window=10, gram=4).collect()
        got = [(r.doc_id, r.n_words, r.n_removed, r.kept) for r in found]
        want = [(d, n, gone, kept) for (d, _), (n, gone, _, kept) in zip(rows, brute(rows, True, 10))]
    else:
        found = suffix_dedup(df, window=20, gram=8).collect()
        got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in found]
        want = [(d, *x) for (d, _), x in zip(rows, brute(rows, False, 20))]
    order = lambda x: tuple((v is None, v) for v in x)
    assert sorted(got, key=order) == sorted(want, key=order)
    assert sum(x[2] for x in got) > 0


@pytest.mark.parametrize("operator", [countmin_dedup, suffix_dedup])
def test_empty_table(spark, operator):
    assert operator(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_document_of_many_segments(spark, monkeypatch):
    monkeypatch.setattr(win, "_SEGMENT", 64)
    rng = random.Random(1)
    long = " ".join(str(rng.randint(0, 10**6)) for _ in range(1000))
    rows = [(1, long), (2, "start " + long[2000:4000] + " end"), (3, long)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows, True, 50)
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in countmin_dedup(df).collect()} == {d: (w[0], w[1], w[3]) for (d, _), w in zip(rows, want)}


def test_texts_stay_in_one_exchange(spark):
    """Every round reads the texts from the same shuffle, and no row of windows is shuffled."""
    df = countmin_dedup(spark.createDataFrame([(1, "a b c")], "doc_id long, text string"))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan and "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan
