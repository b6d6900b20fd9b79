"""Segmentation into pieces: exact lists of best segmentations, exact round trips."""

import random

import numpy as np
import pyarrow as pa
import pytest

from passagemill.llm import pieces


@pytest.fixture(scope="module")
def vocabulary():
    try:
        return pieces.load_vocabulary()
    except ImportError:
        pytest.skip("no public vocabulary here")


def every(text, vocabulary):
    """All segmentations of a text as (score, ids), best first."""
    if not text:
        return [(0, [])]
    lattice = pieces.Lattice(" " + text, vocabulary)
    out, stack = [], [(0, [], lattice.n)]
    while stack:
        total, ids, at = stack.pop()
        if at == 0:
            out.append((total, ids))
        for i, piece, score in lattice.into[at] if at else ():
            stack.append((total + score, [*(piece if isinstance(piece, tuple) else (piece,)), *ids], i))
    return sorted(out, key=lambda x: -x[0])


@pytest.mark.parametrize("text", ["", " ", "a  b", "hello wor\nld", "é▁☃x", "the in", "\n\n x ", "thetheth", "12 3.", "\x00\u00a0"])
@pytest.mark.parametrize("n", [1, 2, 4])
def test_best_segmentations_of_the_whole_text(vocabulary, text, n):
    encoder, decode = pieces.Encoder(vocabulary, n), pieces.decoder(vocabulary)
    ids, scores, picks = encoder.encode([text])[0]
    want = every(text, vocabulary)
    assert scores == [s for s, _ in want[:n]]
    whole = [encoder.whole(text, p) for p in picks]
    assert whole[0] == list(ids) and len({tuple(x) for x in whole}) == len(whole)
    assert all((s, x) in want and decode(x).decode() == text for s, x in zip(scores, whole))


def test_batches_equal_single_lattices(vocabulary):
    rng = random.Random(1)
    letters = "etaoin shrdlu.,ABC12é ñßç☃"
    segments = list({(" " if rng.random() < 0.7 else "") + "".join(rng.choices(letters, k=rng.randint(1, 30))).replace(" ", "") for _ in range(800)} - {""})
    encoder = pieces.Encoder(vocabulary, 2)
    encoder._add_all(segments)
    for s in segments:
        lattice, k = pieces.Lattice(s, vocabulary), encoder.number[s]
        assert encoder.score[k] == lattice.best[-1] == lattice.n_best(1)[0][0]
        two = lattice.n_best(2)
        assert encoder.behind[k] == (two[0][0] - two[1][0] if len(two) > 1 else -1)
        scores = {i: v for i, v in vocabulary.scores.values()} | {i: vocabulary.byte_score for i in vocabulary.bytes}
        assert sum(scores[i] for i in encoder.ids[encoder.first[k] : encoder.first[k + 1]]) == encoder.score[k]


def test_encode_and_decode(spark, vocabulary):
    rng = random.Random(2)
    rows = [(1, None), (2, ""), (3, "▁ ▁"), (None, "x"), (4, "a" * 5000), (5, "日本\u0000\u2028語 " * 30_000), (3, "▁ ▁")]
    rows += [(i, "".join(rng.choices("abc é\n\t☃𝄞Z9.▁", k=rng.randint(0, 80)))) for i in range(10, 60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as ids")
    found = pieces.encode_pieces(df, vocabulary=vocabulary)
    got = {r.doc_id: r for r in found.collect()}
    assert got[1].ids is None and got[1].scores is None and got[1].round_trip is None
    assert got[2].ids == [] and got[2].scores == [0]
    assert all(r.round_trip for r in got.values() if r.ids is not None)
    assert all(r.scores == sorted(r.scores, reverse=True) for r in got.values() if r.scores)
    texts = {r.doc_id: r.text for r in pieces.decode_pieces(found, vocabulary=vocabulary).collect()}
    assert texts == dict(rows)
    assert pieces.encode_pieces(df.filter("doc_id > 99")).collect() == []


def test_all_best_segmentations_come_out(spark, vocabulary):
    texts = [None, "", " ", "a  b", "hello wor\nld", "é▁☃x", "the in", "thetheth", "12 3.", "one two three four five six seven " * 50]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = pieces.encode_pieces(df, vocabulary=vocabulary)
    rows = {r.doc_id: r for r in found.withColumn("all", pieces.segmentations(found.ids, found.changes)).collect()}
    decode, encoder = pieces.decoder(vocabulary), pieces.Encoder(vocabulary, 4)
    assert rows[0].all is None and rows[1].all == [[]]
    for i, text in list(enumerate(texts))[1:]:
        got = rows[i].all
        assert got[0] == rows[i].ids and len({tuple(x) for x in got}) == len(got) == len(rows[i].scores)
        assert all(decode(x).decode() == text for x in got)
        assert got == [encoder.whole(text, picks) for picks in encoder.encode([text])[0][2]]
        if len(text) < 12:
            want = every(text, vocabulary)
            assert all((s, x) in want for s, x in zip(rows[i].scores, got))


def test_memory_is_bounded(vocabulary, monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED", 50)
    encoder = pieces.Encoder(vocabulary, 2)
    fresh = pieces.Encoder(vocabulary, 2)
    for i in range(40):
        text = f"word{i} other{i} more{i}"
        ids, scores, _ = encoder.encode([text])[0]
        assert len(encoder.number) < 60
        fresh.forget()
        again = fresh.encode([text])[0]
        assert np.array_equal(ids, again[0]) and scores == again[1]


def test_long_text_without_a_space_is_bounded(vocabulary):
    """Random letters and equal ones: time and memory grow with the text."""
    import random
    import time
    import tracemalloc

    letters = random.Random(5)
    took = []
    for n in (20_000, 100_000):
        for text in ("".join(letters.choices("abcdefghijklmnop", k=n)), "a" * n):
            lattice = pieces.Lattice(text, vocabulary)
            start = time.process_time()
            tracemalloc.start()
            found = lattice.n_best(4)
            peak = tracemalloc.get_traced_memory()[1]
            tracemalloc.stop()
            took.append(time.process_time() - start)
            assert [s for s, _ in found] == sorted((s for s, _ in found), reverse=True) and found[0][0] == lattice.best[-1]
            assert len({tuple(x) for _, x in found}) == 4 and peak < 3_000 * n
    assert took[2] < 15 * max(took[0], 0.2) and took[3] < 15 * max(took[1], 0.2)


def test_decoding_of_ids_that_are_none(spark, vocabulary):
    first = vocabulary.bytes[0xC3]
    hello = pieces.Encoder(vocabulary, 1).encode(["hello"])[0][0].tolist()
    rows = [(1, [*hello, 10**9, -5]), (2, [first]), (3, [None, *hello]), (4, []), (5, None), (5, hello)]
    df = spark.createDataFrame(rows, "doc_id long, ids array<int>").selectExpr("*", "'x' as text", "1 as scores")
    found = sorted(((r.doc_id, r.text) for r in pieces.decode_pieces(df, vocabulary=vocabulary).collect()), key=repr)
    assert found == [(1, "hello\ufffd\ufffd"), (2, "\ufffd"), (3, "\ufffd hello"), (4, ""), (5, "hello"), (5, None)]
    assert pieces.decode_pieces(df.limit(0), vocabulary=vocabulary).collect() == []


def test_reading_words_lets_go_what_pieces_hold():
    """A worker process that goes on with another query does not keep the segments of the last one."""
    from passagemill.llm import tokens

    class Shared:
        value = pieces.load_vocabulary()

    held = pieces._of_worker("query", Shared, 4)
    assert pieces._of_worker("query", Shared, 4) is held
    list(tokens.words_of(pa.array(["a b"])))
    assert not tokens.HELD
