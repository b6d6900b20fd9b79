"""Alignment of two vocabularies against whole encodings and a naive count."""

import hashlib
import os
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from passagemill.llm import align, encoders, queries

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TEXTS = [
    "hello world", "  two  spaces ", " ", "\n", "a\n\nb \n c", "x\r\ny\tz", "\u2581under", "nul\0x <|endoftext|> <s> </s> <0x41> <unk>",
    "e\u0301\u0301 \U0001f600\U0001f600 \u3000ideo \u2028 line", "don't we'll 'S", "a" * 3000, "\xa0x \x1c y", " \n \n", "tab\t\t x",
    "repeated words repeated words\nrepeated words", "", None, "hello world", "aaa aaaa aaaaa", "word " * 700, "\u4e2d\u6587\u5b57 mixed \u03b1\u03b2",
]


@pytest.fixture(scope="module")
def whole():
    a = Tokenizer.from_file(encoders.default_path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=encoders.default_path("piece_bpe_32k.model"))
    return a, b, encoders.byte_encoder().token_bytes, encoders.piece_encoder().token_bytes


def brute(texts, whole):
    """Per text ``n_a, n_b, n_groups, n_links, n_best, count_sum, groups`` from whole encodings and all pairs."""
    a, b, a_bytes, b_bytes = whole
    made, counts = [], Counter()
    for text in texts:
        xs = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ys = b.encode(text) if text else []
        raw = (" " + text).encode() if text else b""
        if b"".join(a_bytes[x] for x in xs) != raw or b"".join(b_bytes[y] for y in ys) != raw:
            xs, ys = [], []
        spans = []
        for ids, table in ((xs, a_bytes), (ys, b_bytes)):
            at, here = 0, []
            for i in ids:
                here.append((at, at + len(table[i]), i))
                at += len(table[i])
            spans.append(here)
        links = [(x, y) for s, e, x in spans[0] for s2, e2, y in spans[1] if s < e2 and s2 < e]
        counts.update(links)
        cuts = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        groups, low = [], 0
        for cut in cuts:
            groups.append("|".join(",".join(str(i) for s, e, i in side if low <= s and e <= cut) for side in spans))
            low = cut
        made.append((xs, ys, groups, links))
    most = Counter()
    for (_, y), n in counts.items():
        most[y] = max(most[y], n)
    return [
        (len(xs), len(ys), len(groups), len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links), ";".join(groups))
        for xs, ys, groups, links in made
    ]


def rows_of(found):
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
    return {r.doc_id: tuple(r[n] for n in names) for r in found.collect()}


@pytest.mark.parametrize("most_pairs", [align.MOST_PAIRS, 0])
def test_against_brute_force(spark, whole, most_pairs, monkeypatch):
    """Both ways of looking counts up, with clashing columns, repeated texts, null and empty ones."""
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(TEXTS)], "doc_id long, text string, groups string, n_a int").repartition(3)
    found = rows_of(align.align_tokenizers(docs, most_pairs=most_pairs))
    assert [found[i] for i in range(len(TEXTS))] == brute(TEXTS, whole)
    assert found[6][:6] == (0,) * 6 == found[15][:6] == found[16][:6] and found[0][0] > 0


@pytest.mark.parametrize("most_pairs", [align.MOST_PAIRS, 0])
def test_null_and_repeated_ids_and_empty_tables(spark, whole, most_pairs):
    docs = spark.createDataFrame([(None, "one text"), (3, "one text"), (3, "one text"), (3, "another \u00e9\u00e9")], "doc_id long, text string")
    found = align.align_tokenizers(docs, most_pairs=most_pairs)
    want = brute(["one text"] * 3 + ["another \u00e9\u00e9"], whole)
    assert sorted(r.count_sum for r in found.collect()) == sorted(w[5] for w in want)
    assert sum(r.doc_id is None for r in found.collect()) == 1
    assert align.align_tokenizers(docs.limit(0), most_pairs=most_pairs).collect() == []


def raw_of(text):
    return np.frombuffer(text.encode(), np.uint8)


@given(st.text(" \n\tab\u00e9\xa0\x85\u2003\u3000\u1680\x1c\u0a85\u4e80", max_size=60), st.integers(4, 30))
def test_cuts_in_bytes(text, limit):
    """The same places as in the text, and parts that end at them."""
    raw = raw_of(" " + text)
    at = encoders.cuts(raw).tolist()
    assert [b.decode() for b in (raw.tobytes()[i:j] for i, j in zip([0, *at], [*at, len(raw)]))] == encoders.CUT.split(" " + text)
    made = list(encoders.parts(raw, limit))
    assert b"".join(p.tobytes() for p in made) == raw.tobytes()
    assert {sum(map(len, made[:i])) for i in range(1, len(made))} <= set(at)


def test_parts_of_long_texts(spark, whole, monkeypatch):
    """A text of many slices, without and with a stretch that a vocabulary does not give back."""
    text = " ".join(f"word{i % 97} line\n{i}" for i in range(500))
    aligner = align.aligner_of(None, None)
    monkeypatch.setattr(align, "SLICE", 64)
    docs = [text, text + " \u2581", "short", "", text + "  "]
    found = rows_of(align.align_tokenizers(spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").repartition(1)))
    assert [found[i] for i in range(len(docs))] == brute(docs, whole)
    good, bad = raw_of(" " + text), raw_of(" " + docs[1])
    assert len(list(aligner.texts(good, np.array([len(good)])))) > 10 and list(aligner.texts(bad, np.array([len(bad)]))) == []


def test_stretches_that_fail_are_found(whole):
    """One bad stretch among many costs the others nothing."""
    stretches = [f" word{i}" for i in range(50)] + [" bad\u2581", " tail ", " ", "\nline"]
    found = align.aligner_of(None, None).align(stretches)
    assert found.ok.tolist() == [True] * 50 + [False, True, True, True]
    assert found.counts[50].tolist() == [0, 0, 0, 0] and found.spelled[50] == ""
    for i in (0, 49, 51, 52):
        assert tuple(found.counts[i][:3]) + (found.spelled[i],) == (lambda w: (*w[:3], w[6]))(brute([stretches[i][1:]], whole)[0]) or stretches[i] == " "


def test_what_is_remembered():
    """Two generations; long stretches are not kept."""
    asked = []
    known = encoders.Remembered(lambda s: [asked.append(x) or x.upper() for x in s], 2)
    assert known(["a", "b", "c" * 2000])["a"] == "A"
    assert "c" * 2000 not in known(["d"])
    assert known(["e", "a"])["a"] == "A" and known(["f"]) and known(["a"])["a"] == "A"
    assert asked.count("a") == 1 and asked.count("b") == 1


def test_both_libraries_agree(whole):
    """All characters that go through the faster library, in the places where words are cut."""
    encoder = encoders.byte_encoder()
    assert encoder._ranked is not None
    plain = [chr(i) for i in range(ord(encoders._PLAIN))]
    texts = [f(c) for c in plain for f in (lambda c: f"a{c}1 {c}{c} {c}b", lambda c: f" {c}\n{c} ", lambda c: f"{c}'s{c}  {c}")]
    assert encoder.encode(texts) == [whole[0].encode(t, add_special_tokens=False).ids for t in texts]


def test_identity_map():
    same = align.same_bytes([b"a", b"b", b"", b"ab"], [b"x", b"a", b"a", b"ab"])
    assert same.tolist() == [1, -1, -1, 3]


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not there")
def test_query(spark, whole):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    ids = sorted(i for i in texts if len(texts[i] or "") < 4000)
    small = spark.read.parquet(f"{SF}/documents.parquet").filter(F.length("text") < 4000)
    want = dict(zip(ids, brute([texts[i] for i in ids], whole)))
    assert rows_of(align.align_tokenizers(small)) == want
    rows = queries.QUERIES["op12_align_tokenizers"](spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    digest = {i: hashlib.sha256(w[6].encode()).hexdigest() if w[6] else "" for i, w in want.items()}
    assert all(r.groups_sha256 == digest[r.doc_id] and (r.n_a, r.n_b, r.n_links) == (want[r.doc_id][0], want[r.doc_id][1], want[r.doc_id][3]) for r in rows if r.doc_id in want)
