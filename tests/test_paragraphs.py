import math

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from checks import fixtures as X
from passagemill.operators import lm, work
from passagemill.operators import paragraphs as P
from passagemill.plans import corpus
from passagemill.sources import readers
from passagemill.sources.scratch import scratch_path

NS = 'xmlns="http://www.tei-c.org/ns/1.0"'


def tei(body, ns=NS):
    return f"<TEI {ns}><text><body>{body}</body></text></TEI>"


CASES = {
    "ref tail stays": (tei("<div><p>a <ref>[1]<hi>x</hi></ref> b</p></div>"), [["a  b"]]),
    "strip per element": (tei("<div><p>a<hi> b</hi> c </p></div>"), [["ab c"]]),
    "nested div repeats": (tei("<div><p>1</p><div><p>2</p></div></div>"), [["1", "2"], ["2"]]),
    "p outside div": (tei("<p>x</p><div><p>y</p></div>"), [["y"]]),
    "empty p": (tei("<div><p> </p><p>z</p></div>"), [["z"]]),
    "no namespace": (tei("<div><p>x</p></div>", ""), []),
    "no body": (f"<TEI {NS}><text/></TEI>", []),
    "first body only": (f"<TEI {NS}><body><div><p>1</p></div></body><body><div><p>2</p></div></body></TEI>", [["1"]]),
    "root body": (f"<body {NS}><div><p>1</p></div></body>", []),
    "nested p": (tei("<div><p>a<note><p>b</p></note>c</p></div>"), [["abc", "b"]]),
    "p in ref": (tei("<div><p>a<ref><p>b</p></ref>c</p></div>"), [["ac", "b"]]),
    "comment": (tei("<div><p>a<!-- no -->b &amp; &lt;c&gt;</p></div>"), [["ab & <c>"]]),
    "malformed": ("<TEI><body>", None),
    "empty": ("", None),
}


def divisions(spark, xml, **options):
    df = spark.createDataFrame([(xml.encode(),)], "content BINARY")
    return df.select(P.tei_divisions(F.col("content"), **options).alias("d")).first().d


def test_tei_walk(spark):
    rows = [(name, xml.encode()) for name, (xml, _) in CASES.items()]
    df = spark.createDataFrame(rows, "name STRING, content BINARY")
    found = dict(df.select("name", P.tei_divisions(F.col("content"))).collect())
    assert found == {name: expected for name, (_, expected) in CASES.items()}


def test_tei_options(spark):
    nested = CASES["nested div repeats"][0]
    assert divisions(spark, nested, dedupe_nested=True) == [["1"], ["2"]]
    assert divisions(spark, CASES["strip per element"][0], keep_inner_space=True) == [["a b c"]]
    assert divisions(spark, tei("<div><p>e\u0301</p></div>"), nfc=True) == [["\u00e9"]]


def test_joined_paragraphs(spark):
    df = spark.createDataFrame([([["a", "b"], [], ["c"]],)], "divisions ARRAY<ARRAY<STRING>>")
    assert [tuple(r) for r in P.explode_paragraphs(df, concat_p=True).collect()] == [(0, "a\nb"), (1, "c")]
    assert [r.paragraph for r in P.explode_paragraphs(df).collect()] == ["a", "b", "c"]


def test_two_files_of_one_id(spark):
    folder = scratch_path(spark, "tei")
    spark.range(0).write.parquet(folder)
    rows = [(n, tei("<div><p>x</p></div>").encode()) for n in ("a.x.xml", "a.y.xml", "b.xml", "c.txt")]
    X.write_files(spark.createDataFrame(rows, "name STRING, content BINARY"), X._uri(folder))
    docs = readers.read_tei(spark, folder)
    assert sorted(r.doc_id for r in docs.collect()) == ["a", "a", "b"]
    model = lm.unigram_model(spark.createDataFrame([("x", 1)], "word STRING, n BIGINT"))
    table = corpus.paragraph_table(corpus.paragraph_arrays(docs, model, words=0))
    assert sorted((r.id, r.idx) for r in table.collect()) == [("a", 0), ("a", 0), ("b", 0)]


def test_numbering_across_blocks_and_files(spark):
    rows = [("hot", p) for p in range(0, 50, 2)] + [("cold", 7)]
    df = spark.createDataFrame(rows, "path STRING, pos INT")
    got = work.number_in_group(df, ["path"], "pos", block=8).orderBy("path", "pos").collect()
    assert [r.idx for r in got] == [0, *range(25)]


def test_numbering_rejects_null_groups(spark):
    df = spark.createDataFrame([(None, 1), ("a", 1)], "path STRING, pos INT")
    with pytest.raises(Exception, match="null in a group column"):
        work.number_in_group(df, ["path"], "pos").collect()


def test_document_arrays_are_one_row_per_file(spark):
    rows = [(f, "a", i, f"{f}p{i}") for f in ("f1", "f2") for i in range(12)]
    df = spark.createDataFrame(rows, "path STRING, id STRING, idx INT, paragraph STRING")
    docs = spark.createDataFrame([("f1", "a"), ("f2", "a"), ("f3", "b")], "path STRING, id STRING")
    assert {(r.path, r.id, tuple(r.paragraphs)) for r in P.all_document_arrays(docs, df).collect()} == {
        ("f1", "a", tuple(f"f1p{i}" for i in range(12))),
        ("f2", "a", tuple(f"f2p{i}" for i in range(12))),
        ("f3", "b", ()),
    }


# --- Language model ------------------------------------------------------------------------------


@pytest.fixture
def model(spark):
    counts = spark.createDataFrame([("the", 6), ("cat", 2)], "word STRING, n BIGINT")
    return lm.unigram_model(counts)


def test_model(model):
    found = dict(model.collect())
    assert found["the"] == pytest.approx(math.log2(6 / 8))
    assert found["<unk>"] == pytest.approx(math.log2((math.sqrt(2) + 1) / 8))


@pytest.mark.parametrize("bound", [10, 0])
def test_scores_with_small_and_large_models(spark, model, monkeypatch, bound):
    monkeypatch.setattr(lm, "fits_broadcast", lambda m: bound > 0)
    df = spark.createDataFrame([(1, "The cat"), (2, "dog"), (3, ""), (4, "The the the cat dog")], "k INT, t STRING")
    got = {r.k: r.score for r in lm.unigram_score(df, model, "t").collect()}
    p = dict(model.collect())
    expected = {
        1: (p["the"] + p["cat"]) / 2,
        2: p["<unk>"],
        3: 0.0,
        4: (3 * p["the"] + p["cat"] + p["<unk>"]) / 5,
    }
    assert got == {k: pytest.approx(v) for k, v in expected.items()}


@pytest.mark.parametrize("bound", [10, 0])
def test_scores_do_not_depend_on_keys(spark, model, monkeypatch, bound):
    monkeypatch.setattr(lm, "fits_broadcast", lambda m: bound > 0)
    df = spark.createDataFrame([(2, "the"), (2, "dog cat"), (None, "dog"), (None, None), (2, "the")], "k INT, t STRING")
    p = dict(model.collect())
    got = sorted(r.score for r in lm.unigram_score(df, model, "t").collect())
    want = sorted([p["the"], p["the"], (p["<unk>"] + p["cat"]) / 2, p["<unk>"], 0.0])
    assert got == pytest.approx(want)


def test_model_is_measured_in_rows_and_bytes(spark, model):
    assert lm.fits_broadcast(model) and not lm.fits_broadcast(model, rows=2) and not lm.fits_broadcast(model, size=20)


def test_threshold_is_strict(spark):
    df = spark.createDataFrame([(-20.0,), (-19.999,), (None,), (-20.0 + 1e-13,)], "score DOUBLE")
    assert lm.min_unigram_score(df).count() == 2


def test_counts_file(spark):
    rows = [("word,count", 0), ("a,1", 1), ("b,2", 2), ("a,3", 3), (" c,4 ", 4), ("nocomma", 5)]
    lines = spark.createDataFrame(rows, "value STRING, seq INT")
    assert dict(readers.parse_unigram_counts(lines).collect()) == {"a": 3, "b": 2, "c": 4}
    with pytest.raises(Exception, match="no comma"):
        readers.parse_unigram_counts(lines, strict=True).collect()


@pytest.mark.parametrize("large_model", [False, True])
def test_corpus_with_small_and_large_models(spark, monkeypatch, large_model):
    monkeypatch.setattr(lm, "fits_broadcast", lambda m: not large_model)
    model = lm.unigram_model(spark.createDataFrame([("the", 90), ("cat", 1)], "word STRING, n BIGINT"))
    body = "<div><p>the the the</p><p>cat zzz cat</p><p>the</p></div><div><p>the http://x.y the cat the</p></div>"
    rows = [("/d/one.tei.xml", "one", tei(body).encode()), ("/d/bad.xml", "bad", b"<x")]
    docs = spark.createDataFrame(rows, "path STRING, doc_id STRING, content BINARY")
    table, stats = corpus.build_paragraph_corpus(docs, model, words=1, score=-3)
    assert sorted(map(tuple, table.collect())) == [("one", 0, "the the the"), ("one", 1, "the the cat the")]
    assert tuple(stats.first()) == (2, 2, 1)


# --- Plans ---------------------------------------------------------------------------------------


def test_corpus_job_does_not_shuffle_and_runs_each_udf_once(spark, model):
    docs = spark.createDataFrame([("/a.xml", "a", b"")], "path STRING, doc_id STRING, content BINARY")
    plan = plan_of(corpus.paragraph_table(corpus.paragraph_arrays(docs, model)))
    assert "Exchange" not in plan
    assert plan.count("ArrowEvalPython") == 2


def test_small_model_is_broadcast_and_large_is_not(spark, model, monkeypatch):
    df = spark.createDataFrame([("the",)], "word STRING")
    assert "BroadcastHashJoin" in plan_of(lm.lookup_logp(df, model))
    monkeypatch.setattr(lm, "fits_broadcast", lambda m: False)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        assert "Broadcast" not in plan_of(lm.lookup_logp(df, model))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
