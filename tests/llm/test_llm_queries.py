"""Registered queries against their SQL, and the pipeline against its stages by brute force."""

import os
import re

import pytest

import corpus_pipeline
from checks.compare import compare, connect
from passagemill.llm import queries
from passagemill.llm.quality import quality_rules

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not there")


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, name):
    assert compare(spark, connect(SF), queries.QUERIES[name], queries.ORACLES[name], SF) is None


def test_all_operators_have_a_query():
    assert [sum(x.startswith(f"op{n}_") for x in queries.QUERIES) for n in range(1, 14)] == [1] * 13
    assert "pipeline" in queries.QUERIES and set(queries.ORACLES) <= set(queries.QUERIES)


def shingles(text):
    words = text.split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or {tuple(words)}


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontaminate", "secrets", "pieces"]
    one = corpus_pipeline.quality(spark, docs, SF)
    assert one.columns == corpus_pipeline.COLUMNS and one.dtypes == docs.select(*corpus_pipeline.COLUMNS).dtypes
    rows = {r.doc_id: r for r in one.collect()}
    source = {r.doc_id: r for r in docs.collect()}
    kept = {r.doc_id for r in quality_rules(docs).filter("kept").collect()}
    assert set(rows) == kept and all((r.lang, r.source) == (source[d].lang, source[d].source) for d, r in rows.items())
    assert all(r.n_chars == len(r.text) for r in rows.values())

    two = corpus_pipeline.near_duplicates(spark, one, SF)
    assert two.columns == corpus_pipeline.COLUMNS
    left = {r.doc_id for r in two.collect()}
    sets, root = {d: shingles(r.text) for d, r in rows.items()}, {d: d for d in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in rows:
        for b in rows:
            if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    assert left == {d for d in rows if find(d) == d} and len(left) < len(rows)

    three = corpus_pipeline.decontaminate(spark, two, SF)
    bad = {r.doc_id for r in queries.QUERIES["op10_decontamination"](spark, SF).filter("contaminated").collect()}
    assert {r.doc_id for r in three.collect()} == left - bad

    four = {r.doc_id: r for r in corpus_pipeline.secrets(spark, three, SF).collect()}
    assert set(four) == left - bad
    assert not any(re.search(r"[0-9a-f]{24}|(?i:token|password) ?= ?['\"]?[A-Za-z0-9]{6}", r.text) for r in four.values())

    five = corpus_pipeline.pieces(spark, spark.createDataFrame(list(four.values())), SF)
    assert {r.doc_id for r in five.filter("round_trip").collect()} == set(four)


def test_run_of_small_tables(spark, tmp_path):
    """Nulls, repeats and documents that every stage treats."""
    words = lambda tag, n=40: " ".join(f"{tag}{i}" for i in range(n))
    rows = [
        (1, words("a")), (2, words("a") + " more"), (3, words("b") + ' token = "abcdef123456"'), (4, words("b", 5)), (5, None),
        (6, words("bench", 13) + " " + words("c")), (7, words("d")), (7, words("d")), (None, words("e")), (8, ""),
    ]
    spark.createDataFrame([(d, t, None, None, len(t or "")) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, words("bench", 13)), (2, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(r.doc_id for r in found if r.doc_id) == [1, 3, 7] and sum(r.doc_id is None for r in found) == 1
    assert all(r.round_trip for r in found)
