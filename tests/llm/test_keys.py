"""Filters of row names in front of joins."""

import pytest
from pyspark.sql import functions as F

from passagemill.llm import keys


@pytest.mark.parametrize("most", [1 << 6, 1 << 26])
def test_rows_are_taken_out(spark, monkeypatch, most):
    monkeypatch.setattr(keys, "MOST_BITS", most)
    rows = [(i % 90 if i % 7 else None, f"text {i % 150}") for i in range(300)] + [(1, None), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    gone = {r for i, r in enumerate(rows) if i % 3 == 0 or i == 301}
    names = spark.createDataFrame(sorted(gone, key=str), "doc_id long, text string").select("doc_id", keys.text_key(F.col("text")).alias("text_key"))
    want = sorted((r for r in rows if r not in gone), key=str)
    for operator in (keys.without_rows, keys.split_without_rows):
        assert sorted(map(tuple, operator(docs, names, "doc_id", "text").collect()), key=str) == want
    assert operator(docs, names.filter("false"), "doc_id", "text").count() == len(rows)
    maybe = docs.filter(keys.may_be_named(names, F.col("doc_id"), keys.text_key(F.col("text"))))
    assert {tuple(r) for r in maybe.collect()} >= gone
