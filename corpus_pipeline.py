"""From raw documents to token ids: quality, near duplicates, benchmark passages, secrets, pieces.

Each stage takes what its predecessor kept, written and reread. All but the last return the
columns of ``documents``; where a stage changes a text, ``n_chars`` follows.

For every stage: an empty table gives an empty one, and columns that ``documents`` does not have
are not read, so their names cannot clash. Null ids stay null. Repeated rows are documents of
their own, but for near duplicates, where they are copies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from passagemill.llm.decontaminate import contamination
from passagemill.llm.jaccard_join import jaccard_join
from passagemill.llm.keys import split_without_rows, text_key, without_rows
from passagemill.llm.pieces import encode_pieces
from passagemill.llm.quality import quality_rules
from passagemill.llm.secrets import secret_scan
from passagemill.sources.scratch import stored

#: No SQL expresses the piece lattice or the inferred formats; tests compare with brute force.
ORACLE_SQL = None
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
_CARRIED = ["lang", "source", "n_chars"]


def _with_text(found: DataFrame, text: str) -> DataFrame:
    """Columns of documents from a scan that carried them; a changed text gets its own length."""
    n_chars = F.coalesce(F.length(text).cast("long"), "carried.n_chars").alias("n_chars")
    return found.select("doc_id", F.col(text).alias("text"), "carried.lang", "carried.source", n_chars)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, without the lines that too many documents of their source share.

    A null or empty text has too few words and goes. Rows without a source are a source of their own.
    """
    return _with_text(quality_rules(docs, carry=_CARRIED).filter("kept"), "cleaned")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that of the least id, null last; then the least text hash.

    Of rows that repeat that document one stays: the first by language, source and length. A text
    without words is no duplicate.
    """
    judged = stored(jaccard_join(docs).select("doc_id", "text_key", "keep"), "near-duplicates")
    kept = split_without_rows(docs.select(*COLUMNS), judged.filter("not keep"), "doc_id", "text")
    repeated = stored(judged.filter("keep").groupBy("doc_id", "text_key").count().filter("count > 1").drop("count"), "repeated")
    if repeated.isEmpty():
        return kept
    # Only rows of repeated names are compared; the text is the same in all of them.
    once = without_rows(kept, repeated, "doc_id", "text")
    keyed = kept.withColumn("text_key", text_key(F.col("text"))).alias("k")
    same = F.col("k.doc_id").eqNullSafe(F.col("r.doc_id")) & (F.col("k.text_key") == F.col("r.text_key"))
    again = keyed.join(repeated.alias("r"), same, "left_semi")
    first = again.groupBy("doc_id", "text_key").agg(F.min(F.struct("lang", "source", "n_chars", "text")).alias("f"))
    return once.unionByName(first.select("doc_id", "f.text", "f.lang", "f.source", "f.n_chars"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that do not hold too much of the benchmark. A null text holds none; an empty benchmark rejects none."""
    found = contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return without_rows(docs.select(*COLUMNS), found.filter("contaminated"), "doc_id", "text")


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by a mark. A null text stays null; without any label only fixed patterns are found."""
    return _with_text(secret_scan(docs, carry=_CARRIED), "redacted")


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, ids, scores, round_trip, changes`` of every document; ``changes`` has the other segmentations.

    A null text has null ids, an empty one none; of equal scores the order is fixed.
    """
    return encode_pieces(docs)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("secrets", secrets),
    ("pieces", pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's result written to the shared folder and reread."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
