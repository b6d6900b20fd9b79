"""Registered queries of this subpackage: one ``opN_<name>`` per operator, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .align import align_tokenizers
from .chat import chat_windows, read_back
from .countmin_dedup import countmin_dedup
from .decontaminate import contamination
from .jaccard_join import jaccard_join
from .langid import identify_language, learn_languages
from .licenses import UNKNOWN, license_scan
from .oracles import ORACLES
from .pieces import encode_pieces, segmentations
from .quality import quality_rules
from .search import lexical_search
from .secrets import secret_scan, span_text
from .suffix_dedup import suffix_dedup
from .urls import url_filter

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
__all__ = ["ORACLES", "QUERIES"]


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query
def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence families in each document, and how many paragraphs are of a known or unknown one."""
    found = license_scan(_table(spark, sf_dir, "documents"))
    sure = F.filter("paragraphs", lambda x: x["family"] != UNKNOWN)
    families = F.array_join(F.array_sort(F.array_distinct(F.transform(sure, lambda x: x["family"]))), ",")
    return found.select("doc_id", F.size(sure).cast("long").alias("n_licences"), (F.size("paragraphs") - F.size(sure)).cast("long").alias("n_unknown"), families.alias("families"))


@_query
def op4_countmin_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words left of each document after repeated passages of 50 words are removed."""
    found = countmin_dedup(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@_query
def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes left of each document after repeated strings of 50 bytes are removed."""
    found = suffix_dedup(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@_query
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base statistics of all documents and the verdict of the quality rules."""
    found = quality_rules(_table(spark, sf_dir, "documents"), with_text=False)
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_removed_words", "base_failed", "kept")


@_query
def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of all documents: fixed patterns and inferred formats."""
    found = secret_scan(_table(spark, sf_dir, "documents"), with_text=False)
    base = F.sha2(span_text(F.col("spans"), base_only=True), 256).alias("base_sha256")
    return found.select("doc_id", "n_assign", "n_access", "n_hex", base, span_text(F.col("spans")).alias("spans"), "n_format")


@_query
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents, learned from three quarters of them."""
    rows = _table(spark, sf_dir, "documents")
    fold = F.crc32(F.col("doc_id").cast("string")) % 4
    model = learn_languages(rows.filter(fold != 2))
    found = identify_language(rows, model)
    return found.select("doc_id", F.coalesce(fold == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


@_query
def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of the rules on the URL of every page."""
    return url_filter(_table(spark, sf_dir, "pages"))


@_query
def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document inside benchmark passages, and whether they are too many."""
    found = contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.array_join("items", ","), 256).alias("items_sha256")
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), digest, "contaminated")


@_query
def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of near-duplicates and number of links of every document."""
    return jaccard_join(_table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")


@_query
def op9_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best segmentation of every text (its length and a hash), scores and a hash of the four best, and whether it decodes."""
    found = encode_pieces(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), F.xxhash64("ids").alias("ids_hash"), F.array_join("scores", ",").alias("scores"), "round_trip", F.xxhash64(segmentations(F.col("ids"), F.col("changes"))).alias("best_hash"))


@_query
def op11_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one made of control strings, read back from their windows."""
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")]
    return read_back(chat_windows(turns.unionByName(spark.createDataFrame(tricky, turns.schema))))


@_query
def op12_align_tokenizers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of tokens of two public vocabularies in all documents, and how often their ids meet."""
    found = align_tokenizers(_table(spark, sf_dir, "documents"))
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256)).alias("groups_sha256")
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", digest)


@_query
def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of each benchmark item."""
    return lexical_search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


@_query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of the corpus pipeline, one after another."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)
