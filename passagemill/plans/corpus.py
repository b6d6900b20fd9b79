"""Job: TEI documents to a paragraph corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passagemill import constants as C
from passagemill.functions.text import clean_text, min_words, tokenize
from passagemill.operators import lm
from passagemill.operators import paragraphs as P
from passagemill.sources import sinks
from passagemill.sources.scratch import stored


def paragraph_arrays(
    documents: DataFrame,
    model: DataFrame,
    concat_p: bool = False,
    words: int = C.MIN_WORDS,
    score: float = C.MIN_SCORE,
    footer: str = C.FOOTER_PATTERN,
) -> DataFrame:
    """``(path, doc_id, n_found, n_kept, paragraphs)`` per document, with no shuffle at all.

    A document is one row, so its paragraphs are cleaned, filtered and kept in order as an
    array. The length filter comes before tokenising and scoring. A model beyond the broadcast
    bound is joined instead, on exploded paragraphs.
    """
    divisions = P.tei_divisions(F.col("content"), nfc=True)
    found = documents.select("path", "doc_id", divisions.alias("divisions"))
    cleaned = found.select(
        "path",
        "doc_id",
        F.transform(P.paragraph_array(F.col("divisions"), concat_p), lambda p: clean_text(p, footer)).alias("all"),
    )
    long = cleaned.select(
        "path",
        "doc_id",
        F.when(F.col("all").isNotNull(), F.size("all")).alias("n_found"),
        F.filter("all", lambda p: min_words(p, words)).alias("long"),
    )
    model = stored(model, "word-model")
    if lm.fits_broadcast(model):
        scores = lm.model_scorer(model, nested=True)(F.transform("long", tokenize))
        pairs = F.zip_with("long", "_s", lambda p, s: F.struct(p.alias("p"), s.alias("s")))
        kept = F.filter(pairs, lambda z: lm.score_passes(z["s"], score))
        scored = long.withColumn("_s", scores)
        result = scored.withColumn("paragraphs", F.transform(kept, lambda z: z["p"]))
    else:
        long = stored(long, "long-paragraphs")  # read three times below; the XML is walked once
        rows = long.select("path", F.posexplode("long").alias("pos", "p"))
        scored = lm.score_by_join(rows, model, "p")
        kept = lm.min_unigram_score(scored, threshold=score).groupBy("path").agg(
            F.array_sort(F.collect_list(F.struct("pos", "p"))).alias("z")
        )  # bounded by one document, which was one row to begin with
        result = long.join(kept, "path", "left").withColumn(
            "paragraphs", F.transform("z", lambda z: z["p"])
        )
    texts = F.coalesce("paragraphs", F.array().cast("array<string>"))
    return result.select("path", "doc_id", "n_found", F.size(texts).alias("n_kept"), texts.alias("paragraphs"))


def paragraph_table(arrays: DataFrame) -> DataFrame:
    """``(id, idx, paragraph)``; the array position is the number after filtering."""
    return arrays.select(
        F.col("doc_id").alias("id"), F.posexplode("paragraphs").alias("idx", "paragraph")
    )


def build_paragraph_corpus(
    documents: DataFrame,
    model: DataFrame,
    arrays_path: str | None = None,
    dataset_path: str | None = None,
    config: str = "default",
    **options,
) -> tuple[DataFrame, DataFrame]:
    """Write the per-document arrays and the paragraph table; return ``(table, stats)``.

    Documents are parsed once: both outputs read the stored arrays.
    """
    arrays = stored(paragraph_arrays(documents, model, **options), "arrays")
    if arrays_path:
        sinks.write_document_arrays(arrays.select(F.col("doc_id").alias("id"), "paragraphs"), arrays_path)
    table = paragraph_table(arrays)
    if dataset_path:
        sinks.save_paragraph_dataset(table, dataset_path, config)
    return table, P.corpus_stats(arrays)
