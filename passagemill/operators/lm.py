"""Unigram language model: build it, look words up, score and filter paragraphs."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passagemill import constants as C
from passagemill.functions.common import array_pieces, explode_rows, run_once
from passagemill.functions.text import tokenize
from passagemill.sources.scratch import stored

_SALTS = 32


def unigram_model(counts: DataFrame) -> DataFrame:
    """``(word, logp)`` from ``(word, n)``: log2 share of each word, plus the unknown word.

    An unknown word counts as if it had occurred sqrt(vocabulary) + 1 times.
    """
    total = F.log2(counts.agg(F.sum("n")).scalar())
    log_n = F.when(F.col("n") > 0, F.log2("n")).otherwise(F.lit(float("-inf")))
    known = counts.filter(F.col("word") != C.UNKNOWN_WORD).select(
        "word", (log_n - total).alias("logp")
    )
    unknown = counts.agg(
        (F.log2(F.sqrt(F.count(F.lit(1))) + 1) - F.log2(F.sum("n"))).alias("logp")
    ).select(F.lit(C.UNKNOWN_WORD).alias("word"), "logp")
    return known.unionByName(unknown)


def fits_broadcast(
    model: DataFrame, rows: int = C.BROADCAST_MODEL_ROWS, size: int = C.BROADCAST_MODEL_BYTES
) -> bool:
    """Check of rows and bytes before a model is sent to every executor."""
    found = model.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("word") + 8).alias("b")).first()
    return found["n"] <= rows and (found["b"] or 0) <= size


def _unknown_logp(model: DataFrame) -> Column:
    return model.filter(F.col("word") == C.UNKNOWN_WORD).select("logp").scalar()


def lookup_logp(tokens: DataFrame, model: DataFrame, word: str = "word") -> DataFrame:
    """Add ``logp`` of each lower-cased token, the unknown word's where there is no entry.

    A model within the checked bound is broadcast. A larger one is shuffled with the tokens;
    frequent words are spread by a salt and the model repeated per salt.
    """
    lowered = tokens.withColumn("_w", F.lower(word))
    entries = model.withColumnRenamed("word", "_w").withColumnRenamed("logp", "_lp")
    if fits_broadcast(model):
        joined = lowered.join(F.broadcast(entries), "_w", "left")
    else:
        salt = F.pmod(F.xxhash64(*tokens.columns), F.lit(_SALTS)).cast("int")
        every = entries.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
        joined = lowered.withColumn("_s", salt).join(every, ["_w", "_s"], "left")
    return joined.select(*tokens.columns, F.coalesce("_lp", _unknown_logp(model)).alias("logp"))


def score_by_join(df: DataFrame, model: DataFrame, text: str, out: str = "score") -> DataFrame:
    """Mean log2 probability per row by joins alone, for models of any size.

    A score depends on the text alone, so texts are named by two hashes of themselves, whatever
    keys the rows have; texts that occur several times have the same mean. Words are counted per
    text before the look-up, so a frequent word is one row per text.
    """
    key = ["_t1", "_t2"]
    named = df.withColumns({"_t1": F.xxhash64(text), "_t2": F.xxhash64(F.lit(7), F.col(text))})
    words = explode_rows(named, key, tokenize(F.col(text)), "word")
    counted = words.groupBy(*key, "word").agg(F.count(F.lit(1)).alias("_n"))
    scores = (
        lookup_logp(counted, model)
        .groupBy(*key)
        .agg((F.sum(F.col("_n") * F.col("logp")) / F.sum("_n")).alias(out))
    )
    joined = named.join(scores, key, "left")
    return joined.select(*df.columns, F.coalesce(out, F.lit(0.0)).alias(out))


def model_scorer(model: DataFrame, nested: bool = False):
    """Vectorised scorer of token arrays (or arrays of them) against a broadcast model.

    Rows are scored where they are, so no text is shuffled. The caller has checked the size of
    the model with :func:`fits_broadcast`. A worker builds its index of the words once; after that
    a batch costs its own different words, however large the model is.
    """
    table = model.toArrow()
    shared = model.sparkSession.sparkContext.broadcast({"table": table})
    unknown = C.UNKNOWN_WORD

    @F.arrow_udf("array<double>" if nested else "double")
    def mean_logp(tokens):
        import numpy as np
        import pandas as pd
        import pyarrow as pa
        import pyarrow.compute as pc

        held = shared.value  # one object per worker process
        if "index" not in held:
            held["index"] = pd.Index(held["table"].column("word").to_pandas())
            held["logp"] = held["table"].column("logp").to_numpy()
            held["fallback"] = held["index"].get_loc(unknown)
        logp = held["logp"]

        def sizes(lists):
            return pc.fill_null(lists.value_lengths(), 0).to_numpy(zero_copy_only=False)

        def means(lists):
            return np.concatenate([means_of(part) for part in array_pieces(lists)])

        def means_of(lists):
            n = sizes(lists)
            coded = lists.flatten().dictionary_encode()
            at = held["index"].get_indexer(coded.dictionary.to_pandas())
            value = logp[np.where(at < 0, held["fallback"], at)]
            row = np.repeat(np.arange(len(n)), n)
            sums = np.bincount(row, weights=value[coded.indices.to_numpy()], minlength=len(n))
            return sums / np.maximum(n, 1)

        if not nested:
            return pa.array(means(tokens))
        offsets = np.concatenate([[0], np.cumsum(sizes(tokens))]).astype("int32")
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(means(tokens.flatten())))

    return run_once(mean_logp)


def unigram_score(df: DataFrame, model: DataFrame, text: str, out: str = "score") -> DataFrame:
    """Mean log2 probability of the tokens of each text; 0 for a text without tokens.

    Within the checked model size rows are scored in place; beyond it the join form is used,
    which gives the same scores. The model is written to the shared folder first, as it is read
    several times.
    """
    model = stored(model, "word-model")
    if fits_broadcast(model):
        return df.withColumn(out, model_scorer(model)(tokenize(F.col(text))))
    return score_by_join(df, model, text, out)


def score_passes(score: Column, threshold: float = C.MIN_SCORE) -> Column:
    """Strictly above the threshold; rounded first, since sums differ in their last digits."""
    return F.round(F.coalesce(score, F.lit(0.0)), 9) > threshold


def min_unigram_score(
    df: DataFrame, score: str = "score", threshold: float = C.MIN_SCORE
) -> DataFrame:
    return df.filter(score_passes(F.col(score), threshold))


def score_text(df: DataFrame, scorer_factory: Callable, text: str, out: str = "score") -> DataFrame:
    """Score with a caller's model: the factory runs once per task and gives Series → Series.

    The model gets a batch of Spark in pieces of about a megabyte, one after the other.
    """

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = scorer_factory()
        for texts in batches:
            scores = (pd.Series(scorer(part.to_pandas())) for part in array_pieces(texts))
            yield pa.concat_arrays([pa.Array.from_pandas(x, type=pa.float64()) for x in scores])

    return df.withColumn(out, F.arrow_udf(run, "double")(F.col(text)))
