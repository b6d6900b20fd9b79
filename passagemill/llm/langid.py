"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens as tk

#: Buckets of hashed n-grams, orders of n-grams, and rows of buckets that travel together.
BUCKETS, ORDERS, BLOCK = 1 << 15, (1, 2, 3), 1 << 12
_letters: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    if not _letters:
        _letters.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _letters[0]


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all n-grams of all texts by order, bounds of the texts in one order, and which texts have a letter.

    Letters are lower-cased; every other character stands for a gap. An n-gram of gaps only, or
    one that reaches into the next text, goes to bucket -1.
    """
    joined = "".join(x.lower() + " " for x in texts)
    lengths = np.fromiter((len(x.lower()) + 1 for x in texts), np.int64, len(texts))
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    letter = _is_letter()[codes.astype(np.int64)]
    codes = np.where(letter, codes, 32)
    owner = np.repeat(np.arange(len(texts)), lengths)
    out = []
    for n in ORDERS:
        bucket = np.full(len(codes), -1, np.int64)
        value = tk.mix(tk.gram_hashes(codes, n) + np.uint64(n)) & np.uint64(BUCKETS - 1)
        some = letter[: len(value)].copy()
        for j in range(1, n):
            some |= letter[j : j + len(value)]
        whole = owner[: len(value)] == owner[n - 1 :]
        bucket[: len(value)] = np.where(some & whole, value.astype(np.int64), -1)
        out.append(bucket)
    count = np.concatenate([[0], np.cumsum(letter)])
    return np.stack(out), bounds, np.diff(count[bounds]) > 0


def _slices(texts: list[str], limit: int = 1 << 18) -> Iterator[tuple[int, list[str]]]:
    """Neighbouring texts of about ``limit`` characters; longer texts come alone, and whole."""
    first, size = 0, 0
    for i, x in enumerate(texts):
        if size and size + len(x) > limit:
            yield first, texts[first:i]
            first, size = i, 0
        size += len(x)
    if texts[first:]:
        yield first, texts[first:]


def learn_languages(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", smoothing: float = 0.5) -> dict[str, np.ndarray]:
    """Log-probabilities of the buckets per language, from all rows with a text and a language.

    Every task counts its own rows into one matrix and sends that, so what is shuffled and what
    the driver receives are languages x buckets, however many rows there are. The last entry of a
    vector is the logarithm of the language's share of the texts.
    """
    rows = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")).filter("lang is not null and text is not null")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), object)
            texts = batch.column("text").to_pylist()
            for lang in sorted(set(langs)):
                own = [texts[i] for i in np.flatnonzero(langs == lang)]
                into = total.setdefault(lang, np.zeros(BUCKETS + BLOCK, np.int64))
                into[BUCKETS] += len(own)
                for _, part in _slices(own):
                    buckets, _, _ = features(part)
                    into[:BUCKETS] += np.bincount(buckets.ravel() + 1, minlength=BUCKETS + 1)[1:]
        for lang, counts in total.items():
            blocks = np.arange(0, BUCKETS + BLOCK, BLOCK)
            parts = [counts[b : b + BLOCK].astype("<i8").tobytes() for b in blocks]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(parts)), pa.array(blocks), pa.array(parts, pa.binary())], names=["lang", "block", "data"])

    def merge(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, "<i8") for x in table["data"].to_pylist())
        return table.slice(0, 1).set_column(2, "data", pa.array([total.tobytes()], pa.binary()))

    merged = rows.mapInArrow(count, "lang string, block long, data binary").groupBy("lang", "block").applyInArrow(merge, "lang string, block long, data binary")
    counts: dict[str, np.ndarray] = {}
    for row in merged.toLocalIterator():
        counts.setdefault(row["lang"], np.zeros(BUCKETS + BLOCK, np.int64))[row["block"] :][:BLOCK] = np.frombuffer(row["data"], "<i8")
    texts = sum(int(c[BUCKETS]) for c in counts.values())
    model = {}
    for lang in sorted(counts):
        c = counts[lang][:BUCKETS] + smoothing
        model[lang] = np.append(np.log(c / c.sum()), np.log(counts[lang][BUCKETS] / texts))
    return model


def identify_language(docs: DataFrame, model: dict[str, np.ndarray], id_col: str = "doc_id", text_col: str = "text", evidence: int = 64) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, lang_pred, score``.

    The language of the greatest posterior wins, the first in order of names among equals; every
    n-gram of the text counts in full. As n-grams of one text are far from independent, that
    posterior is near 1 for any long text, so ``score`` is the winner's share if log-likelihoods
    are scaled down to ``evidence`` n-grams; it can be below one half. A text that is null or has no letter, and
    any text if no language was learned, gets ``und`` with score 0. Whole texts are read. The
    model goes to the tasks by broadcast; its size is languages x buckets.
    """
    names = sorted(model)
    matrix = np.stack([model[x] for x in names]) if names else np.zeros((0, BUCKETS + 1))
    shared = docs.sparkSession.sparkContext.broadcast(matrix)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.concatenate([shared.value[:, :BUCKETS], np.zeros((len(names), 1))], 1)  # bucket -1 is the last
        prior = shared.value[:, BUCKETS]
        for batch in batches:
            texts = batch.column("text").to_pylist()
            best, score = ["und"] * len(texts), np.zeros(len(texts))
            for first, part in _slices([x or "" for x in texts]) if names else ():
                buckets, bounds, some = features(part)
                sums = np.zeros((len(names), len(part)))
                n = np.zeros(len(part))
                for row in buckets:
                    n += np.add.reduceat(row >= 0, bounds[:-1])
                    for j in range(len(names)):
                        sums[j] += np.add.reduceat(table[j][row], bounds[:-1])
                top = (sums + prior[:, None]).argmax(0)
                total = sums * np.minimum(1, evidence / np.maximum(n, 1)) + prior[:, None]
                share = np.exp(total - total.max(0))
                share /= share.sum(0)
                for i in np.flatnonzero(some).tolist():
                    best[first + i], score[first + i] = names[top[i]], share[top[i], i]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(best, pa.string()), pa.array(score)], names=["doc_id", "lang_pred", "score"])

    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double")
