"""Ranked lexical search: every document against every item of a stated query set.

Documents are restricted to the words of the items. Documents that are then the same bag of
words, and of the same length norm, get the same scores, so each such class is scored once and
its members come back at the end.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import stored
from .tokens import document_slices, text_bytes

#: A term, as code points for Spark's regular expressions and as bytes of lower-cased UTF-8.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_TERM_BYTES = re.compile(rb"[0-9a-z\x80-\xff]+")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What one block of items may hold, so that its words and their items fit a task.
BLOCK_PAIRS, BLOCK_BYTES, BLOCK_ITEMS = 200_000, 8 << 20, 10_000
#: Score cells and additions that are handled at once; bytes of text handled at once.
_CELLS, _SLICE = 4 << 20, 1 << 20
_NO_ID = (1 << 63) - 1


def terms_of(text: Column) -> Column:
    """All terms of a text with A-Z lower-cased; none of a null text."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), F.lit(TERM), F.lit(0))


def _slices(raw: bytes) -> Iterator[bytes]:
    """Parts of a lower-cased text that cut no term."""
    first = 0
    while first < len(raw):
        last = min(len(raw), first + _SLICE)
        found = _TERM_BYTES.match(raw, last) if last < len(raw) else None
        last = found.end() if found else last
        yield raw[first:last]
        first = last


def bag_of(raw: bytes, vocabulary: dict[bytes, int]) -> tuple[int, Counter]:
    """Number of terms of a text, and how often it has each term of the vocabulary."""
    n, counts = 0, Counter()
    for part in _slices(raw.lower()):
        words = _TERM_BYTES.findall(part)
        n += len(words)
        counts.update(filter(vocabulary.__contains__, words))
    return n, counts


def _bags(docs: DataFrame, terms: list[bytes]) -> DataFrame:
    """``doc_id, n, terms, tfs`` of documents with at least one term; term numbers ascend."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def read(batches):
        vocabulary = {term: i for i, term in enumerate(shared.value)}
        for batch in batches:
            raw, offsets = text_bytes(batch.column("text"))
            for low, high in document_slices(offsets):
                ids, sizes, found, times, ends = [], [], [], [], [0]
                for i in range(low, high):
                    n, counts = bag_of(raw[offsets[i] : offsets[i + 1]].tobytes(), vocabulary)
                    if n:
                        bag = sorted((vocabulary[t], tf) for t, tf in counts.items())
                        found += [t for t, _ in bag]
                        times += [tf for _, tf in bag]
                        ids.append(i)
                        sizes.append(n)
                        ends.append(len(found))
                lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, pa.int32())) for x in (found, times)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(ids, pa.int64())), pa.array(sizes, pa.int64()), *lists], names=["doc_id", "n", "terms", "tfs"])

    return docs.mapInArrow(read, "doc_id long, n long, terms array<int>, tfs array<int>")


class _Best:
    """The ``k`` best classes of each item among those a task has met, ties by least document."""

    def __init__(self, items: int, k: int):
        self.k, self.floor = k, np.zeros(items, np.int64)
        self.rows = np.zeros((0, 4), np.int64)  # item, score, least, hash

    def add(self, scores: np.ndarray, least: np.ndarray, hashes: np.ndarray) -> None:
        at, item = np.nonzero((scores > 0) & (scores >= self.floor))
        if not len(at):
            return
        rows = np.concatenate([self.rows, np.column_stack([item, scores[at, item], least[at], hashes[at]])])
        rows = rows[np.lexsort((rows[:, 3], rows[:, 2], -rows[:, 1], rows[:, 0]))]
        place = np.arange(len(rows)) - np.searchsorted(rows[:, 0], rows[:, 0])
        self.rows = rows[place < self.k]
        last = rows[place == self.k - 1]
        self.floor[last[:, 0]] = last[:, 1]


def _scored(classes: DataFrame, weights: np.ndarray, starts: np.ndarray, items: np.ndarray, n_items: int, k: int) -> DataFrame:
    """``item, score, least, hash``: the best classes of each item in each task.

    ``items[starts[t]:starts[t + 1]]`` are the items that hold term ``t``.
    """
    shared = classes.sparkSession.sparkContext.broadcast((weights, starts, items))

    def score(batches):
        weight, first, holders = shared.value
        degree, best = np.diff(first), _Best(n_items, k)
        for batch in batches:
            sizes = batch.column("terms").value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            terms, tfs = (batch.column(c).flatten().to_numpy().astype(np.int64) for c in ("terms", "tfs"))
            m, least, hashes = (batch.column(c).to_numpy() for c in ("m", "least", "hash"))
            ends = np.concatenate([[0], np.cumsum(sizes)])
            work = np.concatenate([[0], np.cumsum(degree[terms])])[ends]
            for low, high in document_slices(work + n_items * np.arange(len(work)), _CELLS):
                t, tf = terms[ends[low] : ends[high]], tfs[ends[low] : ends[high]]
                row = np.repeat(np.arange(high - low), sizes[low:high])
                share = weight[t] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[low:high][row]))
                times = degree[t]
                at = np.repeat(first[t] - np.concatenate([[0], np.cumsum(times)[:-1]]), times) + np.arange(times.sum())
                cells = np.zeros((high - low) * n_items, np.int64)
                np.add.at(cells, np.repeat(row, times) * n_items + holders[at], np.repeat(share, times))
                best.add(cells.reshape(-1, n_items), least[low:high], hashes[low:high])
        yield pa.RecordBatch.from_arrays([pa.array(best.rows[:, i]) for i in range(4)], names=["item", "score", "least", "hash"])

    return classes.mapInArrow(score, "item long, score long, least long, hash long")


def _search_block(docs: DataFrame, pairs: DataFrame, k: int) -> DataFrame:
    """The search for items whose ``(item_id, term)`` pairs are few enough to be sent to every task."""
    spark = docs.sparkSession
    table = pairs.toArrow()
    item, term = (table[c].combine_chunks() for c in ("item_id", "term"))
    item = pc.dictionary_encode(item, null_encoding="encode")
    term = pc.dictionary_encode(term)
    names, terms = item.dictionary, [t.encode() for t in term.dictionary.to_pylist()]
    held = np.lexsort((item.indices.to_numpy(), term.indices.to_numpy()))
    items = item.indices.to_numpy().astype(np.int64)[held]
    starts = np.searchsorted(term.indices.to_numpy()[held], np.arange(len(terms) + 1))

    bags = stored(_bags(docs, terms), "bags")
    total = bags.agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("l")).first()
    big_n, big_l = F.lit(total["n"]).cast("long"), F.lit(total["l"] or 1).cast("long")
    df = bags.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df"))
    weight = F.floor(1000 * F.log((2 * big_n + 2) / (2 * F.col("df") + 1)))
    found = df.select("t", weight.alias("w")).toArrow()  # one row per term of the block
    weights = np.zeros(len(terms), np.int64)
    weights[found["t"].to_numpy()] = found["w"].to_numpy()

    norm = (10 + F.call_function("div", 90 * F.col("n") * big_n, big_l)).alias("m")
    normed = bags.filter(F.size("terms") > 0).select("doc_id", norm, "terms", "tfs")
    hashed = normed.select("*", F.xxhash64("m", "terms", "tfs").alias("hash"), F.coalesce("doc_id", F.lit(_NO_ID)).alias("_id"))
    # grouping by the vector itself is the check that equal hashes are equal bags
    bag = ["hash", "m", "terms", "tfs"]
    classes = hashed.groupBy(*bag).agg(F.min("_id").alias("least"))
    of_tasks = _scored(classes, weights, starts, items, len(names), k)
    by_item = Window.partitionBy("item").orderBy(F.desc("score"), "least", "hash")
    winners = stored(of_tasks.select("*", F.row_number().over(by_item).alias("_r")).filter(F.col("_r") <= k).drop("_r"), "best-classes")

    wanted = F.broadcast(winners.select("hash").distinct())  # k per item of a block at most
    by_class = Window.partitionBy(*bag).orderBy("_id")
    members = hashed.join(wanted, "hash").select(*bag, "doc_id", "_id", F.row_number().over(by_class).alias("_r")).filter(F.col("_r") <= k)
    members = members.select("hash", F.min("_id").over(Window.partitionBy(*bag)).alias("least"), "doc_id", "_id")
    ranked = Window.partitionBy("item").orderBy(F.desc("score"), "_id")
    best = winners.join(members, ["hash", "least"]).select("item", "score", "doc_id", F.row_number().over(ranked).alias("rank")).filter(F.col("rank") <= k)
    named = spark.createDataFrame(pa.table({"item": pa.array(np.arange(len(names))), "item_id": names}))
    return best.join(F.broadcast(named), "item").select("item_id", "rank", "doc_id", "score")


def lexical_search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of each item.

    Terms are runs of ASCII letters and digits and of all other non-ASCII characters, A-Z
    lower-cased. With N documents of at least one term, L their terms and ``df`` the documents
    with a term, a term weighs ``floor(1000 ln((2N + 2) / (2 df + 1)))``. A document of ``n``
    terms has the norm ``m = 10 + 90 n N div L``; a term it holds ``tf`` times adds the weight times
    ``10^9 tf div (1000 tf + 8 m)``, in 64-bit integers. Equal scores come by ascending ``doc_id``.

    Only documents of a score above 0 are given, so an item without terms (null or empty text),
    and every item over an empty table, has no row. Rows of one ``item_id`` are one item with the
    terms of all; null is an id. Repeated rows of ``docs`` are documents of their own and are all
    counted; a null ``doc_id`` comes last. Other columns are not read, so names cannot clash.

    Texts stay where they are; per document only the counts of words that an item has are
    stored. Equal counts are combined before they are shuffled. Each task scores all its classes
    against all items and passes on the ``k`` best per item. Items are worked on in blocks that
    are measured before they are broadcast; one block holds 10,000 items.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    asked = items.select(F.col(item_col).alias("item_id"), F.explode(F.array_distinct(terms_of(F.col(item_text)))).alias("term"))
    pairs = stored(asked.distinct(), "item-terms")
    blocks = _blocks(pairs)
    if not blocks:
        return spark.createDataFrame([], pairs.select("item_id", F.lit(1).alias("rank"), F.lit(1).cast("long").alias("doc_id"), F.lit(1).cast("long").alias("score")).schema)
    found = None
    for b in range(blocks):
        part = _search_block(texts, pairs.filter(_block_of(blocks) == b) if blocks > 1 else pairs, k)
        found = part if found is None else found.unionByName(part)
    return found


def _block_of(blocks: int) -> Column:
    return F.pmod(F.xxhash64("item_id"), F.lit(blocks))


def _blocks(pairs: DataFrame) -> int:
    """Into how many blocks items are dealt so that each is within the bounds, unless it is one item."""
    size = [F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("term")).alias("b"), F.approx_count_distinct("item_id", 0.01).alias("i")]
    blocks = 1
    while True:
        parts = pairs.groupBy(_block_of(blocks).alias("block")).agg(*size)  # one row per block
        if parts.isEmpty():
            return 0
        large = parts.filter((F.col("i") > 1) & ((F.col("n") > BLOCK_PAIRS) | (F.col("b") > BLOCK_BYTES) | (F.col("i") > BLOCK_ITEMS)))
        if large.isEmpty():
            return blocks
        blocks *= 2
