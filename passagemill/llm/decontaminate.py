"""Benchmark decontamination as a prefix-filtered set join, in DataFrame operations only.

A window of an item is a set of (word, place) pairs that a document must contain whole. Since all
of them are necessary, a prefix of one is enough: the word of the window that is rarest in the
corpus. Only document words equal to such a word are candidates; bounds on place and length come
next, and the words of the document around it decide.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import stored
from .keys import text_key

#: Words of an item window.
WINDOW = 13
#: Bytes of the window table up to which it is broadcast; beyond, candidates are joined by a shuffle.
BROADCAST_BYTES = 32 << 20
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_END = "\x00"


def word_array(text: Column) -> Column:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z is lower-cased; none of a null text."""
    lower = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    return F.array_remove(F.split(lower, "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"), "")


def item_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """``words, items``: every different window and the ids, as strings, of the items that have it."""
    rows = items.select(F.col(id_col).cast("string").alias("item"), word_array(F.col(text_col)).alias("all"))
    rows = rows.filter(F.size("all") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("all") - window + 1, F.lit(1)))
    parts = rows.select("item", F.explode(F.transform(starts, lambda i: F.slice("all", i, window))).alias("words"))
    return parts.groupBy("words").agg(F.collect_set("item").alias("items"))


def rarest_words(windows: DataFrame, docs: DataFrame, small: bool) -> DataFrame:
    """Windows with their rarest word (``token``) and its place (``offset``, from 0)."""
    vocabulary = windows.select(F.explode("words").alias("word")).distinct()
    every = docs.select(F.explode("words").alias("word"))
    counts = every.join(F.broadcast(vocabulary) if small else vocabulary, "word").groupBy("word").agg(F.count("*").alias("n"))
    placed = windows.select("words", "items", F.posexplode("words").alias("offset", "word"))
    placed = placed.join(stored(counts, "word-counts"), "word", "left")
    order = F.struct(F.coalesce("n", F.lit(0)).alias("n"), F.col("word"), F.col("offset"))
    return placed.groupBy("words").agg(F.first("items").alias("items"), F.min(order).alias("least")).select("words", "items", F.col("least.word").alias("token"), F.col("least.offset").alias("offset"))


def contamination(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_id_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, text_key, n_words, n_hit, items, contaminated``.

    Windows are ``window`` consecutive words of an item; an item of fewer words, but not none, is
    one window. A word of a document inside any occurrence of a window is hit. ``items`` are the
    ids, as strings in order, of the items of which a window occurs; an item without an id is
    counted for hits only. ``contaminated``: a word is hit, and at least one in twenty is.
    A null text has no words. Ids may be null or repeated; repeated rows get equal results.
    ``text_key`` are two 64-bit hashes of the text, which with the id name a row. An empty
    ``items`` table hits nothing. Other columns are not read.

    The window table is written to the shared folder and measured. Up to ``broadcast_bytes`` it is
    broadcast and the words of a document never leave their task; a larger one is joined on the
    rare words by a shuffle, and candidates are verified in a second join. Results are the same.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), text_key(F.col(text_col)).alias("text_key"), word_array(F.col(text_col)).alias("words"))
    windows = stored(item_windows(items, item_id_col, item_text_col, window), "item-windows")
    size = windows.agg(F.sum(F.octet_length(F.array_join("words", " ")) + F.octet_length(F.array_join("items", " ")) + 64).alias("n")).first()["n"] or 0
    small = size <= broadcast_bytes
    found = stored(rarest_words(windows, rows, small), "rare-words")
    if small:
        end = found.sparkSession.createDataFrame([(None, None, _END, -1)], found.schema)
        spread = rows.select("doc_id", "text_key", "words", F.posexplode(F.concat("words", F.array(F.lit(_END)))).alias("place", "token"))
        met = spread.join(F.broadcast(found.unionByName(end).withColumnRenamed("words", "wanted")), "token")
        start = F.col("place") - F.col("offset")
        fits = (start >= 0) & (start + F.size("wanted") <= F.size("words")) & (F.slice("words", F.greatest(start, F.lit(0)) + 1, F.size("wanted")) == F.col("wanted"))
        met = met.filter((F.col("offset") == -1) | fits)
        met = met.select("doc_id", "text_key", F.when(F.col("offset") == -1, F.col("place")).alias("n_words"), start.alias("start"), (start + F.size("wanted")).alias("end"), "items")
    else:
        met = _shuffled(rows, found)
    return _summed(met)


def _shuffled(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The same candidates without a broadcast: join on the rare word, then verify next to the document."""
    spread = rows.select("doc_id", "text_key", F.size("words").alias("n"), F.posexplode("words").alias("place", "token"))
    met = spread.join(found.withColumnRenamed("words", "wanted"), "token")
    start = F.col("place") - F.col("offset")
    met = met.withColumn("start", start).filter((start >= 0) & (start + F.size("wanted") <= F.col("n")))
    one = F.struct("start", "wanted", "items")
    candidates = met.groupBy("doc_id", "text_key").agg(F.collect_set(one).alias("candidates"))
    same = F.col("d.doc_id").eqNullSafe(F.col("c.doc_id")) & (F.col("d.text_key") == F.col("c.text_key"))
    joined = rows.alias("d").join(candidates.alias("c"), same, "left").select("d.doc_id", "d.text_key", "words", "candidates")
    right = F.filter("candidates", lambda x: F.slice("words", x["start"] + 1, F.size(x["wanted"])) == x["wanted"])
    hits = joined.select("doc_id", "text_key", F.size("words").alias("n"), right.alias("hits"))
    end = hits.select("doc_id", "text_key", F.col("n").alias("n_words"), F.lit(None).cast("int").alias("start"), F.lit(None).cast("int").alias("end"), F.lit(None).cast("array<string>").alias("items"))
    each = hits.select("doc_id", "text_key", F.explode("hits").alias("x"))
    each = each.select("doc_id", "text_key", F.lit(None).cast("int").alias("n_words"), F.col("x.start"), (F.col("x.start") + F.size("x.wanted")).alias("end"), F.col("x.items"))
    return end.unionByName(each)


def _summed(met: DataFrame) -> DataFrame:
    """Rows of documents (``n_words`` set) and of occurrences, by document."""
    span = F.when(F.col("n_words").isNull(), F.struct("start", "end"))
    by = met.groupBy("doc_id", "text_key").agg(
        F.max("n_words").cast("long").alias("n_words"),
        F.count("n_words").alias("copies"),
        F.sort_array(F.collect_set(span)).alias("spans"),
        F.collect_set(F.when(F.col("n_words").isNull(), F.col("items"))).alias("lists"),
    )
    zero = F.struct(F.lit(0).cast("long").alias("hit"), F.lit(0).cast("long").alias("upto"))

    def widen(acc, x):
        low = F.greatest(acc["upto"], x["start"].cast("long"))
        high = x["end"].cast("long")
        return F.struct((acc["hit"] + F.greatest(high - low, F.lit(0).cast("long"))).alias("hit"), F.greatest(acc["upto"], high).alias("upto"))

    n_hit = F.aggregate("spans", zero, widen)["hit"]
    rows = by.select("doc_id", "text_key", "n_words", n_hit.alias("n_hit"), F.array_sort(F.array_distinct(F.flatten("lists"))).alias("items"), F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"))
    return rows.drop("copy").withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))
