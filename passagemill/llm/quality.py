"""Quality rules: base statistics of a text, and lines that too many documents of one host share."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import stored
from . import tokens as tk

#: A window of the repetition rule, in words.
REPEAT_WINDOW = 8
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_DIGITS = re.compile(rb"[0-9]+")
#: Lines above the limits, of all hosts, that are sent to every task (8 bytes each and the host's name).
MOST_LINES = 200_000


def line_hash(line: bytes) -> int:
    """Signed 64-bit hash of a line in lower case, its numbers as 0, white space collapsed."""
    words = _DIGITS.sub(b"0", line).split()
    value = xxhash.xxh64_intdigest(b" ".join(words).decode("utf-8", "replace").lower().encode())
    return value - (1 << 64) if value >> 63 else value


def frequent_lines(
    docs: DataFrame, host_col: str = "source", text_col: str = "text", id_col: str = "doc_id",
    min_docs: int = 20, max_share: float = 0.1, max_docs: int = 200,
) -> DataFrame:
    """``host, line``: hashes of the normalised lines above the limits.

    A line is above them if at least ``min_docs`` different documents of the host have it, and
    either more than ``max_share`` of its documents do or ``max_docs`` do. Documents are told
    apart by id: one that is stored twice, or repeats a line, counts once, and rows without an id
    do not count. Rows without a host form a host of their own.

    Counts are summed in the tasks before they are shuffled. Only rows of ids that occur more than
    once are made distinct first.
    """
    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(host_col).cast("string").alias("host"), F.col(text_col).cast("string").alias("text")).filter("id is not null")
    repeated = stored(rows.groupBy("id").agg(F.count("*").alias("n")).filter("n > 1").select("id"), "repeated-ids")
    if repeated.isEmpty():
        counts = _line_rows(rows).groupBy("host", "line").agg(F.count("*").alias("n"))
    else:
        once = _line_rows(rows.join(repeated, "id", "left_anti")).groupBy("host", "line").agg(F.count("*").alias("n"))
        again = _line_rows(rows.join(repeated, "id", "left_semi")).distinct().groupBy("host", "line").agg(F.count("*").alias("n"))
        counts = once.unionByName(again).groupBy("host", "line").agg(F.sum("n").alias("n"))
    counts = stored(counts.filter(F.col("line").isNull() | (F.col("n") >= min_docs)), "line-counts")
    sizes = counts.filter("line is null").select(F.col("host").alias("of"), F.col("n").alias("size"))
    some = counts.filter("line is not null").join(sizes, F.col("host").eqNullSafe(F.col("of")))
    above = (F.col("n") > max_share * F.col("size")) | (F.col("n") >= max_docs)
    return some.filter(above).select("host", "line")


def _line_rows(rows: DataFrame) -> DataFrame:
    """``host, line, id``: the different lines of each row, and a null line for the row itself."""
    return rows.select("host", "id", "text").mapInArrow(_lines, "host string, id string, line long")


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, offsets = tk.text_bytes(batch.column("text"))
        data = raw.tobytes()
        picks, lines = [], []
        for i in range(batch.num_rows):
            found = {line_hash(x) for x in set(data[offsets[i] : offsets[i + 1]].split(b"\n")) if x.strip()}
            lines.append(None)
            lines.extend(found)
            picks.extend([i] * (len(found) + 1))
        place = pa.array(picks, pa.int64())
        keys = [batch.column(c).take(place).cast(pa.string()) for c in ("host", "id")]
        yield pa.RecordBatch.from_arrays([*keys, pa.array(lines, pa.int64())], names=["host", "id", "line"])


_STATS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_removed_words long, cleaned string"


def quality_rules(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
    min_docs: int = 20, max_share: float = 0.1, max_docs: int = 200, max_removed: float = 0.5, with_text: bool = True,
    carry: Sequence[str] = (), most_lines: int = MOST_LINES,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, base statistics, ``base_failed``, ``depleted``, ``kept`` and ``cleaned``.

    ``cleaned`` is the text without the lines that ``frequent_lines`` names for its host (null for
    a null text, and unless ``with_text``); ``n_removed_words`` counts their words. A document is
    depleted if more than ``max_removed`` of its words are removed. ``base_failed``: fewer than 20
    words, or more than 30 % of the words are in 8-word windows that the text has twice or more.
    A null text has no words, so it fails. Columns named by ``carry`` come along in a struct
    ``carried``; others, whatever they are called, are not read. Repeated rows are judged each; an
    empty table gives no row.

    The lines of all hosts are counted. Up to ``most_lines`` are sent to every task; beyond, the
    lines of each text meet the (host, line) pairs, and the text gets its own list back.
    """
    lines = stored(frequent_lines(docs, host_col, text_col, id_col, min_docs, max_share, max_docs), "frequent-lines")
    carried = F.struct(*carry) if carry else F.lit(None).cast("struct<none:int>")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(host_col).cast("string").alias("of"), F.col(text_col).cast("string").alias("text"), carried.alias("carried"))
    shared = None
    if lines.limit(most_lines + 1).count() <= most_lines:
        table = lines.groupBy("host").agg(F.collect_list("line").alias("lines")).toArrow()  # most_lines numbers at most
        of_host = dict(zip(table["host"].to_pylist(), (x.values.to_numpy() for x in table["lines"])))
        shared = docs.sparkSession.sparkContext.broadcast(of_host)
        joined = rows.select("doc_id", "text", "of", "carried")
    else:
        joined = _with_own_lines(rows, lines).select("doc_id", "text", "lines", "carried")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets: dict[str | None, frozenset] = {}

        def of(host: str | None) -> frozenset:
            if host not in sets:
                sets[host] = frozenset(shared.value.get(host, np.zeros(0, np.int64)).tolist())
            return sets[host]

        for batch in batches:
            heavy = [of(h) for h in batch.column("of").to_pylist()] if shared else [frozenset(x or ()) for x in batch.column("lines").to_pylist()]
            yield from _statistics(batch, heavy, with_text)

    found = joined.mapInArrow(run, f"doc_id long, carried {rows.schema['carried'].dataType.simpleString()}, {_STATS}")
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    depleted = F.col("n_removed_words") > max_removed * F.col("n_words")
    found = found if carry else found.drop("carried")
    return found.withColumns({"base_failed": failed, "depleted": depleted}).withColumn("kept", ~(F.col("base_failed") | F.col("depleted")))


def _with_own_lines(rows: DataFrame, lines: DataFrame) -> DataFrame:
    """``rows`` with the lines above the limits that each text has; texts and hosts meet by their hash.

    Lines of equal texts of a host are the same, so they are made distinct before the join; a
    line that many texts share is split by adaptive execution, as the other side has it once.
    """
    keyed = rows.withColumn("key", F.struct(F.xxhash64("of", "text").alias("a"), F.xxhash64(F.lit(7), "of", "text").alias("b")))
    texts = keyed.filter("text is not null").select(F.to_json("key").alias("id"), F.col("of").alias("host"), "text")
    own = _line_rows(texts).filter("line is not null").distinct().alias("o")
    met = own.join(lines.alias("l"), (F.col("o.line") == F.col("l.line")) & F.col("o.host").eqNullSafe(F.col("l.host")), "left_semi")
    lists = met.groupBy("id").agg(F.sort_array(F.collect_list("line")).alias("lines"))
    return keyed.join(lists, F.to_json("key") == F.col("id"), "left")


def _statistics(batch: pa.RecordBatch, heavy: list[frozenset], with_text: bool) -> Iterator[pa.RecordBatch]:
    texts, ids = batch.column("text"), batch.column("doc_id")
    null = np.asarray(texts.is_null())
    for first, raw, starts, ends, firsts, values in tk.words_of(texts):
        n = len(firsts) - 1
        words = np.diff(firsts)
        inside = np.zeros(len(raw) + 1, np.int64)
        inside[starts] += 1
        inside[ends] -= 1
        inside = np.cumsum(inside)[:-1] > 0
        bounds = _text_bounds(texts, first, n)
        chars = _per_text(inside & ((raw & 0xC0) != 0x80), bounds)
        symbols = _per_text(_SYMBOL[raw], bounds)
        repeat = _repeated_words(values, firsts)
        data, dups, gone, cleaned = raw.tobytes(), [], [], []
        for i in range(n):
            text = data[bounds[i] : bounds[i + 1]]
            rows = text.split(b"\n")
            filled = [x for x in rows if x.strip()]
            dups.append(len(filled) - len(set(filled)))
            removed, limits = 0, heavy[first + i]
            if limits:
                bad = {x for x in set(filled) if line_hash(x) in limits}
                if bad:
                    removed = sum(len(x.split()) for x in filled if x in bad)
                    text = b"\n".join(x for x in rows if x not in bad)
            gone.append(removed)
            cleaned.append(None if null[first + i] or not with_text else text.decode())
        columns = [ids.slice(first, n), batch.column("carried").slice(first, n), words, chars, symbols, dups, repeat, gone, pa.array(cleaned, pa.string())]
        names = ["doc_id", "carried", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_removed_words", "cleaned"]
        arrays = [x if isinstance(x, pa.Array) else pa.array(x, pa.int64()) for x in columns]
        yield pa.RecordBatch.from_arrays(arrays, names=names)


def _text_bounds(texts: pa.Array, first: int, n: int) -> np.ndarray:
    _, offsets = tk.text_bytes(texts.slice(first, n))
    return offsets


def _per_text(marked: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.zeros(len(marked) + 1, np.int64)
    np.cumsum(marked, out=total[1:])
    return np.diff(total[bounds])


def _repeated_words(values: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Per text: words covered by windows that it has twice or more."""
    n = len(values) - REPEAT_WINDOW + 1
    if n <= 0:
        return np.zeros(len(firsts) - 1, np.int64)
    owner = np.searchsorted(firsts, np.arange(n), "right") - 1
    valid = np.flatnonzero(firsts[owner + 1] >= np.arange(n) + REPEAT_WINDOW)
    grams = tk.gram_hashes(values, REPEAT_WINDOW)[valid]
    order = np.lexsort((grams, owner[valid]))
    g, o = grams[order], owner[valid][order]
    same = (g[1:] == g[:-1]) & (o[1:] == o[:-1])
    several = np.zeros(len(order), bool)
    several[1:] |= same
    several[:-1] |= same
    edge = np.zeros(len(values) + 1, np.int64)
    at = valid[order[several]]
    np.add.at(edge, at, 1)
    np.add.at(edge, at + REPEAT_WINDOW, -1)
    return _per_text(np.cumsum(edge)[:-1] > 0, firsts)
