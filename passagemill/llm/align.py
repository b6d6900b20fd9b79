"""Tokens of two vocabularies next to each other, and how often their ids meet in a corpus.

Most groups are one token of each vocabulary with the same bytes. Which id that is in the other
vocabulary is known from the start, so those groups are counted in a vector as long as the first
vocabulary; only the pairs of all other groups are shuffled, after each task has summed its own.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import stored
from .encoders import byte_encoder, cuts, parts, piece_encoder
from .keys import text_key
from .tokens import document_slices, text_bytes, word_hashes

#: Pairs of irregular groups that are broadcast at most (17 bytes each), and that a task sums up before it passes them on.
MOST_PAIRS, SUMMED = 1_000_000, 200_000
#: Bytes of text handled at once; the more, the fewer words are encoded again.
SLICE = 2 << 20
_COUNTS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


def same_bytes(a_bytes: list[bytes], b_bytes: list[bytes]) -> np.ndarray:
    """For each id of the first vocabulary the least id of the second with the same bytes, or -1."""
    ids: dict[bytes, int] = {}
    for i, piece in enumerate(b_bytes):
        ids.setdefault(piece, i)
    return np.array([ids.get(piece, -1) if piece else -1 for piece in a_bytes], np.int64)


@dataclass(frozen=True)
class Aligned:
    """Stretches of text side by side in both vocabularies; those that are not ``ok`` have no tokens.

    ``counts`` has tokens of each side, groups and links per stretch; ``codes`` the links of all, in
    order. The code of a pair that the identity map knows is its first id, of any other
    ``n_a + a * n_b + b``. ``spelled`` are the groups as text.
    """

    ok: np.ndarray
    counts: np.ndarray
    codes: np.ndarray
    spelled: list[str]

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Sums of a value per link over the links of each stretch."""
        total, ends = np.concatenate([[0], np.cumsum(values)]), np.cumsum(self.counts[:, 3])
        return total[ends] - total[ends - self.counts[:, 3]]


class Aligner:
    """Two vocabularies and what aligning them needs; a worker keeps one per pair."""

    def __init__(self, a_path: str | None, b_path: str | None):
        self.a, self.b = byte_encoder(a_path), piece_encoder(b_path)
        self.same = same_bytes(self.a.token_bytes, self.b.token_bytes)
        self.n_a, self.n_b = len(self.a.token_bytes), len(self.b.token_bytes)
        self._lengths = [np.array([len(x) for x in side.token_bytes], np.int64) for side in (self.a, self.b)]
        names = [str(i) for i in range(max(self.n_a, self.n_b))]
        self._inside, self._last_a, self._last_b = (np.array([x + end for x in names], object) for end in ",|;")
        self._digits = np.array([len(x) for x in names], np.int64)

    def align(self, stretches: list[str], spell: bool = True) -> Aligned:
        """Stretches that do not end in white space are encoded by A as one text: no token crosses their ends."""
        ends = [s[-1].isspace() for s in stretches]
        joined = [i for i, blank in enumerate(ends) if not blank]
        alone = [[i] for i, blank in enumerate(ends) if blank]
        found = [x for part in ([joined] if joined else []) + alone for x in self._encoded(stretches, part)]
        order = np.fromiter(chain.from_iterable(part for part, _, _ in found), np.int64, len(stretches))
        xs, ys = (np.fromiter(chain.from_iterable(f[k] for f in found), np.int64) for k in (1, 2))
        sizes = np.fromiter((len(s) if s.isascii() else len(s.encode()) for s in stretches), np.int64, len(stretches))
        ok = np.ones(len(stretches), bool)
        ok[[i for part, ids, _ in found if not ids for i in part]] = False
        counts, codes, spelled = self._side_by_side(xs, ys, np.cumsum((sizes * ok)[order]), spell)
        if len(found) == 1:
            return Aligned(ok, counts, codes, spelled)
        place = np.argsort(order)
        links = counts[:, 3]
        first = (np.cumsum(links) - links)[place]
        taken = np.repeat(first - (np.cumsum(links[place]) - links[place]), links[place])
        return Aligned(ok, counts[place], codes[taken + np.arange(len(taken))], [spelled[i] for i in place.tolist()] if spell else [])

    def _encoded(self, stretches: list[str], part: list[int]) -> list[tuple[list[int], list[int], list[int]]]:
        """``(stretches, ids, ids)``; without ids if a vocabulary does not give a stretch back."""
        some = [stretches[i] for i in part]
        text = "".join(some)
        raw, xs, ys = text.encode(), self.a.encode([text])[0], list(chain.from_iterable(self.b.encode(some)))
        if all(b"".join([side.token_bytes[x] for x in ids]) == raw for side, ids in ((self.a, xs), (self.b, ys))):
            return [(part, xs, ys)]
        if len(part) == 1:
            return [(part, [], [])]
        half = len(part) // 2
        return self._encoded(stretches, part[:half]) + self._encoded(stretches, part[half:])

    def _side_by_side(self, xs: np.ndarray, ys: np.ndarray, ends: np.ndarray, spell: bool) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """Counts per stretch, codes of links and groups as text, of tokens over the same bytes, of stretches with these ``ends``."""
        ends_a, ends_b = np.cumsum(self._lengths[0][xs]), np.cumsum(self._lengths[1][ys])
        cells = np.sort(np.concatenate([ends_a, ends_b]), kind="stable")  # two runs, merged
        cells = cells[np.diff(cells, append=-1) != 0]  # every cell lies in one token of each side, and every link is one cell
        a, b = xs[np.searchsorted(ends_a, cells)], ys[np.searchsorted(ends_b, cells)]
        codes = np.where(self.same[a] == b, a, self.n_a + a * self.n_b + b)
        closes_a, closes_b = np.isin(ends_a, ends_b, assume_unique=True), np.isin(ends_b, ends_a, assume_unique=True)
        groups_a, groups_b = np.cumsum(closes_a), np.cumsum(closes_b)
        of_a, of_b, of_cells = (np.searchsorted(e, ends, "right") for e in (ends_a, ends_b, cells))
        of_groups = np.concatenate([[0], groups_a])[of_a]
        counts = np.diff(np.column_stack([of_a, of_b, of_groups, of_cells]), axis=0, prepend=0).astype(np.int64)
        if not spell:
            return counts, codes, []
        # tokens of A, then those of B, group by group
        order = np.argsort(np.concatenate([2 * (groups_a - closes_a), 2 * (groups_b - closes_b) + 1]), kind="stable")
        names = np.concatenate([np.where(closes_a, self._last_a[xs], self._inside[xs]), np.where(closes_b, self._last_b[ys], self._inside[ys])])[order]
        lengths = np.concatenate([[0], np.cumsum(self._digits[np.concatenate([xs, ys])[order]] + 1)])
        text, at = "".join(names.tolist()), lengths[of_a + of_b].tolist()
        spelled = [text[low : high - 1] if high > low else "" for low, high in zip([0, *at], at)]
        return counts, codes, spelled

    def regular(self, codes: np.ndarray) -> np.ndarray:
        return codes < self.n_a

    def texts(self, raw: np.ndarray, ends: np.ndarray, spell: bool = True) -> Iterator[tuple[Aligned, np.ndarray, np.ndarray]]:
        """Different stretches of texts aligned, the number of each stretch of every text, and where texts end.

        ``raw`` are the bytes of texts on end, each with its space in front. A text that a
        vocabulary does not give back has no stretch. A text of more than a slice comes alone and
        in parts, after all its parts were found to be given back. Within a slice stretches of one
        length and 64-bit hash are the same.
        """
        if len(ends) > 1 or len(raw) <= 2 * SLICE:
            yield self._numbered(raw, ends, spell)
        elif all(self._numbered(part, np.array([len(part)]), False)[0].ok.all() for part in parts(raw, SLICE)):
            for part in parts(raw, SLICE):
                yield self._numbered(part, np.array([len(part)]), spell)

    def _numbered(self, raw: np.ndarray, ends: np.ndarray, spell: bool) -> tuple[Aligned, np.ndarray, np.ndarray]:
        begins = np.zeros(len(raw) + 1, bool)
        begins[cuts(raw)] = True
        begins[np.concatenate([[0], ends])] = True
        bounds = np.flatnonzero(begins)
        starts, stops = bounds[:-1], bounds[1:]
        _, first, ids = np.unique(word_hashes(raw, starts, stops), return_index=True, return_inverse=True)
        text = raw.tobytes()
        found = self.align([text[i:j].decode() for i, j in zip(starts[first].tolist(), stops[first].tolist())], spell)
        until = np.searchsorted(starts, ends)
        if not found.ok.all():
            of = np.searchsorted(ends, starts, "right")
            fits = np.bincount(of[~found.ok[ids]], minlength=len(ends)) == 0
            ids, until = ids[fits[of]], np.cumsum(np.diff(until, prepend=0) * fits)
        return found, ids, until


_aligners: dict[tuple, Aligner] = {}


def aligner_of(a_path: str | None, b_path: str | None) -> Aligner:
    if (a_path, b_path) not in _aligners:
        _aligners[a_path, b_path] = Aligner(a_path, b_path)
    return _aligners[a_path, b_path]


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Texts of a batch, about ``SLICE`` bytes at a time: the first and last one, bytes and where each ends.

    Every text that is not empty gets a space in front.
    """
    raw, offsets = text_bytes(batch.column("text"))
    for low, high in document_slices(offsets, SLICE):
        own = offsets[low : high + 1] - offsets[low]
        filled = np.diff(own) > 0
        ends = own[1:] + np.cumsum(filled)
        spaced = np.empty(ends[-1], np.uint8)
        letters = np.ones(len(spaced), bool)
        letters[(own[:-1] + np.cumsum(filled) - filled)[filled]] = False
        spaced[~letters] = 32
        spaced[letters] = raw[offsets[low] : offsets[high]]
        yield low, high, spaced, ends


def _summed(codes: np.ndarray, times: np.ndarray) -> tuple[list[int], list[int]]:
    """Different codes and the sum of each one's times, without those of none."""
    codes, times = codes[times > 0], times[times > 0]
    met, at = np.unique(codes, return_inverse=True)
    sums = np.zeros(len(met), np.int64)
    np.add.at(sums, at, times)
    return met.tolist(), sums.tolist()


def pair_counts(texts: DataFrame, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """``(a, b, n)``: how many links of all texts hold two ids linked.

    A task keeps one vector for regular groups and at most ``SUMMED`` sums of other pairs.
    """

    def count(batches):
        aligner = aligner_of(a_path, b_path)
        vector, pairs = np.zeros(aligner.n_a, np.int64), Counter()

        def rows(a, b, n):
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(n, pa.int64())], names=["a", "b", "n"])

        def of_pairs():
            codes = np.fromiter(pairs.keys(), np.int64, len(pairs)) - aligner.n_a
            return rows(codes // aligner.n_b, codes % aligner.n_b, np.fromiter(pairs.values(), np.int64, len(pairs)))

        for batch in batches:
            for _, _, raw, ends in _texts(batch):
                for found, ids, _ in aligner.texts(raw, ends, spell=False):
                    times = np.repeat(np.bincount(ids, minlength=len(found.ok)), found.counts[:, 3])
                    plain = aligner.regular(found.codes)
                    np.add.at(vector, found.codes[plain], times[plain])
                    for code, n in zip(*_summed(found.codes[~plain], times[~plain])):
                        pairs[code] += n
                if len(pairs) > SUMMED:
                    yield of_pairs()
                    pairs.clear()
        met = np.flatnonzero(vector)
        yield rows(met, aligner.same[met], vector[met])
        yield of_pairs()

    found = texts.mapInArrow(count, "a int, b int, n long")
    return found.groupBy("a", "b").agg(F.sum("n").alias("n"))


def with_best(pairs: DataFrame) -> DataFrame:
    """``pairs`` with ``best``: whether no pair of the same ``b`` has a greater count.

    One row per id of the second vocabulary is joined back; an id has a pair per id of the first at most.
    """
    most = pairs.groupBy("b").agg(F.max("n").alias("most"))
    return pairs.join(most, "b").select("a", "b", "n", (F.col("n") == F.col("most")).alias("best"))


def align_tokenizers(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    a_path: str | None = None,
    b_path: str | None = None,
    most_pairs: int = MOST_PAIRS,
) -> DataFrame:
    """``doc_id, groups, n_a, n_b, n_groups, n_links, n_best, count_sum`` of every row of ``docs``.

    A text with a space in front is encoded by a byte-level vocabulary (A) and a piece vocabulary
    (B). Places where tokens of both end cut it into groups, written ``a1,a2|b1;a3|b2``. Tokens of
    a group that share a byte are linked. ``count_sum`` adds up, over the links, how many links of
    all texts join the same two ids; ``n_best`` counts links that no other partner of their B id
    exceeds, ties included.

    A text that is null or empty, or that a vocabulary does not give back byte by byte (as one
    with U+2581), has no tokens: zeros and empty groups, and it adds nothing to the counts.
    Repeated rows and ids are texts of their own; null ids stay. An empty table gives no row. Other
    columns of ``docs`` are not read, so their names cannot clash.

    Texts are encoded twice, once to count and once to look up, and are never stored or shuffled.
    The table of irregular pairs is broadcast if it has ``most_pairs`` at most; beyond, the pairs
    of each text are joined with it by a shuffle, with the same result.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    counted = stored(with_best(pair_counts(texts.select("text"), a_path, b_path)), "pair-counts")
    aligner = aligner_of(a_path, b_path)
    same, n_a, n_b = aligner.same, aligner.n_a, aligner.n_b
    identity = texts.sparkSession.createDataFrame(pa.table({"a": pa.array(np.arange(n_a), pa.int32()), "b": pa.array(same, pa.int32())}))
    of_vector = counted.join(F.broadcast(identity), ["a", "b"])  # one row per id of A at most
    vector = _numbers(of_vector.select(F.col("a").cast("long").alias("code"), "n", "best"))
    code = (n_a + F.col("a").cast("long") * n_b + F.col("b")).alias("code")
    others = counted.join(F.broadcast(identity), ["a", "b"], "left_anti").select(code, "n", "best")
    small = others.limit(most_pairs + 1).count() <= most_pairs
    irregular = _numbers(others) if small else None
    shared = texts.sparkSession.sparkContext.broadcast((vector, irregular))

    def look_up(batches):
        aligner = aligner_of(a_path, b_path)
        (codes_v, n_v, best_v), table = shared.value
        n_of, best_of = np.zeros(aligner.n_a, np.int64), np.zeros(aligner.n_a, bool)
        n_of[codes_v], best_of[codes_v] = n_v, best_v

        def scored(codes):
            plain, n, best = aligner.regular(codes), np.zeros(len(codes), np.int64), np.zeros(len(codes), np.int64)
            n[plain], best[plain] = n_of[codes[plain]], best_of[codes[plain]]
            if table is not None and len(table[0]):
                at = np.minimum(np.searchsorted(table[0], codes[~plain]), len(table[0]) - 1)
                met = table[0][at] == codes[~plain]
                n[~plain], best[~plain] = table[1][at] * met, table[2][at] & met
            return n, best

        for batch in batches:
            other = [i for i, name in enumerate(batch.schema.names) if name != "text"]
            for low, high, raw, text_ends in _texts(batch):
                table_of, pieces = np.zeros((high - low, len(_COUNTS)), np.int64), [[] for _ in range(low, high)]
                for found, ids, ends in aligner.texts(raw, text_ends):
                    n, best = scored(found.codes)
                    of_stretch = np.column_stack([found.counts, found.sums(best), found.sums(n)])
                    sums = np.concatenate([np.zeros((1, len(_COUNTS)), np.int64), np.cumsum(of_stretch[ids], axis=0)])
                    starts = np.concatenate([[0], ends[:-1]])
                    table_of += sums[ends] - sums[starts]
                    spelled = [found.spelled[i] for i in ids.tolist()]
                    for piece, first, last in zip(pieces, starts.tolist(), ends.tolist()):
                        if last > first:
                            piece.append(";".join(spelled[first:last]))
                columns = [batch.column(i).slice(low, high - low) for i in other]
                columns.append(pa.array([";".join(x) for x in pieces], pa.string()))
                columns += [pa.array(table_of[:, i]) for i in range(len(_COUNTS))]
                yield pa.RecordBatch.from_arrays(columns, names=[*(batch.schema.names[i] for i in other), "groups", *_COUNTS])

    kept = texts if small else texts.withColumn("text_key", text_key(F.col("text")))
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept.schema.fields if f.name != "text")
    found = kept.mapInArrow(look_up, f"{fields}, groups string, " + ", ".join(f"{c} long" for c in _COUNTS))
    return found if small else _joined(found, kept, others, a_path, b_path)


def _numbers(counted: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted codes, counts and marks of a table whose size is known to be small."""
    table = counted.orderBy("code").toArrow()
    return tuple(table[name].to_numpy() for name in ("code", "n", "best"))


def _joined(found: DataFrame, texts: DataFrame, others: DataFrame, a_path: str | None, b_path: str | None) -> DataFrame:
    """``found`` with the counts of irregular pairs added, by joins.

    Pairs are those of a text, not of a row: equal texts are summed up before the shuffle, and a
    row of code -1 per text counts how many rows shared the sum.
    """

    def pairs_of(batches):
        aligner = aligner_of(a_path, b_path)
        for batch in batches:
            keys = batch.column("text_key")
            for low, high, raw, text_ends in _texts(batch):
                sums = [Counter({-1: 1}) for _ in range(low, high)]
                for found, ids, ends in aligner.texts(raw, text_ends, spell=False):
                    first = np.cumsum(found.counts[:, 3]) - found.counts[:, 3]
                    for of_text, own in zip(sums, np.split(ids, ends[:-1])):
                        links = found.counts[own, 3]
                        at = np.repeat(first[own] - (np.cumsum(links) - links), links) + np.arange(links.sum())
                        codes = found.codes[at]
                        codes = codes[~aligner.regular(codes)]
                        for code, n in zip(*_summed(codes, np.ones(len(codes), np.int64))):
                            of_text[code] += n
                row = pa.array(np.repeat(np.arange(low, high), [len(x) for x in sums]))
                codes, times = (pa.array(chain.from_iterable(x), pa.int64()) for x in (sums, [x.values() for x in sums]))
                yield pa.RecordBatch.from_arrays([keys.take(row), codes, times], names=["text_key", "code", "times"])

    rows = texts.select("text_key", "text").mapInArrow(pairs_of, "text_key struct<a: bigint, b: bigint>, code long, times long")
    summed = rows.groupBy("text_key", "code").agg(F.sum("times").alias("times"))
    met = summed.join(others, "code", "left")
    copies = F.sum(F.when(F.col("code") == -1, F.col("times")))

    def share(value: Column) -> Column:
        return F.call_function("div", F.coalesce(F.sum(value), F.lit(0)), copies)

    of_text = met.groupBy("text_key").agg(
        share(F.col("times") * F.col("n")).alias("more_sum"),
        share(F.when(F.col("best"), F.col("times"))).alias("more_best"),
    )
    both = found.join(of_text, "text_key")
    return both.select(
        "doc_id", "groups", "n_a", "n_b", "n_groups", "n_links",
        (F.col("n_best") + F.col("more_best")).alias("n_best"),
        (F.col("count_sum") + F.col("more_sum")).alias("count_sum"),
    )
