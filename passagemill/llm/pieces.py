"""N-best segmentation into the pieces of a given vocabulary, and its inverse.

A text is a lattice of pieces. The vocabulary decides where no piece can cross: in front of a
space, around a line end. Between such cuts the lattice is small; its second-best score tells
which stretches can take part in the best few segmentations of the whole text, and only for those
is the list of best segmentations needed: a backward A-star search whose heuristic, the forward
Viterbi score of the rest, is exact, so that segmentations come out in order.
"""

from __future__ import annotations

import heapq
import math
import re
import uuid
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tokens import HELD, mix
from .windows import _ranges

#: The space of pieces; scores are kept as whole millionths, so sums and comparisons are exact.
_SPACE, _UNIT = "▁", 1_000_000
#: Segments that a worker remembers, and characters of text handled at once.
REMEMBERED, SLICE = 400_000, 1 << 20
_SEGMENT = re.compile(r"\n| ?[^ \n]+| ")


@dataclass(frozen=True)
class Vocabulary:
    """Pieces with a space as space, their ids and scores, the ids of single bytes and their score."""

    scores: dict[str, tuple[int, int]]
    bytes: list[int]
    byte_score: int
    longest: int

    def text_of(self) -> dict[int, bytes]:
        out = {i: p.encode() for p, (i, _) in self.scores.items()}
        return out | {i: bytes([b]) for b, i in enumerate(self.bytes)}


def load_vocabulary(path: str | None = None, ranked: bool = True) -> Vocabulary:
    """Vocabulary of a model file with byte pieces; by default a public one of 32,000 pieces.

    ``ranked``: the file has merge ranks, not log-probabilities, so the r-th piece gets the
    logarithm of its share under Zipf's law, 1 / (r + 2.7). Pieces of several characters that the
    file marks as never produced, and those with a space after the first, are left out.
    """
    import sentencepiece

    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, single, rank = {}, {}, -1
    for i in range(model.get_piece_size()):
        piece, score = model.id_to_piece(i), model.get_score(i)
        if model.is_byte(i):
            single[int(piece[1:-1], 16)] = i
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            rank += 1
            if not (_SPACE in piece[1:] or "\n" in piece or (score < -1e8 and len(piece) > 1)):
                pieces[piece.replace(_SPACE, " ")] = (i, float(rank) if ranked else score)
    if sorted(single) != list(range(256)):
        raise ValueError("the vocabulary must have a piece for every byte")
    if ranked:
        total = math.log(sum(1 / (2.7 + r) for _, r in pieces.values()))
        pieces = {p: (i, -math.log(2.7 + r) - total) for p, (i, r) in pieces.items()}
    fixed = {p: (i, round(s * _UNIT)) for p, (i, s) in pieces.items()}
    least = min(s for _, s in fixed.values())
    return Vocabulary(fixed, [single[b] for b in range(256)], least - _UNIT, max(map(len, fixed)))


class Lattice:
    """All pieces of one segment. A character that is no piece itself is one edge of its bytes."""

    def __init__(self, text: str, vocabulary: Vocabulary):
        n, get = len(text), vocabulary.scores.get
        self.n = n
        self.into: list[list] = [[] for _ in range(n + 1)]
        self.best = [None] * (n + 1)
        self.best[0] = 0
        self.back = [None] * (n + 1)
        for i in range(n):
            base = self.best[i]
            for j in range(i + 1, min(n, i + vocabulary.longest) + 1):
                piece = get(text[i:j])
                if piece is None:
                    if j > i + 1:
                        continue
                    codes = text[i].encode()
                    piece = (tuple(vocabulary.bytes[b] for b in codes), vocabulary.byte_score * len(codes))
                edge = (i, piece[0], piece[1])
                self.into[j].append(edge)
                total = base + piece[1]
                if self.best[j] is None or total > self.best[j]:
                    self.best[j], self.back[j] = total, edge

    def path(self) -> list[int]:
        """Ids of the best segmentation."""
        out, at = [], self.n
        while at:
            i, ids, _ = self.back[at]
            out.append(ids)
            at = i
        return [x for ids in reversed(out) for x in (ids if isinstance(ids, tuple) else (ids,))]

    def second(self) -> int | None:
        """Score of the second-best segmentation: the best that has an edge off the best path."""
        after = [None] * (self.n + 1)
        after[self.n] = 0
        for j in range(self.n, 0, -1):
            tail = after[j]
            if tail is not None:
                for i, _, score in self.into[j]:
                    if after[i] is None or tail + score > after[i]:
                        after[i] = tail + score
        on, at = set(), self.n
        while at:
            on.add((self.back[at][0], at))
            at = self.back[at][0]
        found = [self.best[i] + s + after[j] for j in range(1, self.n + 1) if after[j] is not None for i, _, s in self.into[j] if (i, j) not in on]
        return max(found, default=None)

    def n_best(self, n: int) -> list[tuple[int, list[int]]]:
        """The ``n`` best segmentations, best first: backward A-star with the Viterbi scores as heuristic.

        A place is gone on from ``n`` times at most, as the ``n`` best ways through it have the ``n``
        best rests. The ways into a place are tried best first, one when the one before it was
        taken, so the heap holds two entries a step; of equal scores the one further back is first.
        """
        if not self.n:
            return [(0, [])]
        ranked, visits, made, out = {}, [0] * (self.n + 1), 0, []

        def push(at: int, rank: int, tail: int, steps) -> None:
            nonlocal made
            if at not in ranked:
                ranked[at] = sorted(self.into[at], key=lambda e: -(self.best[e[0]] + e[2]))
            if rank < len(ranked[at]):
                i, _, score = ranked[at][rank]
                made += 1
                heapq.heappush(heap, (-(self.best[i] + score + tail), i, made, at, rank, tail, steps))

        heap: list[tuple] = []
        push(self.n, 0, 0, None)
        while heap and len(out) < n:
            negative, i, _, at, rank, tail, steps = heapq.heappop(heap)
            push(at, rank + 1, tail, steps)
            if visits[i] == n:
                continue
            visits[i] += 1
            _, ids, score = ranked[at][rank]
            if i:
                push(i, 0, tail + score, (ids, steps))
                continue
            steps, found = (ids, steps), []
            while steps:
                found.extend(steps[0] if isinstance(steps[0], tuple) else (steps[0],))
                steps = steps[1]
            out.append((-negative, found))
        return out


_BASE = 0x9E3779B97F4A7C15 | 1
_NONE = -(1 << 60)


class BatchLattice:
    """Viterbi over many segments at once, for those that have no character outside the pieces.

    Substrings meet pieces by 64-bit hashes. ``score[k, i]`` holds, for all segments, the score of
    the piece of ``k + 1`` characters at place ``i``.
    """

    WIDTHS, ROWS = (6, 9, 12, 16, 24), 4096

    def __init__(self, vocabulary: Vocabulary):
        self.longest = vocabulary.longest
        pieces = list(vocabulary.scores)
        self.ids = np.array([vocabulary.scores[p][0] for p in pieces] + [-1], np.int64)
        self.scores = np.array([vocabulary.scores[p][1] for p in pieces] + [_NONE], np.int64)
        size = max(max(self.WIDTHS), self.longest) + 1
        self.up, self.down = (np.array([pow(x, k, 2**64) for k in range(size)], np.uint64) for x in (_BASE, pow(_BASE, -1, 2**64)))
        codes, lengths = self._codes(pieces, self.longest)
        sums = self._sums(codes)
        self.hashes = np.append(self._hash(sums[np.arange(len(pieces)), lengths], lengths.astype(np.uint64)), np.uint64(0))
        self.slots = np.full((2, 1 << 20), len(pieces), np.int64)
        number = np.arange(len(pieces))
        self.slots[0][self._slot(self.hashes[:-1], 0)] = number
        rest = number[self.slots[0][self._slot(self.hashes[:-1], 0)] != number]
        self.slots[1][self._slot(self.hashes[rest], 1)] = rest
        if len(np.unique(self._slot(self.hashes[rest], 1))) != len(rest):
            raise ValueError("two pieces share both slots")

    def _slot(self, h, which):
        return ((h >> np.uint64(44 * which)) & np.uint64((1 << 20) - 1)).astype(np.int64)

    @staticmethod
    def _codes(texts: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        joined = "".join(x.ljust(width, "\0") for x in texts)
        return np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).reshape(-1, width), lengths

    def _sums(self, codes: np.ndarray) -> np.ndarray:
        out = np.zeros((len(codes), codes.shape[1] + 1), np.uint64)
        np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * self.up[: codes.shape[1]], axis=1, out=out[:, 1:])
        return out

    @staticmethod
    def _hash(value: np.ndarray, length) -> np.ndarray:
        return mix(value + np.uint64(0x51ED270B) * length)

    def _find(self, h: np.ndarray) -> np.ndarray:
        """Number of the piece with a hash; the last entry of the tables if there is none."""
        k = self.slots[0][self._slot(h, 0)]
        miss = self.hashes[k] != h
        again = self.slots[1][self._slot(h[miss], 1)]
        k[miss] = np.where(self.hashes[again] == h[miss], again, len(self.ids) - 1)
        return k

    def solve(self, texts: list[str], width: int):
        """Per segment: whether it is covered, best score, second-best score (``_NONE``: none), and the path as ids by row."""
        codes, lengths = self._codes(texts, width)
        n, none = len(texts), len(self.ids) - 1
        sums = np.ascontiguousarray(self._sums(codes).T)
        spans = min(self.longest, width)
        piece = np.full((spans, width, n), none, np.int64)
        for k in range(spans):
            places = width - k
            inside = np.arange(places)[:, None] + k + 1 <= lengths
            if not inside.any():
                break
            value = (sums[k + 1 :] - sums[:places])[inside] * np.repeat(self.down[:places], inside.sum(1))
            piece[k, :places][inside] = self._find(self._hash(value, np.uint64(k + 1)))
        score = self.scores[piece]
        covered = ((np.arange(width)[:, None] >= lengths) | (piece[0] != none)).all(0)
        rows = np.arange(n)
        ahead, behind = np.full((width + 1, n), _NONE, np.int64), np.full((width + 1, n), _NONE, np.int64)
        back = np.zeros((width + 1, n), np.int64)
        ahead[0] = 0
        behind[lengths, rows] = 0
        for j in range(1, width + 1):
            for k in range(min(spans, j)):
                total = ahead[j - k - 1] + score[k, j - k - 1]
                better = total > ahead[j]
                ahead[j][better], back[j][better] = total[better], k
        for i in range(width - 1, -1, -1):
            for k in range(min(spans, width - i)):
                np.maximum(behind[i], behind[i + k + 1] + score[k, i], out=behind[i])
        best = ahead[lengths, rows]
        at = lengths.copy()
        path = np.full((n, width), -1, np.int64)
        for step in range(width):
            k = back[at, rows]
            left = rows[at > 0]
            i, k = at[left] - k[left] - 1, k[left]
            path[left, step] = self.ids[piece[k, i, left]]
            score[k, i, left] = _NONE  # what stays are the edges off the best path
            at[left] = i
            if not at.any():
                break
        through = np.full(n, _NONE, np.int64)
        for i in range(width):
            for k in range(min(spans, width - i)):
                np.maximum(through, ahead[i] + score[k, i] + behind[i + k + 1], out=through)
        return covered, best, np.where(through < _NONE // 2, _NONE, through), path[:, ::-1]


class Encoder:
    """Segments seen so far: best ids, best score and how far the second-best is behind."""

    def __init__(self, vocabulary: Vocabulary, n: int):
        self.vocabulary, self.n = vocabulary, n
        self.batch = BatchLattice(vocabulary)
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.ids, self.first, self.score, self.behind = array("i"), array("q", [0]), array("q"), array("q")
        self.lists: dict[str, list] = {}

    def _put(self, segment: str, ids, score: int, behind: int) -> None:
        self.number[segment] = len(self.score)
        self.ids.extend(ids)
        self.first.append(len(self.ids))
        self.score.append(score)
        self.behind.append(behind)

    def _add(self, segment: str) -> None:
        lattice = Lattice(segment, self.vocabulary)
        second = lattice.second() if self.n > 1 else None
        self._put(segment, lattice.path(), lattice.best[-1], -1 if second is None else lattice.best[-1] - second)

    def _add_all(self, segments: list[str]) -> None:
        """New segments, by width; those that need bytes or are very long one by one."""
        groups: dict[int, list[str]] = {}
        for s in segments:
            groups.setdefault(next((w for w in BatchLattice.WIDTHS if len(s) <= w), 0), []).append(s)
        for width, group in groups.items():
            for low in range(0, len(group), BatchLattice.ROWS):
                part = group[low : low + BatchLattice.ROWS]
                if not width:
                    for s in part:
                        self._add(s)
                    continue
                covered, best, second, path = self.batch.solve(part, width)
                for row in np.flatnonzero(~covered).tolist():
                    self._add(part[row])
                rows = np.flatnonzero(covered)
                own = path[rows]
                counts = (own >= 0).sum(1)
                start = len(self.score)
                self.number.update(zip((part[r] for r in rows.tolist()), range(start, start + len(rows))))
                self.first.extend(array("q", (len(self.ids) + np.cumsum(counts)).astype(np.int64).tobytes()))
                self.ids.frombytes(own[own >= 0].astype(np.int32).tobytes())
                self.score.frombytes(best[rows].tobytes())
                self.behind.frombytes(np.where(second[rows] == _NONE, -1, best[rows] - second[rows]).tobytes())

    def _best(self, segment: str) -> list[tuple[int, list[int]]]:
        found = self.lists.get(segment)
        if found is None:
            if len(self.lists) > REMEMBERED // 20:
                self.lists.clear()
            found = self.lists[segment] = Lattice(segment, self.vocabulary).n_best(self.n)
        return found

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, list[int], list[list[tuple[int, list[int]]]]]]:
        """Per text: ids of the best segmentation, the ``n`` best scores, and what the others replace.

        The last entry has, per segmentation, (segment number, its ids) where it differs from the best.
        """
        return [(ids, scores, [[(at, own) for at, _, _, own in picks] for picks in ways]) for ids, scores, ways in self.encode_at(texts)]

    def encode_at(self, texts: list[str]) -> list[tuple[np.ndarray, list[int], list[list[tuple[int, int, int, list[int]]]]]]:
        """As :meth:`encode`; what replaces is (segment number, its first place in the best ids, its number of ids there, new ids)."""
        if len(self.number) > REMEMBERED:
            self.forget()
        cut = [_SEGMENT.findall(" " + text) if text else [] for text in texts]
        self._add_all(list({s for segments in cut for s in segments if s not in self.number}))
        first, flat = np.frombuffer(self.first, np.int64), np.frombuffer(self.ids, np.int32)
        score, behind_all = np.frombuffer(self.score, np.int64), np.frombuffer(self.behind, np.int64)
        get, out = self.number.__getitem__, []
        for segments in cut:
            numbers = np.fromiter(map(get, segments), np.int64, len(segments))
            low = first[numbers]
            sizes = first[numbers + 1] - low
            ids = flat[_ranges(low, sizes)]
            best, behind = int(score[numbers].sum()), behind_all[numbers]
            ways = [(0, ())]
            if self.n > 1:
                # A segmentation that is among the best n changes only segments whose second-best is among the n - 1 nearest.
                open_ = np.flatnonzero(behind >= 0)
                if len(open_) >= self.n:
                    open_ = open_[np.argpartition(behind[open_], self.n - 2)[: self.n - 1]]
                for at in sorted(open_.tolist()):
                    options = self._best(segments[at])
                    top = options[0][0]
                    grown = [(cost + top - s, picks + ((at, o),) if k else picks) for cost, picks in ways for k, (s, o) in enumerate(options)]
                    ways = sorted(grown, key=lambda x: x[0])[: self.n]
            ends = np.cumsum(sizes) if len(ways) > 1 else sizes
            out.append((ids, [best - cost for cost, _ in ways], [[(at, int(ends[at] - sizes[at]), int(sizes[at]), own) for at, own in picks] for _, picks in ways]))
        return out

    def whole(self, text: str, picks: list[tuple[int, list[int]]]) -> list[int]:
        """Ids of the segmentation that replaces ``picks``."""
        swap, out = dict(picks), []
        for at, segment in enumerate(_SEGMENT.findall(" " + text) if text else []):
            out.extend(swap.get(at) or Lattice(segment, self.vocabulary).path())
        return out


def decoder(vocabulary: Vocabulary):
    """Function from ids to the bytes that they encode, without the space in front.

    An id that is null or outside the vocabulary stands for U+FFFD.
    """
    table = vocabulary.text_of()
    size = max(table) + 1
    parts = [table.get(i, b"") for i in range(size)] + ["\ufffd".encode()]
    data = b"".join(parts)
    first = np.concatenate([[0], np.cumsum([len(x) for x in parts])])
    raw = np.frombuffer(data, np.uint8)

    def decode(ids: np.ndarray) -> bytes:
        ids = np.asarray(ids, np.int64)
        ids = np.where((ids < 0) | (ids >= size), size, ids)
        found = raw[_ranges(first[ids], first[ids + 1] - first[ids])].tobytes() if len(ids) else b""
        return found.removeprefix(b" ")

    return decode


def _of_worker(token: str, shared, n: int) -> tuple:
    """Encoder and decoder of this worker process: what it has segmented helps its later tasks."""
    if (token, n) not in HELD:
        HELD.clear()
        HELD[token, n] = (Encoder(shared.value, n), decoder(shared.value))
    return HELD[token, n]


def encode_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 4, vocabulary: Vocabulary | None = None) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, ids, scores, round_trip, changes``.

    ``ids`` is the best segmentation of the whole text after a space in front, as such
    vocabularies expect; ``scores`` are those of the ``n`` best segmentations, best first, in
    millionths (fewer if there are fewer). ``changes`` has an entry for each of them: by place, what
    to put instead of the ``n`` ids from place ``at`` (from 0) of ``ids``; that of the best is empty.
    :func:`segmentations` puts them in. ``round_trip``: decoding ``ids`` gives the text back.
    No text is normalised, so it always does; a character that is no piece is spelled in bytes,
    and so is the character that pieces use for a space. An empty text has no ids and one
    segmentation of score 0; a null text has null ids, scores and changes. Segmentations of equal score
    come in a fixed order. Other columns are not read.
    """
    if n < 1:
        raise ValueError("n must be 1 or more")
    shared, token = docs.sparkSession.sparkContext.broadcast(vocabulary or load_vocabulary()), uuid.uuid4().hex
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    change = pa.struct([("at", pa.int32()), ("n", pa.int32()), ("ids", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decode = _of_worker(token, shared, n)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            first = 0
            while first < len(texts):
                last, size = first, 0
                while last < len(texts) and (last == first or size < SLICE):
                    size += len(texts[last] or "")
                    last += 1
                part = texts[first:last]
                found = encoder.encode_at([x or "" for x in part])
                ids = pa.array([None if t is None else f[0] for t, f in zip(part, found)], pa.list_(pa.int32()))
                scores = pa.array([None if t is None else f[1] for t, f in zip(part, found)], pa.list_(pa.int64()))
                same = pa.array([None if t is None else decode(f[0]) == t.encode() for t, f in zip(part, found)], pa.bool_())
                changes = pa.array([None if t is None else [[{"at": at, "n": size, "ids": own} for _, at, size, own in picks] for picks in f[2]] for t, f in zip(part, found)], pa.list_(pa.list_(change)))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(first, last - first), ids, scores, same, changes], names=["doc_id", "ids", "scores", "round_trip", "changes"])
                first = last

    return rows.mapInArrow(run, "doc_id long, ids array<int>, scores array<long>, round_trip boolean, changes array<array<struct<at:int,n:int,ids:array<int>>>>")


def segmentations(ids: Column, changes: Column) -> Column:
    """Ids of every segmentation, best first, from two columns of :func:`encode_pieces`."""
    put = lambda a, x: F.concat(F.slice(a, F.lit(1), x["at"]), x["ids"], F.slice(a, x["at"] + x["n"] + 1, F.size(a)))
    return F.transform(changes, lambda c: F.aggregate(F.reverse(c), ids, put))


def decode_pieces(encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", vocabulary: Vocabulary | None = None) -> DataFrame:
    """``doc_id, text`` of rows with ids; a null list gives a null text.

    Ids that are null or outside the vocabulary, and bytes that are cut off, come out as U+FFFD.
    Repeated rows are decoded each; an empty table gives none. Other columns are not read.
    """
    shared = encoded.sparkSession.sparkContext.broadcast(vocabulary or load_vocabulary())
    rows = encoded.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = decoder(shared.value)
        for batch in batches:
            texts = [None if x is None else decode(np.array([-1 if i is None else i for i in x], np.int64)).decode("utf-8", "replace") for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return rows.mapInArrow(run, "doc_id long, text string")
