"""Windows of 50 words or bytes that also start in an earlier document, without moving every window.

All windows of a text are far too many to shuffle. As in super-k-mer counting, every window is
dealt by its *anchor*, the gram of least hash inside it: equal windows have equal anchors, and
neighbouring windows share one, so a run of up to ``window - gram + 1`` windows travels as one.

1. Texts are dealt to chunks of bounded size by a hash of document and text. A chunk sends, for
   each block of sketch cells, the cells of its anchors (about two bytes each). A block adds up
   the cells of all chunks and answers each chunk with one bit per cell: seen more than once.
2. A chunk sends the runs whose anchor was seen more than once to the part that their anchor
   names. Equal runs of one chunk are sent once, for the least document; windows of anchors that
   very many documents share are dealt one by one, by their own content. So no passage, however
   common, brings more than one message per chunk to one task.
3. A part groups equal windows exactly and answers each run with one bit per window: it starts
   in a document with a smaller id too.
4. The chunk marks what those windows cover.

Exact copies of a text with a smaller id need none of this: all they hold is covered.
Both operators built on this keep the texts in one exchange, which the plan reuses.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens as tk

#: Bytes of text in a chunk, on average.
CHUNK_BYTES = 8 << 20
#: Anchors per block of cells, cells per block and tokens per part, on average.
BLOCK_ANCHORS, BLOCK_CELLS, PART_TOKENS = 1 << 21, 1 << 26, 4 << 20
#: From so many texts on, the windows of an anchor are dealt one by one.
COMMON = 4096
_SEGMENT = 1 << 20
_PLACE = np.uint64((1 << 24) - 1)
MESSAGE = "chunk long, kind int, a long, b long, data binary"
_COPY, _ANSWER, _MASK = 0, 1, 2


@dataclass(frozen=True)
class Plan:
    """What tasks need to know: units, sizes, and how many chunks, blocks and parts there are."""

    words: bool
    window: int
    gram: int
    rows: int
    chunks: int
    blocks: int
    parts: int
    common: int

    @property
    def reach(self) -> int:
        return self.window - self.gram + 1


def make_plan(docs: DataFrame, text_col: str, words: bool, window: int, gram: int, rows: int) -> Plan:
    """Numbers of chunks, blocks and parts in proportion to the bytes of text."""
    size = docs.agg(F.sum(F.octet_length(text_col)).alias("n")).first()["n"] or 0
    units = size / 6 if words else size
    anchors = 2 * units / (window - gram + 2)
    share = lambda n, per: max(1, -int(-n // per))
    return Plan(words, window, gram, rows, share(size, CHUNK_BYTES), share(anchors, BLOCK_ANCHORS), share(units, PART_TOKENS), COMMON)


@dataclass
class Chunk:
    """Documents of a chunk in a fixed order, and which of them take part."""

    ids: np.ndarray
    known: np.ndarray
    copies: np.ndarray
    texts: pa.Array

    @property
    def live(self) -> np.ndarray:
        return self.known & ~self.copies


def open_chunk(left: pa.Table, right: pa.Table) -> Chunk:
    known = left["doc_id"].is_valid().to_numpy(zero_copy_only=False)
    ids = left["doc_id"].fill_null(0).to_numpy()
    text = left["t1"].to_numpy()
    order = np.lexsort((text, ids, ~known))
    ids, known, text = ids[order], known[order], text[order]
    rows = np.flatnonzero(right["kind"].to_numpy() == _COPY)
    copied = set(zip(right["a"].to_numpy()[rows].tolist(), right["b"].to_numpy()[rows].tolist()))
    copies = np.fromiter((k and (i, t) in copied for i, t, k in zip(ids.tolist(), text.tolist(), known.tolist())), bool, len(ids))
    column = left["text"].cast(pa.large_string()).take(pa.array(order))
    return Chunk(ids, known, copies, column)


def segments(chunk: Chunk, plan: Plan) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Slices of the chunk as tokens: (tokens, segment starts, segment ends, document rows, token number in the document).

    A very long document comes in several segments that overlap so that each window is in one.
    """
    raw, offsets = tk.text_bytes(chunk.texts)
    live = chunk.live
    for a, b in tk.document_slices(offsets, 1 << 20):
        if not live[a:b].any():
            continue
        part = raw[offsets[a] : offsets[b]]
        bounds = offsets[a : b + 1] - offsets[a]
        if plan.words:
            starts, ends, bounds = tk.word_bounds(part, bounds)
            values = tk.word_hashes(part, starts, ends)
        rows = np.arange(a, b)
        if not plan.words:
            for low in range(0, max(1, len(part) - plan.window + 1), _SEGMENT) if b == a + 1 else (0,):
                high = min(len(part), low + _SEGMENT + plan.window - 1) if b == a + 1 else len(part)
                s, e, base = (bounds[:-1], bounds[1:], np.zeros(b - a, np.int64)) if b > a + 1 else (np.array([0]), np.array([high - low]), np.array([low]))
                yield tk.BYTE_VALUES[part[low:high]], s[live[a:b]], e[live[a:b]], rows[live[a:b]], base[live[a:b]]
        elif b > a + 1:
            yield values, bounds[:-1][live[a:b]], bounds[1:][live[a:b]], rows[live[a:b]], np.zeros(int(live[a:b].sum()), np.int64)
        else:
            for low in range(0, max(1, len(values) - plan.window + 1), _SEGMENT):
                high = min(len(values), low + _SEGMENT + plan.window - 1)
                yield values[low:high], np.array([0]), np.array([high - low]), rows, np.array([low])


@dataclass
class Runs:
    """Runs of neighbouring windows with one anchor, in one slice."""

    key: np.ndarray
    row: np.ndarray
    start: np.ndarray
    place: np.ndarray
    count: np.ndarray


def anchor_runs(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, rows: np.ndarray, base: np.ndarray, plan: Plan) -> Runs:
    long = ends - starts >= plan.window
    starts, ends, rows, base = starts[long], ends[long], rows[long], base[long]
    n = len(values) - plan.window + 1
    if not len(starts) or n <= 0:
        none = np.zeros(0, np.int64)
        return Runs(np.zeros(0, np.uint64), none, none, none, none)
    grams = tk.gram_hashes(values, plan.gram)
    least = tk.sliding_min((grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64), plan.reach)
    anchor = (least & _PLACE).astype(np.int64)
    valid = np.zeros(len(values) + 1, np.int64)
    valid[starts] += 1
    valid[ends - plan.window + 1] -= 1
    inside = np.cumsum(valid)[:n] > 0
    first = inside.copy()
    first[1:] &= (anchor[1:] != anchor[:-1]) | ~inside[:-1]
    first[starts] = True  # neighbours of two documents never share an anchor that both contain
    at = np.flatnonzero(first)
    total = np.concatenate([[0], np.cumsum(inside)])
    count = total[np.append(at[1:], n)] - total[at]
    owner = np.searchsorted(starts, at, "right") - 1
    return Runs(grams[anchor[at]], rows[owner], at, at - starts[owner] + base[owner], count)


def _cells(key: np.ndarray, row: int, plan: Plan) -> np.ndarray:
    """Cell of each anchor in a row of the sketch, counted over all blocks."""
    return tk.mix(key + np.uint64((row + 1) * 0xA24BAED4963EE407 % 2**64)) % np.uint64(plan.blocks * BLOCK_CELLS)


def _pairs(runs: list[Runs]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (anchor, document row) of a chunk, sorted."""
    found = [(r.key, r.row) for r in runs]
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    key, row = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((row, key))
    key, row = key[order], row[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (row[1:] != row[:-1])
    return key[new], row[new]


def _planes(values: np.ndarray, counts: np.ndarray) -> bytes:
    """Gaps and counts by byte planes: the planes of zeros and ones vanish in Spark's shuffle compression."""
    gaps = values.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return gaps.tobytes() + np.minimum(counts, 255).astype(np.uint8).tobytes()


def _unplanes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(data, np.uint8).reshape(5, -1)
    return planes[:4].T.copy().view("<u4").ravel(), planes[4]


def _table(schema: pa.Schema, **columns) -> pa.Table:
    return pa.table({k: pa.array(v, schema.field(k).type) for k, v in columns.items()}, schema=schema)


_MESSAGE = pa.schema([("chunk", pa.int64()), ("kind", pa.int32()), ("a", pa.int64()), ("b", pa.int64()), ("data", pa.binary())])
_SENT = pa.schema([("block", pa.int64()), ("chunk", pa.int64()), ("data", pa.binary())])


def send_cells(plan: Plan) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """A chunk's partial sketch: per block its cells in order, each with the number of documents and anchors in it."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out: tuple[list, list, list] = ([], [], [])
        if left.num_rows:
            chunk = open_chunk(left, right)
            key, _ = _pairs([anchor_runs(*s, plan) for s in segments(chunk, plan)])
            for row in range(plan.rows):
                cells, counts = np.unique(_cells(key, row, plan), return_counts=True)
                block = (cells // np.uint64(BLOCK_CELLS)).astype(np.int64)
                ids, first = np.unique(block, return_index=True)
                for i, own, n in zip(ids.tolist(), np.split(cells, first[1:]), np.split(counts, first[1:])):
                    place = (own % np.uint64(BLOCK_CELLS)).astype(np.int64)
                    out[0].append(row * plan.blocks + i)
                    out[1].append(left["chunk"][0].as_py())
                    out[2].append(_planes(np.diff(place, prepend=0), n))
        return _table(_SENT, block=out[0], chunk=out[1], data=out[2])

    return run


def merge_cells(plan: Plan) -> Callable[[pa.Table], pa.Table]:
    """Merge the partial sketches of a block; tell each chunk which of its cells count 2 and which are common."""
    return lambda table: _merged(table, plan.common)


def _merged(table: pa.Table, common: int) -> pa.Table:
    sent = [_unplanes(x) for x in table["data"].to_pylist()]
    parts = [np.cumsum(gaps, dtype=np.int64) for gaps, _ in sent]
    cells, which = np.unique(np.concatenate(parts), return_inverse=True)
    counts = np.bincount(which, np.concatenate([n for _, n in sent]), len(cells))
    answers = []
    for part in parts:
        n = counts[np.searchsorted(cells, part)]
        answers.append(np.packbits(n >= 2).tobytes() + np.packbits(n >= common).tobytes())
    n = len(parts)
    return _table(_MESSAGE, chunk=table["chunk"].to_pylist(), kind=[_ANSWER] * n, a=table["block"].to_pylist(), b=[len(x) for x in parts], data=answers)


def _estimates(key: np.ndarray, right: pa.Table, plan: Plan) -> tuple[np.ndarray, np.ndarray]:
    """Of each anchor of the chunk: estimated to be repeated, and to be common. The least of all rows counts."""
    repeated, common = np.ones(len(key), bool), np.ones(len(key), bool)
    rows = np.flatnonzero(right["kind"].to_numpy() == _ANSWER)
    blocks, sizes, data = right["a"].to_numpy(), right["b"].to_numpy(), right["data"]
    for row in range(plan.rows):
        _, which = np.unique(_cells(key, row, plan), return_inverse=True)
        mine = sorted((int(blocks[i]), int(i)) for i in rows if blocks[i] // plan.blocks == row)
        found: tuple[list, list] = ([], [])
        for _, i in mine:
            bits, n = np.unpackbits(np.frombuffer(data[i].as_py(), np.uint8)).astype(bool), int(sizes[i])
            found[0].append(bits[:n])
            found[1].append(bits[len(bits) // 2 :][:n])
        if mine:
            repeated &= np.concatenate(found[0])[which]
            common &= np.concatenate(found[1])[which]
    return repeated, common


def pack(*arrays: np.ndarray) -> bytes:
    return b"".join(x.tobytes() for x in arrays)


_TO_PART = pa.schema([("part", pa.int64()), ("chunk", pa.int64()), ("n", pa.int64()), ("data", pa.binary())])


def send_runs(plan: Plan) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Runs whose anchor is estimated to be repeated, dealt to parts; what the chunk can decide alone goes along with n = -1."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out: tuple[list, list, list, list] = ([], [], [], [])
        if left.num_rows:
            number = left["chunk"][0].as_py()
            for part, n, data in _runs_of(open_chunk(left, right), right, plan, number):
                for column, value in zip(out, (part, number, n, data)):
                    column.append(value)
        return _table(_TO_PART, part=out[0], chunk=out[1], n=out[2], data=out[3])

    return run


def _runs_of(chunk: Chunk, right: pa.Table, plan: Plan, number: int):
    runs = [anchor_runs(*s, plan) for s in segments(chunk, plan)]
    key, row = _pairs(runs)
    repeated, common = _estimates(key, right, plan)
    if not repeated.any():
        return
    frequent = np.unique(key[common & repeated])
    wanted = np.unique(key[repeated])
    made = []
    for (values, *_), r in zip(segments(chunk, plan), runs):
        keep = _member(r.key, wanted)
        if not keep.any():
            continue
        r = Runs(*(x[keep] for x in (r.key, r.row, r.start, r.place, r.count)))
        split = _member(r.key, frequent)
        single = np.repeat(np.flatnonzero(split), r.count[split])
        step = np.arange(len(single)) - np.repeat(np.cumsum(r.count[split]) - r.count[split], r.count[split])
        whole = np.flatnonzero(~split)
        pick, step = np.concatenate([whole, single]), np.concatenate([np.zeros(len(whole), np.int64), step])
        count = np.where(split[pick], 1, r.count[pick])
        start, place = r.start[pick] + step, r.place[pick] + step
        one = tk.gram_hashes(values, plan.window)
        two = tk.gram_hashes(tk.mix(values + np.uint64(77)), plan.window)
        part = np.where(split[pick], tk.mix(one[start]), tk.mix(r.key[pick])) % np.uint64(plan.parts)
        made.append((part.astype(np.int64), r.row[pick], place, count, one[start], one[start + count - 1], two[start], two[start + count - 1], *_content(values, one, two, start, count, plan)))
    if not made:
        return
    *cols, lengths, blob = zip(*made)
    part, row, place, count, h1, h2, h3, h4 = (np.concatenate(x) for x in cols)
    lengths, blob = np.concatenate(lengths), np.concatenate(blob)
    first = np.concatenate([[0], np.cumsum(lengths)])
    order = np.lexsort((row, h4, h3, h2, h1, count))
    same = np.zeros(len(order), bool)
    for x in (count, h1, h2, h3, h4):
        y = x[order]
        same[1:] = y[1:] == y[:-1] if x is count else same[1:] & (y[1:] == y[:-1])
    leader = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))
    ids = chunk.ids[row]
    later = np.zeros(len(order), bool)
    later[order] = ids[order] > ids[order][leader]
    if later.any():
        full = ((np.int64(1) << count[later]) - 1).astype("<u4")
        yield number % plan.parts, -1, pack(row[later].astype("<u4"), place[later].astype("<u4"), full)
    rest = np.flatnonzero(~later)
    rest = rest[np.argsort(part[rest], kind="stable")]
    ids_of, at = np.unique(part[rest], return_index=True)
    for p, mine in zip(ids_of.tolist(), np.split(rest, at[1:]) if len(at) else ()):
        body = blob[_ranges(first[mine], lengths[mine])]
        yield p, len(mine), pack(ids[mine].astype("<i8"), row[mine].astype("<u4"), place[mine].astype("<u4"), count[mine].astype("<u4"), body)


def _member(values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    if not len(wanted):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(wanted, values), len(wanted) - 1)
    return wanted[at] == values


def _ranges(first: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All indexes of several ranges, one range after another."""
    total = np.cumsum(lengths)
    return np.arange(total[-1] if len(total) else 0) + np.repeat(first - (total - lengths), lengths)


def _content(values, one, two, start, count, plan: Plan):
    """What a run sends. Words: both hashes of each window. Bytes: its text, as byte codes."""
    if plan.words:
        at = _ranges(start, count)
        return count, np.stack([one[at], two[at]], 1)
    lengths = count + plan.window - 1
    return lengths, _CODES[(values[_ranges(start, lengths)] >> np.uint64(48)).astype(np.int64)]


_CODES = np.zeros(1 << 16, np.uint8)
_CODES[(tk.BYTE_VALUES >> np.uint64(48)).astype(np.int64)] = np.arange(256, dtype=np.uint8)
if len(np.unique(tk.BYTE_VALUES >> np.uint64(48))) != 256:
    raise AssertionError("byte values must differ in their upper 16 bits")


def compare_runs(plan: Plan, groups: Callable[[np.ndarray, np.ndarray, np.ndarray, Plan], np.ndarray]) -> Callable[[pa.Table], pa.Table]:
    """Group equal windows of a part by ``groups`` (a group number per window, -1 if alone) and answer each run."""

    def run(table: pa.Table) -> pa.Table:
        chunk, n, data = table["chunk"].to_pylist(), table["n"].to_pylist(), table["data"].to_pylist()
        out = ([], [])
        sent = [i for i in range(len(n)) if n[i] >= 0]
        for i in range(len(n)):
            if n[i] < 0:
                out[0].append(chunk[i])
                out[1].append(data[i])
        if sent:
            ids, count, body = [], [], []
            for i in sent:
                m = n[i]
                ids.append(np.frombuffer(data[i], "<i8", m))
                count.append(np.frombuffer(data[i], "<u4", m, 16 * m))
                body.append(np.frombuffer(data[i], np.uint8, -1, 20 * m))
            ids, count, body = (np.concatenate(x) for x in (ids, count, body))
            count = count.astype(np.int64)
            owner = np.repeat(np.arange(len(ids)), count)
            group = groups(count, owner, body, plan)
            mark = np.zeros(len(owner), bool)
            some = np.flatnonzero(group >= 0)
            if len(some):
                low = np.full(group.max() + 1, np.iinfo(np.int64).max)
                np.minimum.at(low, group[some], ids[owner[some]])
                mark[some] = ids[owner[some]] > low[group[some]]
            step = np.arange(len(owner)) - (np.cumsum(count) - count)[owner]
            mask = np.bincount(owner, mark * np.exp2(step), len(ids)).astype(np.uint32)
            first = 0
            for i in sent:
                m = n[i]
                own = mask[first : first + m]
                first += m
                hit = own > 0
                if hit.any():
                    row, place = np.frombuffer(data[i], "<u4", m, 8 * m), np.frombuffer(data[i], "<u4", m, 12 * m)
                    out[0].append(chunk[i])
                    out[1].append(pack(row[hit], place[hit], own[hit].astype("<u4")))
        k = len(out[0])
        return _table(_MESSAGE, chunk=out[0], kind=[_MASK] * k, a=[0] * k, b=[0] * k, data=out[1])

    return run


def covered(right: pa.Table, plan: Plan) -> dict[int, np.ndarray]:
    """Starts of removed windows, by document row of the chunk."""
    parts = [x for x, k in zip(right["data"].to_pylist(), right["kind"].to_pylist()) if k == _MASK]
    if not parts:
        return {}
    fields = [np.frombuffer(x, "<u4").reshape(3, -1) for x in parts]
    row, place, mask = (np.concatenate(x).astype(np.int64) for x in zip(*fields))
    bit = (mask[:, None] >> np.arange(plan.reach)) & 1
    at, step = np.nonzero(bit)
    row, start = row[at], place[at] + step
    order = np.argsort(row, kind="stable")
    row, start = row[order], start[order]
    rows, first = np.unique(row, return_index=True)
    return dict(zip(rows.tolist(), np.split(start, first[1:])))


def removed_mask(starts: np.ndarray | None, copy: bool, n: int, window: int) -> np.ndarray:
    """Which of a document's ``n`` tokens the windows cover."""
    if copy and n >= window:
        return np.ones(n, bool)
    if starts is None:
        return np.zeros(n, bool)
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + window, -1)
    return np.cumsum(edge)[:n] > 0


def drop_repeats(
    docs: DataFrame, id_col: str, text_col: str, plan: Plan,
    groups: Callable, finish: Callable[[Chunk, dict[int, np.ndarray], Plan], pa.Table], schema: str,
) -> DataFrame:
    """The four steps as one plan; ``finish`` makes the rows of a chunk from what is removed."""
    keyed = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    chunk_of = F.pmod(F.xxhash64("doc_id", "t1"), F.lit(plan.chunks)).alias("chunk")
    hashed = keyed.select("doc_id", F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(7), "text").alias("t2"), "text")
    by_chunk = hashed.select(chunk_of, "doc_id", "t1", "text").groupBy("chunk")

    same = ["t1", "t2"]
    firsts = hashed.filter("doc_id is not null and text is not null").groupBy(*same).agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    several = firsts.filter("first < last").select(*same, "first")
    copies = hashed.select("doc_id", *same).join(several, same).filter("doc_id > first")
    flags = copies.select(chunk_of, F.lit(_COPY).alias("kind"), F.col("doc_id").alias("a"), F.col("t1").alias("b"), F.lit(None).cast("binary").alias("data"))

    def rounds(function, messages: DataFrame, columns: str) -> DataFrame:
        return by_chunk.cogroup(messages.groupBy("chunk")).applyInArrow(function, columns)

    cells = rounds(send_cells(plan), flags, "block long, chunk long, data binary")
    answers = cells.groupBy("block").applyInArrow(merge_cells(plan), MESSAGE)
    runs = rounds(send_runs(plan), flags.unionByName(answers), "part long, chunk long, n long, data binary")
    masks = runs.groupBy("part").applyInArrow(compare_runs(plan, groups), MESSAGE)

    def last(left: pa.Table, right: pa.Table) -> pa.Table:
        opened = open_chunk(left, right)
        return finish(opened, covered(right, plan), plan)

    return rounds(last, flags.unionByName(masks), schema)
