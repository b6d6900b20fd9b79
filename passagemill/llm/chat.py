"""Conversations as training texts: windows of whole turns within a budget of tokens.

A window is the system turn, a little history and the turns that are new in it. History was new
in an earlier window, so only new turns of the assistant are under the loss mask and each is
trained on once.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..operators.work import with_global_position
from ..sources.scratch import stored
from .encoders import CUT, Remembered, byte_encoder

#: Turns of a conversation that are brought together; a longer one is cut into parts.
PART = 1024
_OPEN, _MIDDLE, _CLOSE = "### ", ": ", "</turn>\n"
#: Characters that would complete a control string, and a backslash itself, get a backslash.
_IN_TEXT, _IN_ROLE = re.compile(r"\\|(?<=#)#|(?<=<)/"), re.compile(r"\\|(?<=#)#|(?<=<)/|(?<=:) ")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_WINDOW = "part long, n_parts long, window long, text string, n_turns int, n_repeated int, n_tokens long, spans array<struct<start: int, end: int>>"


def escape(text: str, role: bool = False) -> str:
    """A text without control strings; :func:`unescape` gives it back."""
    return (_IN_ROLE if role else _IN_TEXT).sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def render(role: str, text: str) -> tuple[str, int, int]:
    """A turn as it stands in a window, and where its text starts and ends."""
    head, body = _OPEN + escape(role, role=True) + _MIDDLE, escape(text)
    return head + body + _CLOSE, len(head), len(head) + len(body)


def read_turns(window: str) -> list[tuple[str, str]]:
    """``(role, text)`` of every turn of a window."""
    turns = []
    for turn in window.split(_CLOSE)[:-1]:
        role, _, text = turn[len(_OPEN) :].partition(_MIDDLE)
        turns.append((unescape(role), unescape(text)))
    return turns


def spans_of_turns(tokens: list[int], first: int, start: int, budget: int, history: int, history_tokens: int) -> Iterator[tuple[int, int, int]]:
    """``(h, s, e)`` per window: turns ``h`` to ``s`` are history, ``s`` to ``e`` are new.

    ``tokens`` are those of all turns, new ones begin at ``start`` and history may begin at ``first``.
    History gives way to the first new turn; a turn that alone is over the budget is a window.
    """
    sums = np.concatenate([[0], np.cumsum(tokens, dtype=np.int64)])
    s = start
    while s < len(tokens):
        room = max(0, min(history_tokens, budget - tokens[s]))
        h = max(first, s - history, int(np.searchsorted(sums, sums[s] - room, "left")))
        h = min(h, s)
        e = max(s + 1, int(np.searchsorted(sums, sums[h] + budget, "right")) - 1)
        yield h, s, e
        s = e


class _Formatter:
    """Windows of a conversation's part, from its rows in order."""

    def __init__(self, budget: int, history: int, history_tokens: int, target: str, system: str, path: str | None):
        encoder = byte_encoder(path)
        self.budget, self.history, self.history_tokens = budget, history, history_tokens
        self.target, self.system = target, system
        self.count = Remembered(lambda some: map(len, encoder.encode(some)))

    def tokens(self, turns: list[str]) -> list[int]:
        out = []
        for turn in turns:
            cut = CUT.split(turn)
            known = self.count(cut)
            out.append(sum(known[s] for s in cut))
        return out

    def windows(self, part: int, rows: list[tuple[int, str, str]]) -> Iterator[tuple]:
        """From ``(kind, role, text)``: 0 the system turn of an earlier part, 1 history of it, 2 own turns."""
        made = [render(role, text) for _, role, text in rows]
        tokens = self.tokens([m[0] for m in made])
        own = sum(kind < 2 for kind, _, _ in rows)
        leads = int(rows[0][0] == 0 or (part == 0 and rows[0][1] == self.system))
        start = max(own, leads)
        budget = self.budget - sum(tokens[:leads])
        spans = list(spans_of_turns(tokens, leads, start, budget, self.history, self.history_tokens))
        for number, (h, s, e) in enumerate(spans or [(start, start, start)]):
            text, at, masks = [], 0, []
            for i in [*range(leads), *range(h, e)]:
                turn, first, last = made[i]
                if i >= s and rows[i][1] == self.target:
                    masks.append({"start": at + first, "end": at + last})
                text.append(turn)
                at += len(turn)
            repeated = s - h + (leads if number or own else 0)
            yield number, "".join(text), leads + e - h, repeated, sum(tokens[:leads]) + sum(tokens[h:e]), masks


def chat_windows(
    turns: DataFrame,
    budget: int = 1024,
    history: int = 4,
    history_tokens: int | None = None,
    target: str = "assistant",
    system: str = "system",
    path: str | None = None,
) -> DataFrame:
    """Windows ``conv_id, part, n_parts, window, text, n_turns, n_repeated, n_tokens, spans`` of conversations.

    ``turns`` has ``conv_id, turn, role, text``. Each turn is ``### role: text</turn>`` and a line
    end, its role and text escaped so that no control string occurs in them (:func:`read_turns`
    reads a window back). A window holds the system turn if the conversation begins with one, up
    to ``history`` turns of at most ``history_tokens`` (a quarter of the budget) that earlier
    windows have, and as many new turns as fit the ``budget`` of tokens. ``n_repeated`` leading
    turns of it are in earlier windows; ``spans`` are the code points under the loss mask, the
    texts of new ``target`` turns. A turn that does not fit with the system turn is a window of its own, whole.

    Turns are in the order of ``turn``, then role and text; null turns come first, and repeated
    rows are turns of their own. A null role or text is empty, a null ``conv_id`` is a
    conversation. An empty table has no windows. Other columns are not read, so names cannot clash.

    Texts are shuffled once. A conversation of more than ``PART`` turns is cut into parts of that
    many by their exact position, found by a range sort of those conversations alone; a part gets
    the system turn and the history before it, so windows go on as before. Windows of a part come
    out of one task in order.
    """
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    sizes = rows.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > PART)
    long_ones = stored(sizes, "long-conversations")
    none = F.lit(0).cast("long")
    if long_ones.isEmpty():
        dealt = rows.select("*", none.alias("part"), F.lit(1).cast("long").alias("n_parts"), F.lit(2).alias("kind"), none.alias("place"))
    else:
        same = F.col("r.conv_id").eqNullSafe(F.col("l.conv_id"))
        short = rows.alias("r").join(long_ones.alias("l"), same, "left_anti")
        dealt = short.select("*", none.alias("part"), F.lit(1).cast("long").alias("n_parts"), F.lit(2).alias("kind"), none.alias("place"))
        dealt = dealt.unionByName(_parts(rows.alias("r").join(long_ones.alias("l"), same).select("r.*", "l.n"), history, system))
    order = ["conv_id", "part", "kind", "place", "turn", "role", "text"]
    sorted_rows = dealt.repartition("conv_id", "part").sortWithinPartitions(*order).select("conv_id", "part", "n_parts", "kind", "role", "text")
    kind = turns.schema["conv_id"].dataType
    names = [f.strip().split(" ")[0] for f in _WINDOW.split(", ")][:8]
    share = budget // 4 if history_tokens is None else history_tokens
    id_type = to_arrow_type(kind)

    def write(batches):
        formatter = _Formatter(budget, history, share, target, system, path)
        types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))]
        for some in _grouped(batches, ("conv_id", "part", "n_parts")):
            out = [[] for _ in range(9)]
            for (conv, part, parts), group in some:
                for number, *window in formatter.windows(part, group):
                    for column, value in zip(out, (conv, part, parts, number, *window)):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], id_type), *(pa.array(x, t) for x, t in zip(out[1:], types))], names=["conv_id", *names])

    return sorted_rows.mapInArrow(write, f"conv_id {kind.simpleString()}, {_WINDOW}")


def _parts(rows: DataFrame, history: int, system: str) -> DataFrame:
    """Rows of long conversations with the part they are in, and copies for parts that repeat them."""
    placed = with_global_position(rows, [F.col("conv_id").isNotNull(), "conv_id", "turn", "role", "text"], "at")
    first = placed.groupBy("conv_id").agg(F.min("at").alias("low"))
    at = placed.alias("p").join(first.alias("f"), F.col("p.conv_id").eqNullSafe(F.col("f.conv_id")))
    at = at.select("p.conv_id", "turn", "role", "text", (F.col("at") - F.col("low")).alias("place"), F.floor((F.col("n") + PART - 1) / PART).alias("n_parts"))
    part = F.floor(F.col("place") / PART)

    def copy(to, kind):
        return F.struct(to.cast("long").alias("part"), F.lit(kind).alias("kind"))

    leads = (F.col("place") == 0) & (F.col("role") == system) & (F.col("n_parts") > 1)
    tail = (F.col("place") % PART >= PART - history) & (part + 1 < F.col("n_parts")) & ~((F.col("place") == 0) & (F.col("role") == system))
    heads = F.when(leads, F.transform(F.sequence(F.lit(1).cast("long"), F.col("n_parts") - 1), lambda p: copy(p, 0)))
    copies = F.concat(
        F.array(copy(part, 2)),
        F.when(tail, F.array(copy(part + 1, 1))).otherwise(F.array().cast("array<struct<part: bigint, kind: int>>")),
        F.coalesce(heads, F.array().cast("array<struct<part: bigint, kind: int>>")),
    )
    spread = at.select("conv_id", "turn", "role", "text", "place", "n_parts", F.explode(copies).alias("c"))
    return spread.select("conv_id", "turn", "role", "text", "c.part", "n_parts", "c.kind", "place")


def _grouped(batches: Iterable[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[list[tuple[tuple, list[tuple]]]]:
    """Runs of rows of equal keys, whole, as lists per batch; rows are tuples of the other columns."""
    held: list[tuple[tuple, list[tuple]]] = []
    for batch in batches:
        columns = {name: batch.column(name).to_pylist() for name in batch.schema.names}
        rest = list(zip(*(v for name, v in columns.items() if name not in keys)))
        for key, run in groupby(zip(zip(*(columns[k] for k in keys)), rest), key=lambda x: x[0]):
            rows = [row for _, row in run]
            if held and held[-1][0] == key:
                held[-1][1].extend(rows)
            else:
                held.append((key, rows))
        if len(held) > 1:
            yield held[:-1]
            held = held[-1:]
    yield held


def read_back(windows: DataFrame) -> DataFrame:
    """``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``, read from windows.

    ``windows`` come straight from :func:`chat_windows`. The digests run over role, line end, text
    and line end of every turn, and over the unescaped texts under the mask. A conversation of
    one part is read where it is; those of several parts are put in order by a shuffle and their
    texts pass through the digests one window at a time.
    """
    kind, id_type = windows.schema["conv_id"].dataType.simpleString(), to_arrow_type(windows.schema["conv_id"].dataType)
    fields = [("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]
    places = [("part", pa.int64()), ("window", pa.int64())]
    texts = [("turns", pa.string()), ("loss", pa.string())]

    def table(rows, columns):
        arrays = [pa.array([r[i] for r in rows], t) for i, (_, t) in enumerate(columns)]
        return pa.RecordBatch.from_arrays(arrays, names=[n for n, _ in columns])

    first_columns = [("conv_id", id_type), *places, *fields, *texts]

    def sums(rows):
        """Digests of windows ``(window, text, n_repeated, spans)`` as a row."""
        return [sum(r[0] for r in rows), _digest(r[1] for r in rows), sum(len(r[2]) for r in rows), _digest(r[2] for r in rows), sum(r[3] for r in rows)]

    def read(text, repeated, spans):
        turns = read_turns(text)[repeated:]
        loss = "".join(unescape(text[s["start"] : s["end"]]) for s in spans)
        return len(turns), "".join(f"{role}\n{body}\n" for role, body in turns), loss, len(text)

    def per_part(batches):
        for some in _grouped(batches, ("conv_id", "part", "n_parts")):
            out = []
            for (conv, part, parts), group in some:
                found = [read(text, repeated, spans) for _, text, repeated, spans in group]
                if parts == 1:
                    out.append([conv, part, 0, *sums(found), None, None])
                else:
                    out += [[conv, part, w[0], n, None, None, None, chars, turns, loss] for w, (n, turns, loss, chars) in zip(group, found)]
            yield table(out, first_columns)

    def whole(batches):
        current, state = None, None

        def done():
            n, turns, chars, loss, size, made = state
            return [current[0], n, made[0] if made else turns.hexdigest(), chars, made[1] if made else loss.hexdigest(), size]

        for batch in batches:
            out = []
            for r in batch.to_pylist():
                if current is None or current[0] != r["conv_id"]:
                    if current is not None:
                        out.append(done())
                    current, state = (r["conv_id"],), [0, hashlib.sha256(), 0, hashlib.sha256(), 0, None]
                state[0] += r["n_turns"]
                state[4] += r["formatted_chars"]
                if r["turns_sha256"] is not None:
                    state[2], state[5] = r["loss_chars"], (r["turns_sha256"], r["loss_sha256"])
                else:
                    state[1].update(r["turns"].encode())
                    state[3].update(r["loss"].encode())
                    state[2] += len(r["loss"])
            yield table(out, [("conv_id", id_type), *fields])
        if current is not None:
            yield table([done()], [("conv_id", id_type), *fields])

    def ddl(columns):
        return f"conv_id {kind}, " + ", ".join(f"{n} {'string' if t == pa.string() else 'long'}" for n, t in columns[1:])

    some = windows.select("conv_id", "part", "n_parts", "window", "text", "n_repeated", "spans").mapInArrow(per_part, ddl(first_columns))
    ordered = some.repartition("conv_id").sortWithinPartitions("conv_id", "part", "window")
    return ordered.mapInArrow(whole, ddl([("conv_id", None), *fields]))


def _digest(texts: Iterable[str]) -> str:
    out = hashlib.sha256()
    for text in texts:
        out.update(text.encode())
    return out.hexdigest()
