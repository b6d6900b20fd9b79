"""Removal of repeated strings of 50 bytes by a depth-limited radix sort of suffixes.

Suffixes are ordered only through their first 50 bytes. The first pass deals them by their least
gram (see ``windows``) and drops those whose gram is in one text only. Every part then sorts its
suffixes by eight bytes at a time, most significant first; a suffix that is alone in its group
after a pass needs no further pass. Groups that are left after the last pass are exactly the
strings of 50 bytes that occur more than once. Two cases are settled before the sort, by hashes:
runs that repeat inside one chunk of texts (64 bits) and exact copies of a text (128 bits).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import tokens as tk
from . import windows as win


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 50, gram: int = 20) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_bytes, n_removed, n_spans, kept`` (binary).

    A byte of the UTF-8 text is removed if a string of ``window`` bytes that covers it also starts
    in a document with a smaller id; overlaps count, and strings are judged on the input.
    ``n_spans`` counts maximal removed runs; ``kept`` is the rest, which need not be valid UTF-8.
    A null text is empty. Rows whose id is null, and rows with one id among themselves, remove
    nothing from each other. Repeated rows get equal results. Columns other than the two named are
    not read. ``gram`` sets how strings are dealt (``window - gram`` at most 31), never the result.
    """
    if window < 8:
        raise ValueError("strings of at least 8 bytes are compared")
    plan = win.make_plan(docs, text_col, False, window, gram, rows=1)
    return win.drop_repeats(docs, id_col, text_col, plan, radix_groups, _finish, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def radix_groups(count: np.ndarray, owner: np.ndarray, body: np.ndarray, plan: win.Plan) -> np.ndarray:
    """A group number per suffix, equal for equal strings of ``window`` bytes; -1 for one that is alone."""
    lengths = count + plan.window - 1
    run_start = np.cumsum(lengths) - lengths
    step = np.arange(len(owner)) - (np.cumsum(count) - count)[owner]
    at = run_start[owner] + step
    digit = body.astype(np.uint64)
    for size in (1, 2, 4):
        digit = (digit[:-size] << np.uint64(8 * size)) | digit[size:]
    group = np.zeros(len(owner), np.int64)
    left = np.arange(len(owner))
    for depth in [*range(0, plan.window - 8, 8), plan.window - 8]:
        value = digit[at[left] + depth]
        order = np.lexsort((value, group[left])) if depth else np.argsort(value, kind="stable")
        left, value = left[order], value[order]
        new = np.ones(len(left), bool)
        new[1:] = (value[1:] != value[:-1]) | (group[left[1:]] != group[left[:-1]])
        number = np.cumsum(new) - 1
        several = np.bincount(number)[number] > 1 if len(number) else np.zeros(0, bool)
        left = left[several]
        group[left] = number[several]
    out = np.full(len(owner), -1, np.int64)
    out[left] = group[left]
    return out


_OUT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary())])


def _finish(chunk: win.Chunk, starts: dict[int, np.ndarray], plan: win.Plan) -> pa.Table:
    n_bytes, n_removed, n_spans, kept = [], [], [], []
    raw, offsets = tk.text_bytes(chunk.texts)
    for i in range(len(chunk.ids)):
        text = raw[offsets[i] : offsets[i + 1]]
        n_bytes.append(len(text))
        if i in starts or chunk.copies[i]:
            gone = win.removed_mask(starts.get(i), bool(chunk.copies[i]), len(text), plan.window)
            n_removed.append(int(gone.sum()))
            n_spans.append(int(np.count_nonzero(np.diff(gone.astype(np.int8), prepend=0) == 1)))
            kept.append(text[~gone].tobytes())
        else:
            n_removed.append(0)
            n_spans.append(0)
            kept.append(text.tobytes())
    ids = pa.array(chunk.ids, mask=~chunk.known)
    return pa.table([ids, n_bytes, n_removed, n_spans, kept], schema=_OUT)
