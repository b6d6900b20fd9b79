"""Removal of repeated passages of 50 words, with a count-min sketch in front of exact grouping.

The sketch counts, for each window's anchor (see ``windows``), the texts that have it, in two rows
of cells. Chunks make partial sketches, blocks of cells merge them. A cell counts everything that
falls into it, so an estimate is never below the true count of a window: windows estimated to be
alone are alone. The second pass groups the others exactly, by 128 bits of their words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import tokens as tk
from . import windows as win


def countmin_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 50, gram: int = 20) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_words, n_removed, kept``.

    A word is removed if a window of ``window`` words that covers it also starts in a document
    with a smaller id; windows are judged on the input. Words are ``[^\\x20\\x09-\\x0D]+``,
    unchanged; ``kept`` is the rest, joined by one space. A null text has no words. Rows whose id
    is null, and rows with one id among themselves, remove nothing from each other: neither id is
    smaller. Repeated rows get equal results. Columns other than the two named are not read.
    ``gram`` sets how windows are dealt (``window - gram`` at most 31), never the result.
    """
    plan = win.make_plan(docs, text_col, True, window, gram, rows=2)
    return win.drop_repeats(docs, id_col, text_col, plan, equal_windows, _finish, "doc_id long, n_words long, n_removed long, kept string")


def equal_windows(count: np.ndarray, owner: np.ndarray, body: np.ndarray, plan: win.Plan) -> np.ndarray:
    """A group number per window, equal for equal pairs of hashes; -1 for a window that is alone."""
    pairs = body.view("<u8").reshape(-1, 2)
    order = np.lexsort((pairs[:, 1], pairs[:, 0]))
    new = np.ones(len(order), bool)
    new[1:] = (pairs[order[1:]] != pairs[order[:-1]]).any(1)
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(new) - 1
    return np.where(np.bincount(group)[group] > 1, group, -1)


_OUT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())])


def _finish(chunk: win.Chunk, starts: dict[int, np.ndarray], plan: win.Plan) -> pa.Table:
    n_words, n_removed, kept = [], [], []
    raw, offsets = tk.text_bytes(chunk.texts)
    data = raw.tobytes()
    for i in range(len(chunk.ids)):
        words = data[offsets[i] : offsets[i + 1]].split()
        gone = win.removed_mask(starts.get(i), bool(chunk.copies[i]), len(words), plan.window)
        n = int(gone.sum())
        n_words.append(len(words))
        n_removed.append(n)
        if n:
            words = [w for w, g in zip(words, gone.tolist()) if not g]
        kept.append(b" ".join(words).decode())
    ids = pa.array(chunk.ids, mask=~chunk.known)
    return pa.table([ids, n_words, n_removed, kept], schema=_OUT)
