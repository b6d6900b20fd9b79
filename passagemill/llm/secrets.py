"""Secrets in texts: fixed patterns, and formats inferred from what those patterns find.

The strings that the fixed patterns find in all documents are the labelled credentials; all
different ones are learned from, whole. Per kind, their prefix tree is folded into a probabilistic automaton: two states are
merged if the frequencies of their continuations differ by less than the Hoeffding bound, and so
do those of all states that the merge brings together. Every long run of credential
characters that fixed patterns leave open is then scored, over all texts, by how much likelier the best automaton makes it, per
character, than a first-order model of the ordinary words of all texts.

A few hundred strings are learned from on the driver. Of more, Spark sends all through the states
folded so far and compares the nodes of the prefix tree that are left, until the driver can hold what
is left; it counts the steps of ordinary words and their best scores.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import job_scope, stored
from . import tokens as tk

KINDS = ("assign", "access", "hex", "format")
_ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE)
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")

_HEX = np.zeros(256, bool)
_HEX[list(b"0123456789abcdef")] = True
_CREDENTIAL = np.zeros(256, bool)
_CREDENTIAL[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-")] = True
#: Classes of credential characters: digits, a-f, g-z, A-F, G-Z and one for each other character.
_CLASSES = [b"0123456789", b"abcdef", b"ghijklmnopqrstuvwxyz", b"ABCDEF", b"GHIJKLMNOPQRSTUVWXYZ", b"+", b"/", b"_", b".", b"=", b"-"]
_CLASS_OF = np.zeros(256, np.int64)
for _i, _chars in enumerate(_CLASSES):
    _CLASS_OF[list(_chars)] = _i
_WIDTH = np.log([len(x) for x in _CLASSES])
_N = len(_CLASSES)
#: A letter for each class, and what translates a credential into these.
_LETTERS = "".join(chr(97 + i) for i in range(_N))
_FROM, _TO = b"".join(_CLASSES).decode(), "".join(_LETTERS[i] * len(x) for i, x in enumerate(_CLASSES))
_FIRST_OF = "".join(chr(x[0]) for x in _CLASSES)


# --- fixed patterns -------------------------------------------------------------------------


def _runs(mark: np.ndarray, bounds: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of marked bytes of ``least`` bytes and more that don't cross texts."""
    before = np.zeros(len(mark) + 1, bool)
    before[1:] = mark
    before[bounds[:-1]] = False
    after = np.zeros(len(mark) + 1, bool)
    after[:-1] = mark
    after[bounds[1:]] = False
    starts = np.flatnonzero(mark & ~before[:-1])
    ends = np.flatnonzero(mark & ~after[1:]) + 1
    long = ends - starts >= least
    return starts[long], ends[long]


def base_spans(text: bytes, hexes: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` in bytes of the fixed patterns; ``hexes`` are the runs of hex digits."""
    out = [(s, 2, e) for s, e in hexes]
    if b":" in text or b"=" in text:
        out += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if b"AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    return sorted(out)


def credential(text: bytes, kind: int, start: int, end: int) -> bytes:
    """The secret itself: of an assignment, what is assigned."""
    return _ASSIGN.match(text, start)[2] if kind == 0 else text[start:end]


# --- automata -------------------------------------------------------------------------------

#: Of the Hoeffding tests.
ALPHA = 0.05


@dataclass(slots=True)
class _State:
    count: int = 0
    final: int = 0
    next: dict[int, int] = field(default_factory=dict)
    seen: dict[int, int] = field(default_factory=dict)


class Automaton:
    """Probabilistic automaton over character classes, folded from the prefix tree of ``words``."""

    def __init__(self, words: list[bytes], alpha: float = ALPHA):
        self.states = [_State()]
        self._alpha = alpha
        for word in words:
            self._add(0, _CLASS_OF[np.frombuffer(word, np.uint8)].tolist(), 1)
        self._fold()

    @classmethod
    def going_on(cls, step: list[list[int]], counts: np.ndarray, waiting: Iterable[tuple[int, int, str, int]], queue: list[tuple[int, int]]) -> Automaton:
        """From states folded before: their steps and counts, the rest of the strings as of :func:`_sent`, and the queue."""
        out = cls([])
        out.states = [_State(int(n.sum()), int(n[_N]), {c: x for c, x in enumerate(to) if x >= 0}, {c: int(n[c]) for c in range(_N) if n[c]}) for to, n in zip(step, counts)]
        for at, c, rest, n in waiting:
            if c not in out.states[at].next:
                out.states[at].next[c] = len(out.states)
                out.states.append(_State())
            out._add(out.states[at].next[c], [_LETTERS.index(x) for x in rest], n)
        out._fold([*range(len(step))], queue)
        return out

    @classmethod
    def of_tree(cls, steps: list[tuple[str, str, int]], alpha: float = ALPHA) -> Automaton:
        """From the counts of a prefix tree: (node as a string of ``_LETTERS``, its next letter or '' for its end, how often)."""
        out = cls([], alpha)
        number = {node: i for i, node in enumerate(sorted({node for node, _, _ in steps} | {""}))}
        out.states = [_State() for _ in number]
        for node, letter, n in steps:
            state = out.states[number[node]]
            state.count += n
            if not letter:
                state.final += n
                continue
            c = _LETTERS.index(letter)
            state.seen[c] = n
            if node + letter in number:
                state.next[c] = number[node + letter]
        out._fold()
        return out

    def _add(self, at: int, classes: Iterable[int], n: int) -> None:
        """``n`` strings that go on from a state by these classes."""
        self.states[at].count += n
        for c in classes:
            state = self.states[at]
            if c not in state.next:
                state.next[c] = len(self.states)
                self.states.append(_State())
            state.seen[c] = state.seen.get(c, 0) + n
            at = state.next[c]
            self.states[at].count += n
        self.states[at].final += n

    def _differ(self, f1: int, n1: int, f2: int, n2: int) -> bool:
        bound = _spread(self._alpha) * (1 / math.sqrt(n1) + 1 / math.sqrt(n2))
        return abs(f1 / n1 - f2 / n2) >= bound

    def _compatible(self, a: int, b: int) -> bool:
        stack = [(a, b)]
        met = set()
        while stack:
            pair = stack.pop()
            if pair in met or pair[0] == pair[1]:
                continue
            met.add(pair)
            x, y = self.states[pair[0]], self.states[pair[1]]
            if self._differ(x.final, x.count, y.final, y.count):
                return False
            for c in x.seen.keys() | y.seen.keys():
                if self._differ(x.seen.get(c, 0), x.count, y.seen.get(c, 0), y.count):
                    return False
                if c in x.next and c in y.next:
                    stack.append((x.next[c], y.next[c]))
        return True

    def _merge(self, into: int, of: int, parent: int, symbol: int, red: set[int]) -> list[tuple[int, int]]:
        """The steps that red states got by it."""
        self.states[parent].next[symbol] = into
        stack, new = [(into, of)], []
        while stack:
            a, b = stack.pop()
            if a == b:
                continue
            x, y = self.states[a], self.states[b]
            x.count += y.count
            x.final += y.final
            for c, n in y.seen.items():
                x.seen[c] = x.seen.get(c, 0) + n
            for c, to in y.next.items():
                if c in x.next:
                    stack.append((x.next[c], to))
                else:
                    x.next[c] = to
                    if a in red:
                        new.append((a, c))
        return new

    def _fold(self, red: Sequence[int] = (0,), queue: Sequence[tuple[int, int]] | None = None) -> None:
        """From the given red states; ``queue`` has the steps from these to states that are not yet red."""
        number = {state: i for i, state in enumerate(red)}
        queue = [(0, c) for c in sorted(self.states[0].next)] if queue is None else [*queue]
        while queue:
            parent, symbol = queue.pop(0)
            state = self.states[parent].next[symbol]
            for other in number:
                if self._compatible(other, state):
                    new = self._merge(other, state, parent, symbol, number.keys())
                    queue += sorted(new, key=lambda x: (x[0] != other, number[x[0]], x[1]))
                    break
            else:
                number[state] = len(number)
                queue += [(state, c) for c in sorted(self.states[state].next)]

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Next states (-1: none), log-probabilities of the steps and of ending, with add-one smoothing."""
        number, order = {0: 0}, [0]
        for at in order:
            for to in self.states[at].next.values():
                if to not in number:
                    number[to] = len(order)
                    order.append(to)
        step, seen = np.full((len(order), _N), -1), np.zeros((len(order), _N + 1))
        for i, at in enumerate(order):
            state = self.states[at]
            for c in range(_N):
                step[i, c] = number[state.next[c]] if c in state.next else -1
                seen[i, c] = state.seen.get(c, 0)
            seen[i, _N] = state.final
        return _tables(step, seen)


def _spread(alpha: float) -> float:
    """The Hoeffding bound for one string; shares of ``n1`` and ``n2`` may differ by as much times 1/sqrt(n1) + 1/sqrt(n2)."""
    return math.sqrt(0.5 * math.log(2 / alpha))


def _tables(step: np.ndarray, seen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tables of an automaton from counts of its steps by class; the last column has those of ending."""
    log = np.log((seen + 1) / (seen.sum(1, keepdims=True) + _N + 1))
    return step, log[:, :_N] - _WIDTH, log[:, _N]


def log_likelihood(tables, word: bytes) -> float:
    """Of a string; a step that the automaton does not have leads back to its start."""
    step, cost, end = tables
    at, total = 0, 0.0
    for c in _CLASS_OF[np.frombuffer(word, np.uint8)].tolist():
        total += cost[at, c]
        at = max(0, step[at, c])
    return total + end[at]


@dataclass
class Formats:
    """What is learned: an automaton per kind, the model of ordinary words, and the least score.

    ``short`` has the least scores of shorter runs by length, from the shortest credential on.
    """

    automata: list
    ordinary: tuple
    least: float
    short: dict[int, float] = field(default_factory=dict)

    def holds(self, word: bytes) -> bool:
        return self.score(word) >= self.short.get(len(word), self.least)

    def score(self, word: bytes) -> float:
        """Log-likelihood ratio per character of the best automaton; minus infinity without any."""
        if not self.automata:
            return -math.inf
        best = max(log_likelihood(t, word) for t in self.automata)
        return (best - log_likelihood(self.ordinary, word)) / len(word)


#: Steps of the first-order model: state 0 is the start, state c + 1 that after class c.
_FIRST_ORDER = np.tile(np.arange(1, _N + 1), (_N + 1, 1))


def _walked(words: Iterable[tuple[bytes, int]], step: np.ndarray) -> np.ndarray:
    """How often each step of an automaton is made, and in the last column how often each state is the last.

    A step that the automaton does not have leads back to its start.
    """
    seen = np.zeros((len(step), _N + 1), np.int64)
    to = np.maximum(step, 0).tolist()
    for word, n in words:
        at = 0
        for c in _CLASS_OF[np.frombuffer(word, np.uint8)].tolist():
            seen[at, c] += n
            at = to[at][c]
        seen[at, _N] += n
    return seen


def _ordinary(words: list[bytes]) -> tuple:
    """First-order class model of words in the form of automaton tables."""
    return _tables(_FIRST_ORDER, _walked(((w, 1) for w in words), _FIRST_ORDER))


def infer_formats(labelled: list[tuple[int, bytes]], words: list[bytes], margin: float = 0.5, least: int = 16) -> Formats:
    """Automata from labelled credentials. No ordinary word of the sample may reach the least score.

    Runs below ``least`` characters, down to the shortest credential, have a least score for each
    length, above the ordinary words of that length. Without any credential nothing is a format.
    """
    by_kind = defaultdict(list)
    for kind, word in labelled:
        by_kind[kind].append(word)
    automata = [Automaton(by_kind[k]).tables() for k in sorted(by_kind)]
    found = Formats(automata, _ordinary(words), 0.0)
    above = lambda some: max([found.score(w) for w in some] + [0.0]) + margin if automata else math.inf
    found.least = above([w for w in words if len(w) >= least])
    for n in range(min([least, *(len(w) for _, w in labelled)]), least):
        found.short[n] = above([w for w in words if len(w) == n])
    return found


# --- the operator ---------------------------------------------------------------------------


def _touched(start: int, end: int, spans: list[tuple[int, int, int]]) -> tuple[bool, bool]:
    """Whether no one of the sorted spans touches a run, and whether they cover all of it."""
    free, at = True, start
    for x, _, y in spans:
        if x < end and y > start:
            free = False
            if x <= at:
                at = max(at, y)
    return free, at >= end


def _scan(column: pa.Array, least: int) -> Iterator[tuple[int, bytes, list, list]]:
    """Per text: its number, bytes, fixed spans, and ``(start, end, free)`` of runs of credential characters.

    Runs that fixed spans cover from end to end are left out; ``free`` ones touch no fixed span.
    """
    raw, offsets = tk.text_bytes(column)
    for a, b in tk.document_slices(offsets):
        part, bounds = raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        data = part.tobytes()
        hexes, runs = defaultdict(list), defaultdict(list)
        for mark, size, into in ((_HEX, 24, hexes), (_CREDENTIAL, least, runs)):
            starts, ends = _runs(mark[part], bounds, size)
            owner = np.searchsorted(bounds, starts, "right") - 1
            for o, s, e in zip(owner.tolist(), starts.tolist(), ends.tolist()):
                into[o].append((s - int(bounds[o]), e - int(bounds[o])))
        for i in range(b - a):
            text = data[bounds[i] : bounds[i + 1]]
            spans = base_spans(text, hexes.get(i, []))
            yield a + i, text, spans, [(s, e, free) for s, e in runs.get(i, []) for free, whole in [_touched(s, e, spans)] if not whole]


#: Characters of a run whose verdict is remembered.
KNOWN = 1024
#: Different strings, and bytes of them, that a task holds before it hands them on.
HELD, HELD_BYTES = 20_000, 16 << 20
#: Characters whose prefix tree the driver holds, nodes of a larger one that are sent to all tasks, and how deep it is looked through in any case.
TREE, HEAD, NEAR = 1_000_000, 10_000, 64


def _drawn(texts: DataFrame, least: int, wanted: Callable[[bytes, list, list], Iterable[tuple[int, bytes]]]) -> DataFrame:
    """``kind, word``: all different strings that ``wanted`` gives for any text."""

    def rows(held: set[tuple[int, bytes]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([k for k, _ in held], pa.int32()), pa.array([w for _, w in held], pa.binary())], names=["kind", "word"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: set[tuple[int, bytes]] = set()
        size = 0
        for batch in batches:
            for _, text, spans, runs in _scan(batch.column("text"), least):
                for found in wanted(text, spans, runs):
                    if found in held:
                        continue
                    held.add(found)
                    size += len(found[1])
                    if len(held) >= HELD or size >= HELD_BYTES:
                        yield rows(held)
                        held.clear()
                        size = 0
        yield rows(held)

    return stored(texts.mapInArrow(run, "kind int, word binary").distinct(), "credentials")


def _is_ordinary(word: bytes) -> bool:
    return word.isalpha() or word.isdigit()


def learn_formats(docs: DataFrame, text_col: str, least: int, per_kind: int) -> Formats:
    """Formats from all different credentials and ordinary words of all documents, whole.

    Up to ``per_kind`` strings of each kind, of ``TREE`` characters in all, are learned from on the
    driver, more by :func:`_infer_counted` with the same result. If a credential is shorter than
    ``least``, a second scan takes the ordinary words from there up to ``least``.
    """
    texts = docs.select(F.col(text_col).cast("string").alias("text")).filter("text is not null")

    def long(text: bytes, spans: list, runs: list) -> Iterator[tuple[int, bytes]]:
        yield from ((k, credential(text, k, s, e)) for s, k, e in spans)
        yield from ((3, text[s:e]) for s, e, free in runs if free and _is_ordinary(text[s:e]))

    found = _drawn(texts, least, long)
    size = F.length("word")
    sizes = found.groupBy("kind").agg(F.count("*").alias("n"), F.min(size).alias("shortest"), F.sum(size).alias("chars")).collect()
    shortest = min([least, *(r["shortest"] for r in sizes if r["kind"] < 3)])
    most, chars = max([r["n"] for r in sizes], default=0), sum(r["chars"] for r in sizes)

    def short(text: bytes, spans: list, runs: list) -> Iterator[tuple[int, bytes]]:
        yield from ((3, text[s:e]) for s, e, free in runs if free and e - s < least and _is_ordinary(text[s:e]))

    if shortest < least:
        brief = _drawn(texts, shortest, short)
        sizes = brief.groupBy(size.alias("size")).count().collect()
        most, chars = max([most, *(r["count"] for r in sizes)]), chars + sum(r["size"] * r["count"] for r in sizes)
        found = found.unionByName(brief)
    if most > per_kind or chars > TREE:
        return _infer_counted(found, least, shortest)
    rows = [(r["kind"], bytes(r["word"])) for r in found.orderBy("kind", "word").collect()]
    return infer_formats([x for x in rows if x[0] < 3], [w for k, w in rows if k == 3], least=least)


def _infer_counted(found: DataFrame, least: int, shortest: int, margin: float = 0.5) -> Formats:
    """As :func:`infer_formats`, from any number of strings ``kind, word`` of any length: counts and best scores are Spark's."""
    kinds = {r["kind"] for r in found.select("kind").distinct().collect()}
    words = found.filter("kind = 3")
    automata = [_folded(found.filter(F.col("kind") == k)) for k in sorted(kinds - {3})]
    ordinary = _tables(_FIRST_ORDER, _counted(words.select("word", F.lit(1).cast("long").alias("n")), _FIRST_ORDER))
    formats = Formats(automata, ordinary, math.inf)
    if not automata:
        return formats

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top: dict[int, float] = {}
        for batch in batches:
            for word in batch.column("word").to_pylist():
                n = min(len(word), least)
                top[n] = max(top.get(n, 0.0), formats.score(word))
        yield pa.RecordBatch.from_arrays([pa.array(top.keys(), pa.int32()), pa.array(top.values(), pa.float64())], names=["size", "score"])

    scored = words.select("word").mapInArrow(best, "size int, score double").groupBy("size").agg(F.max("score").alias("score"))
    tops = {r["size"]: r["score"] for r in scored.collect()}
    formats.least = tops.get(least, 0.0) + margin
    formats.short = {n: tops.get(n, 0.0) + margin for n in range(shortest, least)}
    return formats


def _folded(words: DataFrame) -> tuple:
    """Tables of the automaton of one kind's different strings ``word``: those of :class:`Automaton`, state by state.

    All strings are sent through the states folded so far, from the first; what follows the step where
    a string leaves these is the rest of it, and the rests behind one step are the prefix tree that it
    leads to. As soon as the rests have ``TREE`` characters at most, the driver folds on. Until then
    it takes the next step of its queue, and Spark compares the tree there with each state.
    """
    letters = F.translate(F.col("word").cast("string"), _FROM, _TO)
    with job_scope(words.sparkSession) as scope:
        strings = stored(words.groupBy(letters.alias("letters")).agg(F.count("*").alias("n")), "class-strings")
        step: list[list[int]] = [[-1] * _N]
        queue: list[tuple[int, int]] = []
        last = 0
        while True:
            sent = stored(_sent(strings, step), "sent")
            counts = np.zeros((len(step), _N + 1), np.int64)
            for r in sent.filter("rest is null").collect():
                counts[r["at"], r["c"]] = r["n"]
            rests = sent.filter("rest is not null")
            size = rests.groupBy("at", "c").agg(F.sum(F.length("rest") + 1).alias("size")).collect()
            new = {(r["at"], r["c"]) for r in size}.difference(queue)
            queue += sorted(new, key=lambda x: (x[0] != last, *x))
            if sum(r["size"] for r in size) <= TREE:
                waiting = ((r["at"], r["c"], r["rest"], r["n"]) for r in rests.collect())
                return Automaton.going_on(step, counts, waiting, queue).tables()
            at, c = queue.pop(0)
            last = _first_alike(rests, counts, step, at, c)
            if last == len(step):
                step.append([-1] * _N)
            step[at][c] = last
            scope.drop(sent)


def _sent(strings: DataFrame, step: list[list[int]]) -> DataFrame:
    """``at, c, rest, n``: how often each step from a state is made (``rest`` is null; the last class is ending), and the rests of strings behind steps that lead nowhere yet."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = [[0] * (_N + 1) for _ in step]
        for batch in batches:
            left = []
            for letters, n in zip(batch.column("letters").to_pylist(), batch.column("n").to_pylist()):
                at = 0
                for i, x in enumerate(letters.encode()):
                    c = x - 97
                    seen[at][c] += n
                    to = step[at][c]
                    if to < 0:
                        left.append((at, c, letters[i + 1 :], n))
                        break
                    at = to
                else:
                    seen[at][_N] += n
            yield _batch(left, _SENT)
        yield _batch([(at, c, None, n) for at, row in enumerate(seen) for c, n in enumerate(row) if n], _SENT)

    return strings.mapInArrow(run, "at int, c int, rest string, n long").groupBy("at", "c", "rest").agg(F.sum("n").alias("n"))


_SENT = {"at": pa.int32(), "c": pa.int32(), "rest": pa.string(), "n": pa.int64()}
_MARKS = {"at": pa.int32(), "c": pa.int32(), "key": pa.string(), "deep": pa.int32(), "place": pa.binary(), "n": pa.int64()}
_PLACES = {"start": pa.int32(), "place": pa.binary(), "edge": pa.int32(), "at": pa.binary(), "c": pa.int32(), "n": pa.int64()}


def _batch(rows: list[tuple], kinds: dict[str, pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, kinds.values())], names=[*kinds])


def _first_alike(rests: DataFrame, counts: np.ndarray, step: list[list[int]], at: int, c: int) -> int:
    """The first state that the tree behind the step ``c`` from ``at`` is compatible with; their number if none is.

    As ``Automaton._compatible``: of every node of the tree, the frequencies are compared with those
    of the state or node that the same classes lead to from the state. What too few strings pass
    for any difference to reach the bound is not compared.
    """
    spark, own = rests.sparkSession, (F.col("at") == at) & (F.col("c") == c)
    first = F.substring("rest", 1, 1)
    root = np.zeros(_N + 1, np.int64)
    for r in rests.filter(own).groupBy(first.alias("first")).agg(F.sum("n").alias("n")).collect():
        root[_LETTERS.index(r["first"]) if r["first"] else _N] = r["n"]
    bound = _spread(ALPHA) * (1 / np.sqrt(counts.sum(1)) + 1 / math.sqrt(root.sum()))
    near = np.abs(counts / counts.sum(1, keepdims=True) - root / root.sum()).max(1) < bound
    starts = np.flatnonzero(near).tolist()
    if not starts or root.sum() <= _spread(ALPHA) ** 2:
        return [*starts, len(step)][0]
    with job_scope(spark):
        rests = _with_depth(rests)
        nodes = stored(_frequencies(_places(rests, step, [-1]), "edge", "at"), "nodes")
        tree = stored(_frequencies(_places(rests.filter(own), step, starts), "start", "place", "edge", "at"), "tree").alias("y")
        by_size = {r["size"]: r["count"] for r in nodes.groupBy(F.floor(F.log2("passed")).alias("size")).count().collect()}
        head = F.col("passed") >= 2 ** next(k for k in range(65) if sum(n for s, n in by_size.items() if s >= k) <= HEAD)
        states = spark.createDataFrame([(-1 - i, bytes(16), int(n.sum()), *n.tolist()) for i, n in enumerate(counts)], nodes.schema)
        found = set()
        for x in (F.broadcast(states.unionByName(nodes.filter(head))), nodes.filter(~head)):
            pairs = tree.join(x.alias("x"), ["edge", "at"])
            most = F.lit(_spread(ALPHA)) * (1 / F.sqrt("x.passed") + 1 / F.sqrt("y.passed"))
            apart = F.greatest(*(F.abs(F.col(f"x.s{k}") / F.col("x.passed") - F.col(f"y.s{k}") / F.col("y.passed")) for k in range(_N + 1)))
            found |= {r["start"] for r in pairs.filter(apart >= most).select("start").distinct().collect()}
    return [*(x for x in starts if x not in found), len(step)][0]


#: Places in a prefix tree are told apart by a hash of the classes that lead there, modulo a prime.
_PRIME, _BASE = 2**127 - 1, 0x2545F4914F6CDD1D9E3779B97F4A7C15


def _with_depth(rests: DataFrame) -> DataFrame:
    """With ``deep``: behind so many classes, or fewer, no other string goes the same way any more."""
    size, by = F.length("rest"), ["at", "c", "key"]
    long = rests.filter(size > NEAR).withColumn("key", F.sha2("rest", 256))
    short = rests.filter(size <= NEAR).withColumn("deep", size)
    if long.isEmpty():
        return short

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for at, c, key, rest, n in zip(*(batch.column(x).to_pylist() for x in ("at", "c", "key", "rest", "n"))):
                place, end = 0, NEAR
                for i, x in enumerate(rest.encode(), 1):
                    place = (place * _BASE + x - 96) % _PRIME
                    if i == end:
                        out.append((at, c, key, i, place.to_bytes(16, "big"), n))
                        end *= 2
            yield _batch(out, _MARKS)

    marks = stored(long.select("at", "c", "key", "rest", "n").mapInArrow(run, "at int, c int, key string, deep int, place binary, n long"), "marks")
    node = ["at", "c", "deep", "place"]
    shared = marks.groupBy(*node).agg(F.sum("n").alias("passed")).filter(F.col("passed") > _spread(ALPHA) ** 2)
    deep = stored(marks.join(shared, node, "left_semi").groupBy(*by).agg((F.max("deep") * 2).alias("deep")), "depths")
    return long.join(deep, by, "left").withColumn("deep", F.coalesce("deep", F.lit(NEAR))).drop("key").unionByName(short)


def _places(rests: DataFrame, step: list[list[int]], starts: list[int]) -> DataFrame:
    """All nodes that each rest passes, as deep as others may pass them, and its next class there (the last class is ending).

    ``place`` is the node in the tree; ``edge, at`` is what the same classes lead to from the state
    ``start``: a state (``edge`` is -1 less its number), or a node behind a step. From -1 it is the node itself.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for batch in batches:
            for behind, by, rest, n, deep in zip(*(batch.column(x).to_pylist() for x in ("at", "c", "rest", "n", "deep"))):
                classes = [x - 97 for x in rest[: deep + 1].encode()]
                if len(rest) <= deep:
                    classes.append(_N)
                for start in starts:
                    place, edge, at = 0, behind * _N + by if start < 0 else -1 - start, 0
                    for c in classes:
                        out.append((start, place.to_bytes(16, "big"), edge, at.to_bytes(16, "big"), c, n))
                        place = (place * _BASE + c + 1) % _PRIME
                        if edge >= 0:
                            at = (at * _BASE + c + 1) % _PRIME
                        elif c < _N:
                            state = -1 - edge
                            edge = -1 - step[state][c] if step[state][c] >= 0 else state * _N + c
                        if len(out) >= 50_000:
                            yield _batch(out, _PLACES)
                            out.clear()
        yield _batch(out, _PLACES)

    return rests.select("at", "c", "rest", "n", "deep").mapInArrow(run, "start int, place binary, edge int, at binary, c int, n long")


def _frequencies(places: DataFrame, *by: str) -> DataFrame:
    """How many strings pass each node, and how many of them go on by each class; only nodes that can differ from any."""
    n = F.col("n")
    sums = [F.sum(F.when(F.col("c") == k, n).otherwise(0)).alias(f"s{k}") for k in range(_N + 1)]
    return places.groupBy(*by).agg(F.sum(n).alias("passed"), *sums).filter(F.col("passed") > _spread(ALPHA) ** 2)


def _counted(words: DataFrame, step: np.ndarray) -> np.ndarray:
    """:func:`_walked` over ``word, n``; tasks send sums by state and class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((len(step), _N + 1), np.int64)
        for batch in batches:
            seen += _walked(zip(batch.column("word").to_pylist(), batch.column("n").to_pylist()), step)
        at, c = np.nonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(c, pa.int32()), pa.array(seen[at, c], pa.int64())], names=["at", "c", "n"])

    out = np.zeros((len(step), _N + 1))
    for r in words.mapInArrow(run, "at int, c int, n long").groupBy("at", "c").agg(F.sum("n").alias("n")).collect():
        out[r["at"], r["c"]] = r["n"]
    return out


def secret_scan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 16,
    per_kind: int = 400, formats: Formats | None = None, with_text: bool = True,
    carry: Sequence[str] = (),
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_assign, n_access, n_hex, n_format, spans, redacted``.

    ``spans`` is an array of (start, kind, end) by start, then kind as in ``KINDS``; positions
    are code points, ``end`` is exclusive. Kind ``format`` are whole runs of credential characters
    that fixed spans do not cover from end to end and that score at least as learned; fixed spans
    inside them stay. They have ``least`` characters, or as many as the shortest credential that
    was learned from if that has fewer.
    ``redacted`` is the text with ``[secret]`` for each stretch of spans (null unless
    ``with_text``). A null text counts as empty and stays null. Columns named by ``carry`` come
    along in a struct ``carried``; others are not read. Formats are learned from whole
    credentials, and all runs are scored whole. Repeated rows are scanned each,
    and learned from once. An empty table gives no row and no format.
    """
    formats = formats or learn_formats(docs, text_col, least, per_kind)
    shortest = min([least, *formats.short])
    carried = F.struct(*carry) if carry else F.lit(None).cast("struct<none:int>")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), carried.alias("carried"))
    span = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.string()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, bool] = {}
        for batch in batches:
            null = np.asarray(batch.column("text").is_null())
            spans_of, texts, counts = [], [], [[], [], [], []]
            for i, text, spans, runs in _scan(batch.column("text"), shortest):
                for s, e, _ in runs:
                    word = text[s:e]
                    hit = known.get(word)
                    if hit is None:
                        if len(known) > 100_000:
                            known.clear()
                        hit = formats.holds(word)
                        if len(word) <= KNOWN:
                            known[word] = hit
                    if hit:
                        spans.append((s, 3, e))
                spans.sort()
                for k in range(4):
                    counts[k].append(sum(x[1] == k for x in spans))
                if spans:
                    place = np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)
                    at = lambda x: int(place[x - 1]) if x else 0
                    spans_of.append([{"start": at(s), "kind": KINDS[k], "end": at(e)} for s, k, e in spans])
                else:
                    spans_of.append([])
                texts.append(None if null[i] or not with_text else redact(text, spans).decode())
            arrays = [batch.column("doc_id"), batch.column("carried"), *(pa.array(x, pa.int64()) for x in counts), pa.array(spans_of, span), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "carried", *(f"n_{k}" for k in KINDS), "spans", "redacted"])

    schema = ", ".join(f"n_{k} long" for k in KINDS)
    kept = rows.schema["carried"].dataType.simpleString()
    found = rows.mapInArrow(run, f"doc_id long, carried {kept}, {schema}, spans array<struct<start:long,kind:string,end:long>>, redacted string")
    return found if carry else found.drop("carried")


def redact(text: bytes, spans: list[tuple[int, int, int]], mark: bytes = b"[secret]") -> bytes:
    """Replace what sorted spans cover; spans that touch or overlap become one mark."""
    out, end = [], 0
    for s, _, e in spans:
        if s > end or not out:
            out += [text[end:s], mark]
        end = max(end, e)
    return b"".join([*out, text[end:]])


def span_text(spans, base_only: bool = False):
    """Column: ``kind:start:end`` of all spans, comma-joined."""
    kept = F.filter(spans, lambda x: x["kind"] != "format") if base_only else spans
    return F.array_join(F.transform(kept, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
