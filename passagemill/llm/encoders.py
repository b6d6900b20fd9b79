"""Tokens of two public tokenizers, worked out once per different stretch of text.

Both vocabularies have places that no token crosses: in front of a space or line end that follows
another character. A text is cut there; words come again and again, so a worker encodes each
stretch once and keeps what it found, up to a bound.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Collection, Iterable, Iterator

import numpy as np

#: In front of a space or line end that follows a character other than white space.
CUT = re.compile(r"(?<=\S)(?=[ \n])")
#: Stretches that a worker remembers twice over, and the longest one.
REMEMBERED, LONGEST = 150_000, 1_000
_SPACE = "▁"
#: Fixed value: how a byte-level vocabulary cuts a text into words.
_WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Below this character both libraries agree on what is a letter, digit or space.
_PLAIN = "\u0250"


_BLANK = np.zeros(256, bool)
_BLANK[[*range(9, 14), *range(28, 33)]] = True
#: White space of several bytes, by its last two or three.
_LONG_BLANKS = [c.encode() for c in "\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"]


def cuts(raw: np.ndarray) -> np.ndarray:
    """Places in UTF-8 bytes where :data:`CUT` cuts the text."""
    at = np.flatnonzero((raw[1:] == 32) | (raw[1:] == 10)) + 1
    at = at[~_BLANK[raw[at - 1]]]
    wide = raw[at - 1] >= 128
    for blank in _LONG_BLANKS if wide.any() else ():
        some = np.flatnonzero(wide & (at >= len(blank)))
        same = np.ones(len(some), bool)
        for k, b in enumerate(reversed(blank)):
            same &= raw[at[some] - 1 - k] == b
        wide[some[same]] = False
        at[some[same]] = 0
    return at[at > 0]


def parts(raw: np.ndarray, limit: int) -> Iterator[np.ndarray]:
    """A text in parts of about ``limit`` bytes, cut where stretches begin."""
    first = 0
    while first < len(raw):
        low, found = first + limit, np.zeros(0, np.int64)
        while low < len(raw) and not len(found):
            found = cuts(raw[low - 4 : low + limit])
            found = found[found >= 4] + low - 4
            low += limit
        last = int(found[0]) if len(found) else len(raw)
        yield raw[first:last]
        first = last


def _byte_values() -> dict[str, int]:
    """The printable characters by which a byte-level vocabulary writes bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteEncoder:
    """Byte-level pairs of a JSON vocabulary; special tokens in a text are plain text.

    If ids are in the order of the merges, a token's id is its rank, and texts of Latin characters
    go through the faster library that takes ranks.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self._model = Tokenizer.from_file(path)
        self._model.encode_special_tokens = True
        values, names = _byte_values(), self._model.get_vocab(with_added_tokens=True)
        special = {t.content for t in self._model.get_added_tokens_decoder().values()}
        self.token_bytes = [b""] * (max(names.values()) + 1)
        for name, i in names.items():
            self.token_bytes[i] = name.encode() if name in special else bytes(values[c] for c in name)
        self._ranked = None
        content = json.loads(self._model.to_str())
        merged = [names["".join(m if isinstance(m, list) else m.split(" "))] for m in content["model"].get("merges", [])]
        cutter = content.get("pre_tokenizer") or {}
        regular = cutter.get("type") == "ByteLevel" and cutter.get("use_regex") and not cutter.get("add_prefix_space")
        if regular and content["normalizer"] is None and merged == sorted(merged) and len(set(merged)) + 256 + len(special) == len(names):
            ranks = {self.token_bytes[i]: i for name, i in names.items() if name not in special}
            self._ranked = tiktoken.Encoding("ranked", pat_str=_WORDS, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        plain = [self._ranked is not None and (t.isascii() or max(t) < _PLAIN) for t in texts]
        rest = iter(self._model.encode_batch([t for t, p in zip(texts, plain) if not p], add_special_tokens=False))
        return [self._ranked.encode_ordinary(t) if p else next(rest).ids for t, p in zip(texts, plain)]


class PieceEncoder:
    """Pieces of a model file that puts a space in front of a text; unknown bytes are byte pieces."""

    def __init__(self, path: str):
        import sentencepiece

        self._model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.token_bytes, self._blank = [], self._model.piece_to_id(_SPACE)
        for i in range(self._model.get_piece_size()):
            piece = self._model.id_to_piece(i)
            if self._model.is_byte(i):
                self.token_bytes.append(bytes([int(piece[1:-1], 16)]))
            else:
                if "\n" in piece or re.search(f"[^{_SPACE}]{_SPACE}", piece):
                    raise ValueError(f"piece {i} crosses a place where texts are cut")
                self.token_bytes.append(piece.replace(_SPACE, " ").encode())

    def encode(self, stretches: list[str]) -> list[list[int]]:
        """Ids of stretches of a text, each beginning with a space or line end of its own."""
        found = self._model.encode([s[1:] if s[0] == " " else s for s in stretches], num_threads=1)
        # an empty text gets no space, and in front of a line end the space is not the text's
        return [ids if s[0] == " " and len(s) > 1 else [self._blank] if s == " " else ids[1:] for s, ids in zip(stretches, found)]


class Remembered:
    """``make(stretches)``, once per stretch as long as it is remembered.

    What was asked for among the last ``size`` stretches stays, in one of two generations.
    """

    def __init__(self, make: Callable[[list[str]], Iterable], size: int = REMEMBERED):
        self._make, self._size, self._known, self._before, self._long = make, size, {}, {}, []

    def __call__(self, stretches: Collection[str]) -> dict[str, object]:
        """What is known of at least the given stretches; valid until the next call."""
        for s in self._long:
            self._known.pop(s, None)
        if len(self._known) > self._size:
            self._known, self._before = {}, self._known
        known, before, new = self._known, self._before, []
        for s in dict.fromkeys(s for s in stretches if s not in known):
            if s in before:
                known[s] = before[s]
            else:
                new.append(s)
        self._long = [s for s in new if len(s) > LONGEST]
        known.update(zip(new, self._make(new)))
        return known


_loaded: dict[tuple[type, str], object] = {}


def default_path(name: str) -> str:
    """Place of a public vocabulary file, from the package that ships them."""
    try:
        import public_tokenizers
    except ImportError as missing:
        raise ValueError(f"give the path of {name}: the package public_tokenizers is not installed") from missing
    return public_tokenizers.path(name)


def byte_encoder(path: str | None = None) -> ByteEncoder:
    """The encoder of a vocabulary, loaded once per worker."""
    return _once(ByteEncoder, path or default_path("byte_bpe_50k.json"))


def piece_encoder(path: str | None = None) -> PieceEncoder:
    return _once(PieceEncoder, path or default_path("piece_bpe_32k.model"))


def _once(kind: type, path: str):
    if (kind, path) not in _loaded:
        _loaded[kind, path] = kind(path)
    return _loaded[kind, path]
