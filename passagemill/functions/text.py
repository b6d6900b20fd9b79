"""Column functions over text. All are built-in expressions except Unicode normalisation."""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from passagemill import constants as C
from passagemill.functions.common import array_pieces, bind


def _nfc_udf():
    @F.arrow_udf("string")
    def to_nfc(texts):
        import unicodedata

        import pyarrow as pa

        def done(part):
            return pa.array([None if t is None else unicodedata.normalize("NFC", t) for t in part.to_pylist()], pa.string())

        return pa.concat_arrays([done(part) for part in array_pieces(texts)])

    return to_nfc


def nfc(col: Column) -> Column:
    """Unicode NFC. Only texts with a character beyond ASCII travel to a Python worker.

    (Arrow's own ``utf8_normalize`` gives the decomposed form for "NFC", so it is not used.) Put
    the column into ``compute_once`` where filters on it follow.
    """
    return F.coalesce(_nfc_udf()(F.when(F.octet_length(col) != F.length(col), col)), col)


def strip_urls(col: Column) -> Column:
    return F.regexp_replace(col, C.URL_PATTERN, "")


def strip_footer(col: Column, pattern: str = C.FOOTER_PATTERN) -> Column:
    """Delete a page footer. With the usual pattern, texts without its marker are not searched."""
    if pattern != C.FOOTER_PATTERN:
        return F.regexp_replace(col, pattern, "")
    marked = F.contains(col, F.lit(C.FOOTER_MARKER))
    return F.when(marked, F.regexp_replace(col, pattern, "")).otherwise(col)


def collapse_ws(col: Column) -> Column:
    """Every run of white space becomes one space; none stays at the edges."""
    return F.trim(F.regexp_replace(col, C.SPACE_PATTERN, " "))


def strip(col: Column) -> Column:
    """Unicode-aware trim (``trim`` itself removes spaces only)."""
    return F.regexp_replace(col, C.EDGE_SPACE_PATTERN, "")


def clean_text(col: Column, footer: str = C.FOOTER_PATTERN) -> Column:
    """The part of :func:`normalize_text` after NFC; usable inside ``transform``."""
    return collapse_ws(bind(strip_urls(col), lambda c: strip_footer(c, footer)))


def normalize_text(col: Column, footer: str = C.FOOTER_PATTERN) -> Column:
    return clean_text(nfc(col), footer)


def word_count(col: Column) -> Column:
    """White-space separated tokens of a text whose words are separated by single spaces."""
    return F.size(F.array_remove(F.split(col, " "), ""))


def min_words(col: Column, n: int = C.MIN_WORDS) -> Column:
    """True for strictly more than ``n`` words; expects normalised text."""
    return (F.size(F.split(col, " ")) if n > 0 else word_count(col)) > n


def is_textual(col: Column) -> Column:
    """A Latin letter occurs, and no two decimal digits of any script stand together."""
    return ~col.rlike(r"(?U)\d\d") & col.rlike("[a-zA-Z]")


def synonym_length(
    col: Column, low: int = C.SYNONYM_MIN_LENGTH, high: int = C.SYNONYM_MAX_LENGTH
) -> Column:
    return F.length(col).between(low, high)


def keep_synonyms(col: Column) -> Column:
    """Array filter: textual entries of allowed length; repeats stay."""
    return F.filter(col, lambda s: is_textual(s) & synonym_length(s))


def tokenize(col: Column) -> Column:
    """Lower-case words and single punctuation marks, as an array; no white space of any kind."""
    return F.regexp_extract_all(
        F.lower(col), F.lit(r"(?U)[\p{L}\p{M}\p{N}]+|[^\s\x1c-\x1f\p{L}\p{M}\p{N}]"), F.lit(0)
    )


def count_tokens(col: Column, counter=None) -> Column:
    """Token estimate: letter runs, digit groups of up to three, punctuation runs.

    A vocabulary-exact count is possible by passing ``counter``, a vectorised UDF.
    """
    if counter is not None:
        return counter(col)
    return F.regexp_count(col, F.lit(r"\p{L}+|\p{N}{1,3}|[^\s\p{L}\p{N}]+"))


def render_prompt(template: str, col: Column, field: str = "text") -> Column:
    """Fill ``{text}`` in a format template. The template is split once, on the driver."""
    parts: list[Column] = []
    for literal, name, spec, conversion in string.Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if name is None:
            continue
        if name != field or spec or conversion:
            raise ValueError(f"prompt template may only use {{{field}}}, found {{{name}}}")
        parts.append(col.cast("string"))
    return F.concat(*parts) if parts else F.lit("")


def custom_id(id_cols: Sequence[str]) -> Column:
    """Ids joined with ``__``; null as soon as one id is null."""
    return F.concat(
        *[
            part
            for i, name in enumerate(id_cols)
            for part in ([F.lit(C.ID_SEPARATOR)] if i else []) + [F.col(name).cast("string")]
        ]
    )


def split_custom_id(col: Column, id_cols: Sequence[str]) -> list[Column]:
    """Inverse of :func:`custom_id`. One id takes the whole text; surplus parts are ignored."""
    if len(id_cols) == 1:
        return [col.alias(id_cols[0])]
    parts = F.split(col, C.ID_SEPARATOR)
    return [F.get(parts, F.lit(i)).alias(name) for i, name in enumerate(id_cols)]


def split_reasoning(col: Column) -> Column:
    """``struct(reasoning, output)``: first ``<think>`` block and the text after it."""
    found = col.rlike(C.THINK_PATTERN)
    return F.struct(
        F.when(found, strip(F.regexp_extract(col, C.THINK_PATTERN, 1))).alias("reasoning"),
        F.when(found, strip(F.regexp_extract(col, C.THINK_PATTERN, 2)))
        .otherwise(col)
        .alias("output"),
    )


def split_name(col: Column) -> tuple[Column, Column]:
    """Stem and extension of a file name; leading dots belong to the stem."""
    parts = r"(?s)^(.*[^.].*)(\.[^.]*)$"
    ext = F.regexp_extract(col, parts, 2)
    return F.when(ext != "", F.regexp_extract(col, parts, 1)).otherwise(col), ext


def safe_filename(col: Column, limit: int = C.FILE_NAME_LIMIT) -> Column:
    """Shorten the stem so that the name fits, keeping the extension."""
    stem, ext = split_name(col)
    room = F.greatest(F.lit(limit) - F.length(ext), F.lit(0))
    return F.when(F.length(col) <= limit, col).otherwise(F.concat(F.left(stem, room), ext))


def natural_order(col: Column) -> Column:
    """Sort key: digit runs compare as numbers, text parts case-folded.

    A number becomes its digit count and digits, so any length compares as text. The first
    part is always text, hence parts of one kind meet at every position.
    """
    parts = F.regexp_extract_all(col, F.lit(r"(?U)\d+|\D+"), F.lit(0))
    aligned = F.when(col.rlike(r"(?U)^\d"), F.concat(F.array(F.lit("")), parts)).otherwise(parts)

    def key(part: Column) -> Column:
        digits = F.regexp_replace(part, "^0+(?=.)", "")
        number = F.concat(F.lpad(F.length(digits).cast("string"), 9, "0"), digits)
        return F.when(part.rlike(r"(?U)^\d"), number).otherwise(F.lower(part))

    return F.transform(aligned, key)


def join_keywords(col: Column) -> Column:
    """Text of a VARIANT keyword field: a list joined with ``"; "``, a bare value as it is."""
    listed = F.try_variant_get(col, "$", "array<string>")
    return F.coalesce(F.array_join(listed, "; "), F.try_variant_get(col, "$", "string"), F.lit(""))


def format_authors(col: Column) -> Column:
    """``First Last`` names joined with ``"; "``; blank names are left out."""
    names = F.transform(
        col,
        lambda a: strip(
            F.concat(F.coalesce(a["firstName"], F.lit("")), F.lit(" "), F.coalesce(a["lastName"], F.lit("")))
        ),
    )
    return F.coalesce(F.array_join(F.filter(names, lambda n: n != ""), "; "), F.lit(""))
