"""Parsing of model answers: lenient JSON, validation against a schema, content blocks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from passagemill.functions.common import bind
from passagemill.schemas import CORRUPT

# Types as the VARIANT reader names them, per field type; int is accepted for a float field.
_ACCEPTED = {
    "string": ["STRING"],
    "boolean": ["BOOLEAN"],
    "int": ["BIGINT"],
    "bigint": ["BIGINT"],
    "double": ["DOUBLE", "BIGINT"],
}
_EMPTY = {"string": "", "boolean": False, "int": 0, "bigint": 0, "double": 0.0}
_OPTIONS = {"allowUnquotedControlChars": "true", "columnNameOfCorruptRecord": CORRUPT}


def _as_variants(col: Column, names: list[str]) -> Column:
    """Parse an object into one VARIANT per name; the whole struct is null if it is no object.

    A missing key gives SQL null while a JSON null stays a VARIANT of type VOID, so required
    keys can be told from empty ones. A repeated key keeps its last value.
    """
    ddl = ", ".join([f"`{n}` VARIANT" for n in names] + [f"{CORRUPT} STRING"])
    # A failed parse raises inside the reader, which is slow: texts of no object are not tried.
    text = F.when(col.rlike(r"^\s*\{"), col)
    return bind(F.from_json(text, ddl, _OPTIONS), lambda p: F.when(p[CORRUPT].isNull(), p))


def fence_body(col: Column) -> Column:
    """Content of the first Markdown code fence, null without one."""
    body = F.regexp_extract(col, r"(?s)```(?:json)?(.*?)(?:```|$)", 1)
    return F.when(col.contains("```"), F.trim(body))


def lenient_object(col: Column, names: list[str]) -> Column:
    """Object parse that forgives a code fence and a cut-off end (inside or after a value)."""
    tries = [
        F.concat(text, F.lit(end)) for text in (col, fence_body(col)) for end in ("", '"}', "}")
    ]
    return F.coalesce(*[_as_variants(t, names) for t in tries])


def json_question(col: Column, field: str = "question") -> Column:
    """Text of one field of an answer, unvalidated; null when absent, null or unparsable."""
    return bind(col, lambda c: lenient_object(c, [field]))[field].cast("string")


def empty_output(schema: T.StructType) -> Column:
    """Default answer: "" / false / 0 / 0.0 for required fields, null for optional ones."""
    return F.struct(*[_default(f).alias(f.name) for f in schema.fields])


def _default(field: T.StructField) -> Column:
    kind = field.dataType.simpleString()
    value = None if field.nullable else _EMPTY.get(kind)
    return F.lit(value).cast(field.dataType)


def fill_empty(col: Column, schema: T.StructType) -> Column:
    """Replace missing fields of an answer struct by their defaults."""
    return F.struct(*[F.coalesce(col[f.name], _default(f)).alias(f.name) for f in schema.fields])


def _validated(parsed: Column, schema: T.StructType) -> Column:
    """The typed struct if every required key is there with the right type, else null."""
    checks = []
    for f in schema.fields:
        kinds = _ACCEPTED[f.dataType.simpleString()] + (["VOID"] if f.nullable else [])
        checks.append(F.coalesce(F.schema_of_variant(parsed[f.name]).isin(kinds), F.lit(False)))
    ok = checks[0]
    for check in checks[1:]:
        ok = ok & check
    typed = F.struct(*[parsed[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])
    return F.when(ok, typed)


def parse_structured(col: Column, schema: T.StructType) -> Column:
    """Parse and validate an answer; retry on its outermost braces; else the empty answer."""

    def attempt(text: Column) -> Column:
        parsed = lenient_object(text, schema.fieldNames())
        return bind(parsed, lambda p: _validated(p, schema))

    def answer(text: Column) -> Column:
        inner = F.regexp_extract(text, r"(?s)(\{.*\})", 1)
        return F.coalesce(attempt(text), attempt(inner), empty_output(schema))

    return bind(col, answer)


def content_blocks(col: Column, style: str = "tool_use") -> Column:
    """``struct(raw_response, reasoning)`` from a VARIANT message content.

    A string is the response itself. In a list, reasoning is the text of the first reasoning
    block; the response is the first ``text`` block's text or the first ``tool_use`` block's
    input. A reasoning block without text leaves both null.
    """
    path = {"text": "$.text", "tool_use": "$.input"}[style]
    blocks = F.try_variant_get(col, "$", "array<variant>")

    def first_of(kind: str) -> Column:
        found = F.filter(blocks, lambda b: F.try_variant_get(b, "$.type", "string") == kind)
        return F.try_element_at(found, F.lit(1))

    thought = first_of("reasoning_content")
    text = F.try_variant_get(thought, "$.reasoning_content.text", "variant")
    broken = thought.isNotNull() & text.isNull()
    answer = F.when(~broken, F.try_variant_get(first_of(style), path, "variant"))
    plain = F.schema_of_variant(col) == "STRING"
    return F.struct(
        F.when(plain, col.cast("string")).otherwise(_variant_text(answer)).alias("raw_response"),
        F.when(~plain, text.cast("string")).alias("reasoning"),
    )


def _variant_text(v: Column) -> Column:
    kind = F.schema_of_variant(v)
    return F.when(kind.isin("STRING", "VOID"), v.cast("string")).otherwise(F.to_json(v))
