"""Requests, responses and the question/passage pairs made from them."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from passagemill import constants as C
from passagemill import schemas as S
from passagemill.functions.answers import json_question
from passagemill.functions.common import compute_once
from passagemill.functions.text import count_tokens, split_custom_id
from passagemill.sources.readers import drop_malformed, is_malformed, parse_lines


def request_line(
    custom_id: Column,
    prompt: Column,
    model: str,
    params: Mapping[str, Any] | None = None,
    response_format: Mapping[str, Any] = C.QUESTION_RESPONSE_FORMAT,
) -> Column:
    """One request as JSON text. ``params`` may override the standard body fields."""
    body: dict[str, Any] = {
        "model": model,
        "messages": F.array(F.struct(F.lit("user").alias("role"), prompt.alias("content"))),
        "response_format": dict(response_format),
        **(params or {}),
    }
    if model in C.MODELS_WITHOUT_TEMPERATURE:
        if "temperature" not in body:
            raise ValueError(f"model {model} expects a temperature to leave out")
        del body["temperature"]
    fields = [
        (v if isinstance(v, Column) else F.parse_json(F.lit(json.dumps(v)))).alias(k)
        for k, v in body.items()
    ]
    task = F.struct(
        custom_id.alias("custom_id"),
        F.lit(C.REQUEST_METHOD).alias("method"),
        F.lit(C.REQUEST_URL).alias("url"),
        F.struct(*fields).alias("body"),
    )
    return F.to_json(task, {"ignoreNullFields": "false"})


def input_token_total(requests: DataFrame, prompt: str = "prompt", counter=None) -> DataFrame:
    """One row ``(input_tokens, shards)``; zeros for no requests."""
    return requests.agg(
        F.coalesce(F.sum(count_tokens(F.col(prompt), counter)), F.lit(0)).cast("bigint").alias("input_tokens"),
        F.count_distinct("shard").alias("shards"),
    )


def response_message(lines: DataFrame) -> DataFrame:
    """``(custom_id, content, completion_tokens)`` of each well-formed line that has a choice."""
    good = drop_malformed(parse_lines(lines, S.RESPONSE_LINE))
    body = F.col("j.response.body")
    return good.filter(F.size(F.coalesce(body["choices"], F.array())) > 0).select(
        F.coalesce("j.custom_id", F.lit("")).alias("custom_id"),
        F.coalesce(F.get(body["choices"], F.lit(0))["message"]["content"], F.lit("")).alias("content"),
        F.coalesce(body["usage"]["completion_tokens"], F.lit(0)).alias("completion_tokens"),
    )


def drop_errors(df: DataFrame, error: str = "error") -> DataFrame:
    """Rows without an error: null, empty and JSON-falsy texts count as none."""
    falsy = F.col(error).isin("", "false", "0", "{}", "[]", "null")
    return df.filter(F.col(error).isNull() | falsy)


def response_fields(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """All fields of each answer without an error, and its ``custom_id``."""
    good = drop_malformed(parse_lines(lines, S.RESPONSE_LINE))
    kept = drop_errors(good.select("j.custom_id", "j.error", "j.response"))
    content = F.get(F.col("response.body.choices"), F.lit(0))["message"]["content"]
    return kept.select(F.from_json(content, schema).alias("a"), "custom_id").select(
        *[f"a.{n}" for n in schema.fieldNames()], "custom_id"
    )


def completion_token_total(messages: DataFrame) -> DataFrame:
    """One row ``completion_tokens`` over the rows of :func:`response_message`."""
    return messages.agg(
        F.coalesce(F.sum("completion_tokens"), F.lit(0)).alias("completion_tokens")
    )


def parsed_responses(lines: DataFrame, id_cols: Sequence[str]) -> DataFrame:
    """Id columns as text, and ``generated_query``."""
    answered = compute_once(response_message(lines), generated_query=json_question(F.col("content")))
    return answered.select(*split_custom_id(F.col("custom_id"), id_cols), "generated_query")


def judged_responses(
    lines: DataFrame, source: DataFrame, id_cols: Sequence[str]
) -> DataFrame:
    """``(value, id columns, generated_query, reason)`` of every response line, parsed once.

    ``reason`` is null for a line that gives pairs, else the first of: malformed, no choice, id does
    not fit, no question, no passage.
    """
    parsed = parse_lines(lines, S.RESPONSE_LINE)
    choices = F.coalesce(F.col("j.response.body.choices"), F.array())
    content = F.coalesce(F.get(choices, F.lit(0))["message"]["content"], F.lit(""))
    rows = parsed.select(
        "value",
        is_malformed("j").alias("_bad"),
        F.when(F.size(choices) > 0, content).alias("_content"),
        *split_custom_id(F.coalesce("j.custom_id", F.lit("")), id_cols),
    )
    answered = compute_once(rows, generated_query=json_question(F.col("_content")))
    cast = cast_ids(answered, source.schema, id_cols)
    unfit = F.lit(False)
    for name in id_cols:
        unfit = unfit | F.col(name).isNull()
    known = source.select(*id_cols).distinct().withColumn("_known", F.lit(True))
    reason = (
        F.when(F.col("_bad"), "malformed")
        .when(F.col("_content").isNull(), "no choice")
        .when(unfit, "id does not fit")
        .when(F.col("generated_query").isNull(), "no question")
        .when(F.col("_known").isNull(), "no passage")
    )
    return cast.join(known, list(id_cols), "left").select("value", *id_cols, "generated_query", reason.alias("reason"))


def cast_ids(df: DataFrame, schema: T.StructType, id_cols: Sequence[str]) -> DataFrame:
    """Give text ids the source's types; a text that does not fit becomes null."""
    types = {f.name: f.dataType for f in schema.fields}
    return df.select(
        *[F.col(c).try_cast(types[c]).alias(c) if c in id_cols and c in types else F.col(c) for c in df.columns]
    )


def attach_questions(source: DataFrame, responses: DataFrame, id_cols: Sequence[str]) -> DataFrame:
    """Inner join on the ids; repeated keys multiply. Hot keys are split by adaptive execution."""
    return source.join(cast_ids(responses, source.schema, id_cols), list(id_cols))


def drop_incomplete(df: DataFrame, counted: Observation | None = None) -> DataFrame:
    """Drop rows with a null or NaN in any column; empty text stays.

    With an observation, ``rows`` and ``dropped`` are counted in the same pass.
    """
    gone = F.lit(False)
    for name, kind in df.dtypes:
        col = F.col(f"`{name}`")
        gone = gone | (col.isNull() | F.isnan(col) if kind in ("double", "float") else col.isNull())
    if counted is not None:
        df = df.observe(
            counted, F.count(F.lit(1)).alias("rows"), F.count_if(gone).alias("dropped")
        )
    return df.filter(~gone)


def two_hop_report(df: DataFrame, text: str) -> DataFrame:
    """Where the two support chunks lie in the passage, and what is wrong with them.

    Only reports: no row is changed or dropped. Positions are 1-based, 0 means not found.
    """
    start1, start2 = F.instr(text, F.col("chunk1")), F.instr(text, F.col("chunk2"))
    found1, found2 = (F.col("chunk1") != "") & (start1 > 0), (F.col("chunk2") != "") & (start2 > 0)
    overlap = (
        found1
        & found2
        & (start1 < start2 + F.length("chunk2"))
        & (start2 < start1 + F.length("chunk1"))
    )
    return df.select(
        "*",
        start1.alias("start1"),
        start2.alias("start2"),
        F.when(~found1 | ~found2, "missing chunk")
        .when(overlap, "overlap")
        .otherwise("ok")
        .alias("verdict"),
    )
