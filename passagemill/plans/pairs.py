"""Jobs: passages to request shards, and responses to training pairs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from passagemill import constants as C
from passagemill.functions.text import custom_id, render_prompt
from passagemill.operators import pairs as P
from passagemill.operators.work import assign_shards, from_files
from passagemill.sources import sinks
from passagemill.sources.readers import require_columns
from passagemill.sources.scratch import stored


def build_requests(
    passages: DataFrame,
    id_cols: Sequence[str],
    text: str,
    template: str,
    model: str,
    params: Mapping[str, Any] | None = None,
    shard_size: int = C.SHARD_SIZE,
    path: str | None = None,
    response_format: Mapping[str, Any] = C.QUESTION_RESPONSE_FORMAT,
    order: Sequence[str] | None = None,
) -> DataFrame:
    """``(shard, custom_id, prompt, value)`` per passage, in source order.

    Passages that come straight from files are numbered by their place in them, without a shuffle;
    a first pass over ids and texts counts the usable ones. Others, or with an ``order``, are
    sorted first (by the ids). Prompts are rendered after that and are never stored. Passages
    without an id or text cannot be asked about and are left out; take them with :func:`request_rejects`.
    """
    require_columns(passages, [*id_cols, text])
    usable = passages.select(*id_cols, F.col(text).alias("_text")).na.drop()
    sharded = assign_shards(usable, shard_size, order=order or (None if from_files(usable) else id_cols))
    asked = sharded.select(
        "shard", custom_id(id_cols).alias("custom_id"), render_prompt(template, F.col("_text")).alias("prompt")
    )
    line = P.request_line(F.col("custom_id"), F.col("prompt"), model, params, response_format)
    requests = asked.select("shard", "custom_id", "prompt", line.alias("value"))
    if path:
        sinks.write_request_shards(requests, path)
    return requests


def request_rejects(passages: DataFrame, id_cols: Sequence[str], text: str) -> DataFrame:
    gone = F.lit(False)
    for name in [*id_cols, text]:
        gone = gone | F.col(name).isNull()
    return passages.filter(gone)


def build_training_pairs(
    source: DataFrame,
    lines: DataFrame,
    id_cols: Sequence[str],
    path: str | None = None,
    counted: Observation | None = None,
    rejects_path: str | None = None,
    drop_blank: bool = False,
) -> DataFrame:
    """The passages with their ``generated_query``; incomplete rows are dropped and counted.

    ``rejects_path`` appends every response line that gives no pair, with the reason. An empty
    question is kept unless ``drop_blank``.
    """
    if rejects_path:
        judged = stored(P.judged_responses(lines, source, id_cols), "responses")
        judged.filter("reason is not null").select("value", "reason").write.mode("append").parquet(rejects_path)
        usable = judged.filter("reason is null").select(*id_cols, "generated_query")
        joined = source.join(usable, list(id_cols))
    else:
        joined = P.attach_questions(source, P.parsed_responses(lines, id_cols), id_cols)
    pairs = P.drop_incomplete(joined, counted)
    if drop_blank:
        pairs = pairs.filter(F.trim("generated_query") != "")
    if path:
        sinks.write_csv(pairs, path)
    return pairs


def response_rejects(lines: DataFrame, id_cols: Sequence[str]) -> DataFrame:
    """Responses whose answer holds no question, for a side table."""
    return P.parsed_responses(lines, id_cols).filter(F.col("generated_query").isNull())


def two_hop_pairs(results: DataFrame, text: str) -> DataFrame:
    """Question, chunks and a verdict on the chunks per generated row."""
    return P.two_hop_report(results, text)
