"""Job: run a generator over passages with sampling, resume and a result cache."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from passagemill import schemas as S
from passagemill.functions.text import render_prompt
from passagemill.operators import generate as G
from passagemill.operators.work import persisted_sample, sample_rows, skip_processed
from passagemill.sources import sinks
from passagemill.sources.readers import existing_table, require_columns
from passagemill.sources.scratch import job_scope, stored


def cache_schema(passages: DataFrame, answer: T.StructType) -> T.StructType:
    """Schema of the cache that :func:`generated` fills for these passages."""
    text, whole = T.StringType(), T.LongType()
    fields = [T.StructField(f.name, f.dataType) for f in answer.fields]
    fields += [
        T.StructField("raw", passages.schema),
        T.StructField("raw_response", text),
        T.StructField("input_tokens", whole),
        T.StructField("output_tokens", whole),
        T.StructField("reasoning_tokens", whole),
        T.StructField("latency", T.DoubleType()),
        T.StructField("date", text),
        T.StructField("reasoning", text),
        T.StructField("error", text),
        T.StructField("model", text),
    ]
    return T.StructType(fields)


def generated(
    passages: DataFrame,
    text: str,
    template: str,
    client_factory: Callable,
    answer: T.StructType = S.QUESTION,
    style: str = "tool_use",
    workers: int | None = None,
    cooldown: float = 0.0,
    model: str | None = None,
) -> DataFrame:
    """Cache rows of freshly generated answers."""
    asked = passages.withColumn("_prompt", render_prompt(template, F.col(text)))
    called = G.generate(asked, client_factory, "_prompt", workers, cooldown)
    return G.result_record(called, passages.columns, answer, style, model)


def commit(fresh: DataFrame, cache_path: str, telemetry_path: str | None = None) -> None:
    """Append results to the cache and, from the same calls, their sketches to the telemetry.

    With telemetry the results are written first: they are the only copy of answers that were paid for.
    """
    if telemetry_path is None:
        sinks.append_results(fresh, cache_path)
        return
    rows = stored(fresh, "answers")
    sinks.append_results(rows, cache_path)
    sinks.append_results(G.telemetry_sketches(rows), telemetry_path)


def run_generation(
    passages: DataFrame,
    id_cols: Sequence[str],
    text: str,
    template: str,
    client_factory: Callable,
    cache_path: str,
    sample_path: str | None = None,
    seed: int | None = None,
    size: int | None = None,
    frac: float | None = None,
    answer: T.StructType | str = S.QUESTION,
    style: str = "tool_use",
    workers: int | None = None,
    cooldown: float = 0.0,
    rounds: int = 4,
    retry_errors: bool = False,
    path: str | None = None,
    model: str | None = None,
    telemetry_path: str | None = None,
) -> DataFrame:
    """Generate for every passage not cached yet, append to the cache, return the final table.

    Each round is one commit, so a failed run loses at most one round of calls. What is left to do
    is worked out once and written to the shared folder. Passages with a null id or text cannot
    be asked about and are left out. The final table covers the whole cache, also rows outside
    the current sample, without failures that a retry made good; ``path`` writes it as CSV.
    ``workers`` bounds the calls that run at once on an executor. ``telemetry_path`` gets the
    sums and sketches of every commit, by ``model`` and day, for :func:`merged_telemetry`.
    """
    require_columns(passages, [*id_cols, text])
    passages = passages.na.drop(subset=[*id_cols, text])
    answer = S.answer_schema(answer)
    if sample_path:
        passages = persisted_sample(passages, id_cols, sample_path, seed, size, frac)
    else:
        passages = sample_rows(passages, id_cols, seed, size, frac)
    spark, schema = passages.sparkSession, cache_schema(passages, answer)
    cache = existing_table(spark, cache_path, schema)
    todo = passages if cache is None else skip_processed(passages, cache, id_cols, retry_errors)
    with job_scope(spark):
        todo = stored(todo, "to-do") if rounds > 1 else todo
        for number in range(rounds):
            part = todo.filter(F.pmod(F.xxhash64(*id_cols), F.lit(rounds)) == number) if rounds > 1 else todo
            fresh = generated(part, text, template, client_factory, answer, style, workers, cooldown, model)
            commit(fresh, cache_path, telemetry_path)
    cache = spark.read.schema(schema).parquet(cache_path)
    final = G.final_projection(G.settled(cache, id_cols, text), id_cols, text)
    if path:
        sinks.write_csv(final, path)
    return final
