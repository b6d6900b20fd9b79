"""Incremental forms of the jobs, with Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from passagemill import schemas as S
from passagemill.functions.text import render_prompt
from passagemill.operators import generate as G
from passagemill.operators.work import skip_processed
from passagemill.plans.generation import cache_schema, commit, generated
from passagemill.plans.preprints import build_preprint_table
from passagemill.sources.readers import existing_table
from passagemill.sources.scratch import job_scope, stored


def stream_lines(spark: SparkSession, folder: str, glob: str = "*", files_per_batch: int = 1000) -> DataFrame:
    """New files of a folder as lines ``(value, arrived, file, start)``."""
    reader = spark.readStream.format("text").option("pathGlobFilter", glob)
    meta = F.col("_metadata")
    return reader.option("maxFilesPerTrigger", files_per_batch).load(folder).select(
        "value",
        meta["file_modification_time"].alias("arrived"),
        meta["file_path"].alias("file"),
        meta["file_block_start"].alias("start"),
    )


def arrival_order(batch: DataFrame) -> DataFrame:
    """``(value, seq)`` of one batch: by arrival of the file, then by place in it."""
    seq = F.struct("arrived", "file", "start", F.monotonically_increasing_id().alias("row"))
    return batch.select("value", seq.alias("seq"))


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a started query keeps in its checkpoint, over all restarts."""
    return spark.read.text(f"{checkpoint}/metadata").select(F.get_json_object("value", "$.id")).first()[0]


def ingest_preprints_stream(
    spark: SparkSession,
    folder: str,
    path: str,
    checkpoint: str,
    raw_path: str | None = None,
    files_per_batch: int = 1000,
    rejects_path: str | None = None,
) -> StreamingQuery:
    """Add preprints of new log files to the table; the first arrival of an id stays.

    A micro-batch is a batch of :func:`build_preprint_table`, named by the query and its number: if it
    is delivered again, or was stopped between the outputs, it replaces what it wrote. One writer
    per table.
    """

    names: dict[str, str] = {}

    def add(batch: DataFrame, number: int) -> None:
        if not names:
            names["query"] = stream_id(spark, checkpoint)
        name = f"{names['query']}-{number:09d}"  # no other query and no later batch has it
        build_preprint_table(arrival_order(batch), path, raw_path, rejects_path, name)

    lines = stream_lines(spark, folder, files_per_batch=files_per_batch)
    return (
        lines.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def dedupe_stream(
    df: DataFrame, key: Sequence[str] = ("id",), within: tuple[str, str] | None = None
) -> DataFrame:
    """First row of every key, by engine state that grows with the keys.

    ``within=(time column, delay)`` bounds the state by a watermark instead; a key that comes
    back after the delay is then passed again.
    """
    if within:
        return df.withWatermark(*within).dropDuplicatesWithinWatermark(list(key))
    return df.dropDuplicates(list(key))


_FAILURE = "row STRING, attempt INT, due DOUBLE"


def _decisions(attempts: int):
    """What to ask again, per id: a passage that failed, when it is due.

    The state is what was asked so far, by passage and attempt (1 if it has none), and the failures
    that wait. A report of an attempt that the state has had already, as a repeated batch makes,
    changes nothing.
    """

    def decide(key, frames, state):
        import json
        import time

        import pandas as pd

        known = json.loads(state.get[0]) if state.exists else {"asked": {}, "waiting": []}
        asked, waiting = known["asked"], known["waiting"]
        ask, now = [], time.time()
        for frame in () if state.hasTimedOut else frames:
            for row, attempt, due in zip(frame["row"], frame["attempt"], frame["due"]):
                if isinstance(row, str) and attempt == asked.get(row, 1) and attempt < attempts and all(row != w[0] for w in waiting):
                    waiting.append([row, int(attempt) + 1, float(due)])
        for row, attempt, due in waiting:
            if due <= now:
                ask.append((row, attempt))
                asked[row] = attempt
        waiting = [w for w in waiting if w[2] > now]
        state.update((json.dumps({"asked": asked, "waiting": waiting}),))
        if waiting:
            state.setTimeoutDuration(max(1, int(1000 * (min(w[2] for w in waiting) - now))))
        yield pd.DataFrame(ask, columns=["row", "attempt"])

    return decide


def generate_stream(
    source: DataFrame,
    id_cols: Sequence[str],
    text: str,
    template: str,
    client_factory: Callable,
    cache_path: str,
    checkpoint: str,
    answer: T.StructType = S.QUESTION,
    style: str = "tool_use",
    workers: int | None = None,
    attempts: int = 1,
    retry_after: float = 60.0,
    every: str | None = None,
    model: str | None = None,
    telemetry_path: str | None = None,
) -> StreamingQuery:
    """Send passages of new files to the generator unless their id is cached already.

    As in the batch job, passages with a null id or text are left out, and all passages of a new
    id are sent. ``every`` is the interval of a stream that goes on; without it the stream ends
    when it has read what is there.

    With ``attempts`` above 1 a failed passage is asked again ``retry_after`` seconds after it
    failed, ``attempts`` times in all. Failures come back to the stream through files next to the
    cache; the engine's state counts the attempts of each id that failed and holds a timer, over restarts. A
    stream that has ended asks what fell due when it runs the next time. New passages pass by the
    state, which grows with the ids that fail.
    """
    spark, schema = source.sparkSession, cache_schema(source, answer)
    passages = source.na.drop(subset=[*id_cols, text])
    columns = source.columns

    def unanswered(rows: DataFrame, retry: bool) -> DataFrame:
        cache = existing_table(spark, cache_path, schema)
        return rows if cache is None else skip_processed(rows, cache, id_cols, retry)

    def append(batch: DataFrame, _: int) -> None:
        todo = unanswered(batch, False)
        commit(generated(todo, text, template, client_factory, answer, style, workers, model=model), cache_path, telemetry_path)

    def append_counted(batch: DataFrame, _: int) -> None:
        with job_scope(spark):
            asked = batch.select(F.from_json("row", source.schema).alias("_p"), "attempt").select("_p.*", F.col("attempt").alias("_attempt"))
            asked = stored(asked, "asked")
            todo = unanswered(asked.filter("_attempt = 1"), False).unionByName(unanswered(asked.filter("_attempt > 1"), True))
            prompts = todo.withColumn("_prompt", render_prompt(template, F.col(text)))
            called = stored(G.generate(prompts, client_factory, "_prompt", workers), "answers")
            again = called.filter(F.col("error").isNotNull() & (F.col("_attempt") < attempts))
            due = (F.unix_micros("called_at") / 1e6 + F.lit(retry_after)).alias("due")
            # failures first: a passage whose error is cached is not asked by a repeated batch
            again.select(F.to_json(F.struct(*columns)).alias("row"), F.col("_attempt").alias("attempt"), due).write.mode("append").parquet(failures)
            commit(G.result_record(called, columns, answer, style, model), cache_path, telemetry_path)

    if attempts > 1:
        failures = f"{cache_path.rstrip('/')}-failures"
        # A stream that ends runs one batch; a row without a passage sees to it that timers are looked at.
        tick = [] if every else [(None, 0, 0.0)]
        spark.createDataFrame(tick, _FAILURE).write.mode("append").parquet(failures)
        new = passages.select(F.to_json(F.struct(*columns)).alias("row"), F.lit(1).alias("attempt"))
        failed = spark.readStream.schema(_FAILURE).parquet(failures)
        ids = F.from_json("row", source.schema)
        keyed = failed.select(*[ids[c].alias(f"_k{i}") for i, c in enumerate(id_cols)], "row", "attempt", "due")
        again = keyed.groupBy(*[f"_k{i}" for i in range(len(id_cols))]).applyInPandasWithState(
            _decisions(attempts), "row STRING, attempt INT", "known STRING", "append", "ProcessingTimeTimeout"
        )
        passages = new.unionByName(again)
    writer = passages.writeStream.foreachBatch(append_counted if attempts > 1 else append).option("checkpointLocation", checkpoint)
    if every:
        return writer.trigger(processingTime=every).start()
    # With timers the engine has always another batch to run, so a stream that ends takes all files at once.
    return (writer.trigger(once=True) if attempts > 1 else writer.trigger(availableNow=True)).start()
