"""Run a caller's generator over partitions, and the result cache around it."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from passagemill import constants as C
from passagemill import schemas as S
from passagemill.functions.answers import content_blocks, parse_structured
from passagemill.functions.common import bind, compute_once

_CALL = (
    "content STRING, input_tokens BIGINT, output_tokens BIGINT, latency DOUBLE, "
    "called_at TIMESTAMP, error STRING"
)


#: Columns of an answer, in order.
ANSWER = [f.strip().split(" ")[0] for f in _CALL.split(",")]


def answer_of(client: Callable[[str], dict], text: str) -> list:
    """The columns of one call; a failed one has its error and no content."""
    import datetime
    import json

    try:
        answer = client(text)
        found = [json.dumps(answer.get("content")), *(answer.get(c, 0) for c in ("input_tokens", "output_tokens", "latency"))]
        return [*found, datetime.datetime.now(datetime.timezone.utc), None]
    except Exception as problem:
        return [None, 0, 0, 0, datetime.datetime.now(datetime.timezone.utc), str(problem)]


@contextmanager
def call_slot(run: str, slots: int | None):
    """Hold one of the executor's ``slots``, so that its tasks together make that many calls at once.

    A slot is a lock on an empty file in the executor's own temporary folder, which ends with the
    process that holds it. All Python workers of an executor have one parent.
    """
    if not slots:
        yield
        return
    import fcntl
    import os
    import random
    import tempfile
    import time

    folder = os.path.join(tempfile.gettempdir(), f"calls-{os.getppid()}-{run}")
    os.makedirs(folder, exist_ok=True)
    while True:
        for i in random.sample(range(slots), slots):
            lock = open(os.path.join(folder, f"slot-{i}"), "w")
            try:
                fcntl.flock(lock, fcntl.LOCK_EX | fcntl.LOCK_NB)
            except OSError:
                lock.close()
                continue
            try:
                yield
            finally:
                lock.close()
            return
        time.sleep(0.005)


def generate(
    df: DataFrame,
    client_factory: Callable[[], Callable[[str], dict]],
    prompt: str = "prompt",
    workers: int | None = None,
    cooldown: float = 0.0,
) -> DataFrame:
    """Call a generator once per row and add the columns of its answer.

    A client maps a prompt to ``{content, input_tokens, output_tokens, latency}``; content is text
    or a list of blocks. A failed call gives an error row. Partitions are left as they are:
    ``workers`` calls run at once on an executor, over all its tasks; each thread that calls
    has its own client. A task has ``C.CALLS_AHEAD`` rows a thread under way and passes rows on as
    they come back, in any order, so a slow call holds up nothing but itself. A retried task calls
    again, so results are to be kept by id. Input columns pass through as Arrow, untouched.
    """
    threads, run = min(workers or 1, C.MOST_THREADS), uuid.uuid4().hex[:12]

    def calls(batches):
        import threading
        import time
        from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait

        import pyarrow as pa

        kinds = [pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.timestamp("us", tz="UTC"), pa.string()]
        own = threading.local()

        def call(text):
            if not hasattr(own, "client"):
                own.client = client_factory()
            with call_slot(run, workers):
                found = answer_of(own.client, text)
                if cooldown:
                    time.sleep(cooldown)
                return found

        def rows(batch, done):
            place, found = pa.array([i for i, _ in done], pa.int64()), list(zip(*(v for _, v in done)))
            columns = [pa.array(v, kind) for v, kind in zip(found, kinds)]
            return pa.RecordBatch.from_arrays([*batch.take(place).columns, *columns], names=[*batch.schema.names, *ANSWER])

        if not workers:  # one call after the other
            for batch in batches:
                texts = batch.column(prompt).to_pylist()
                for low in range(0, len(texts), C.CALLS_PER_BATCH):
                    some = range(low, min(low + C.CALLS_PER_BATCH, len(texts)))
                    yield rows(batch, [(i, call(texts[i])) for i in some])
            return

        with ThreadPoolExecutor(threads) as pool:
            waiting, done = {}, {}  # calls under way; answers per batch that are not passed on yet

            def collect(most):
                """Wait until ``most`` calls are under way at most, and pass on what makes a batch."""
                while len(waiting) > most:
                    for call in wait(waiting, return_when=FIRST_COMPLETED).done:
                        number, i = waiting.pop(call)
                        done[number][1].append((i, call.result()))
                        if len(done[number][1]) >= C.CALLS_PER_BATCH:
                            yield rows(*done[number])
                            done[number][1].clear()

            for number, batch in enumerate(batches):
                done[number] = (batch, [])
                for i, text in enumerate(batch.column(prompt).to_pylist()):
                    yield from collect(threads * C.CALLS_AHEAD - 1)
                    waiting[pool.submit(call, text)] = (number, i)
                open_ = {n for n, _ in waiting.values()}
                for n in [n for n in done if n not in open_]:
                    if done[n][1]:
                        yield rows(*done[n])
                    del done[n]
            yield from collect(0)
            for batch, rest in done.values():
                if rest:
                    yield rows(batch, rest)

    schema = T.StructType([*df.schema.fields, *T.StructType.fromDDL(_CALL).fields])
    return df.mapInArrow(calls, schema)


def result_record(
    df: DataFrame, raw_cols: Sequence[str], schema: T.StructType, style: str = "tool_use", model: str | None = None
) -> DataFrame:
    """Cache rows: answer fields, the whole input row as ``raw``, and telemetry.

    A failed call has null answer fields; an unreadable answer has the empty ones. Reasoning
    tokens are not reported by clients and stay 0.
    """
    blocks = compute_once(df, _b=bind(F.try_parse_json("content"), lambda c: content_blocks(c, style)))
    parsed = F.when(F.col("error").isNull(), parse_structured(F.coalesce("_b.raw_response", F.lit("")), schema))
    return compute_once(blocks, _a=parsed).select(
        *[F.col(f"_a.{n}").alias(n) for n in schema.fieldNames()],
        F.struct(*raw_cols).alias("raw"),
        F.col("_b.raw_response").alias("raw_response"),
        "input_tokens",
        "output_tokens",
        F.lit(0).cast("bigint").alias("reasoning_tokens"),
        F.round("latency", 2).alias("latency"),
        F.date_format("called_at", C.CALL_TIME_FORMAT).alias("date"),
        F.col("_b.reasoning").alias("reasoning"),
        "error",
        F.lit(model).cast("string").alias("model"),
    )


def final_projection(cache: DataFrame, id_cols: Sequence[str], text: str) -> DataFrame:
    """Ids, passage and answer fields, in schema order; failed rows have null answers."""
    answers = [c for c in cache.columns if c not in S.TELEMETRY]
    return cache.select(*[F.col(f"raw.{c}").alias(c) for c in [*id_cols, text]], *answers)


def one_per_key(cache: DataFrame, id_cols: Sequence[str]) -> DataFrame:
    """Compact a cache that saw repeated calls: per id the latest row, a good one first."""
    rank = F.struct(F.col("error").isNull(), F.col("date"), F.xxhash64(F.col("raw_response")))
    best = cache.groupBy(*[F.col(f"raw.{c}").alias(f"_k{i}") for i, c in enumerate(id_cols)]).agg(
        F.max_by(F.struct(*cache.columns), rank).alias("_r")
    )
    return best.select("_r.*")


def settled(cache: DataFrame, id_cols: Sequence[str], text: str | None = None) -> DataFrame:
    """The cache without failures of ids that a later call answered, and one row per open failure.

    Answered rows pass untouched; only failed rows, which are few, are compared with them, by
    id: a failure stays settled if its text was mended. Open failures count per id and ``text``.
    """
    good, bad = cache.filter(F.col("error").isNull()), cache.filter(F.col("error").isNotNull())
    names = [f"_k{i}" for i in range(len(id_cols))]
    key = [F.col(f"raw.{c}").alias(n) for c, n in zip(id_cols, names)]
    open_ = bad.select("*", *key).join(good.select(*key).distinct(), names, "left_anti").drop(*names)
    return good.unionByName(one_per_key(open_, [*id_cols, *([text] if text else [])]))


def telemetry_sketches(cache: DataFrame) -> DataFrame:
    """Sums and a quantile sketch of latencies per model and day, to be stored and merged.

    One row per model and day, of a few kilobytes, from any part of a cache, such as one commit.
    """
    return cache.groupBy("model", F.substring("date", 1, 10).alias("day")).agg(
        F.count(F.lit(1)).alias("calls"),
        F.sum("input_tokens").alias("input_tokens"),
        F.sum("output_tokens").alias("output_tokens"),
        F.sum("latency").alias("latency"),
        F.count("latency").alias("timed"),
        F.kll_sketch_agg_double("latency", C.SKETCH_SIZE).alias("latencies"),
        F.count_if(F.col("error").isNotNull()).alias("errors"),
    )


def merged_telemetry(sketches: DataFrame) -> DataFrame:
    """Calls, tokens, latency and failures per model and day, from sketches of any number of parts.

    ``p95_latency`` is an observed latency whose rank is within about one percent of 0.95
    (``C.SKETCH_SIZE``), and exact as long as a sketch holds all values.
    """
    merged = sketches.groupBy("model", "day").agg(
        *[F.sum(c).alias(c) for c in ("calls", "input_tokens", "output_tokens", "latency", "timed", "errors")],
        F.kll_merge_agg_double("latencies", C.SKETCH_SIZE).alias("latencies"),
    )
    return merged.select(
        "model", "day", "calls", "input_tokens", "output_tokens",
        (F.col("latency") / F.col("timed")).alias("mean_latency"),
        F.kll_sketch_get_quantile_double("latencies", F.lit(0.95)).alias("p95_latency"),
        (F.col("errors") / F.col("calls")).alias("error_rate"),
    )


def generation_telemetry(cache: DataFrame) -> DataFrame:
    """Telemetry per model and day of a whole cache."""
    return merged_telemetry(telemetry_sketches(cache))
