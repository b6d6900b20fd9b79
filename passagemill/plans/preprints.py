"""Job: preprint log lines to the summary table and the raw log."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from passagemill import schemas as S
from passagemill.operators.preprints import project_preprints
from passagemill.operators.work import distinct_by_key, has_id
from passagemill.sources import sinks
from passagemill.sources.readers import existing_table, is_malformed, parse_lines
from passagemill.sources.scratch import job_scope, stored

#: What a line can come to: a row, or the reason why it is none.
ROW, MALFORMED, NO_ID = "row", "malformed", "no id"


def judged_preprints(lines: DataFrame, keep_line: bool = False) -> DataFrame:
    """Every line ``(value, seq)`` parsed once: the table's columns, ``seq``, ``value`` and ``outcome``.

    The line itself stays with rejects; with rows only for the raw log (``keep_line``).
    """
    parsed = parse_lines(lines, S.PREPRINT_HIT)
    outcome = F.when(is_malformed("j"), MALFORMED).when(has_id("j.item.id"), ROW).otherwise(NO_ID)
    judged = parsed.select("value", "seq", F.col("j.item").alias("item"), outcome.alias("outcome"))
    value = F.col("value") if keep_line else F.when(F.col("outcome") != ROW, F.col("value"))
    return project_preprints(judged, keep=["seq", value.alias("value"), "outcome"])


def preprint_rejects(lines: DataFrame) -> DataFrame:
    """``(value, reason)`` of lines that cannot become a row: not readable, or without an id."""
    return judged_preprints(lines).filter(F.col("outcome") != ROW).select("value", F.col("outcome").alias("reason"))


def build_preprint_table(
    lines: DataFrame,
    path: str,
    raw_path: str | None = None,
    rejects_path: str | None = None,
    batch: str | None = None,
) -> DataFrame:
    """Add new preprints to the table at ``path``, their lines to the raw log, unusable lines to the rejects.

    Lines are parsed once and stored with their outcome. Of each id that is not stored yet the first
    line counts; that is decided on ids and places, and the wide rows are fetched after it.

    All outputs are partitioned by ``batch``. A run that repeats a batch, because it failed between
    two outputs or was delivered twice, replaces what that batch wrote; ids of other batches are
    skipped. Without a name a run is a batch of its own. Returns the rows added.
    """
    spark, batch = lines.sparkSession, batch or uuid.uuid4().hex
    with job_scope(spark):
        good = Observation()
        judged = judged_preprints(lines, raw_path is not None).observe(good, F.count_if(F.col("outcome") == ROW).alias("n"))
        judged = stored(judged, "preprints")
        rows = judged.filter(F.col("outcome") == ROW).drop("outcome")
        known = existing_table(spark, path, "id STRING, batch STRING")
        known = known if known is None else known.filter(F.col("batch") != batch).select("id")
        new = distinct_by_key(rows, ["id"], "seq", known, good.get["n"])
        if raw_path:
            sinks.replace_batch(new.select("value"), raw_path, batch, "text")
        if rejects_path:
            rejects = judged.filter(F.col("outcome") != ROW).select("value", F.col("outcome").alias("reason"))
            sinks.replace_batch(rejects, rejects_path, batch)
        table = new.select(*S.PREPRINT_COLUMNS)
        sinks.replace_batch(table, path, batch)
    added = existing_table(spark, path, T.StructType([*table.schema.fields, T.StructField("batch", T.StringType())]))
    return added.filter(F.col("batch") == batch).drop("batch")


def read_preprint_table(spark, path: str) -> DataFrame:
    """The stored table, of all batches."""
    return spark.read.parquet(path).select(*S.PREPRINT_COLUMNS)
