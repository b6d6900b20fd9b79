"""Job: compound records to the compounds and descriptions tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passagemill.operators import compounds as P
from passagemill.sources import sinks
from passagemill.sources.scratch import job_scope, stored

#: What a record can come to.
ROW, NO_ID = "row", "no id"


def build_compound_tables(
    records: DataFrame,
    compounds_path: str | None = None,
    descriptions_path: str | None = None,
    strict: bool = False,
    rejects_path: str | None = None,
    batch: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """``(compounds, descriptions)``, optionally appended to stored tables by key.

    Records are parsed once, into one row per record that holds both tables' columns and
    the record's outcome. Records without an id are not rows; they go to ``rejects_path`` with their title,
    as do descriptions without a reference: ``(kind, reason, CID, Title, ReferenceNumber,
    Description)``. Rows and rejects together are the input. A repeated ``batch`` replaces its rejects.
    """
    found = P.compounds_table(records, P.described(F.col("Record")).alias("described"))
    judged = found.withColumn("outcome", F.when(F.col("CID").isNull(), NO_ID).otherwise(ROW))
    with job_scope(records.sparkSession):
        parts = stored(judged, "compounds", keep=True)
        flat = parts.filter(F.col("outcome") == ROW).drop("outcome")
        compounds, rows = flat.drop("described"), P.explode_described(flat)
        descriptions = P.only_matched(rows, strict)
        if strict:
            descriptions.write.format("noop").mode("overwrite").save()  # raises before anything is appended
        if rejects_path:
            sinks.replace_batch(_rejects(parts, rows), rejects_path, batch or uuid.uuid4().hex)
        if compounds_path:
            sinks.append_table(compounds, compounds_path, ["CID"])
        if descriptions_path:
            sinks.append_table(descriptions, descriptions_path, ["CID", "ReferenceNumber"])
    return compounds, descriptions


def _rejects(parts: DataFrame, rows: DataFrame) -> DataFrame:
    def reject(kind: str, reason: str) -> list:
        return [F.lit(kind).alias("kind"), F.lit(reason).alias("reason")]

    nameless = parts.filter(F.col("outcome") == NO_ID)
    own = nameless.select(*reject("compound", NO_ID), "CID", "Title", F.lit(None).cast("long").alias("ReferenceNumber"), F.lit(None).cast("string").alias("Description"))
    columns = ["CID", "Title", "ReferenceNumber", "Description"]
    theirs = P.explode_described(nameless).select(*reject("description", NO_ID), *columns)
    unmatched = rows.filter(~F.col("matched")).select(*reject("description", "no reference"), *columns)
    return own.unionByName(theirs).unionByName(unmatched)
