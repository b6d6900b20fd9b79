"""Writers. Each one names its save mode; repeating a run does not repeat rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from passagemill.operators.work import distinct_by_key, skip_existing_ids
from passagemill.sources.readers import existing_table


def append_table(df: DataFrame, path: str, key: Sequence[str], buckets: int | None = None) -> DataFrame:
    """Append rows whose key is not stored yet, one per key; returns the rejects, rows with a null key.

    Of rows that share a key the one of least row hash is taken, so repeating a batch adds nothing.
    With ``buckets`` the table is partitioned by a hash of the key, and a batch reads only the
    buckets that its keys fall into, so a small batch does not scan the stored keys of a large
    table. The number of buckets belongs to the table: it is part of the partition's name.
    """
    spark, name = df.sparkSession, f"{BUCKET}{buckets}"
    usable = df.na.drop(subset=list(key))
    dealt = [T.StructField(name, T.IntegerType())] if buckets else []
    target = existing_table(spark, path, T.StructType([*df.schema.fields, *dealt]))
    if target is not None and buckets:
        _same_buckets(spark, path, name)
        target = stored_keys(target, usable, key, buckets)
    if set(df.columns) != set(key):
        plain = [f"`{f.name}`" for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
        new = distinct_by_key(usable.withColumn("_order", F.xxhash64(*plain)), key, "_order", target).drop("_order")
    else:
        new = usable if target is None else skip_existing_ids(usable, target, key, few_new=True)
        new = new.distinct()
    if buckets:
        new.withColumn(name, bucket_of(key, buckets)).repartition(name).write.mode("append").partitionBy(name).parquet(path)
    else:
        new.write.mode("append").parquet(path)
    return df.filter(~F.expr(" and ".join(f"`{c}` is not null" for c in key)))


#: Partition column of a table that is dealt by its key; the number of buckets follows.
BUCKET = "bucket_of_"


def bucket_of(key: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


def stored_keys(target: DataFrame, batch: DataFrame, key: Sequence[str], buckets: int) -> DataFrame:
    """The stored rows that a batch could meet: those of its buckets. Other files are not opened."""
    met = [r[0] for r in batch.select(bucket_of(key, buckets)).distinct().collect()]  # ``buckets`` numbers at most
    return target.filter(F.col(f"{BUCKET}{buckets}").isin(met))


def _same_buckets(spark: SparkSession, path: str, name: str) -> None:
    found = [c for c in spark.read.parquet(path).columns if c.startswith(BUCKET)]
    if found and found != [name]:
        raise ValueError(f"the table is dealt by {found[0]}, not by {name}")


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with header and doubled quotes; arrays and structs become JSON text."""
    nested = (T.ArrayType, T.StructType, T.MapType)
    flat = df.select(
        *[
            F.to_json(f"`{f.name}`").alias(f.name) if isinstance(f.dataType, nested) else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )
    writer = flat.write.mode("overwrite").option("escape", '"').option("emptyValue", "")
    for side in ("Leading", "Trailing"):  # Spark would trim fields on writing
        writer = writer.option(f"ignore{side}WhiteSpace", False)
    writer.csv(path, header=True)


def write_document_arrays(df: DataFrame, path: str) -> None:
    """One JSON line per file: ``{id, paragraphs}``."""
    df.write.mode("overwrite").json(path)


def save_paragraph_dataset(df: DataFrame, path: str, config: str = "default") -> None:
    """Publish a paragraph table under a config name; other configs stay."""
    (
        df.withColumn("config", F.lit(config))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("config")
        .parquet(path)
    )


def write_request_shards(df: DataFrame, path: str) -> None:
    """Request lines ``(shard, value)``, one folder per shard.

    The sharding operator leaves rows in shard order, so a task meets few shards and no
    further shuffle is needed here.
    """
    df.select("shard", "value").write.mode("overwrite").partitionBy("shard").text(path)


def write_merged_lines(df: DataFrame, path: str) -> None:
    df.select("value").write.mode("overwrite").text(path)


def append_raw_log(df: DataFrame, path: str, batch: str | None = None) -> None:
    """Keep accepted hits verbatim, one line each, for later re-parsing.

    A named ``batch`` replaces what it wrote before, so that it can be repeated.
    """
    if batch:
        replace_batch(df.select("value"), path, batch, "text")
    else:
        df.select("value").write.mode("append").text(path)


def replace_batch(df: DataFrame, path: str, batch: str, fmt: str = "parquet") -> None:
    """Write rows as the partition ``batch`` of a table, in place of what that partition held.

    Other partitions are not touched. A batch without rows leaves its partition as it is: the
    same batch has the same rows whenever it is repeated.
    """
    (
        df.withColumn("batch", F.lit(batch))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch")
        .format(fmt)
        .save(path)
    )


def write_job_status(df: DataFrame, path: str) -> None:
    df.select("shard", "batch_id", "status").write.mode("overwrite").parquet(path)


def append_results(df: DataFrame, path: str) -> None:
    """One commit per round of generated results."""
    df.write.mode("append").parquet(path)
