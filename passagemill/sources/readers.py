"""Readers. Lines keep their file position so that "first" and "last" are well defined."""

from __future__ import annotations

import os.path
import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from passagemill import constants as C
from passagemill import schemas as S
from passagemill.functions.common import compute_once


def read_lines(spark: SparkSession, paths: str | Sequence[str], glob: str | None = None) -> DataFrame:
    """Lines as ``(value, seq)``; ``seq`` orders lines by file, split start and place in the split."""
    reader = spark.read.format("text")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(paths if isinstance(paths, str) else list(paths)).select(
        "value",
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("start"),
            F.monotonically_increasing_id().alias("row"),
        ).alias("seq"),
    )


def parse_lines(lines: DataFrame, schema: str, col: str = "value") -> DataFrame:
    """Parse JSON lines into struct ``j``; a malformed line has its text in ``j._corrupt``."""
    parsed = F.from_json(
        col, f"{schema}, {S.CORRUPT} STRING", {"columnNameOfCorruptRecord": S.CORRUPT}
    )
    return compute_once(lines, j=parsed)


def is_malformed(col: str):
    return F.col("j").isNull() | F.col(f"j.{S.CORRUPT}").isNotNull()


def drop_malformed(parsed: DataFrame) -> DataFrame:
    return parsed.filter(~is_malformed("j"))


def malformed(parsed: DataFrame) -> DataFrame:
    """The rejected lines, for a side table."""
    return parsed.filter(is_malformed("j")).drop("j")


def parse_preprints(lines: DataFrame, col: str = "value") -> DataFrame:
    """Well-formed hits as ``(item, value, …)``; other columns of ``lines`` are kept."""
    good = drop_malformed(parse_lines(lines, S.PREPRINT_HIT, col))
    return good.withColumn("item", F.col("j.item")).drop("j")


def read_preprints(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Preprint log lines: ``(value, seq, item)``."""
    return parse_preprints(read_lines(spark, path))


def document_id(path):
    """File name without ``.xml``, up to its first dot."""
    stem = F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.xml$", "")
    return F.substring_index(stem, ".", 1)


def read_tei(spark: SparkSession, folder: str) -> DataFrame:
    """The ``*.xml`` files of one flat folder as ``(path, doc_id, content)``.

    Spark counts a file as 4 MB and so puts about thirty into a partition. Partitions of small
    files are taken together, without a shuffle, so that there is not a task for every few of them.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.xml").load(folder)
    cores = spark.sparkContext.defaultParallelism
    files = files.coalesce(max(4 * cores, files.rdd.getNumPartitions() // C.PARTS_PER_TASK))
    return files.select("path", document_id(F.col("path")).alias("doc_id"), "content")


def read_compounds(spark: SparkSession, folder: str, one_per_file: bool = True) -> DataFrame:
    """Compound records. ``one_per_file=False`` reads packed files of one record per line."""
    reader = spark.read.schema(S.COMPOUND_RECORD).option("pathGlobFilter", "*.json")
    return reader.json(folder, multiLine=one_per_file)


def check_source(path: str) -> str:
    """``csv``, ``parquet`` or an error: an existing path, a .csv location or a two-part name."""
    if path.lower().endswith(".csv"):
        return "csv"
    if os.path.exists(path) or "://" in path or len(path.split("/")) == 2:
        return "parquet"
    raise ValueError("source must be an existing path, end in .csv, or be a two-part table name")


def read_passages(
    spark: SparkSession,
    path: str,
    text_col: str,
    id_cols: Sequence[str],
    fmt: str | None = None,
    na_values: Sequence[str] = C.CSV_MISSING,
    schema: str | None = None,
    config: str | None = None,
) -> DataFrame:
    """Passages from CSV, Parquet or a table of the catalog. In CSV text, ``na_values`` are missing values.

    A two-part name, ``owner/data``, is the table ``owner.data`` if the catalog has it. ``config``
    selects one published config; only its folder is read.

    Quoted fields may span lines, so one CSV file is one task: give many files, or Parquet.
    """
    name = path.replace("/", ".")
    if fmt is None and re.fullmatch(r"\w+[./]\w+", path) and spark.catalog.tableExists(name):
        fmt, df = "table", spark.table(name)
    fmt = fmt or check_source(path)
    if fmt == "table":
        pass
    elif fmt == "csv":
        reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"')
        df = (reader.schema(schema) if schema else reader).csv(path)
        df = df.select(
            *[
                F.when(~F.col(f"`{n}`").isin(*na_values), F.col(f"`{n}`")).alias(n)
                if t == "string"
                else F.col(f"`{n}`")
                for n, t in df.dtypes
            ]
        )
    else:
        df = spark.read.parquet(path)
        df = df if config else spread(df)
    if config:
        require_columns(df, ["config"])
        df = df.filter(F.col("config") == config).drop("config")
    require_columns(df, [*id_cols, text_col])
    return df


def spread(scan: DataFrame) -> DataFrame:
    """Use all cores for costly per-row work on a scan of few files.

    Only a scan with fewer partitions than the session has cores is shuffled, so this never
    touches large inputs. ``scan`` must be a plain read: its partitions are counted.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores)


def require_columns(df: DataFrame, names: Sequence[str]) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")


def read_responses(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """All lines of the ``*.jsonl`` files of a folder, or of the given files."""
    return read_lines(spark, paths, "*.jsonl" if isinstance(paths, str) else None)


def union_lines(frames: Sequence[DataFrame]) -> DataFrame:
    """Bag union: no line is dropped, no order promised."""
    first, *rest = frames
    for df in rest:
        first = first.unionByName(df)
    return first


def parse_unigram_counts(lines: DataFrame, strict: bool = False) -> DataFrame:
    """``(word, n)`` from ``word,count`` lines ``(value, seq)``.

    Non-numeric counts (a header) are dropped and the last line of a repeated word counts.
    A line without a comma fails when ``strict``, else it is dropped.
    """
    parts = F.split(F.trim("value"), ",", 2)
    rows = lines.select(parts[0].alias("word"), F.get(parts, F.lit(1)).alias("count"), "seq")
    if strict:
        rows = rows.withColumn(
            "count",
            F.coalesce("count", F.raise_error(F.concat(F.lit("no comma after "), "word")).cast("string")),
        )
    rows = rows.filter(F.col("count").rlike("^[0-9]+$"))
    return rows.groupBy("word").agg(F.max_by(F.col("count").cast("bigint"), "seq").alias("n"))


def read_unigram_counts(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    return parse_unigram_counts(read_lines(spark, path), strict)


def file_names(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """Names of stored files as ``(name)``. Only paths are read, never contents."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("name"))


def existing_table(spark: SparkSession, path: str, schema) -> DataFrame | None:
    """A stored Parquet table under its declared schema, or None where nothing is stored yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
