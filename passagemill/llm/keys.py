"""How a row of documents is named: by its id and a hash of its text."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import stored


def text_key(text: Column) -> Column:
    """Two 64-bit hashes of a text."""
    return F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit(7), text).alias("b"))


#: Bits of a filter of row names, per name and at most (8 MB).
BITS_PER_NAME, MOST_BITS = 16, 1 << 26


def may_be_named(names: DataFrame, doc_id: Column, key: Column) -> Column:
    """Whether ``names (doc_id, text_key)`` may hold a row: false for all but a few that it does not hold.

    A bit map of hashes, of bounded size, is put together by tasks and broadcast; a row's hash
    alone goes to Python. In front of a join it spares the texts of other rows the shuffle. With
    more names than the map has room for it lets more rows pass, and the join decides as before.
    """
    bits = 1 << 12
    while bits < min(MOST_BITS, BITS_PER_NAME * names.count()):
        bits *= 2
    hashed = names.select(F.pmod(F.xxhash64("doc_id", "text_key"), F.lit(bits)).alias("h"))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("h") % 64).cast("int"))
    words = hashed.groupBy(F.shiftright("h", 6).alias("w")).agg(F.bit_or(one).alias("b")).toArrow()  # bits / 64 rows at most
    table = np.zeros(bits // 64, np.int64)
    table[words["w"].to_numpy()] = words["b"].to_numpy()
    shared = names.sparkSession.sparkContext.broadcast(table)

    @F.arrow_udf("boolean")
    def maybe(hashes: pa.Array) -> pa.Array:
        h = hashes.to_numpy(zero_copy_only=False)
        return pa.array((shared.value[h >> 6] >> (h & 63)) & 1, pa.int64()).cast(pa.bool_())

    return maybe(F.pmod(F.xxhash64(doc_id, key), F.lit(bits)))


def split_without_rows(docs: DataFrame, rejected: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """As :func:`without_rows`, for many rejected rows: only rows that may be named are joined."""
    names = stored(rejected.select("doc_id", "text_key").distinct(), "rejected")
    maybe = may_be_named(names, F.col(id_col), text_key(F.col(text_col)))
    return docs.filter(~maybe).unionByName(without_rows(docs.filter(maybe), names, id_col, text_col))


def without_rows(docs: DataFrame, rejected: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows of ``docs`` that no row ``doc_id, text_key`` of ``rejected`` names; nulls name nulls.

    Rejected names are written first: Spark broadcasts them if their files are below its limit.
    """
    names = stored(rejected.select("doc_id", "text_key").distinct(), "rejected").alias("r")
    same = F.col(f"d.{id_col}").eqNullSafe(F.col("r.doc_id")) & (text_key(F.col(f"d.{text_col}")) == F.col("r.text_key"))
    return docs.alias("d").join(names, same, "left_anti")
