"""Small helpers that keep costly expressions from being evaluated more than once."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and hand it to ``body`` as a lambda variable."""
    return F.try_element_at(F.transform(F.array(value), body), F.lit(1))


def run_once(udf):
    """Keep the optimizer from copying a costly UDF into pushed-down filters.

    A deterministic UDF column that a later filter or explode refers to is evaluated again
    below that filter, together with everything computed from it.
    """
    return udf.asNondeterministic()


def compute_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add costly columns so that later filters on them do not compute them again.

    A filter moves below a projection and takes a copy of the expression along; it does not
    move below a generator of its column. The generator here has one element per row.
    """
    for name, value in columns.items():
        df = df.select("*", F.explode_outer(F.array(value)).alias(name))
    return df


def explode_rows(df: DataFrame, keep: Sequence[str | Column], array: Column, name: str) -> DataFrame:
    """``keep`` and one row per array element.

    A plain explode makes the optimizer push a "size > 0" filter below it, which computes the
    array a second time. The outer form does not; its null rows are dropped here.
    """
    rows = df.select(*keep, F.explode_outer(array).alias(name))
    return rows.filter(F.col(name).isNotNull())


def array_pieces(array, most: int = 1 << 20) -> Iterator:
    """Slices of an Arrow array, of about ``most`` bytes each; at least one.

    Spark sends rows to Python by number, not by size; what a batch of long texts is turned into
    there is several times its size, so that is done piece by piece.
    """
    rows = max(1, len(array) * most // max(1, array.nbytes))
    for first in range(0, max(1, len(array)), rows):
        yield array.slice(first, rows)
