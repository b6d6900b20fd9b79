"""Work control: what is new, what is left, which rows, in which shard.

Semi and anti joins first make the right side distinct (combined map-side), so a hot key on
that side is one row; a hot key on the left side is split by adaptive execution. Nothing here is
broadcast by hint, so Spark's own size check decides.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from passagemill import constants as C
from passagemill.functions.text import natural_order, safe_filename, split_name
from passagemill.sources.readers import existing_table
from passagemill.sources.scratch import stored


def _keys(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.select(*names).distinct()


def has_id(col: str | Column = "id") -> Column:
    col = F.col(col) if isinstance(col, str) else col
    return F.coalesce(col != "", F.lit(False))


def has_id_and_url(id_col: str | Column, url_col: str | Column) -> Column:
    return has_id(id_col) & has_id(url_col)


def skip_existing_ids(
    new: DataFrame, existing: DataFrame, key: Sequence[str], few_new: bool = False
) -> DataFrame:
    """Rows of ``new`` whose key is not in ``existing``.

    ``few_new`` is for a small batch against a large table: the table is first reduced to the
    keys of the batch by a semi join. Spark broadcasts those keys when their size allows, and
    the stored ids are then scanned but not shuffled.
    """
    known = existing.select(*key)
    if few_new:
        known = known.join(_keys(new, key), list(key), "left_semi")
    return new.join(known.distinct(), list(key), "left_anti")


def restrict_to_sample(df: DataFrame, ids: DataFrame, id_cols: Sequence[str]) -> DataFrame:
    """All rows of the sampled ids, repeats included."""
    return df.join(_keys(ids, id_cols), list(id_cols), "left_semi")


def skip_processed(
    df: DataFrame, cache: DataFrame, id_cols: Sequence[str], retry_errors: bool = False
) -> DataFrame:
    """Passages without a cached result. Failed rows count as done unless ``retry_errors``."""
    done = cache.filter(F.col("error").isNull()) if retry_errors else cache
    return skip_existing_ids(df, done.select(*[F.col(f"raw.{c}").alias(c) for c in id_cols]), id_cols)


def _place() -> list[Column]:
    """Where a row of stored Parquet files is: a hash of its file, and its number in it."""
    return [F.xxhash64("_metadata.file_path").alias("_f"), F.col("_metadata.row_index").alias("_r")]


def first_places(rows: DataFrame, key: Sequence[str], order: str, known: DataFrame | None = None) -> DataFrame:
    """Places ``_f, _r`` of the first row per key in ``order``, without keys that ``known`` holds.

    ``rows`` reads stored Parquet files, of which only the key and order columns are read. Each task
    keeps one place per key before the shuffle. Equal orders are decided by place.
    """
    narrow = rows.select(*key, F.col(order).alias("_order"), *_place())
    if known is not None:
        narrow = skip_existing_ids(narrow, known, key, few_new=True)
    first = narrow.groupBy(*key).agg(F.min(F.struct("_order", "_f", "_r")).alias("_first"))
    return first.select("_first._f", "_first._r")


def rows_at(rows: DataFrame, places: DataFrame, total: int, wanted: int) -> DataFrame:
    """The stored rows at the given places; wide rows meet whichever list is shorter.

    If nearly all rows are wanted, the few that are not are looked up instead, so that Spark can
    broadcast them and the wide rows stay where they are.
    """
    if wanted == total:
        return rows
    placed = rows.select("*", *_place())
    if 2 * wanted <= total:
        return placed.join(places, ["_f", "_r"], "left_semi").drop("_f", "_r")
    unwanted = rows.select(*_place()).join(places, ["_f", "_r"], "left_anti")
    return placed.join(unwanted, ["_f", "_r"], "left_anti").drop("_f", "_r")


def distinct_by_key(
    df: DataFrame, key: Sequence[str], order: str, known: DataFrame | None = None, total: int | None = None
) -> DataFrame:
    """First row per key in ``order``, without rows whose key ``known`` holds. A null key is a key.

    The decision is made on keys, orders and places alone; wide rows are neither aggregated nor
    compared. ``df`` is computed once and written, unless it reads stored files, of ``total`` rows.
    """
    if total is None:
        seen = Observation()
        rows = stored(df.observe(seen, F.count(F.lit(1)).alias("n")), "rows")
        total = seen.get["n"]
    else:
        rows = df
    met = Observation()
    places = stored(first_places(rows, key, order, known).observe(met, F.count(F.lit(1)).alias("n")), "first-rows")
    return rows_at(rows, places, total, met.get["n"])


def download_worklist(hits: DataFrame, listing: DataFrame) -> DataFrame:
    """Hits ``(id, url)`` whose ``{id}.pdf`` is not among the stored names; repeats stay."""
    named = hits.filter(has_id_and_url("id", "url")).select(
        "id", "url", safe_filename(F.concat("id", F.lit(".pdf"))).alias("name")
    )
    return named.join(_keys(listing, ["name"]), "name", "left_anti").select("id", "url", "name")


def response_name(shard: Column) -> Column:
    """``a.jsonl`` → ``a-response.jsonl``."""
    stem, ext = split_name(F.element_at(F.split(shard, "/"), -1))
    return F.concat(stem, F.lit("-response"), ext)


def pending_outputs(shards: DataFrame, existing: DataFrame) -> DataFrame:
    """Shards whose response file is not stored yet, with the name it will have."""
    named = shards.withColumn("name", response_name(F.col("shard")))
    return named.join(_keys(existing, ["name"]), "name", "left_anti").select(*shards.columns, "name")


def all_completed(status: DataFrame) -> DataFrame:
    """One row ``completed``; true when there is no job at all."""
    done = F.bool_and(F.col("status") == "completed")
    return status.agg(F.coalesce(done, F.lit(True)).alias("completed"))


def stored_number(name: Column, prefix: str = C.STORED_PREFIX) -> Column:
    pattern = rf"^{prefix}(\d+)(?:[._].*)?\.json$"
    return F.when(name.rlike(pattern), F.regexp_extract(name, pattern, 1).cast("bigint"))


def high_watermark(listing: DataFrame, prefix: str = C.STORED_PREFIX) -> DataFrame:
    """One row ``last_id``: the largest stored number, 0 when nothing is stored."""
    return listing.agg(
        F.coalesce(F.max(stored_number(F.col("name"), prefix)), F.lit(0)).alias("last_id")
    )


def resume_range(
    spark: SparkSession, last: int, max_id: int, stored_ids: DataFrame | None = None
) -> DataFrame:
    """Ids still to fetch: ``last+1 … max_id``, or every gap if ``stored_ids`` is given."""
    if stored_ids is None:
        return spark.range(last + 1, max_id + 1)
    return spark.range(1, max_id + 1).join(_keys(stored_ids, ["id"]), "id", "left_anti")


def predefined_worklist(spark: SparkSession, ids: Sequence[int] | str) -> DataFrame:
    """A given list, or JSON files holding one each, as ``(list, pos, id)``; nothing is skipped."""
    if isinstance(ids, str):
        text = spark.read.text(ids, wholetext=True)
        listed = F.coalesce(
            F.from_json("value", "array<bigint>"),
            F.raise_error(F.lit("the id file must hold a JSON list")).cast("array<bigint>"),
        )
        name = F.element_at(F.split("_metadata.file_path", "/"), -1).alias("list")
        return text.select(name, F.posexplode(listed).alias("pos", "id"))
    if not isinstance(ids, (list, tuple)):
        raise ValueError("ids must be a list")
    rows = spark.createDataFrame(list(enumerate(ids)), "pos INT, id BIGINT")
    return rows.select(F.lit("given").alias("list"), "pos", "id")


def _tie_break(df: DataFrame) -> Column:
    plain = [
        f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))
    ]
    return F.xxhash64(*[F.col(f"`{n}`") for n in plain])


def with_global_position(df: DataFrame, order: Sequence[str | Column], out: str = "position") -> DataFrame:
    """0-based position of every row in a total order, without gathering rows in one task.

    A range shuffle sorts the rows; partition sizes, one number per partition, give each
    partition its offset. Ties are broken by row hash and then by input place, so a hot value
    spreads over partitions. The sorted rows are written to the shared folder between the two
    passes: a lost executor cannot move rows between partitions afterwards.
    """
    spark = df.sparkSession
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    names = [f"_o{i}" for i in range(len(cols))]
    keyed = df.select(
        "*",
        *[c.alias(n) for c, n in zip(cols, names)],
        _tie_break(df).alias("_tie"),
        F.monotonically_increasing_id().alias("_in"),
    )
    keys = [*names, "_tie", "_in"]
    placed = (
        keyed.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .select(*df.columns, F.monotonically_increasing_id().alias("_row"))
        .select(
            *df.columns,
            F.shiftright("_row", 33).alias("_part"),
            F.col("_row").bitwiseAND(F.lit((1 << 33) - 1)).alias("_local"),
        )
    )
    rows = stored(placed, "sorted")
    sizes = sorted(rows.groupBy("_part").count().collect())  # one row per partition
    starts = accumulate((n for _, n in sizes[:-1]), initial=0)
    offsets = spark.createDataFrame(
        [(part, start) for (part, _), start in zip(sizes, starts)], "_part BIGINT, _start BIGINT"
    )
    joined = rows.join(F.broadcast(offsets), "_part")  # bounded by the partition count
    return joined.select(*df.columns, (F.col("_start") + F.col("_local")).alias(out))


def from_files(df: DataFrame) -> bool:
    """Whether the rows of ``df`` still know the file they were read from."""
    try:
        df.select("_metadata.file_path", "_metadata.file_block_start")
    except AnalysisException:
        return False
    return True


#: Two hashes that name a split of a file.
_SPLIT = (F.xxhash64, lambda *c: F.xxhash64(F.lit(7), *c))


def _splits(rows: DataFrame) -> pa.Table:
    """Per split of a file: its key, its first row number, its rows and the rows before it in the source.

    Paths stay in the executors; the driver gets five numbers a split.
    """
    seen = [F.count(F.lit(1)).alias("n"), F.min("_row").alias("first"), F.max("_row").alias("last")]
    found = stored(rows.groupBy("_file", "_start").agg(*seen), "splits")
    if not found.filter(F.col("last") - F.col("first") + 1 != F.col("n")).isEmpty():
        raise ValueError("rows have left the order of their files; give an order")
    keys = [h("_file", "_start").alias(f"_k{i}") for i, h in enumerate(_SPLIT)]
    table = found.orderBy("_file", "_start").select(*keys, "first", "n").toArrow()
    counts = table["n"].to_numpy()
    return table.append_column("_at", pa.array(np.cumsum(counts) - counts, pa.int64()))


def with_source_position(df: DataFrame, out: str = "position", most_splits: int = C.MOST_SPLITS) -> DataFrame:
    """0-based position of every row in its source: by file path, then by place in the file.

    ``df`` is a scan of files of any format, with projections and filters that keep rows where
    they are; rows that were filtered out take no number. Nothing is shuffled. A first pass counts
    the rows of each split and reads no other columns than the filters need; the second numbers the
    rows of each task and moves each split to its place. The table of splits, three numbers each,
    is measured and broadcast; with more than ``most_splits`` it is joined as Spark sees fit. A pass
    that finds other rows in a split than the first one ends with an error.
    """
    rows = df.select(
        *df.columns,
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_row"),
    )
    table = _splits(rows)
    places = df.sparkSession.createDataFrame(table)
    places = F.broadcast(places) if table.num_rows <= most_splits else places
    keyed = rows.select("*", *[h("_file", "_start").alias(f"_k{i}") for i, h in enumerate(_SPLIT)])
    met = keyed.join(places, [f"_k{i}" for i in range(len(_SPLIT))], "left")
    local = F.col("_row") - F.col("first")
    known = F.coalesce((local >= 0) & (local < F.col("n")), F.lit(False))
    place = F.when(known, F.col("_at") + local).otherwise(F.raise_error(F.lit("the source changed while it was numbered")).cast("long"))
    return met.select(*df.columns, place.alias(out))


def assign_shards(
    df: DataFrame, size: int = C.SHARD_SIZE, order: Sequence[str] | None = None
) -> DataFrame:
    """Add ``shard``: position // size, named ``shard-000`` and on. All but the last are full.

    Positions are those of the source files, found without a shuffle. With an ``order``, or if
    ``df`` does not come straight from files, rows are sorted by it (by the first column).
    """
    if order is None and from_files(df):
        placed = with_source_position(df, "_position")
    else:
        placed = with_global_position(df, order or df.columns[:1], "_position")
    number = F.floor(F.col("_position") / F.lit(size)).cast("int")
    return placed.withColumn("shard", F.format_string(C.SHARD_NAME, number)).drop("_position")


def naturally_ordered(df: DataFrame, name: str, out: str = "position") -> DataFrame:
    """Position of every row when ``name`` is sorted naturally."""
    return with_global_position(df, [natural_order(F.col(name)), F.col(name)], out)


def number_in_group(
    df: DataFrame, group: Sequence[str], order: str, out: str = "idx", block: int = C.BLOCK_ROWS
) -> DataFrame:
    """0-based consecutive number within each group, by integer column ``order``.

    A group is cut into blocks of the order column. Rows are numbered inside their block and
    blocks are offset by the rows of earlier blocks, so a group of any size spreads over tasks.
    ``order`` must be unique within its group, and group columns must not be null.
    """
    keys = [*group, "_block"]
    blocks = df.withColumn("_block", F.floor(F.col(order) / F.lit(block)))
    before = Window.partitionBy(*group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        blocks.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(*keys, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    )
    local = F.row_number().over(Window.partitionBy(*keys).orderBy(order))
    numbered = blocks.withColumn("_local", local).join(starts, keys, "left")
    start = F.coalesce("_start", F.raise_error(F.lit("null in a group column")).cast("bigint"))
    idx = (start + F.col("_local") - 1).cast("int").alias(out)
    return numbered.select(*df.columns, idx)


def sample_ids(
    df: DataFrame,
    id_cols: Sequence[str],
    seed: int | None,
    size: int | None = None,
    frac: float | None = None,
) -> DataFrame | None:
    """Distinct ids of an exact, repeatable, uniform sample without replacement.

    Returns None when no sampling is asked for, that is without a seed or without a size and
    fraction. ``size`` goes before ``frac``, which gives ``max(1, int(rows * frac))``. Repeated ids
    count once; a sample of more ids than there are is an error.
    """
    if seed is None or not (size or frac):
        return None
    rows = df.count()
    k = size or max(1, int(rows * frac))
    if k > rows:
        raise ValueError(f"cannot sample {k} of {rows} rows")
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in id_cols])
    hashed = df.select(*id_cols, F.md5(text).alias("_h"))
    # Hashes are uniform: ids below twice the expected cut are nearly always enough, and only
    # those are made distinct. If they are not (many repeats), all ids are.
    cut = min((2 * k + 100) / rows, 1.0)
    ranked = hashed.filter(F.col("_h") < format(int(cut * 0xFFFFFFFF), "08x")).distinct()
    if cut == 1.0 or ranked.count() < k:
        ranked = hashed.distinct()
        if (found := ranked.count()) < k:
            raise ValueError(f"cannot sample {k} of {found} different ids")
    return _smallest(ranked, ["_h", *id_cols], k).select(*id_cols)


def _smallest(df: DataFrame, order: list[str], k: int) -> DataFrame:
    """The k first rows by hex hash ``order[0]``; large k by counted hash prefixes.

    Whole prefixes below the cut are taken by a filter; only the prefix holding the cut is
    sorted. Counts come back per four hex digits, at most 65,536 numbers at a time.
    """
    taken, pool, lead = None, df, 0
    while k > C.TOP_K_ROWS and lead < 32:
        prefix = F.substring(order[0], lead + 1, 4)
        counts = sorted(pool.groupBy(prefix.alias("p")).count().collect())
        below, cut = 0, None
        for p, n in counts:
            if below + n > k:
                cut = p
                break
            below += n
        lower = pool if cut is None else pool.filter(prefix < cut)
        taken = lower if taken is None else taken.unionByName(lower)
        k -= below
        if cut is None or k == 0:
            return taken
        pool, lead = pool.filter(prefix == cut), lead + 4
    rest = pool.orderBy(*order).limit(k)
    return rest if taken is None else taken.unionByName(rest)


def sample_rows(
    df: DataFrame,
    id_cols: Sequence[str],
    seed: int | None,
    size: int | None = None,
    frac: float | None = None,
) -> DataFrame:
    """All rows of the sampled ids; ``df`` itself when no sampling is asked for."""
    ids = sample_ids(df, id_cols, seed, size, frac)
    return df if ids is None else restrict_to_sample(df, ids, id_cols)


def persisted_sample(
    df: DataFrame,
    id_cols: Sequence[str],
    path: str,
    seed: int | None,
    size: int | None = None,
    frac: float | None = None,
) -> DataFrame:
    """Sample once, store the ids at ``path``, and keep to them in every later run."""
    if seed is None or not (size or frac):
        return df
    schema = df.select(*id_cols).schema
    ids = existing_table(df.sparkSession, path, schema)
    if ids is None:
        sample_ids(df, id_cols, seed, size, frac).write.parquet(path)
        ids = df.sparkSession.read.schema(schema).parquet(path)
    return restrict_to_sample(df, ids, id_cols)
