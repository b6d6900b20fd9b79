import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from passagemill.operators import work
from passagemill.sources import readers, sinks
from passagemill.sources.scratch import scratch_path, shared_folder


def test_shards_are_exact_and_parallel(spark):
    df = spark.range(0, 1003, numPartitions=5).withColumn("k", F.xxhash64("id"))
    rows = work.assign_shards(df, 100, ["k"]).collect()
    sizes = {}
    for r in rows:
        sizes[r.shard] = sizes.get(r.shard, 0) + 1
    assert sizes == {**{f"shard-{i:03d}": 100 for i in range(10)}, "shard-010": 3}
    order = sorted(rows, key=lambda r: r.k)
    assert [r.shard for r in order] == sorted(r.shard for r in rows)
    plan = plan_of(work.assign_shards(df, 100, ["k"]))
    assert "SinglePartition" not in plan and "Window" not in plan


def test_hot_value_spreads_over_partitions(spark):
    """A third of all rows share one sort value; they must not end up in one partition."""
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    placed = work.with_global_position(df, ["k"])
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(r.position for r in placed.collect()) == list(range(3000))
    stored = placed._jdf.inputFiles()
    hot = [spark.read.parquet(f).filter("k = 7").count() for f in stored]
    assert sum(hot) >= 1000 and max(hot) < sum(hot)


def test_source_order_needs_no_shuffle(spark, tmp_path):
    """Files in an order of their own, several splits each; filtered rows take no number."""
    rows = spark.range(3000).withColumn("v", F.format_string("value %d %s", F.hash("id"), F.repeat(F.lit("x"), F.col("id").cast("int") % 90)))
    rows.repartitionByRange(4, "v").sortWithinPartitions("v").write.option("parquet.block.size", 4096).parquet(f"{tmp_path}/p")
    rows.repartitionByRange(4, "v").sortWithinPartitions("v").write.csv(f"{tmp_path}/c")
    wanted = [r.id for r in sorted(rows.filter("id % 7 <> 0").collect(), key=lambda r: r.v)]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 9000)
    try:
        for source in (spark.read.parquet(f"{tmp_path}/p"), spark.read.schema("id BIGINT, v STRING").csv(f"{tmp_path}/c")):
            assert source.rdd.getNumPartitions() > 4
            placed = work.with_source_position(source.filter("id % 7 <> 0").select("id"))
            assert [r.id for r in sorted(placed.collect(), key=lambda r: r.position)] == wanted
            assert sorted(r.position for r in placed.collect()) == list(range(len(wanted)))
            sharded = work.assign_shards(source.filter("id % 7 <> 0"), 100)
            plan = plan_of(sharded)
            assert "Exchange hashpartitioning" not in plan and "rangepartitioning" not in plan and "SinglePartition" not in plan
            joined = work.with_source_position(source.select("id"), most_splits=0)
            assert sorted(r.position for r in joined.collect()) == list(range(3000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_rows_that_left_their_files(spark, tmp_path):
    spark.range(1000).write.parquet(f"{tmp_path}/p")
    source = spark.read.parquet(f"{tmp_path}/p")
    with pytest.raises(ValueError, match="give an order"):
        work.with_source_position(source.repartition(7, "id"))
    assert not work.from_files(spark.range(3))
    assert work.assign_shards(source.repartition(7, "id"), 100, ["id"]).filter("shard = 'shard-003'").agg(F.min("id"), F.max("id")).first()[:] == (300, 399)
    assert work.assign_shards(source.limit(0), 100).count() == 0


def test_shard_names_grow(spark):
    df = spark.range(1, 2)
    assert df.select(F.format_string("shard-%03d", F.lit(1234))).first()[0] == "shard-1234"


def test_empty_input_has_no_shards(spark):
    assert work.assign_shards(spark.range(0), 10).count() == 0


def test_first_per_key_decides_on_places(spark):
    """Only keys, orders and places are aggregated, combined before the shuffle; wide rows are fetched after that."""
    rows = [("a", 2, "x"), ("a", 1, "y"), ("b", 3, None), ("a", 1, "z"), (None, 5, "n"), (None, 4, "m")]
    df = spark.createDataFrame(rows, "id STRING, seq INT, v STRING").coalesce(1)
    first = work.distinct_by_key(df, ["id"], "seq")
    assert {r.id: r.seq for r in first.collect()} == {"a": 1, "b": 3, None: 4} and first.count() == 3
    assert first.columns == df.columns
    path = scratch_path(spark, "wide")
    df.write.parquet(path)
    table = spark.read.parquet(path)
    plan = plan_of(work.first_places(table, ["id"], "seq"))
    assert "partial_min" in plan and "Window " not in plan and "ReadSchema: struct<id:string,seq:int,_tmp_metadata_row_index:bigint>" in plan
    known = spark.createDataFrame([("a",)], "id STRING")
    assert {r.id for r in work.distinct_by_key(table, ["id"], "seq", known, 6).collect()} == {"b", None}


def test_rows_meet_the_shorter_list(spark):
    path = scratch_path(spark, "wide")
    spark.range(100).withColumn("k", F.col("id") % 95).write.parquet(path)
    few = work.distinct_by_key(spark.read.parquet(path), ["k"], "id", total=100)
    assert few.count() == 95 and "LeftAnti" in plan_of(few)
    spark.range(100).withColumn("k", F.col("id") % 5).write.mode("overwrite").parquet(path)
    many = work.distinct_by_key(spark.read.parquet(path), ["k"], "id", total=100)
    assert sorted(r.id for r in many.collect()) == [0, 1, 2, 3, 4] and "LeftSemi" in plan_of(many)


def test_anti_join_plan(spark):
    new, old = spark.range(10), spark.range(5)
    for few_new in (False, True):
        left = work.skip_existing_ids(new, old, ["id"], few_new)
        assert sorted(r.id for r in left.collect()) == [5, 6, 7, 8, 9]
        assert "LeftAnti" in plan_of(left)


def test_hot_join_keys_are_split(spark):
    """Adaptive execution splits the left side of joins on a key that holds most rows."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    for name, value in {"skewedPartitionThresholdInBytes": "2KB", "skewedPartitionFactor": "2.0"}.items():
        spark.conf.set(f"spark.sql.adaptive.skewJoin.{name}", value)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2KB")
    try:
        hot = spark.range(0, 40000, 1, 8).select(F.when(F.col("id") % 3 > 0, F.col("id")).otherwise(F.lit(7)).alias("id"), F.md5(F.col("id").cast("string")).alias("t"))
        ids = spark.range(0, 40000, 1, 8)
        for left in (work.restrict_to_sample(hot, ids, ["id"]), work.skip_existing_ids(hot, ids, ["id"]), hot.join(ids, "id")):
            left.collect()
            assert "skew=true" in plan_of(left)
    finally:
        for name in ("autoBroadcastJoinThreshold", "adaptive.skewJoin.skewedPartitionThresholdInBytes",
                     "adaptive.skewJoin.skewedPartitionFactor", "adaptive.advisoryPartitionSizeInBytes"):
            spark.conf.unset(f"spark.sql.{name}")


def test_semi_join_keeps_repeats(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "id INT")
    ids = spark.createDataFrame([(1,), (1,)], "id INT")
    assert work.restrict_to_sample(df, ids, ["id"]).count() == 2


def test_worklist(spark):
    rows = [("a", "u"), ("a", "u"), ("b", None), ("", "u"), ("c", "u"), ("d" * 300, "u")]
    hits = spark.createDataFrame(rows, "id STRING, url STRING")
    listing = spark.createDataFrame([("c.pdf",)], "name STRING")
    got = sorted(r.name for r in work.download_worklist(hits, listing).collect())
    assert got == ["a.pdf", "a.pdf", "d" * 251 + ".pdf"]


def test_job_files(spark):
    df = spark.createDataFrame([("/x/shard-000.jsonl",), ("b",)], "shard STRING")
    have = spark.createDataFrame([("b-response",)], "name STRING")
    assert [r.name for r in work.pending_outputs(df, have).collect()] == ["shard-000-response.jsonl"]
    status = spark.createDataFrame([("a", "completed"), ("b", "failed")], "shard STRING, status STRING")
    assert not work.all_completed(status).first().completed
    assert work.all_completed(status.filter("shard = 'a'")).first().completed
    assert work.all_completed(status.limit(0)).first().completed


def test_watermark_and_ranges(spark):
    names = spark.createDataFrame([("cid_7.json",), ("cid_12.json",), ("cid_99.txt",), ("x_1.json",)], "name STRING")
    assert work.high_watermark(names).first().last_id == 12
    assert work.high_watermark(names.limit(0)).first().last_id == 0
    assert [r.id for r in work.resume_range(spark, 12, 14).collect()] == [13, 14]
    stored = spark.createDataFrame([(2,), (4,)], "id BIGINT")
    assert sorted(r.id for r in work.resume_range(spark, 4, 5, stored).collect()) == [1, 3, 5]


def test_given_ids(spark):
    assert [tuple(r) for r in work.predefined_worklist(spark, [5, 3, 5]).collect()] == [("given", 0, 5), ("given", 1, 3), ("given", 2, 5)]
    with pytest.raises(ValueError):
        work.predefined_worklist(spark, {"a": 1})
    path = scratch_path(spark, "ids")
    spark.createDataFrame([('{"a": 1}',)], "value STRING").write.text(path)
    with pytest.raises(Exception, match="JSON list"):
        work.predefined_worklist(spark, path).collect()


# --- Sampling -------------------------------------------------------------------------------------


def test_sample_rules(spark):
    df = spark.range(50).withColumn("t", F.lit("x"))
    assert work.sample_rows(df, ["id"], None, size=5).count() == 50
    assert work.sample_rows(df, ["id"], 1).count() == 50
    assert work.sample_rows(df, ["id"], 1, size=5, frac=0.9).count() == 5
    assert work.sample_rows(df, ["id"], 1, frac=0.001).count() == 1
    with pytest.raises(ValueError):
        work.sample_rows(df, ["id"], 1, size=51)
    a, b = ({r.id for r in work.sample_rows(df, ["id"], s, size=20).collect()} for s in (1, 2))
    assert a != b and a == {r.id for r in work.sample_rows(df, ["id"], 1, size=20).collect()}
    ids = work.sample_ids(df, ["id"], 1, size=5)
    assert "TakeOrderedAndProject" in plan_of(ids)


@pytest.mark.parametrize("size", [1, 777, 1999, 2000])
def test_large_samples_take_the_same_ids(spark, monkeypatch, size):
    df = spark.range(2000)
    small = {r.id for r in work.sample_ids(df, ["id"], 3, size=size).collect()}
    monkeypatch.setattr(work.C, "TOP_K_ROWS", 10)
    large = work.sample_ids(df, ["id"], 3, size=size).collect()
    assert len(large) == size and {r.id for r in large} == small


def test_stored_sample_wins_later(spark):
    df, path = spark.range(40), scratch_path(spark, "sample")
    first = {r.id for r in work.persisted_sample(df, ["id"], path, 1, size=8).collect()}
    again = {r.id for r in work.persisted_sample(df, ["id"], path, 2, size=3).collect()}
    assert len(first) == 8 and first == again


# --- Sources and sinks ----------------------------------------------------------------------------


def test_shared_folder_is_required_off_local(spark, monkeypatch):
    class Conf:
        def __init__(self, values):
            self.values = values

        def get(self, key, default=None):
            return self.values.get(key, default)

    class Session:
        conf = Conf({"spark.master": "yarn"})

    with pytest.raises(ValueError):
        shared_folder(Session)
    Session.conf = Conf({"spark.master": "yarn", "spark.checkpoint.dir": "hdfs:///c/"})
    assert shared_folder(Session) == "hdfs:///c"


def test_source_rules(spark):
    assert readers.check_source("x/Y.CSV") == "csv"
    assert readers.check_source("owner/data") == "parquet"
    with pytest.raises(ValueError):
        readers.check_source("a/b/c")
    with pytest.raises(ValueError, match="missing columns: t"):
        readers.require_columns(spark.range(1), ["id", "t"])


def test_csv_round_trip(spark):
    path = scratch_path(spark, "t") + ".csv"
    rows = [(1, ' a "q", \\ \n b '), (2, "NA"), (3, "null"), (4, "x")]
    sinks.write_csv(spark.createDataFrame(rows, "id INT, t STRING"), path)
    got = readers.read_passages(spark, path, "t", ["id"], schema="id INT, t STRING").orderBy("id").collect()
    assert [tuple(r) for r in got] == [(1, ' a "q", \\ \n b '), (2, None), (3, None), (4, "x")]


def test_response_files(spark):
    folder = scratch_path(spark, "r")
    spark.createDataFrame([("{}",)], "value STRING").write.text(folder)
    assert readers.read_responses(spark, folder).count() == 0  # no .jsonl name
    assert readers.read_responses(spark, [folder, folder]).count() == 2


def test_file_names_read_no_content(spark):
    folder = scratch_path(spark, "f")
    spark.range(1).write.parquet(folder)
    names = readers.file_names(spark, folder, "*.parquet")
    assert names.first().name.endswith(".parquet")
    assert "content" not in plan_of(names).split("ReadSchema")[1]


def test_append_is_idempotent(spark):
    path = scratch_path(spark, "t")
    for ids in (range(3), range(5), range(5)):
        sinks.append_table(spark.createDataFrame([(i,) for i in ids], "id INT"), path, ["id"])
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [0, 1, 2, 3, 4]


def test_dataset_configs_are_kept_apart(spark):
    path = scratch_path(spark, "d")
    df = spark.createDataFrame([("a", 0, "x")], "id STRING, idx INT, paragraph STRING")
    for config in ("one", "two", "one"):
        sinks.save_paragraph_dataset(df, path, config)
    assert sorted(r.config for r in spark.read.parquet(path).collect()) == ["one", "two"]


def test_filter_reaches_the_scan(spark):
    path = scratch_path(spark, "p")
    spark.range(10).withColumn("t", F.lit("x")).withColumn("u", F.lit("y")).write.parquet(path)
    df = spark.read.parquet(path).filter("id > 5").select("id")
    plan = plan_of(work.skip_existing_ids(df, spark.range(2), ["id"]))
    assert "PushedFilters: [IsNotNull(id), GreaterThan(id,5)]" in plan
    assert "ReadSchema: struct<id:bigint>" in plan


def test_a_batch_reads_only_its_buckets(spark):
    path = scratch_path(spark, "dealt")
    rows = spark.range(2000).selectExpr("id", "concat('v', id) as v")
    sinks.append_table(rows, path, ["id"], buckets=32)
    batch = spark.createDataFrame([(5, "new"), (5, "again"), (3000, "x"), (None, "n")], "id LONG, v STRING")
    target = spark.read.parquet(path)
    known = sinks.stored_keys(target, batch.na.drop(subset=["id"]), ["id"], 32)
    assert "PartitionFilters: [isnotnull(bucket_of_32" in plan_of(known) or "PartitionFilters: [bucket_of_32" in plan_of(known)
    assert 0 < len(known.select("id").inputFiles()) and known.select("id").count() < 2000 / 32 * 2 * 1.6
    rejects = sinks.append_table(batch, path, ["id"], buckets=32)
    assert [r.v for r in rejects.collect()] == ["n"]
    stored_rows = spark.read.parquet(path)
    assert stored_rows.count() == 2001 and stored_rows.filter("id = 5").first().v == "v5"
    with pytest.raises(ValueError, match="bucket_of_32"):
        sinks.append_table(batch, path, ["id"], buckets=8)
