"""Queries of the preprint operators, work control and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import fixtures as X
from checks import sql as Q
from checks.registry import query
from passagemill.functions import text as T
from passagemill.operators import preprints as P
from passagemill.operators import work
from passagemill.plans import preprints as plan
from passagemill.sources import readers, sinks
from passagemill.sources.scratch import scratch_path
from passagemill.streaming import ingest


def _log(spark, sf):
    """The hit lines as text files, in line order within and across files."""
    folder = scratch_path(spark, "hits")
    lines = X.preprint_lines(spark, sf)
    lines.repartitionByRange("seq").sortWithinPartitions("seq").select("value").write.text(folder)
    return folder


def _hits(spark, sf):
    return readers.parse_preprints(X.preprint_lines(spark, sf))


@query(f"WITH {Q.HITS} SELECT id, title FROM all_hits")
def read_preprints(spark, sf):
    return readers.read_preprints(spark, _log(spark, sf)).select("item.id", "item.title")


@query("SELECT doc_id AS seq FROM documents WHERE doc_id % 40 = 7")
def malformed_lines(spark, sf):
    parsed = readers.parse_lines(X.preprint_lines(spark, sf), "item STRUCT<id STRING>")
    return readers.malformed(parsed).select("seq")


@query("SELECT doc_id AS seq FROM documents WHERE doc_id % 40 <> 7 UNION ALL "
       "SELECT doc_id + 1099511627776 FROM documents WHERE doc_id % 50 = 0")  # fmt: skip
def drop_malformed(spark, sf):
    parsed = readers.parse_lines(X.preprint_lines(spark, sf), "item STRUCT<id STRING>")
    return readers.drop_malformed(parsed).select("seq")


@query(f"WITH {Q.HITS} SELECT seq, id FROM hits")
def has_id(spark, sf):
    return _hits(spark, sf).filter(work.has_id("item.id")).select("seq", "item.id")


@query(f"WITH {Q.HITS} SELECT seq, id FROM hits WHERE doc_id % 4 > 1")
def has_id_and_url(spark, sf):
    hits = _hits(spark, sf)
    kept = hits.filter(work.has_id_and_url("item.id", P.pdf_url(F.col("item"))))
    return kept.select("seq", "item.id")


@query(f"WITH {Q.HITS} SELECT seq, {Q.HIT_KEYWORDS} AS keywords FROM all_hits")
def join_keywords(spark, sf):
    return _hits(spark, sf).select("seq", T.join_keywords(F.col("item.keywords")).alias("keywords"))


@query(
    f"WITH {Q.HITS} SELECT seq, {Q.HIT_AUTHORS} AS authors FROM all_hits LEFT JOIN customer ON c_custkey = doc_id"
)
def format_authors(spark, sf):
    return _hits(spark, sf).select("seq", T.format_authors(F.col("item.authors")).alias("authors"))


@query(f"WITH {Q.HITS} SELECT seq, {Q.HIT_URL} AS url FROM all_hits")
def pdf_url(spark, sf):
    return _hits(spark, sf).select("seq", P.pdf_url(F.col("item")).alias("url"))


@query(f"WITH {Q.HITS} SELECT {Q.HIT_COLUMNS} FROM all_hits LEFT JOIN customer ON c_custkey = doc_id")
def project_preprints(spark, sf):
    return P.project_preprints(_hits(spark, sf))


@query(f"WITH {Q.HITS} SELECT id, title, seq FROM first_hits")
def distinct_by_key(spark, sf):
    hits = _hits(spark, sf).filter(work.has_id("item.id")).select("item.id", "item.title", "seq")
    return work.distinct_by_key(hits, ["id"], "seq")


# Lines before the repeated ones.
ORIGINAL = "seq < 1099511627776"
FIRST = f"WITH {Q.HITS} SELECT {Q.HIT_COLUMNS} FROM first_hits LEFT JOIN customer ON c_custkey = doc_id"


@query(FIRST)
def build_preprint_table(spark, sf):
    path = scratch_path(spark, "preprints")
    lines = X.preprint_lines(spark, sf)
    plan.build_preprint_table(lines.filter(f"seq % 2 = 0 AND {ORIGINAL}"), path)
    plan.build_preprint_table(lines, path)
    return plan.read_preprint_table(spark, path)


@query(f"WITH {Q.HITS} SELECT id, title FROM first_hits")
def append_raw_log(spark, sf):
    path, raw = scratch_path(spark, "preprints"), scratch_path(spark, "raw-log")
    plan.build_preprint_table(X.preprint_lines(spark, sf), path, raw)
    return readers.read_preprints(spark, raw).select("item.id", "item.title")


@query(FIRST + " WHERE seq % 2 <> 0")
def build_preprint_table_returned(spark, sf):
    """What a second run with a raw log returns: the rows that it appended."""
    path, raw = scratch_path(spark, "preprints"), scratch_path(spark, "raw-log")
    lines = X.preprint_lines(spark, sf)
    plan.build_preprint_table(lines.filter(f"seq % 2 = 0 AND {ORIGINAL}"), path, raw)
    return plan.build_preprint_table(lines, path, raw)


@query(FIRST)
def ingest_preprints_stream(spark, sf):
    """Three overlapping deliveries; the last one repeats everything and adds second versions."""
    folder, path, marks = (scratch_path(spark, n) for n in ("log", "preprints", "marks"))
    lines = X.preprint_lines(spark, sf)
    for part in (f"{ORIGINAL} AND seq % 3 < 2", f"{ORIGINAL} AND seq % 3 > 0", "true"):
        lines.filter(part).select("value").write.mode("append").text(folder)
        ingest.ingest_preprints_stream(spark, folder, path, marks).awaitTermination()
    return plan.read_preprint_table(spark, path)


@query(f"WITH {Q.HITS} SELECT DISTINCT id FROM hits")
def dedupe_stream(spark, sf):
    folder, path, marks = _log(spark, sf), scratch_path(spark, "ids"), scratch_path(spark, "marks")
    hits = readers.parse_preprints(ingest.stream_lines(spark, folder, files_per_batch=4))
    ids = hits.filter(work.has_id("item.id")).select("item.id")
    writer = ingest.dedupe_stream(ids).writeStream.option("checkpointLocation", marks)
    writer.format("parquet").trigger(availableNow=True).start(path).awaitTermination()
    return spark.read.parquet(path)


@query("SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def skip_existing_ids(spark, sf):
    docs = X.table(spark, sf, "documents").select("doc_id", "source")
    return work.skip_existing_ids(docs, X.table(spark, sf, "labels"), ["doc_id"])


@query(
    f"""WITH {Q.HITS} SELECT id, {Q.HIT_URL} AS url, id || '.pdf' AS name FROM hits
    WHERE doc_id % 4 > 1 AND doc_id NOT IN (SELECT doc_id FROM labels)"""
)
def download_worklist(spark, sf):
    hits = _hits(spark, sf).select("item.id", P.pdf_url(F.col("item")).alias("url"))
    stored = X.table(spark, sf, "labels").select(F.concat(F.col("doc_id").cast("string"), F.lit(".pdf")).alias("name"))
    return work.download_worklist(hits, stored)


@query(
    """SELECT printf('shard-%03d.jsonl', o_orderkey) AS shard, printf('shard-%03d-response.jsonl', o_orderkey) AS name
    FROM orders WHERE o_orderstatus <> 'F'"""
)
def pending_outputs(spark, sf):
    status = X.job_status(spark, sf)
    stored = status.filter("status = 'completed'").select(work.response_name(F.col("shard")).alias("name"))
    return work.pending_outputs(status.select("shard"), stored)


@query(
    """SELECT 'all' AS jobs, coalesce(bool_and(o_orderstatus = 'F'), true) AS completed FROM orders
    UNION ALL SELECT 'finished', true UNION ALL SELECT 'none', true"""
)
def all_completed(spark, sf):
    status = X.job_status(spark, sf)
    cases = {
        "all": status,
        "finished": status.filter("status = 'completed'"),
        "none": status.filter("status = 'unknown'"),
    }
    return readers.union_lines(
        [work.all_completed(jobs).select(F.lit(name).alias("jobs"), "completed") for name, jobs in cases.items()]
    )


@query(
    """SELECT printf('shard-%03d.jsonl', o_orderkey) AS shard, 'batch_' || o_custkey AS batch_id,
    CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'in_progress' ELSE 'validating' END AS status FROM orders"""
)
def write_job_status(spark, sf):
    path = scratch_path(spark, "status")
    sinks.write_job_status(X.job_status(spark, sf), path)
    return spark.read.parquet(path)


@query(f"WITH {Q.NAMES} SELECT max(id) AS last_id FROM names WHERE name LIKE 'cid_%.json'")
def high_watermark(spark, sf):
    return work.high_watermark(X.stored_names(spark, sf))


@query(
    f"""WITH {Q.NAMES}, m AS (SELECT max(id) AS last FROM names WHERE name LIKE 'cid_%.json')
    SELECT CAST(unnest(range(last + 1, (SELECT CAST(2 * max(p_partkey) AS BIGINT) FROM part) + 1)) AS BIGINT) AS id FROM m"""
)
def resume_range(spark, sf):
    last = work.high_watermark(X.stored_names(spark, sf)).first()["last_id"]
    top = X.table(spark, sf, "part").agg(F.max("p_partkey")).first()[0]
    return work.resume_range(spark, last, 2 * top)


@query(
    f"""WITH {Q.NAMES} SELECT p_partkey AS id FROM part WHERE p_partkey > 0 AND p_partkey NOT IN
      (SELECT id FROM names WHERE name LIKE 'cid_%.json')"""
)
def resume_range_gaps(spark, sf):
    names = X.stored_names(spark, sf)
    stored = names.select(work.stored_number(F.col("name")).alias("id")).na.drop()
    top = X.table(spark, sf, "part").agg(F.max("p_partkey")).first()[0]
    return work.resume_range(spark, 0, top, stored)


@query(
    """SELECT 'ids-' || p_partkey // 1000 || '.json' AS list, p_partkey AS id,
    CAST(row_number() OVER (PARTITION BY p_partkey // 1000 ORDER BY p_partkey) - 1 AS INTEGER) AS pos FROM part"""
)
def predefined_worklist(spark, sf):
    """List files of at most a thousand ids each, as users would give them."""
    folder = scratch_path(spark, "ids")
    spark.range(0).write.parquet(folder)  # creates the folder
    number = F.floor(F.col("p_partkey") / 1000).alias("n")
    lists = X.table(spark, sf, "part").groupBy(number).agg(F.array_sort(F.collect_list("p_partkey")).alias("ids"))
    name = F.concat(F.lit("ids-"), F.col("n").cast("string"), F.lit(".json"))
    X.write_files(lists.select(name.alias("name"), F.encode(F.to_json("ids"), "UTF-8").alias("content")), X._uri(folder))
    return work.predefined_worklist(spark, f"{folder}/*.json")
