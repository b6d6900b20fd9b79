"""Queries of requests, responses, sampling, generation and their jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import fixtures as X
from checks import sql as Q
from checks.registry import query
from passagemill import schemas as S
from passagemill.functions import answers as A
from passagemill.operators import generate as G
from passagemill.operators import pairs as P
from passagemill.operators import work
from passagemill.plans import generation, pairs
from passagemill.sources import readers, sinks
from passagemill.sources.scratch import scratch_path
from passagemill.streaming import ingest

IDS = ["doc_id", "source"]


@query("SELECT doc_id, source, text FROM documents")
def read_passages_parquet(spark, sf):
    rows = readers.read_passages(spark, f"{sf}/documents.parquet", "text", ["doc_id"])
    return rows.select("doc_id", "source", "text")


@query("SELECT doc_id, CASE WHEN doc_id % 4 <> 0 THEN text END AS text FROM documents")
def read_passages_csv(spark, sf):
    path = scratch_path(spark, "passages") + ".csv"
    text = F.when(F.col("doc_id") % 4 == 0, F.lit("NA")).otherwise(F.col("text"))
    sinks.write_csv(X.table(spark, sf, "documents").select("doc_id", text.alias("text")), path)
    rows = readers.read_passages(spark, path, "text", ["doc_id"], schema="doc_id BIGINT, text STRING")
    return rows.select("doc_id", "text")


SHARDED = f"""sharded AS (SELECT *, {Q.PROMPT} AS prompt,
    printf('shard-%03d', (row_number() OVER () - 1) // 300) AS shard FROM documents)"""


def _requests(spark, sf, path=None):
    params = {"temperature": 0.2, "max_tokens": None}
    return pairs.build_requests(
        X.passages_in_place(spark, sf), IDS, "text", X.TEMPLATE, "small-model", params, shard_size=300, path=path
    )


@query(f"WITH {SHARDED} SELECT doc_id, source, shard FROM sharded")
def assign_shards(spark, sf):
    return work.assign_shards(X.passages_in_place(spark, sf), 300).select("doc_id", "source", "shard")


@query(
    """WITH t AS (SELECT c_custkey, c_name, c_nationkey, row_number() OVER (ORDER BY c_custkey) - 1 AS k FROM customer)
    SELECT c_custkey, printf('shard-%03d', CAST((row_number() OVER (ORDER BY c_nationkey, c_custkey) - 1) // 70 AS INTEGER)) AS shard
    FROM t WHERE c_custkey % 3 <> 0"""
)
def assign_shards_of_files(spark, sf):
    """Source order over many CSV files that are not in id order; rows filtered out take no number."""
    path = scratch_path(spark, "customers")
    one = X.table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    ordered = one.repartitionByRange(6, "c_nationkey", "c_custkey").sortWithinPartitions("c_nationkey", "c_custkey")
    ordered.write.csv(path, header=True)
    rows = spark.read.csv(path, header=True, schema="c_custkey BIGINT, c_name STRING, c_nationkey BIGINT")
    return work.assign_shards(rows.filter("c_custkey % 3 <> 0"), 70).select("c_custkey", "shard")


def _fields(value):
    def at(path):
        return F.get_json_object(value, path)

    return [
        at("$.custom_id").alias("custom_id"),
        at("$.method").alias("method"),
        at("$.url").alias("url"),
        at("$.body.model").alias("model"),
        at("$.body.messages[0].content").alias("prompt"),
        at("$.body.messages[0].role").alias("role"),
        at("$.body.response_format.json_schema.name").alias("format"),
        at("$.body.temperature").alias("temperature"),
    ]


REQUEST = f"""CAST(doc_id AS VARCHAR) || '__' || source AS custom_id, 'POST' AS method, '/v1/chat/completions' AS url,
    'small-model' AS model, {Q.PROMPT} AS prompt, 'user' AS role, 'QueryGeneration' AS format"""


@query(f"SELECT {REQUEST}, CAST(NULL AS VARCHAR) AS temperature FROM documents".replace("small-model", "o3-mini"))
def request_line(spark, sf):
    """A model that takes no temperature: the parameter is removed."""
    asked = X.passages(spark, sf).select(
        pairs.custom_id(IDS).alias("id"), pairs.render_prompt(X.TEMPLATE, F.col("text")).alias("p")
    )
    line = P.request_line(F.col("id"), F.col("p"), "o3-mini", {"temperature": 1})
    return asked.select(line.alias("value")).select(*_fields("value"))


@query(f"WITH {SHARDED} SELECT shard, {REQUEST}, '0.2' AS temperature FROM sharded")
def build_requests(spark, sf):
    path = scratch_path(spark, "requests")
    _requests(spark, sf, path)
    back = spark.read.text(path).select(F.col("shard").cast("string").alias("shard"), "value")
    return back.select("shard", *_fields("value"))


@query(
    f"""WITH {SHARDED} SELECT shard, CAST(count(*) AS BIGINT) AS lines FROM sharded GROUP BY shard"""
)
def write_request_shards(spark, sf):
    path = scratch_path(spark, "requests")
    _requests(spark, sf, path)
    back = spark.read.text(path)
    return back.groupBy(F.col("shard").cast("string").alias("shard")).agg(F.count(F.lit(1)).alias("lines"))


@query(
    f"""WITH {SHARDED} SELECT CAST(sum({Q.TOKEN_ESTIMATE.format(x="prompt")}) AS BIGINT) AS input_tokens,
    CAST(count(DISTINCT shard) AS BIGINT) AS shards FROM sharded"""
)
def input_token_total(spark, sf):
    return P.input_token_total(_requests(spark, sf))


# --- Responses ----------------------------------------------------------------------------------


def _lines(spark, sf):
    return X.response_lines(spark, sf)


@query(f"WITH {Q.RESPONSES} SELECT CAST(count(*) AS BIGINT) AS lines FROM resp")
def read_responses(spark, sf):
    folder = scratch_path(spark, "responses")
    spark.range(0).write.parquet(folder)  # creates the folder
    X.write_lines(_lines(spark, sf), X._uri(folder), ".jsonl")
    return readers.read_responses(spark, folder).agg(F.count(F.lit(1)).alias("lines"))


@query(f"WITH {Q.RESPONSES} SELECT conv_id, turn FROM resp UNION ALL SELECT conv_id, turn FROM resp WHERE kind > 5")
def union_lines(spark, sf):
    lines = _lines(spark, sf)
    return readers.union_lines([lines, lines.filter("kind > 5")]).select("conv_id", "turn")


@query(
    f"""WITH {Q.RESPONSES} SELECT kind, CAST(count(*) AS BIGINT) AS n FROM resp GROUP BY kind"""
)
def write_merged_lines(spark, sf):
    path = scratch_path(spark, "merged")
    lines = _lines(spark, sf)
    sinks.write_merged_lines(lines, path)
    merged = spark.read.text(path).groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    return merged.join(lines.select("value", "kind").distinct(), "value").groupBy("kind").agg(F.sum("n").alias("n"))


@query(f"WITH {Q.RESPONSES} SELECT custom_id, CAST(completion_tokens AS BIGINT) AS completion_tokens FROM answered")
def response_message(spark, sf):
    return P.response_message(_lines(spark, sf)).select("custom_id", "completion_tokens")


@query(f"WITH {Q.RESPONSES} SELECT CAST(sum(completion_tokens) AS BIGINT) AS completion_tokens FROM answered")
def completion_token_total(spark, sf):
    return P.completion_token_total(P.response_message(_lines(spark, sf)))


@query(f"WITH {Q.RESPONSES} SELECT custom_id FROM resp WHERE kind NOT IN (0, 7)")
def drop_errors(spark, sf):
    good = readers.drop_malformed(readers.parse_lines(_lines(spark, sf), S.RESPONSE_LINE))
    return P.drop_errors(good.select("j.*")).select("custom_id")


@query(
    f"""WITH {Q.RESPONSES} SELECT CASE WHEN kind IN (1, 2, 3, 9) THEN NULL ELSE question END AS question, custom_id
    FROM (SELECT * FROM answered UNION ALL SELECT *, 0, NULL FROM resp WHERE kind = 1)"""
)
def response_fields(spark, sf):
    return P.response_fields(_lines(spark, sf), S.QUESTION)


@query(f"WITH {Q.RESPONSES} SELECT custom_id, question FROM answered")
def json_question(spark, sf):
    content = A.json_question(F.col("content")).alias("question")
    return P.response_message(_lines(spark, sf)).select("custom_id", content)


@query(
    f"""WITH {Q.RESPONSES} SELECT conv_id, turn, CASE kind WHEN 4 THEN '' WHEN 5 THEN NULL WHEN 6 THEN NULL
      WHEN 9 THEN 'cut of' ELSE q END AS question FROM resp"""
)
def parse_structured(spark, sf):
    rows = _lines(spark, sf)
    return rows.select("conv_id", "turn", A.parse_structured(F.col("content"), S.QUESTION).alias("a")).select(
        "conv_id", "turn", "a.*"
    )


@query("SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN lang ELSE '' END AS question, '' AS chunk1, source AS chunk2 FROM documents")
def empty_output(spark, sf):
    docs = X.table(spark, sf, "documents")
    partial = F.struct(
        F.when(F.col("doc_id") % 2 == 0, F.col("lang")).alias("question"),
        F.lit(None).cast("string").alias("chunk1"),
        F.col("source").alias("chunk2"),
    )
    return docs.select("doc_id", A.fill_empty(partial, S.TWO_HOP).alias("a")).select("doc_id", "a.*")


def _blocks(spark, sf):
    """VARIANT contents: plain text, a list of three blocks, or an empty list, by turn."""
    talk = X.table(spark, sf, "conversations")
    block = [
        F.struct(F.lit("reasoning_content").alias("type"), F.struct(F.col("text").alias("text")).alias("reasoning_content")),
        F.struct(F.lit("text").alias("type"), F.col("text").alias("text")),
        F.struct(F.lit("tool_use").alias("type"), F.struct(F.col("role").alias("question")).alias("input")),
    ]
    listed = F.concat(F.lit("["), F.concat_ws(",", *[F.to_json(b) for b in block]), F.lit("]"))
    plain = F.col("text").cast("variant")
    kind = F.col("turn") % 3
    content = F.when(kind == 0, plain).when(kind == 1, F.parse_json(listed)).otherwise(F.parse_json(F.lit("[]")))
    return talk.select("conv_id", "turn", content.alias("content"))


@query(
    """SELECT conv_id, turn, CASE turn % 3 WHEN 0 THEN text WHEN 1 THEN text END AS by_text,
    CASE turn % 3 WHEN 0 THEN text WHEN 1 THEN '{"question":"' || role || '"}' END AS by_tool,
    CASE WHEN turn % 3 = 1 THEN text END AS reasoning FROM conversations"""
)
def content_blocks(spark, sf):
    rows = _blocks(spark, sf)
    both = rows.select(
        "conv_id", "turn",
        A.content_blocks(F.col("content"), "text").alias("t"),
        A.content_blocks(F.col("content"), "tool_use").alias("u"),
    )
    return both.select(
        "conv_id", "turn", F.col("t.raw_response").alias("by_text"), F.col("u.raw_response").alias("by_tool"), "u.reasoning"
    )


@query(
    "SELECT CASE WHEN length(text) > 100 THEN conv_id END AS conv_id, turn FROM conversations"
)
def cast_ids(spark, sf):
    source = X.table(spark, sf, "conversations")
    text = source.select(
        F.when(F.length("text") > 100, F.col("conv_id").cast("string")).otherwise(F.lit("not a number")).alias("conv_id"),
        F.col("turn").cast("string").alias("turn"),
    )
    return P.cast_ids(text, source.schema, ["conv_id", "turn"])


@query(
    f"""WITH {Q.RESPONSES} SELECT c.conv_id, c.turn, c.text, a.question AS generated_query
    FROM conversations c JOIN answered a ON a.conv_id = c.conv_id AND a.turn = c.turn"""
)
def attach_questions(spark, sf):
    source = X.table(spark, sf, "conversations").select("conv_id", "turn", "text")
    responses = P.parsed_responses(_lines(spark, sf), ["conv_id", "turn"])
    return P.attach_questions(source, responses, ["conv_id", "turn"])


@query(
    """SELECT event_id, value FROM
    (SELECT event_id, CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS value FROM events WHERE event_id % 5 <> 0)
    WHERE value IS NOT NULL"""
)
def drop_incomplete(spark, sf):
    key = F.col("event_id")
    value = F.when(key % 7 == 0, F.lit(None)).when(key % 5 == 0, F.lit(float("nan"))).otherwise(F.col("value"))
    return P.drop_incomplete(X.table(spark, sf, "events").select("event_id", value.alias("value")))


@query(
    f"""WITH {Q.RESPONSES} SELECT c.conv_id, c.turn, c.role, c.text, a.question AS generated_query
    FROM conversations c JOIN answered a ON a.conv_id = c.conv_id AND a.turn = c.turn WHERE a.question IS NOT NULL"""
)
def build_training_pairs(spark, sf):
    path = scratch_path(spark, "pairs")
    pairs.build_training_pairs(X.table(spark, sf, "conversations"), _lines(spark, sf), ["conv_id", "turn"], path)
    schema = "conv_id BIGINT, turn BIGINT, role STRING, text STRING, generated_query STRING"
    back = readers.read_passages(spark, path, "text", ["conv_id"], fmt="csv", na_values=(), schema=schema)
    return back.withColumn("generated_query", F.coalesce("generated_query", F.lit("")))


@query(
    f"""WITH {Q.RESPONSES} SELECT outcome, count(*) AS n FROM (
      SELECT CASE WHEN kind = 0 THEN 'malformed' WHEN kind IN (1, 7) THEN 'no choice'
        WHEN kind IN (3, 5) THEN 'no question' ELSE 'pair' END AS outcome FROM resp) GROUP BY outcome"""
)
def training_pairs_rejects(spark, sf):
    """Pairs and rejects account for every response line."""
    rejects = scratch_path(spark, "rejects")
    found = pairs.build_training_pairs(
        X.table(spark, sf, "conversations"), _lines(spark, sf), ["conv_id", "turn"], rejects_path=rejects
    )
    outcomes = spark.read.parquet(rejects).select(F.col("reason").alias("outcome"))
    every = outcomes.unionByName(found.select(F.lit("pair").alias("outcome")))
    return every.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {Q.RESPONSES} SELECT CAST(conv_id AS VARCHAR) AS conv_id, CAST(turn AS VARCHAR) AS turn FROM answered "
       "WHERE question IS NULL")  # fmt: skip
def response_rejects(spark, sf):
    return pairs.response_rejects(_lines(spark, sf), ["conv_id", "turn"]).select("conv_id", "turn")


@query(
    """SELECT doc_id, question, chunk1, chunk2, CAST(start1 AS BIGINT) AS start1, CAST(start2 AS BIGINT) AS start2,
    CASE WHEN start1 = 0 OR start2 = 0 OR chunk1 = '' OR chunk2 = '' THEN 'missing chunk'
         WHEN start1 < start2 + length(chunk2) AND start2 < start1 + length(chunk1) THEN 'overlap' ELSE 'ok' END AS verdict
    FROM (SELECT *, CASE WHEN chunk1 = '' THEN 1 ELSE instr(text, chunk1) END AS start1, CASE WHEN chunk2 = '' THEN 1 ELSE instr(text, chunk2) END AS start2 FROM (
      SELECT doc_id, text, 'Q ' || doc_id AS question, CASE WHEN doc_id % 4 = 3 THEN '' ELSE left(text, 20) END AS chunk1,
        CASE doc_id % 4 WHEN 1 THEN substr(text, 11, 20) WHEN 2 THEN chr(1) || ' not in any passage'
          ELSE substr(text, 31, 20) END AS chunk2
      FROM documents))"""
)
def two_hop_pairs(spark, sf):
    report = pairs.two_hop_pairs(X.two_hop_rows(spark, sf), "text").drop("text")
    return report.withColumn("start1", F.col("start1").cast("bigint")).withColumn("start2", F.col("start2").cast("bigint"))


# --- Sampling, resume and generation ------------------------------------------------------------

SAMPLE = """SELECT doc_id, source FROM documents ORDER BY md5('24|' || doc_id || '|' || source), doc_id, source LIMIT {k}"""


@query(SAMPLE.format(k=150))
def sample_rows(spark, sf):
    return work.sample_rows(X.passages(spark, sf), IDS, seed=24, size=150).select(*IDS)


@query(SAMPLE.format(k="(SELECT CAST(floor(count(*) * 0.25) AS BIGINT) FROM documents)"))
def sample_rows_fraction(spark, sf):
    return work.sample_rows(X.passages(spark, sf), IDS, seed=24, frac=0.25).select(*IDS)


@query(
    """SELECT doc_id, source FROM documents WHERE source IN (
      SELECT source FROM (SELECT DISTINCT source FROM documents) ORDER BY md5('24|' || source), source LIMIT 5)"""
)
def sample_rows_repeated_ids(spark, sf):
    """Many rows to an id: five ids are drawn, with all their rows."""
    docs = X.passages(spark, sf)
    return work.sample_rows(docs, ["source"], seed=24, size=5).select("doc_id", "source")


@query(SAMPLE.format(k=150))
def persisted_sample(spark, sf):
    path = scratch_path(spark, "sample")
    docs = X.passages(spark, sf)
    work.persisted_sample(docs, IDS, path, seed=24, size=150)
    return work.persisted_sample(docs, IDS, path, seed=99, size=10).select(*IDS)


@query("SELECT event_id, user_id FROM events WHERE user_id IN (SELECT doc_id FROM labels WHERE toxic = 1)")
def restrict_to_sample(spark, sf):
    ids = X.table(spark, sf, "labels").filter("toxic = 1").select(F.col("doc_id").alias("user_id"))
    return work.restrict_to_sample(X.table(spark, sf, "events"), ids, ["user_id"]).select("event_id", "user_id")


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def skip_processed(spark, sf):
    return work.skip_processed(X.passages(spark, sf), X.cache(spark, sf), ["doc_id"]).select("doc_id")


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 0)")
def skip_processed_retry(spark, sf):
    left = work.skip_processed(X.passages(spark, sf), X.cache(spark, sf), ["doc_id"], retry_errors=True)
    return left.select("doc_id")


GENERATED = """generated AS (SELECT *, left(text, 1) = 'A' AS failed,
    CASE WHEN left(text, 1) <> 'A' THEN 'Q ' || text END AS question FROM documents)"""


@query(
    f"""WITH {GENERATED} SELECT doc_id, CASE WHEN failed THEN 'refused' END AS error,
    CASE WHEN failed THEN 0 ELSE length({Q.PROMPT}) END AS input_tokens,
    CAST(CASE WHEN failed THEN 0 ELSE 3 END AS BIGINT) AS output_tokens FROM generated"""
)
def generate(spark, sf):
    prompt = pairs.render_prompt(X.TEMPLATE, F.col("text"))
    called = G.generate(X.passages(spark, sf).withColumn("prompt", prompt), X.echo_client_factory)
    return called.select("doc_id", "error", "input_tokens", "output_tokens")


RECORD = f"""WITH {GENERATED} SELECT doc_id, question, CAST(0 AS BIGINT) AS reasoning_tokens,
    CASE WHEN failed THEN 0 ELSE 12.35 END::DOUBLE AS latency,
    CASE WHEN NOT failed THEN 'because' END AS reasoning, CASE WHEN failed THEN 'refused' END AS error FROM generated"""


def _record_columns(cache):
    return cache.select("raw.doc_id", "question", "reasoning_tokens", "latency", "reasoning", "error")


@query(RECORD)
def result_record(spark, sf):
    fresh = generation.generated(X.passages(spark, sf), "text", X.TEMPLATE, X.echo_client_factory)
    return _record_columns(fresh)


@query(RECORD)
def append_results(spark, sf):
    path = scratch_path(spark, "cache")
    fresh = generation.generated(X.passages(spark, sf), "text", X.TEMPLATE, X.echo_client_factory)
    sinks.append_results(fresh, path)
    return _record_columns(spark.read.parquet(path))


@query(f"WITH {Q.CACHE} SELECT doc_id, source, text, question FROM cache")
def final_projection(spark, sf):
    return G.final_projection(X.cache(spark, sf), IDS, "text")


TELEMETRY = f"""WITH {Q.CACHE} SELECT CASE WHEN doc_id % 3 = 0 THEN 'small-model' ELSE 'large-model' END AS model, day,
    CAST(count(*) AS BIGINT) AS calls, CAST(sum(input_tokens) AS BIGINT) AS input_tokens,
    CAST(sum(output_tokens) AS BIGINT) AS output_tokens, round(avg(latency), 6) AS mean_latency,
    CAST(quantile_disc(latency, 0.95) AS DOUBLE) AS p95_latency,
    round(count_if(failed) / count(*), 6) AS error_rate FROM cache GROUP BY ALL"""


def _telemetry(rows):
    return rows.withColumn("mean_latency", F.round("mean_latency", 6)).withColumn("error_rate", F.round("error_rate", 6))


@query(TELEMETRY)
def generation_telemetry(spark, sf):
    return _telemetry(G.generation_telemetry(X.cache(spark, sf)))


@query(TELEMETRY)
def generation_telemetry_merged(spark, sf):
    """Sketches of seven commits, stored one by one and merged."""
    path, cache = scratch_path(spark, "telemetry"), X.cache(spark, sf)
    for k in range(7):
        sinks.append_results(G.telemetry_sketches(cache.filter(F.col("raw.doc_id") % 7 == k)), path)
    return _telemetry(G.merged_telemetry(spark.read.parquet(path)))


@query(f"WITH {GENERATED} SELECT doc_id, source, text, question FROM generated")
def run_generation(spark, sf):
    """Two runs into one cache; the second only generates what the first did not."""
    path = scratch_path(spark, "cache")
    docs = X.passages(spark, sf)
    args = (IDS, "text", X.TEMPLATE, X.echo_client_factory, path)
    labelled = work.restrict_to_sample(docs, X.table(spark, sf, "labels"), ["doc_id"])
    generation.run_generation(labelled, *args)
    return generation.run_generation(docs, *args, rounds=2)


@query(f"WITH {GENERATED} SELECT doc_id, question FROM generated")
def generate_stream(spark, sf):
    folder, path, marks = (scratch_path(spark, n) for n in ("passages", "cache", "marks"))
    docs = X.passages(spark, sf)
    for part in ("doc_id % 3 < 2", "doc_id % 3 > 0"):
        docs.filter(part).write.mode("append").parquet(folder)
        source = spark.readStream.schema(docs.schema).parquet(folder)
        ingest.generate_stream(source, IDS, "text", X.TEMPLATE, X.echo_client_factory, path, marks).awaitTermination()
    return spark.read.parquet(path).select("raw.doc_id", "question")


@query(
    f"""WITH {GENERATED} SELECT doc_id, question, CAST(CASE WHEN question IS NULL THEN 3 ELSE 1 END AS BIGINT) AS calls FROM generated"""
)
def generate_stream_retry(spark, sf):
    """Passages whose call fails are asked three times, each time that the stream runs again."""
    folder, path, marks = (scratch_path(spark, n) for n in ("passages", "cache", "marks"))
    docs = X.passages(spark, sf)
    docs.write.parquet(folder)
    for _ in range(5):
        source = spark.readStream.schema(docs.schema).parquet(folder)
        query = ingest.generate_stream(source, IDS, "text", X.TEMPLATE, X.echo_client_factory, path, marks, attempts=3, retry_after=0.0)
        query.awaitTermination()
    cache = spark.read.parquet(path)
    return cache.groupBy("raw.doc_id").agg(F.max("question").alias("question"), F.count(F.lit(1)).alias("calls"))
