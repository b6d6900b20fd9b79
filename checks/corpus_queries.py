"""Queries of the TEI reader, paragraph operators and the paragraph corpus job."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import fixtures as X
from checks import sql as Q
from checks.registry import query
from passagemill.functions import text as T
from passagemill.functions.common import compute_once
from passagemill.operators import lm, work
from passagemill.operators import paragraphs as P
from passagemill.plans import corpus
from passagemill.sources import readers, sinks
from passagemill.sources.scratch import scratch_path

# Mean log2 probability that some paragraphs of the given tables reach and others do not.
THRESHOLD = -6.3


def _divided(spark, sf):
    docs = X.tei_documents(spark, sf)
    return docs.select("path", "doc_id", P.tei_divisions(F.col("content")).alias("divisions"))


@query("SELECT CAST(doc_id AS VARCHAR) AS doc_id, doc_id || '.tei.xml' AS file FROM documents")
def read_tei(spark, sf):
    files = readers.read_tei(spark, X.tei_folder(spark, sf))
    return files.filter(F.length("content") > 0).select(
        "doc_id", F.element_at(F.split("path", "/"), -1).alias("file")
    )


@query(
    f"""WITH {Q.TEI} SELECT id AS doc_id, row_number() OVER (PARTITION BY id ORDER BY copy DESC, div, pos) - 1 AS pos, text
    FROM tei"""
)
def tei_paragraphs(spark, sf):
    rows = P.explode_paragraphs(_divided(spark, sf))
    return rows.select("doc_id", F.col("pos").cast("bigint").alias("pos"), F.col("paragraph").alias("text"))


@query(
    f"""WITH {Q.TEI}, d AS (
      SELECT id, copy, CASE WHEN copy = 1 THEN -1 ELSE div END AS div, string_agg(text, chr(10) ORDER BY pos) AS text
      FROM tei GROUP BY ALL)
    SELECT id AS doc_id, row_number() OVER (PARTITION BY id ORDER BY copy DESC, div) - 1 AS pos, text FROM d"""
)
def explode_paragraphs_joined(spark, sf):
    rows = P.explode_paragraphs(_divided(spark, sf), concat_p=True)
    return rows.select("doc_id", F.col("pos").cast("bigint").alias("pos"), F.col("paragraph").alias("text"))


def _long_lines(spark, sf):
    lines = compute_once(X.paragraphs(spark, sf), normal=T.normalize_text(F.col("paragraph")))
    lines = lines.drop("paragraph").withColumnRenamed("normal", "paragraph")
    return lines.filter(T.min_words(F.col("paragraph")))


LONG = f"""{Q.LINES},
clean AS (SELECT doc_id, id, pos, {Q.normalize("paragraph")} AS paragraph FROM lines),
long AS (SELECT * FROM clean WHERE {Q.words("paragraph")} > 50),
numbered AS (SELECT id, row_number() OVER (PARTITION BY id ORDER BY pos) - 1 AS idx, paragraph FROM long)"""


@query(f"WITH {LONG} SELECT id, CAST(idx AS INTEGER) AS idx, paragraph FROM numbered")
def number_paragraphs(spark, sf):
    rows = P.number_paragraphs(_long_lines(spark, sf), document="id")
    return rows.select("id", "idx", "paragraph")


@query(f"WITH {LONG} SELECT id, string_agg(paragraph, '|' ORDER BY idx) AS paragraphs FROM numbered GROUP BY ALL")
def document_arrays(spark, sf):
    rows = P.number_paragraphs(_long_lines(spark, sf), document="id")
    return P.document_arrays(rows, file="id").select("id", F.array_join("paragraphs", "|").alias("paragraphs"))


@query(
    f"""WITH {LONG} SELECT id AS path, CAST(CAST(id AS BIGINT) % 7 AS VARCHAR) AS id,
    string_agg(paragraph, '|' ORDER BY idx) AS paragraphs FROM numbered GROUP BY ALL"""
)
def document_arrays_shared_id(spark, sf):
    """Many files to an id; their paragraphs do not mix."""
    rows = P.number_paragraphs(_long_lines(spark, sf), document="id").withColumnRenamed("id", "path")
    shared = rows.withColumn("id", (F.col("path").cast("bigint") % 7).cast("string"))
    return P.document_arrays(shared).select("path", "id", F.array_join("paragraphs", "|").alias("paragraphs"))


@query(
    f"""WITH {LONG}, a AS (SELECT id, string_agg(paragraph, '|' ORDER BY idx) AS p FROM numbered GROUP BY ALL)
    SELECT CAST(d.doc_id AS VARCHAR) AS id, coalesce(a.p, '') AS paragraphs
    FROM documents d LEFT JOIN a ON a.id = CAST(d.doc_id AS VARCHAR)"""
)
def write_document_arrays(spark, sf):
    path = scratch_path(spark, "document-arrays")
    rows = P.number_paragraphs(_long_lines(spark, sf), document="id")
    documents = X.table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("id"))
    sinks.write_document_arrays(P.all_document_arrays(documents, rows, file="id"), path)
    back = spark.read.schema("id STRING, paragraphs ARRAY<STRING>").json(path)
    return back.select("id", F.array_join("paragraphs", "|").alias("paragraphs"))


def _model(spark, sf):
    return lm.unigram_model(X.unigram_counts(spark, sf))


# The job over the TEI documents: cleaned, long enough, likely enough, numbered.
CORPUS = f"""WITH {Q.MODEL}, {Q.TEI},
clean AS (SELECT id, copy, div, pos, {Q.normalize("text")} AS paragraph FROM tei),
keyed AS (SELECT *, id || '/' || copy || '/' || pos AS k FROM clean WHERE {Q.words("paragraph")} > 50),
{Q.scores("keyed", "k", "paragraph")},
kept AS (SELECT id, paragraph, row_number() OVER (PARTITION BY id ORDER BY copy DESC, div, pos) - 1 AS idx
         FROM keyed JOIN scores USING (k) WHERE round(score, 9) > {THRESHOLD})
"""


@query(CORPUS + "SELECT id, CAST(idx AS INTEGER) AS idx, paragraph FROM kept")
def build_paragraph_corpus(spark, sf):
    arrays = corpus.paragraph_arrays(X.tei_documents(spark, sf), _model(spark, sf), score=THRESHOLD)
    return corpus.paragraph_table(arrays)


@query(
    CORPUS
    + """SELECT CAST((SELECT count(*) FROM clean) - (SELECT count(*) FROM kept) AS BIGINT) AS rejected,
    CAST((SELECT count(*) FROM kept) AS BIGINT) AS kept,
    CAST((SELECT count(*) FROM documents WHERE doc_id % 11 = 0) AS BIGINT) AS unparsed"""
)
def corpus_stats(spark, sf):
    arrays = corpus.paragraph_arrays(X.tei_documents(spark, sf), _model(spark, sf), score=THRESHOLD)
    return P.corpus_stats(arrays)


@query(CORPUS + "SELECT id, CAST(idx AS INTEGER) AS idx, paragraph, 'v1' AS config FROM kept")
def save_paragraph_dataset(spark, sf):
    path = scratch_path(spark, "paragraphs")
    docs = X.tei_documents(spark, sf)
    corpus.build_paragraph_corpus(docs, _model(spark, sf), dataset_path=path, config="v1", score=THRESHOLD)
    return spark.read.parquet(path).select("id", "idx", "paragraph", "config")


@query(
    """SELECT name, row_number() OVER (ORDER BY regexp_extract(name, '^\\D+'),
         CAST(regexp_extract(name, '\\d+') AS BIGINT), name) - 1 AS position
    FROM (SELECT CASE WHEN p_partkey % 3 = 0 THEN 'cid_' ELSE 'b' END || p_partkey || '.json' AS name FROM part)"""
)
def natural_order(spark, sf):
    part = X.table(spark, sf, "part")
    lead = F.when(F.col("p_partkey") % 3 == 0, F.lit("cid_")).otherwise(F.lit("b"))
    names = part.select(F.concat(lead, F.col("p_partkey").cast("string"), F.lit(".json")).alias("name"))
    return work.naturally_ordered(names, "name")
