"""Queries of the text functions, filters and the language model."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import fixtures as X
from checks import sql as Q
from checks.registry import query
from passagemill.functions.common import compute_once
from passagemill.functions import text as T
from passagemill.operators import lm
from passagemill.sources import readers


@query(f"WITH {Q.DIRTY} SELECT doc_id, nfc_normalize(text) AS text FROM dirty")
def nfc(spark, sf):
    return X.dirty_text(spark, sf).select("doc_id", T.nfc(F.col("text")).alias("text"))


@query(f"WITH {Q.DIRTY} SELECT doc_id, {Q.strip_urls('text')} AS text FROM dirty")
def strip_urls(spark, sf):
    return X.dirty_text(spark, sf).select("doc_id", T.strip_urls(F.col("text")).alias("text"))


@query(f"WITH {Q.DIRTY} SELECT doc_id, {Q.strip_footer('text')} AS text FROM dirty")
def strip_footer(spark, sf):
    return X.dirty_text(spark, sf).select("doc_id", T.strip_footer(F.col("text")).alias("text"))


@query(f"WITH {Q.DIRTY} SELECT doc_id, {Q.collapse('text')} AS text FROM dirty")
def collapse_ws(spark, sf):
    return X.dirty_text(spark, sf).select("doc_id", T.collapse_ws(F.col("text")).alias("text"))


@query(f"WITH {Q.DIRTY} SELECT doc_id, {Q.normalize('text')} AS text FROM dirty")
def normalize_text(spark, sf):
    return X.dirty_text(spark, sf).select("doc_id", T.normalize_text(F.col("text")).alias("text"))


@query(
    f"""WITH {Q.DIRTY}, n AS (SELECT doc_id, {Q.normalize("text")} AS text FROM dirty)
    SELECT doc_id, CAST({Q.words("text")} AS BIGINT) AS words FROM n WHERE {Q.words("text")} > 50"""
)
def min_words(spark, sf):
    normal = compute_once(X.dirty_text(spark, sf), normal=T.normalize_text(F.col("text")))
    kept = normal.select("doc_id", F.col("normal").alias("text")).filter(T.min_words(F.col("text")))
    return kept.select("doc_id", T.word_count(F.col("text")).cast("bigint").alias("words"))


@query(
    """SELECT p_partkey, p_brand, NOT regexp_matches(p_brand, '\\p{Nd}\\p{Nd}') AND regexp_matches(p_brand, '[a-zA-Z]')
         AS textual FROM part"""
)
def is_textual(spark, sf):
    part = X.table(spark, sf, "part")
    return part.select("p_partkey", "p_brand", T.is_textual(F.col("p_brand")).alias("textual"))


@query("SELECT p_partkey, p_name FROM part WHERE length(p_name) BETWEEN 9 AND 10")
def synonym_length(spark, sf):
    part = X.table(spark, sf, "part").select("p_partkey", "p_name")
    return part.filter(T.synonym_length(F.col("p_name"), 9, 10))


@query(f"""SELECT doc_id, array_to_string({Q.tokens("text")}, ' ') AS tokens FROM documents""")
def tokenize(spark, sf):
    docs = X.table(spark, sf, "documents")
    return docs.select("doc_id", F.array_join(T.tokenize(F.col("text")), " ").alias("tokens"))


@query(f"SELECT doc_id, CAST({Q.TOKEN_ESTIMATE.format(x='text')} AS BIGINT) AS tokens FROM documents")
def count_tokens(spark, sf):
    docs = X.table(spark, sf, "documents")
    return docs.select("doc_id", T.count_tokens(F.col("text")).cast("bigint").alias("tokens"))


@query(f"SELECT doc_id, {Q.PROMPT} AS prompt FROM documents")
def render_prompt(spark, sf):
    docs = X.table(spark, sf, "documents")
    return docs.select("doc_id", T.render_prompt(X.TEMPLATE, F.col("text")).alias("prompt"))


@query("SELECT CAST(doc_id AS VARCHAR) || '__' || source AS custom_id FROM documents")
def custom_id(spark, sf):
    return X.table(spark, sf, "documents").select(T.custom_id(["doc_id", "source"]).alias("custom_id"))


@query(
    """SELECT string_split(c, '__')[1] AS a, string_split(c, '__')[2] AS b, c AS whole
    FROM (SELECT CAST(conv_id AS VARCHAR) || '__' || turn || '__' || role AS c FROM conversations)"""
)
def split_custom_id(spark, sf):
    ids = X.table(spark, sf, "conversations").select(T.custom_id(["conv_id", "turn", "role"]).alias("c"))
    one = T.split_custom_id(F.col("c"), ["whole"])
    return ids.select(*T.split_custom_id(F.col("c"), ["a", "b"]), *one)


@query(
    f"""WITH t AS (SELECT conv_id, turn, role, text, {Q.strip("text")} AS s FROM conversations)
    SELECT conv_id, turn, CASE WHEN role = 'assistant' THEN 'because ' || role END AS reasoning,
           CASE WHEN role = 'assistant' THEN s ELSE text END AS output FROM t"""
)
def split_reasoning(spark, sf):
    talk = X.table(spark, sf, "conversations")
    thought = F.concat(F.lit("x <think>\n because "), "role", F.lit("\n</think> \n"), "text", F.lit(" "))
    text = F.when(F.col("role") == "assistant", thought).otherwise(F.col("text"))
    return talk.select("conv_id", "turn", T.split_reasoning(text).alias("s")).select("conv_id", "turn", "s.*")


@query(
    """WITH n AS (SELECT doc_id, replace(text, chr(10), '_') || '.pdf' AS name FROM documents)
    SELECT doc_id, CASE WHEN length(name) <= 255 THEN name ELSE left(name, 251) || '.pdf' END AS name FROM n"""
)
def safe_filename(spark, sf):
    name = F.concat(F.replace(F.col("text"), F.lit("\n"), F.lit("_")), F.lit(".pdf"))
    return X.table(spark, sf, "documents").select("doc_id", T.safe_filename(name).alias("name"))


@query(
    f"""WITH {Q.COUNTS} SELECT word, CAST(n + 1 AS BIGINT) AS n FROM counts WHERE word NOT LIKE '%,%'"""
)
def read_unigram_counts(spark, sf):
    return readers.read_unigram_counts(spark, X.unigram_folder(spark, sf) + "/*")


@query(f"WITH {Q.MODEL} SELECT word, round(logp, 6) AS logp FROM model")
def unigram_model(spark, sf):
    model = lm.unigram_model(X.unigram_counts(spark, sf))
    return model.select("word", F.round("logp", 6).alias("logp"))


def _tokens(spark, sf):
    docs = X.table(spark, sf, "conversations")
    return docs.select("conv_id", "turn", F.posexplode(T.tokenize(F.col("text"))).alias("pos", "word"))


@query(
    f"""WITH {Q.MODEL}, t AS (SELECT conv_id, turn, unnest({Q.tokens("text")}) AS word FROM conversations)
    SELECT t.word, CAST(count(*) AS BIGINT) AS n,
      round(coalesce(max(m.logp), (SELECT logp FROM model WHERE word = '<unk>')), 6) AS logp
    FROM t LEFT JOIN model m USING (word) GROUP BY t.word"""
)
def lookup_logp(spark, sf):
    found = lm.lookup_logp(_tokens(spark, sf), lm.unigram_model(X.unigram_counts(spark, sf)))
    return found.groupBy("word").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.max("logp"), 6).alias("logp")
    )


SCORED = f"WITH {Q.MODEL}, {Q.scores('documents', 'doc_id', 'text')} "


@query(SCORED + "SELECT doc_id, round(score, 6) AS score FROM scores")
def unigram_score(spark, sf):
    model = lm.unigram_model(X.unigram_counts(spark, sf))
    scored = lm.unigram_score(X.table(spark, sf, "documents"), model, "text")
    return scored.select("doc_id", F.round("score", 6).alias("score"))


@query(SCORED + "SELECT doc_id, round(score, 6) AS score FROM scores")
def unigram_score_joined(spark, sf):
    model = lm.unigram_model(X.unigram_counts(spark, sf))
    scored = lm.score_by_join(X.table(spark, sf, "documents"), model, "text")
    return scored.select("doc_id", F.round("score", 6).alias("score"))


@query(
    SCORED
    + """SELECT form, doc_id % 3 AS k, round(score, 6) AS score FROM scores,
    (SELECT unnest(['in place', 'joined']) AS form)"""
)
def unigram_score_repeated_keys(spark, sf):
    """Both forms score texts alike, whatever keys their rows have."""
    model = lm.unigram_model(X.unigram_counts(spark, sf))
    docs = X.table(spark, sf, "documents").select((F.col("doc_id") % 3).alias("k"), "text")
    placed = lm.unigram_score(docs, model, "text").withColumn("form", F.lit("in place"))
    joined = lm.score_by_join(docs, model, "text").withColumn("form", F.lit("joined"))
    return placed.unionByName(joined).select("form", "k", F.round("score", 6).alias("score"))


@query(SCORED + "SELECT doc_id FROM scores WHERE round(score, 9) > -6.31")
def min_unigram_score(spark, sf):
    model = lm.unigram_model(X.unigram_counts(spark, sf))
    scored = lm.unigram_score(X.table(spark, sf, "documents"), model, "text")
    return lm.min_unigram_score(scored, threshold=-6.31).select("doc_id")


@query("SELECT doc_id, CAST(length(text) AS DOUBLE) AS score FROM documents")
def score_text(spark, sf):
    docs = X.table(spark, sf, "documents")
    scored = lm.score_text(docs, lambda: lambda texts: texts.str.len().astype(float), "text")
    return scored.select("doc_id", "score")
