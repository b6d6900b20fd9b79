"""Queries of the compound record operators and job."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import fixtures as X
from checks import sql as Q
from checks.registry import query
from passagemill.functions import compounds as N
from passagemill.operators import compounds as P
from passagemill.plans import compounds as plan
from passagemill.sources import readers, sinks
from passagemill.sources.scratch import scratch_path


def _cid():
    return F.col("Record.RecordNumber").alias("CID")


def _names():
    return N.names_section(F.col("Record"))


@query("SELECT p_partkey AS \"CID\", p_name AS title FROM part")
def read_compounds(spark, sf):
    rows = readers.read_compounds(spark, X.compound_folder(spark, sf), one_per_file=False)
    return rows.select(_cid(), F.col("Record.RecordTitle").alias("title"))


@query(
    """SELECT p_partkey AS "CID", CASE WHEN p_partkey % 5 <> 0 THEN 'Synonyms' END AS heading,
    CASE WHEN p_partkey % 7 <> 3 THEN 'Record Description' END AS other FROM part"""
)
def section(spark, sf):
    inner = _names()["Section"]
    return X.compound_records(spark, sf).select(
        _cid(),
        N.section(inner, "Synonyms")["TOCHeading"].alias("heading"),
        N.section(inner, "Record Description")["TOCHeading"].alias("other"),
    )


REFERENCES = """SELECT p AS "CID", k AS "ReferenceNumber", s_name AS "SourceName", 'S' || k AS "SourceID",
    'nation ' || s_nationkey AS "ReferenceDescription", CASE WHEN k % 5 <> 0 THEN 'http://s/' || k END AS "URL" FROM links"""


@query(f"WITH {Q.LINKS} {REFERENCES}")
def compound_references(spark, sf):
    return P.compound_references(X.compound_records(spark, sf))


@query(
    f"""WITH {Q.DESCRIPTIONS}
    SELECT cid AS "CID", title AS "Title", k AS "ReferenceNumber", text AS "Description" FROM descr
    UNION ALL SELECT p_partkey, p_name, 99999999, 'no reference' FROM part WHERE p_partkey % 7 = 1"""
)
def compound_descriptions_raw(spark, sf):
    return P.compound_descriptions_raw(X.compound_records(spark, sf))


@query(
    """SELECT p_partkey AS "CID", CASE WHEN p_partkey % 9 <> 0 THEN lower(p_type) END AS "IUPACName",
    'InChI=' || p_partkey AS "InChI", p_brand AS "SMILES" FROM part"""
)
def compound_descriptors(spark, sf):
    found = N.descriptors(_names())
    return X.compound_records(spark, sf).select(_cid(), found.alias("d")).select("CID", "d.*")


@query("""SELECT p_partkey AS "CID", 'C' || p_size AS formula FROM part""")
def compound_formula(spark, sf):
    return X.compound_records(spark, sf).select(_cid(), N.formula(_names()).alias("formula"))


@query("""SELECT p_partkey AS "CID", CAST(CASE WHEN p_partkey % 5 = 0 THEN 0 ELSE 11 END AS BIGINT) AS n FROM part""")
def compound_synonyms(spark, sf):
    found = N.synonyms(_names())
    return X.compound_records(spark, sf).select(_cid(), F.size(found).cast("bigint").alias("n"))


COMPOUNDS = f"""SELECT p_partkey AS "CID", p_name AS "Title", 'C' || p_size AS "MolecularFormula",
    CASE WHEN p_partkey % 9 <> 0 THEN lower(p_type) END AS "IUPACName", 'InChI=' || p_partkey AS "InChI",
    p_brand AS "SMILES", array_to_string({Q.SYNONYMS}, '|') AS "Synonyms" FROM part"""


@query(COMPOUNDS)
def compounds_table(spark, sf):
    rows = P.compounds_table(X.compound_records(spark, sf))
    return rows.withColumn("Synonyms", F.array_join("Synonyms", "|"))


DESCRIBED = f"""WITH {Q.DESCRIPTIONS} SELECT cid AS "CID", title AS "Title", text AS "Description", k AS "ReferenceNumber",
    s_name AS "SourceName", 'S' || k AS "SourceID", 'nation ' || s_nationkey AS "ReferenceDescription",
    CASE WHEN k % 5 <> 0 THEN 'http://s/' || k END AS "URL" FROM descr"""


@query(DESCRIBED)
def descriptions_table(spark, sf):
    return P.descriptions_table(X.compound_records(spark, sf))


@query(DESCRIBED)
def attach_references(spark, sf):
    rows = X.compound_records(spark, sf)
    return P.attach_references(P.compound_descriptions_raw(rows), P.compound_references(rows))


@query(
    """SELECT p_partkey AS "CID", CAST(99999999 AS BIGINT) AS "ReferenceNumber", 'no reference' AS "Description"
    FROM part WHERE p_partkey % 7 = 1"""
)
def description_rejects(spark, sf):
    return P.description_rejects(X.compound_records(spark, sf))


def _stored(spark, sf):
    paths = scratch_path(spark, "compound-table"), scratch_path(spark, "description-table")
    plan.build_compound_tables(X.compound_records(spark, sf), *paths)
    return [spark.read.parquet(p) for p in paths]


@query(COMPOUNDS)
def build_compounds(spark, sf):
    compounds, _ = _stored(spark, sf)
    return compounds.withColumn("Synonyms", F.array_join("Synonyms", "|"))


@query(DESCRIBED)
def build_descriptions(spark, sf):
    return _stored(spark, sf)[1]


@query("SELECT p_partkey, p_name FROM part")
def append_table(spark, sf):
    path = scratch_path(spark, "parts")
    part = X.table(spark, sf, "part").select("p_partkey", "p_name")
    sinks.append_table(part.filter("p_partkey % 3 = 0"), path, ["p_partkey"])
    sinks.append_table(part, path, ["p_partkey"])
    return spark.read.parquet(path)


@query("SELECT p_partkey, p_name FROM part")
def append_table_buckets(spark, sf):
    """Three overlapping batches into a table that is dealt by a hash of its key."""
    path = scratch_path(spark, "parts")
    part = X.table(spark, sf, "part").select("p_partkey", "p_name")
    for batch in (part.filter("p_partkey % 3 = 0"), part.filter("p_partkey < 50"), part):
        sinks.append_table(batch, path, ["p_partkey"], buckets=16)
    return spark.read.parquet(path).select("p_partkey", "p_name")


COMPOUND_REJECTS = f"""WITH {Q.DESCRIPTIONS} SELECT 'compound' AS kind, 'no id' AS reason, p_name AS "Title",
    CAST(NULL AS BIGINT) AS "ReferenceNumber", CAST(NULL AS VARCHAR) AS "Description" FROM part WHERE p_partkey % 50 = 1
    UNION ALL SELECT 'description', 'no id', title, k, text FROM descr WHERE cid % 50 = 1
    UNION ALL SELECT 'description', CASE WHEN p_partkey % 50 = 1 THEN 'no id' ELSE 'no reference' END, p_name, 99999999, 'no reference'
    FROM part WHERE p_partkey % 7 = 1"""


@query(COMPOUND_REJECTS)
def compound_rejects(spark, sf):
    """Records without an id and descriptions without a reference, from the job's one pass."""
    path = scratch_path(spark, "rejects")
    cid = F.when(F.col("Record.RecordNumber") % 50 != 1, F.col("Record.RecordNumber"))
    records = X.compound_records(spark, sf).withColumn("Record", F.col("Record").withField("RecordNumber", cid))
    plan.build_compound_tables(records, rejects_path=path)
    return spark.read.parquet(path).select("kind", "reason", "Title", "ReferenceNumber", "Description")


@query("SELECT DISTINCT CAST(p_partkey // 2 AS BIGINT) AS k FROM part WHERE p_partkey % 5 <> 0")
def append_table_repeats(spark, sf):
    """A batch with repeated and null keys, appended twice."""
    path = scratch_path(spark, "parts")
    key = F.when(F.col("p_partkey") % 5 != 0, F.floor(F.col("p_partkey") / 2)).cast("bigint")
    batch = X.table(spark, sf, "part").select(key.alias("k"), "p_name")
    for _ in range(2):
        sinks.append_table(batch, path, ["k"])
    return spark.read.parquet(path).select("k")


@query(
    f"""SELECT p_partkey AS "CID", CASE WHEN len({Q.SYNONYMS}) = 0 THEN '[]'
      ELSE '["' || array_to_string({Q.SYNONYMS}, '","') || '"]' END AS "Synonyms" FROM part"""
)
def write_csv(spark, sf):
    path = scratch_path(spark, "csv")
    sinks.write_csv(P.compounds_table(X.compound_records(spark, sf)), path)
    back = readers.read_passages(spark, path, "Synonyms", ["CID"], fmt="csv")
    return back.select(F.col("CID").cast("bigint").alias("CID"), "Synonyms")
