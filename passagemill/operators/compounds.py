"""Compound records to flat tables. Everything comes from one record, so nothing shuffles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passagemill.functions import compounds as P
from passagemill.functions.common import bind, explode_rows

_REFERENCE = {
    "SourceName": "SourceName",
    "SourceID": "SourceID",
    "Description": "ReferenceDescription",
    "URL": "URL",
}


def compounds_table(df: DataFrame, *extra: Column) -> DataFrame:
    """One row of seven columns per record."""
    record = F.col("Record")
    names = P.names_section(record)
    parts = df.select("Record", names.alias("_names"), P.descriptors(names).alias("_d"))
    return parts.select(
        record["RecordNumber"].alias("CID"),
        record["RecordTitle"].alias("Title"),
        P.formula(F.col("_names")).alias("MolecularFormula"),
        F.col("_d.IUPACName").alias("IUPACName"),
        F.col("_d.InChI").alias("InChI"),
        F.col("_d.SMILES").alias("SMILES"),
        P.textual_synonyms(F.col("_names")).alias("Synonyms"),
        *extra,
    )


#: References that are few enough to be looked up one by one.
_FEW = 64


def described(record: Column) -> Column:
    """Array of a record's descriptions, each with its reference's fields (null if unmatched).

    References are in order of their number, so a description of a record with many of them finds
    its own by halving steps; with few a map, which is searched from its start, is faster.
    """

    def attach(refs: Column) -> Column:
        few = F.size(refs) <= _FEW
        by_number = F.map_from_entries(
            F.transform(F.slice(refs, F.lit(1), F.when(few, _FEW).otherwise(0)), lambda r: F.struct(r["ReferenceNumber"].alias("n"), r.alias("r")))
        )
        steps = F.filter(F.array(*[F.lit(1 << k) for k in reversed(range(31))]), lambda p: p <= F.size(refs))

        def halved(number: Column, steps: Column) -> Column:
            reach = F.aggregate(
                steps,
                F.lit(0),
                lambda at, step: F.when(F.get(refs, at + step - 1)["ReferenceNumber"] <= number, at + step).otherwise(at),
            )
            return bind(F.get(refs, reach - 1), lambda last: F.when(last["ReferenceNumber"] == number, last))

        def one(d: Column, found: Column) -> Column:
            return bind(
                found,
                lambda ref: F.struct(
                    d["Description"].alias("Description"),
                    d["ReferenceNumber"].alias("ReferenceNumber"),
                    *[ref[name].alias(alias) for name, alias in _REFERENCE.items()],
                    ref.isNotNull().alias("matched"),
                ),
            )

        own = P.descriptions(P.names_section(record))
        mapped = bind(by_number, lambda m: F.transform(own, lambda d: one(d, F.try_element_at(m, d["ReferenceNumber"]))))
        searched = bind(steps, lambda s: F.transform(own, lambda d: one(d, halved(d["ReferenceNumber"], s))))
        return F.when(few, mapped).otherwise(searched)

    return bind(F.filter(P.references(record), lambda r: r["ReferenceNumber"].isNotNull()), attach)


def compound_references(df: DataFrame) -> DataFrame:
    """``(CID, ReferenceNumber, SourceName, SourceID, ReferenceDescription, URL)``."""
    cid = F.col("Record.RecordNumber").alias("CID")
    rows = explode_rows(df, [cid], P.references(F.col("Record")), "r")
    fields = [F.col(f"r.{name}").alias(alias) for name, alias in _REFERENCE.items()]
    return rows.select("CID", "r.ReferenceNumber", *fields)


def compound_descriptions_raw(df: DataFrame) -> DataFrame:
    """``(CID, Title, ReferenceNumber, Description)``."""
    found = P.descriptions(P.names_section(F.col("Record")))
    keep = [F.col("Record.RecordNumber").alias("CID"), F.col("Record.RecordTitle").alias("Title")]
    rows = explode_rows(df, keep, found, "d")
    return rows.select("CID", "Title", "d.ReferenceNumber", "d.Description")


def explode_described(df: DataFrame) -> DataFrame:
    """Rows of the descriptions table from ``(CID, Title, described)``, with ``matched``."""
    rows = explode_rows(df, ["CID", "Title"], F.col("described"), "d")
    return rows.select(
        "CID",
        "Title",
        "d.Description",
        "d.ReferenceNumber",
        *[f"d.{alias}" for alias in _REFERENCE.values()],
        "d.matched",
    )


def _all_described(df: DataFrame) -> DataFrame:
    record = F.col("Record")
    return explode_described(
        df.select(
            record["RecordNumber"].alias("CID"),
            record["RecordTitle"].alias("Title"),
            described(record).alias("described"),
        )
    )


def only_matched(rows: DataFrame, strict: bool = False) -> DataFrame:
    """Drop descriptions without a reference. ``strict`` fails on the first, and on one that lacks a field."""
    if strict:
        number = F.col("ReferenceNumber").cast("string")
        lacking = F.filter(F.array(*[F.when(F.col(alias).isNull(), F.lit(alias)) for alias in _REFERENCE.values()]), lambda x: x.isNotNull())
        problem = F.when(~F.col("matched"), F.concat(F.lit("no reference "), number)).when(
            F.size(lacking) > 0, F.concat(F.lit("reference "), number, F.lit(" lacks "), F.array_join(lacking, ", "))
        )
        kept = F.when(problem.isNull(), True).otherwise(F.raise_error(problem).cast("boolean"))
        return rows.filter(kept).drop("matched")
    return rows.filter("matched").drop("matched")


def descriptions_table(df: DataFrame, strict: bool = False) -> DataFrame:
    """Eight columns per description that has a reference; the others are in the rejects."""
    return only_matched(_all_described(df), strict)


def description_rejects(df: DataFrame) -> DataFrame:
    """Descriptions whose reference number names no reference of their record."""
    return _all_described(df).filter(~F.col("matched")).select("CID", "ReferenceNumber", "Description")


def attach_references(descriptions: DataFrame, references: DataFrame) -> DataFrame:
    """The same table from two flat tables, as an equi-join on ``(CID, ReferenceNumber)``."""
    joined = descriptions.join(references, ["CID", "ReferenceNumber"])
    fields = list(_REFERENCE.values())
    return joined.select("CID", "Title", "Description", "ReferenceNumber", *fields)
