"""Preprint hits to the twelve-column summary table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passagemill.functions.text import format_authors, join_keywords


def pdf_url(item: Column) -> Column:
    return item["asset"]["original"]["url"]


def project_preprints(df: DataFrame, item: str = "item", keep: Sequence[str] = ()) -> DataFrame:
    """The twelve columns, and after them the columns named in ``keep``."""
    it = F.col(item)
    plain = ["id", "doi", "title", "abstract", "publishedDate", "submittedDate", "status", "version"]
    return df.select(
        *[it[name].alias(name) for name in plain],
        it["license"]["name"].alias("license"),
        join_keywords(it["keywords"]).alias("keywords"),
        format_authors(it["authors"]).alias("authors"),
        pdf_url(it).alias("pdf_url"),
        *keep,
    )
