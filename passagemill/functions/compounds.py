"""Column functions over one nested compound record. None of them shuffles.

A record is one row, so "last entry of a number wins" is decided inside its own arrays: entries
are sorted by (number, position) and the last of each run is kept, in n log n steps.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from passagemill import constants as C
from passagemill.functions.common import bind
from passagemill.functions.text import keep_synonyms


def section(sections: Column, heading: str) -> Column:
    """First section with the heading, or null."""
    return F.try_element_at(F.filter(sections, lambda s: s["TOCHeading"] == heading), F.lit(1))


def names_section(record: Column) -> Column:
    return section(record["Section"], C.NAMES_HEADING)


def first_string(information: Column) -> Column:
    """First text of the first information entry."""
    entry = F.try_element_at(information, F.lit(1))
    return F.try_element_at(entry["Value"]["StringWithMarkup"], F.lit(1))["String"]


def last_per_number(entries: Column) -> Column:
    """Entries ``struct(ReferenceNumber, …)`` of an array, the last one of every number."""

    def run_ends(runs: Column) -> Column:
        following = F.slice(runs, F.lit(2), F.greatest(F.size(runs), F.lit(1)))
        pairs = F.zip_with(
            runs, following, lambda a, b: F.struct(a.alias("this"), b.alias("next"))
        )
        ends = F.filter(
            pairs,
            lambda z: z["next"].isNull() | ~z["next"]["n"].eqNullSafe(z["this"]["n"]),
        )
        return F.transform(ends, lambda z: z["this"]["e"])

    placed = F.transform(
        entries,
        lambda e, i: F.struct(e["ReferenceNumber"].alias("n"), i.alias("i"), e.alias("e")),
    )
    return bind(F.array_sort(placed), run_ends)


def references(record: Column) -> Column:
    """One reference per number of a record."""
    return last_per_number(record["Reference"])


def descriptions(names: Column) -> Column:
    """``array<struct(ReferenceNumber, Description)>``, excluded number left out."""
    info = section(names["Section"], C.DESCRIPTION_HEADING)["Information"]
    kept = F.filter(info, lambda e: e["ReferenceNumber"] != C.EXCLUDED_REFERENCE)
    texts = F.transform(
        kept,
        lambda e: F.struct(
            e["ReferenceNumber"].alias("ReferenceNumber"),
            F.try_element_at(e["Value"]["StringWithMarkup"], F.lit(1))["String"].alias(
                "Description"
            ),
        ),
    )
    return last_per_number(texts)


def descriptors(names: Column) -> Column:
    """``struct(IUPACName, InChI, SMILES)``; the last subsection of a heading counts."""
    subs = section(names["Section"], C.DESCRIPTOR_HEADING)["Section"]

    def value(heading: str) -> Column:
        found = F.filter(subs, lambda s: s["TOCHeading"] == heading)
        return first_string(F.try_element_at(found, F.lit(-1))["Information"])

    return F.struct(
        value("IUPAC Name").alias("IUPACName"),
        value("InChI").alias("InChI"),
        value("SMILES").alias("SMILES"),
    )


def formula(names: Column) -> Column:
    return first_string(section(names["Section"], C.FORMULA_HEADING)["Information"])


def synonyms(names: Column) -> Column:
    """Depositor-supplied names, all of them; an empty array when any step is missing."""
    listed = section(section(names["Section"], C.SYNONYM_HEADING)["Section"], C.DEPOSITOR_HEADING)
    entry = F.try_element_at(listed["Information"], F.lit(1))
    texts = F.transform(entry["Value"]["StringWithMarkup"], lambda s: s["String"])
    return F.coalesce(texts, F.array().cast("array<string>"))


def textual_synonyms(names: Column) -> Column:
    return keep_synonyms(synonyms(names))
