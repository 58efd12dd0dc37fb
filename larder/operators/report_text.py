"""Markdown reports: sections, numbered recommendations, the assembled row.

Every rule is a row-local expression over the whole text, so a table of
reports is processed where it lies, without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder import functions as fn

# Headings, section names, the numbered-item pattern, defaults.
HEADING = "\n## "
INTRODUCTION = "introduction"
SUMMARY_SECTION = "executive_summary"
ADVICE_SECTION = "key_business_recommendations"
NUMBERED_ITEM = r"(?mdU)^(?:[^\S\n]|[\x1C-\x1F])*+\d+[.)][\s\x1C-\x1F]*(.+)$"
SUMMARY_LENGTH = 500
PENDING_MODEL = "pending"
PENDING_SUMMARY = "AI insights will be generated in the next pipeline task."
UNKNOWN_MODEL = "unknown"


def with_sections(reports: DataFrame) -> DataFrame:
    """Add ``sections``: an array of (section, body) in text order.

    A section runs from its ``## `` line to the next one.  What precedes the
    first is the introduction.  A heading with no line below it is left out.
    Sections with the same name are one: at the place of the first, with the
    body of the last.
    """
    text = F.col("text")
    # cut before every heading; the one added last only ends the text's final piece
    lines = F.concat(F.lit("\n"), fn.ended_lines(text), F.lit("## "))
    pieces = F.split(lines, HEADING)

    def section(piece: Column, at: Column) -> Column:
        # ahead of the first heading a piece has no heading line but starts with "\n"
        heading = fn.strip(F.lower(F.substring_index(piece, "\n", 1)))
        name = F.when(at == 0, INTRODUCTION).otherwise(F.translate(heading, " -", "__"))
        break_at = F.instr(piece, "\n")
        body = F.when(break_at > 0, fn.strip(F.substr(piece, break_at + 1)))
        return F.struct(name.alias("section"), at.alias("at"), body.alias("body"))

    found = F.filter(F.transform(pieces, section), lambda s: s["body"].isNotNull())
    # sorted by name and place, a section is the last of its name if the next one differs;
    # the array is a column first, so that looking at a neighbour does not compute it anew
    by_name = F.col("_by_name")
    last = F.filter(
        by_name, lambda s, i: ~s["section"].eqNullSafe(F.get(by_name, i + 1)["section"])
    )
    # likewise the first of its name; both arrays have the names in the same order
    first = F.filter(
        by_name,
        lambda s, i: (i == 0) | ~s["section"].eqNullSafe(F.get(by_name, i - 1)["section"]),
    )
    in_order = F.array_sort(
        F.zip_with(
            first, last, lambda a, b: F.struct(a["at"].alias("at"), b["section"], b["body"])
        )
    )
    listed = F.transform(
        in_order, lambda s: F.struct(s["section"].alias("section"), s["body"].alias("body"))
    )
    return (
        reports.withColumn("_by_name", F.array_sort(found))
        .withColumn("sections", listed)
        .drop("_by_name")
    )


def recommendations(text: Column) -> Column:
    """Array of the texts of lines that begin with ``1.`` or ``1)``."""
    items = F.regexp_extract_all(text, F.lit(NUMBERED_ITEM), F.lit(1))
    return F.filter(F.transform(items, fn.strip), lambda item: item != "")


def _exploded(reports: DataFrame, array: Column, position: str, item: str) -> DataFrame:
    """One row per array entry.

    The outer form, because Spark would filter on the size of an inner one
    first and so compute the array twice.
    """
    rows = reports.select("doc_id", F.posexplode_outer(array).alias(position, item))
    return rows.filter(F.col(position).isNotNull())


def report_sections(reports: DataFrame) -> DataFrame:
    """One row per report and section."""
    found = _exploded(with_sections(reports), F.col("sections"), "section_no", "found")
    return found.select("doc_id", "section_no", "found.section", "found.body")


def report_recommendations(reports: DataFrame) -> DataFrame:
    """One row per report and recommendation."""
    return _exploded(reports, recommendations(F.col("text")), "item_no", "recommendation")


def _body_of(found: Column, section: str) -> Column:
    return F.get(F.filter(found, lambda s: s["section"] == section), 0)["body"]


def assemble_reports(reports: DataFrame, generated_at: str) -> DataFrame:
    """One row per report, ready to show; a placeholder where its text is null.

    ``reports`` has doc_id and text, and may have model, generated_at and
    kpi_overview, the numbers that were current when the report was written.
    """

    def stored(column: str, default: str) -> Column:
        if column not in reports.columns:
            return F.lit(default)
        return F.coalesce(F.col(column), F.lit(default))

    text = F.col("text")
    here = text.isNotNull()
    found = F.col("sections")
    summary = F.coalesce(
        _body_of(found, SUMMARY_SECTION), F.substring(text, 1, SUMMARY_LENGTH)
    )
    advice = recommendations(F.coalesce(_body_of(found, ADVICE_SECTION), text))
    no_text = F.array().cast("array<string>")
    unknown = F.create_map().cast("map<string,string>").alias("kpi_overview")
    overview = "kpi_overview" if "kpi_overview" in reports.columns else unknown
    return with_sections(reports).select(
        "doc_id",
        F.when(here, stored("generated_at", generated_at))
        .otherwise(generated_at)
        .alias("last_updated"),
        F.when(here, stored("model", UNKNOWN_MODEL)).otherwise(PENDING_MODEL).alias("model"),
        F.when(here, summary).otherwise(PENDING_SUMMARY).alias("executive_summary"),
        F.when(here, F.map_from_entries(found))
        .otherwise(F.create_map().cast("map<string,string>"))
        .alias("sections"),
        F.when(here, advice).otherwise(no_text).alias("recommendations"),
        F.coalesce(text, F.lit("")).alias("full_text"),
        overview,
    )
