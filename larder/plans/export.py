"""Gold tables to the KPI summary and the dashboard documents."""

from __future__ import annotations

from datetime import datetime, timezone
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from larder import LarderError
from larder.operators import documents, reports
from larder.plans.gold import read_gold
from larder.plans.together import together
from larder.sources.json import one_row, read_document, write_document

INSIGHTS = "ai_insights.json"
SUMMARY = "kpi_summary.json"


def no_report(spark: SparkSession) -> DataFrame:
    """A report row without text, which is shown as a placeholder."""
    return one_row(spark).select(
        F.col("id").alias("doc_id"), F.lit(None).cast("string").alias("text")
    )


def export_summary(spark: SparkSession, gold: str, out: str) -> dict[str, str]:
    """Write the KPI summary, from which reports are written; returns its path."""
    write_document(documents.kpi_summary(read_gold(spark, gold), indented=True), f"{out}/{SUMMARY}")
    return {SUMMARY: f"{out}/{SUMMARY}"}


def stored_report(spark: SparkSession, path: str) -> DataFrame:
    """A report stored as a JSON document, as ``export_dashboards`` takes it.

    Its fields are executive_insights, the text; model; generated_at; and kpi_summary,
    the summary it was written from, whose overview stays with it.  All may be missing,
    the text is empty then.  A document with a text field is taken as it is.
    """
    document = read_document(spark, path)
    found = document.schema
    if "text" in found.names:
        same = [name for name in document.columns if name != "doc_id"]
        return document.select(F.lit(0).cast("long").alias("doc_id"), *same)
    text = F.col("executive_insights") if "executive_insights" in found.names else F.lit(None)
    shown = [text.cast("string").alias("text")]
    shown += [F.col(name) for name in ("model", "generated_at") if name in found.names]
    summary = found["kpi_summary"].dataType if "kpi_summary" in found.names else None
    if isinstance(summary, StructType) and "dataset_overview" in summary.names:
        shown.append(F.col("kpi_summary.dataset_overview").alias("kpi_overview"))
    return document.select(F.lit(0).cast("long").alias("doc_id"), *shown).fillna("", ["text"])


def export_dashboards(
    spark: SparkSession,
    gold: str,
    out: str,
    report: DataFrame | None = None,
    require_report: bool = True,
    now: str | None = None,
    indented: bool = True,
) -> dict[str, str]:
    """Write the six dashboard documents below ``out``; returns their paths.

    ``report`` is the one-row report to show (doc_id, text, and if known model,
    generated_at, kpi_overview).  Without one the export fails, or writes a
    placeholder if ``require_report`` is off.  ``now`` is the time to show, by default
    that of the call.
    """
    if report is None:
        if require_report:
            raise LarderError("no report to export")
        report = no_report(spark)
    now = now or datetime.now(timezone.utc).isoformat()
    written = documents.dashboards(read_gold(spark, gold), now, indented)
    written[INSIGHTS] = documents.insight_document(report, now, indented)
    together(
        spark,
        {
            name: partial(write_document, document, f"{out}/{name}")
            for name, document in written.items()
        },
    )
    return {name: f"{out}/{name}" for name in written}


def read_overview(spark: SparkSession, out: str) -> DataFrame:
    """The headline numbers of exported documents, in one row.

    Numbers stored with the report come first, then those of the tables.
    """
    shown = {
        name: read_document(spark, f"{out}/{name}")
        for name in (
            "top_products.json",
            "department_metrics.json",
            "basket_metrics.json",
            "customer_metrics.json",
            INSIGHTS,
        )
    }

    def figure(document: str, path: str) -> Column:
        return shown[document].select(path).scalar()

    overview = one_row(spark).select(
        figure("top_products.json", "total_products").alias("total_unique_products"),
        figure("department_metrics.json", "total_departments").alias("total_departments"),
        figure("basket_metrics.json", "summary.total_orders").alias("total_orders"),
        figure("customer_metrics.json", "summary.total_customers").alias("total_customers"),
        figure("basket_metrics.json", "summary.total_line_items").alias("total_line_items"),
    )
    insights = shown[INSIGHTS]
    numbers = ["kpi_overview.*"] if "kpi_overview" in insights.columns else []
    stored = insights.select("last_updated", *numbers)
    return reports.dashboard_overview(overview, stored, last_updated="")
