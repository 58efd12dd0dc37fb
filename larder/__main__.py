"""Run a stage: ``spark-submit larder/__main__.py STAGE FROM TO`` or ``python -m larder ...``.

ingest   raw CSV folder      -> bronze folder
silver   bronze folder       -> silver folder
gold     silver folder       -> gold folder
summary  gold folder         -> folder of the KPI summary
export   gold folder         -> dashboard folder
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from larder.plans.export import export_dashboards, export_summary, stored_report
from larder.plans.gold import build_gold
from larder.plans.ingest import ingest_all
from larder.plans.silver import build_silver

STAGES = {
    "ingest": ingest_all,
    "silver": build_silver,
    "gold": build_gold,
    "summary": export_summary,
}


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="larder", description="Run one stage.")
    parser.add_argument("stage", choices=[*STAGES, "export"])
    parser.add_argument("source", help="folder to read")
    parser.add_argument("target", help="folder to write")
    parser.add_argument("--report", help="JSON document of the report to export")
    parser.add_argument(
        "--multi-line", nargs="*", metavar="TABLE", help="ingest: tables with line breaks in values"
    )
    options = parser.parse_args(arguments)

    spark = SparkSession.builder.appName(f"larder {options.stage}").getOrCreate()
    if options.stage == "export":
        report = stored_report(spark, options.report) if options.report else None
        done = export_dashboards(
            spark, options.source, options.target, report, require_report=report is not None
        )
    elif options.stage == "ingest":
        done = ingest_all(spark, options.source, options.target, options.multi_line)
    else:
        done = STAGES[options.stage](spark, options.source, options.target)
    for name, result in done.items():
        print(f"{name}: {result}")


if __name__ == "__main__":
    main()
