"""Bronze tables to checked, cleaned and joined silver tables."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime, timezone
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from larder import tables
from larder.operators import cleaning, quality, star
from larder.operators.joins import Size
from larder.plans.stage import Stage
from larder.plans.together import together
from larder.sources import parquet
from larder.sources.json import write_document
from larder.sources.workspace import file_system, scope, staged
from larder.tables import TableSpec

SINGLE = (tables.ORDERS, tables.PRODUCTS, tables.DEPARTMENTS, tables.AISLES)
SPLITS = (tables.PRIOR_LINES, tables.TRAIN_LINES)
LINES = "clean_order_products"


def check_bronze(
    bronze: Mapping[str, DataFrame], merged: DataFrame, groups: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """Checks of all inputs.

    The two line splits get schema checks only; their values are checked once,
    merged.  ``groups`` has, by table, one row for each key, from which duplicates are counted
    without grouping again.  Checks report, they never stop a run.
    """
    groups = groups or {}
    return quality.union_checks(
        [
            *[
                quality.check_table(bronze[spec.name], spec, groups=groups.get(spec.name))
                for spec in SINGLE
            ],
            *[quality.schema_checks(bronze[spec.name], spec) for spec in SPLITS],
            quality.check_table(
                merged, tables.MERGED_LINES, groups=groups.get(tables.MERGED_LINES.name)
            ),
        ]
    )


def build_silver(spark: SparkSession, bronze: str, silver: str) -> dict[str, int]:
    """Write all silver tables and the quality report; returns rows per table.

    Every cleaned table is read back from its files, so nothing is cleaned
    twice and the joins see plain scans, which adaptive execution can split
    where keys are skewed.  Each input is grouped by its key once, for the count of
    duplicates and the cleaned table together.  Sizes of tables come from their manifests, so
    joins are planned without jobs.

    Tables are published together at the end.  A table whose inputs are those of a
    whole version is not made again, whether that was published or left by a run
    that ended early.  Work folders are gone when it returns.
    """
    with scope(spark):
        return _Silver(spark, bronze, silver).build()


class _Silver:
    def __init__(self, spark: SparkSession, bronze: str, silver: str) -> None:
        self.spark, self.bronze, self.stage = spark, bronze, Stage(spark, silver)
        self.ids = {s.name: parquet.identity(spark, bronze, s.name) for s in tables.RAW_TABLES}
        self.inputs = {s.name: parquet.read_table(spark, bronze, s.name) for s in tables.RAW_TABLES}
        self.merged = cleaning.merge_order_products(*[self.inputs[s.name] for s in SPLITS])
        self.groups: dict[str, DataFrame] = {}

    def build(self) -> dict[str, int]:
        split_ids = {spec.name: self.ids[spec.name] for spec in SPLITS}
        report_known = self.stage.known(tables.QUALITY_REPORT, self.ids) is not None
        together(
            self.spark, {s.name: partial(self.cleaned, s, report_known) for s in SINGLE}
        )
        ids = {name: version.id for name, version in self.stage.made.items()}
        lines_from = {**split_ids, **{n: ids[n] for n in ("clean_orders", "clean_products")}}
        if not report_known or self.stage.known(LINES, lines_from) is None:
            rows = self.line_rows()
            self.groups[tables.MERGED_LINES.name] = staged(
                cleaning.grouped_lines(self.merged, self.stage.read("clean_orders"), rows)
            )
        together(self.spark, {"report": self.report, "lines": partial(self.lines, lines_from)})
        self.stage.publish()
        return {name: self.stage.rows[name] for name in sorted(self.stage.rows)}

    def cleaned(self, spec: TableSpec, report_known: bool) -> None:
        name, inputs = f"clean_{spec.name}", {spec.name: self.ids[spec.name]}
        if not report_known or self.stage.known(name, inputs) is None:
            self.groups[spec.name] = staged(cleaning.grouped(self.inputs[spec.name], spec))
        self.stage.table(name, inputs, lambda: cleaning.best_rows(self.groups[spec.name], spec))

    def line_rows(self) -> int | None:
        """Rows of both splits, where their manifests tell."""
        found = [parquet.published(self.spark, self.bronze, spec.name) for spec in SPLITS]
        return sum(v.rows for v in found) if all(found) else None

    def report(self) -> None:
        generated_at = datetime.now(timezone.utc).isoformat()
        name = tables.QUALITY_REPORT
        self.stage.table(
            name,
            self.ids,
            lambda: quality.report_table(
                check_bronze(self.inputs, self.merged, self.groups), generated_at
            ),
        )
        path = f"{self.stage.root}/{name}.json"
        files, at = file_system(self.spark, path)
        if self.stage.is_new(name) or not files.exists(at):
            write_document(quality.summary_document(self.stage.read(name), generated_at), path)

    def lines(self, inputs: Mapping[str, str]) -> None:
        """The cleaned lines, and the transactions joined from them."""
        made, read = self.stage.made, self.stage.read
        products = made["clean_products"]
        lines = self.stage.table(
            LINES,
            inputs,
            lambda: cleaning.known_lines(
                self.groups[tables.MERGED_LINES.name], read("clean_products"), Size(products.rows)
            ),
        )
        names = made["clean_aisles"].widest + made["clean_departments"].widest
        cleaned = ("clean_orders", "clean_products", "clean_aisles", "clean_departments")
        self.stage.table(
            tables.TRANSACTIONS,
            {name: made[name].id for name in (LINES, *cleaned)},
            lambda: star.retail_transactions(
                read(LINES),
                *map(read, cleaned),
                size=Size(products.rows, products.octets + products.rows * names),
                rows=lines.rows,
            ),
        )
