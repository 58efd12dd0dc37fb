"""The silver transaction table to the five gold tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from larder import tables
from larder.operators import kpis, quality
from larder.operators.joins import find_hot_keys
from larder.plans.stage import Stage
from larder.plans.together import together
from larder.sources import parquet
from larder.sources.parquet import read_table
from larder.sources.workspace import scope, staged


def read_fact(spark: SparkSession, silver: str) -> DataFrame:
    """The transaction table with the columns the KPIs need, and no others."""
    return read_table(spark, silver, tables.TRANSACTIONS, tables.KPI_FACT_COLUMNS)


GOLD = {
    "gold_top_products": (kpis.gold_top_products, "products"),
    "gold_reorder_metrics": (kpis.gold_reorder_metrics, "products"),
    "gold_department_metrics": (kpis.gold_department_metrics, "fact"),
    "gold_basket_metrics": (kpis.gold_basket_metrics, "orders"),
    "gold_customer_metrics": (kpis.gold_customer_metrics, "orders"),
}


def gold_table(name: str, parts: Mapping[str, DataFrame], rows: int | None = None) -> DataFrame:
    """One of the five tables, from the product aggregates, the order level or the fact table of ``rows`` rows."""
    table, source = GOLD[name]
    return table(parts[source], rows) if source == "fact" else table(parts[source])


def build_gold(spark: SparkSession, silver: str, gold: str) -> dict[str, str]:
    """Write the gold tables; returns the folders of their files.

    The fact table is read three times: what two tables share, the aggregates of products and
    of orders, is written once below the work folder and read by both, so a lost
    executor costs a re-read.  Orders are written by customer, so that each customer is whole
    within a file and adding customers up moves a row for each.  Tables are published together; those that are there for
    this version of the fact table already are not made again.
    """
    stage = Stage(spark, gold)
    inputs = {tables.TRANSACTIONS: parquet.identity(spark, silver, tables.TRANSACTIONS)}
    fact = read_fact(spark, silver)
    stored = parquet.published(spark, silver, tables.TRANSACTIONS)
    rows = stored.rows if stored else None

    def by_customer(fact: DataFrame) -> DataFrame:
        hot = find_hot_keys(fact, "user_id", rows=rows)
        return kpis.orders_by_customer(fact, hot)

    chains = (
        (("gold_top_products", "gold_reorder_metrics"), "products", kpis.product_aggregates),
        (("gold_department_metrics",), "fact", None),
        (("gold_basket_metrics", "gold_customer_metrics"), "orders", by_customer),
    )

    def make(names: tuple[str, ...], shared: str, aggregate: Callable | None) -> None:
        parts = dict.fromkeys(("products", "orders", "fact"), fact)
        missing = any(stage.known(name, inputs) is None for name in names)
        if aggregate and missing:
            parts[shared] = staged(aggregate(fact))
        for name in names:
            stage.table(name, inputs, lambda: checked(gold_table(name, parts, rows), name))

    with scope(spark):
        together(spark, {chain[1]: partial(make, *chain) for chain in chains})
    stage.publish()
    return {name: f"{gold}/{stage.made[name].place}" for name in tables.GOLD_SCHEMAS}


def checked(df: DataFrame, name: str) -> DataFrame:
    """``df``, if it has the columns of the gold table it is meant for."""
    quality.require_columns(df, tables.GOLD_SCHEMAS[name], name)
    return df


def read_gold(spark: SparkSession, gold: str) -> dict[str, DataFrame]:
    """All gold tables, for reporting; a missing one is an error."""
    return {name: read_table(spark, gold, name) for name in tables.GOLD_SCHEMAS}
