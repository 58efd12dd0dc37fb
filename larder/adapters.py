"""The basket tables derived from the order, line, part and document tables.

Plain projections and filters (see FIXTURES.md), so that the plan of a query is
the plan of its operator.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp_ntz",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_linenumber int, "
    "l_returnflag string, l_linestatus string",
    "documents": "doc_id bigint, text string, lang string, source string",
}


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def _id_of(name: str) -> str:
    """A stable 60-bit number for a name, computed row by row."""
    return f"CAST(conv(substring(md5({name}), 1, 15), 16, 10) AS BIGINT)"


def orders(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "orders").selectExpr(
        "o_orderkey AS order_id",
        "o_custkey AS user_id",
        "CASE o_orderstatus WHEN 'F' THEN ' Prior ' WHEN 'O' THEN 'TRAIN' ELSE 'test' END"
        " AS eval_set",
        "CAST(o_orderkey % 100 + 1 AS INT) AS order_number",
        "dayofweek(o_orderdate) - 1 AS order_dow",
        "CAST(o_orderkey % 24 AS INT) AS order_hour_of_day",
        "CASE WHEN o_orderkey % 100 > 0 THEN CAST(o_orderkey % 31 AS DOUBLE) END"
        " AS days_since_prior_order",
    )


def aisles(spark: SparkSession, folder: str) -> DataFrame:
    names = _table(spark, folder, "part").selectExpr("p_type AS aisle").distinct()
    return names.selectExpr(f"{_id_of('aisle')} AS aisle_id", "aisle")


def departments(spark: SparkSession, folder: str) -> DataFrame:
    names = _table(spark, folder, "part").selectExpr("p_brand AS department").distinct()
    return names.selectExpr(f"{_id_of('department')} AS department_id", "department")


def products(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "part").selectExpr(
        "p_partkey AS product_id",
        "p_name AS product_name",
        f"{_id_of('p_type')} AS aisle_id",
        f"{_id_of('p_brand')} AS department_id",
    )


def _lines(spark: SparkSession, folder: str, status: str) -> DataFrame:
    return (
        _table(spark, folder, "lineitem")
        .filter(f"l_linestatus = '{status}'")
        .selectExpr(
            "l_orderkey AS order_id",
            "l_partkey AS product_id",
            "l_linenumber AS add_to_cart_order",
            "CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS reordered",
        )
    )


def prior_lines(spark: SparkSession, folder: str) -> DataFrame:
    return _lines(spark, folder, "F")


def train_lines(spark: SparkSession, folder: str) -> DataFrame:
    return _lines(spark, folder, "O")


def messy_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with nulls, values out of range, and ids that occur twice."""
    base = orders(spark, folder).withColumns(
        {
            "user_id": F.when(F.col("order_dow") != 3, F.col("user_id")),
            "order_number": F.col("order_number") - 1,
        }
    )
    again = base.filter(F.col("eval_set") == "test").withColumn(
        "order_hour_of_day", F.col("order_hour_of_day") + 1
    )
    return base.unionByName(again)


def messy_products(spark: SparkSession, folder: str) -> DataFrame:
    """Products with untidy, blank or missing names, and ids that occur twice."""
    base = _table(spark, folder, "part").selectExpr(
        "p_partkey AS product_id",
        "CASE WHEN p_size = 1 THEN '   ' WHEN p_size != 2"
        " THEN concat('  ', upper(p_name), char(9), '  ', p_type, ' ') END AS product_name",
        f"CASE WHEN p_size != 3 THEN {_id_of('p_type')} END AS aisle_id",
        f"{_id_of('p_brand')} AS department_id",
    )
    again = base.withColumn("product_name", F.concat(F.lit("A second "), "product_name"))
    return base.unionByName(again)


def messy_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lines with values out of range and with duplicates that disagree."""
    prior = prior_lines(spark, folder).withColumn(
        "add_to_cart_order", F.col("add_to_cart_order") - 1
    )
    again = prior.withColumn(
        "reordered", F.when(F.col("add_to_cart_order") == 1, 2).otherwise(1 - F.col("reordered"))
    )
    return prior.unionByName(again).unionByName(train_lines(spark, folder))


def report_texts(spark: SparkSession, folder: str) -> DataFrame:
    """A markdown report around every whole document text.

    The layout depends on the language: with both named sections (English),
    with text ahead of the first heading and a heading that is repeated
    (German), without named sections (French), with a heading that comes back after
    another one (the rest).  Each of the rest also has a report that is not written
    yet, under a negative id.
    """
    text, source = F.col("text"), F.col("source")
    lang = F.col("lang")

    def layout(*parts: Column | str) -> Column:
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])

    documents = _table(spark, folder, "documents")
    rest = ~F.coalesce(lang, F.lit("")).isin("en", "de", "fr")
    pending = documents.filter(rest).select(
        (-1 - F.col("doc_id")).alias("doc_id"), F.lit(None).cast("string").alias("text")
    )
    written = documents.select(
        "doc_id",
        F.when(
            lang == "en",
            layout(
                "## Executive Summary\n",
                text,
                "\n## Key Business Recommendations\n1. ",
                lang,
                "\n2) ",
                source,
            ),
        )
        .when(
            lang == "de",
            layout(
                source,
                "\r\n## Basket-Size Analysis\n## Executive Summary\nfirst\n",
                "## Executive Summary\n\n  ",
                text,
                "  \n",
            ),
        )
        .when(lang == "fr", layout(text, "\n 12. ", source, "\n3) \n4 x\n"))
        .otherwise(
            layout(
                "## Notes\nfirst\n## Executive Summary\r\n",
                text,
                "\n## Notes\n\n1. ",
                source,
                "\n",
            )
        )
        .alias("text"),
    )
    return written.union(pending)
