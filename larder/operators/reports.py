"""Reporting tables over the gold tables: rankings, histograms, segments, summaries.

Gold tables have one row per product, department, order or customer, so these are
counted as rows, without a shuffle of their ids.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from larder import functions as fn

# List lengths, histogram bounds, segment names.
TOP_PRODUCTS = 500
TOP_CUSTOMERS = 50
SUMMARY_TOP = 10
SUMMARY_TOP_CUSTOMERS = 5
FREQUENCY_ROWS = 15
SHARE_TOP = 6
SEARCH_ROWS = 100
BASKET_BUCKETS = (
    ("1", 1, 2),
    ("2", 2, 3),
    ("3-4", 3, 5),
    ("5-9", 5, 10),
    ("10-19", 10, 20),
    ("20-49", 20, 50),
    ("50-99", 50, 100),
    ("100+", 100, None),
)
SEGMENTS = (
    ("Single Order", 1),
    ("Occasional (2-5)", 5),
    ("Regular (6-10)", 10),
    ("Loyal (11-20)", 20),
)
TOP_SEGMENT = "Power User (21+)"
POWER_ORDERS = 21
LOYAL_ORDERS = 10
HIGH_REORDER_RATE = 0.5


def _display(df: DataFrame) -> DataFrame:
    """Doubles to the four decimals that documents show."""
    return df.withColumns(
        {
            f.name: fn.rounded(F.col(f.name), 4)
            for f in df.schema.fields
            if isinstance(f.dataType, T.DoubleType)
        }
    )


def top_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows in the given order, with their 1-based position.

    ``order`` must end in a unique column, so that ties cannot reorder.  The
    window runs over the ``n`` rows that are left, not over the table.
    """
    head = df.orderBy(*order).limit(n)
    return _display(head.withColumn("position", F.row_number().over(Window.orderBy(*order))))


def _n_rows(df: DataFrame, column: str) -> Column:
    """Number of rows with the column, which names each row, as a scalar subquery."""
    return df.agg(F.count(column)).scalar()


def top_products(products: DataFrame, n: int = TOP_PRODUCTS) -> DataFrame:
    return top_n(products, [F.desc("total_orders"), F.asc("product_id")], n)


def top_reorder(rates: DataFrame, n: int = TOP_PRODUCTS) -> DataFrame:
    return top_n(rates, [F.desc("reorder_rate"), F.asc("product_id")], n)


def top_departments(departments: DataFrame, n: int = SUMMARY_TOP) -> DataFrame:
    return top_n(departments, [F.desc("total_products_sold"), F.asc("department")], n)


def top_customers(customers: DataFrame, n: int = TOP_CUSTOMERS) -> DataFrame:
    return top_n(customers, [F.desc("total_orders"), F.asc("user_id")], n)


def product_ranking(products: DataFrame, n: int = TOP_PRODUCTS) -> DataFrame:
    """Top products next to the number of all products."""
    return top_products(products, n).withColumn(
        "total_products", _n_rows(products, "product_id")
    )


def reorder_ranking(rates: DataFrame, n: int = TOP_PRODUCTS) -> DataFrame:
    return top_reorder(rates, n).withColumn("total_products", _n_rows(rates, "product_id"))


def department_rank(departments: DataFrame) -> DataFrame:
    """Every department with its rank; one row per department of the catalogue."""
    order = Window.orderBy(F.desc("total_products_sold"), F.asc("department"))
    return departments.withColumn("rank", F.row_number().over(order))


def department_ranking(departments: DataFrame) -> DataFrame:
    """Departments by lines sold, next to their number."""
    return departments.orderBy(F.desc("total_products_sold"), "department").withColumn(
        "total_departments", _n_rows(departments, "department")
    )


def department_share(departments: DataFrame, n: int = SHARE_TOP) -> DataFrame:
    """Each top department's part of what the top departments sell together."""
    sold = F.col("total_products_sold")
    together = F.sum(sold).over(Window.partitionBy())
    return top_departments(departments, n).select(
        "position", "department", sold, fn.rounded(fn.ratio(sold, together), 4).alias("share")
    )


def top_reorder_mean(rates: DataFrame, n: int = TOP_PRODUCTS) -> DataFrame:
    """Mean of the rates shown in the top list (not of all products)."""
    return top_reorder(rates, n).agg(
        fn.rounded(F.avg("reorder_rate"), 4).alias("mean_reorder_rate")
    )


def basket_figures(baskets: DataFrame) -> DataFrame:
    """Size statistics and orders per size bucket (a struct), in one row from one pass.

    The median is exact: its buffer holds one entry per distinct basket size.
    Empty buckets are included; sizes below the first bucket count nowhere.
    """
    size = F.col("basket_size")
    buckets = [
        F.count_if((size >= low) & (F.lit(True) if high is None else size < high)).alias(label)
        for label, low, high in BASKET_BUCKETS
    ]
    return baskets.agg(
        F.count("order_id").alias("total_orders"),
        F.sum(size).alias("total_line_items"),
        fn.rounded(F.avg(size), 2).alias("mean_basket_size"),
        fn.rounded(F.median(size), 2).alias("median_basket_size"),
        F.min(size).alias("min_basket_size"),
        F.max(size).alias("max_basket_size"),
        fn.rounded(F.stddev_samp(size), 2).alias("std_basket_size"),
        F.struct(*buckets).alias("buckets"),
    )


def bucket_list() -> Column:
    """The buckets of ``basket_figures`` as an array, in bucket order."""
    return F.array(
        *[
            F.struct(
                F.lit(at).alias("position"),
                F.lit(label).alias("bucket"),
                F.col("buckets")[label].alias("orders"),
            )
            for at, (label, _, _) in enumerate(BASKET_BUCKETS, start=1)
        ]
    )


def basket_histogram(baskets: DataFrame) -> DataFrame:
    """Orders per size bucket, in bucket order, empty buckets included."""
    return basket_figures(baskets).select(F.inline(bucket_list()))


def basket_summary(baskets: DataFrame) -> DataFrame:
    """Size statistics in one row."""
    return basket_figures(baskets).drop("buckets")


def customer_segment(customers: DataFrame) -> DataFrame:
    """Label every customer by number of orders."""
    orders = F.col("total_orders")
    (first, one), *rest = SEGMENTS
    label = F.when(orders == one, first)
    for name, most in rest:
        label = label.when(orders <= most, name)
    return customers.withColumn("segment", label.otherwise(TOP_SEGMENT))


def customer_segmentation(customers: DataFrame) -> DataFrame:
    """Customers per segment, their share and their mean habits."""
    everyone = F.sum("customers").over(Window.partitionBy())
    return (
        customer_segment(customers)
        .groupBy("segment")
        .agg(
            F.count("user_id").alias("customers"),
            F.avg("avg_basket_size").alias("basket"),
            F.avg("total_products").alias("products"),
        )
        .select(
            "segment",
            "customers",
            fn.percent(F.col("customers"), everyone).alias("percentage"),
            fn.rounded(F.col("basket"), 2).alias("avg_basket_size"),
            fn.rounded(F.col("products"), 2).alias("avg_products"),
        )
        .orderBy("segment")
    )


def order_frequency(customers: DataFrame, n: int = FREQUENCY_ROWS) -> DataFrame:
    """Customers per number of orders, for the smallest numbers."""
    return (
        customers.groupBy(F.col("total_orders").alias("orders"))
        .agg(F.count("*").alias("customers"))
        .orderBy("orders")
        .limit(n)
    )


def _customer_means(customers: DataFrame, at_least: int, share_name: str) -> DataFrame:
    orders = F.col("total_orders")

    def share(condition: Column) -> Column:
        return fn.rounded(F.avg(F.when(condition, 1.0).otherwise(0.0)) * 100.0, 2)

    return customers.agg(
        F.count("user_id").alias("total_customers"),
        fn.rounded(F.avg(orders), 2).alias("avg_orders_per_customer"),
        fn.rounded(F.median(orders), 2).alias("median_orders_per_customer"),
        fn.rounded(F.avg("total_products"), 2).alias("avg_products_per_customer"),
        fn.rounded(F.avg("avg_basket_size"), 2).alias("avg_basket_size"),
        share(orders == 1).alias("single_order_customer_pct"),
        share(orders >= at_least).alias(share_name),
    )


def customer_summary(customers: DataFrame) -> DataFrame:
    return _customer_means(customers, POWER_ORDERS, "power_user_pct")


def customer_trends(customers: DataFrame) -> DataFrame:
    means = _customer_means(customers, LOYAL_ORDERS, "customers_with_10plus_orders_pct")
    return means.drop("total_customers").withColumnsRenamed(
        {
            "avg_basket_size": "avg_basket_size_per_customer",
            "single_order_customer_pct": "customers_with_single_order_pct",
        }
    )


def dataset_overview(
    products: DataFrame, departments: DataFrame, baskets: DataFrame, customers: DataFrame
) -> DataFrame:
    """How much there is of everything, in one row."""
    sizes = baskets.agg(
        F.count("order_id").alias("total_orders"), F.sum("basket_size").alias("total_line_items")
    )
    return sizes.select(
        _n_rows(products, "product_id").alias("total_unique_products"),
        _n_rows(departments, "department").alias("total_departments"),
        "total_orders",
        _n_rows(customers, "user_id").alias("total_customers"),
        "total_line_items",
    )


def reorder_highlights(products: DataFrame) -> DataFrame:
    """Unweighted mean rate, and how many products exceed one half."""
    rate = F.col("reorder_rate")
    return products.agg(
        fn.rounded(F.avg(rate), 4).alias("overall_avg_reorder_rate"),
        F.count_if(rate > HIGH_REORDER_RATE).alias("products_with_reorder_rate_above_50pct"),
    )


def top_slices(
    products: DataFrame, rates: DataFrame, departments: DataFrame, n: int = SUMMARY_TOP
) -> DataFrame:
    """The three top lists of the summary, one under another."""

    def part(title: str, rows: DataFrame, name: str, measure: str) -> DataFrame:
        return rows.select(
            F.lit(title).alias("slice"),
            "position",
            F.col(name).alias("name"),
            F.col(measure).cast("double").alias("measure"),
        )

    return (
        part("top_performing_products", top_products(products, n), "product_name", "total_orders")
        .unionByName(
            part("most_reordered_products", top_reorder(rates, n), "product_name", "reorder_rate")
        )
        .unionByName(
            part(
                "best_performing_departments",
                top_departments(departments, n),
                "department",
                "total_products_sold",
            )
        )
    )


def dashboard_overview(
    overview: DataFrame, stored: DataFrame | None = None, last_updated: str | None = None
) -> DataFrame:
    """The headline numbers, preferring those stored with the last report.

    ``overview`` is the one-row ``dataset_overview``; ``stored`` one with the
    same columns and ``last_updated``, some of them null or absent.
    """
    known = {} if stored is None else dict(stored.dtypes)

    def preferred(column: str, otherwise: Column) -> Column:
        if column not in known:
            return otherwise
        return F.coalesce(stored.agg(F.max(column)).scalar(), otherwise)

    numbers = {
        "total_customers": "total_customers",
        "total_products": "total_unique_products",
        "total_departments": "total_departments",
        "total_transactions": "total_orders",
        "total_line_items": "total_line_items",
    }
    shown = [preferred(c, F.col(c)).alias(name) for name, c in numbers.items()]
    if last_updated is not None:
        shown.append(preferred("last_updated", F.lit(last_updated)).alias("last_updated"))
    return overview.select(*shown)


def product_search(
    products: DataFrame,
    text: str,
    sort_by: str = "total_orders",
    descending: bool = True,
    n: int = SEARCH_ROWS,
) -> DataFrame:
    """Products whose name or id contains ``text``; the first ``n`` and the match count.

    Names sort by Unicode collation, the rest by value, ties by product id.
    """
    wanted = fn.strip(F.lower(F.lit(text)))
    found = products.filter(
        F.contains(F.lower("product_name"), wanted)
        | F.contains(F.col("product_id").cast("string"), wanted)
    )
    key = F.collate(sort_by, "UNICODE") if sort_by == "product_name" else F.col(sort_by)
    order = [key.desc() if descending else key.asc(), F.asc("product_id")]
    return top_n(found, order, n).withColumn(
        "matches", found.agg(F.count("*")).scalar()
    )
