"""Dashboard and summary documents: small results nested into one JSON row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.operators import report_text, reports
from larder.sources.json import one_row, to_document

Gold = dict[str, DataFrame]

# Fields of listed records, titles of the summary's lists.
PRODUCT_FIELDS = ("product_id", "product_name", "total_orders", "total_reorders", "reorder_rate")
RATE_FIELDS = ("product_id", "product_name", "reorder_rate")
DEPARTMENT_FIELDS = ("department", "total_products_sold", "unique_customers")
CUSTOMER_FIELDS = ("user_id", "total_orders", "total_products", "avg_basket_size")
TOP_PRODUCTS_TITLE = "Top 10 products by total order volume"
TOP_RATES_TITLE = "Top 10 products by reorder rate"
TOP_DEPARTMENTS_TITLE = "Top 10 departments by products sold"


def _listed(rows: DataFrame, *fields: str) -> Column:
    """A short ranked list as an array in rank order, as a scalar subquery.

    Collecting keeps no order, so the array is sorted by position afterwards.
    """
    entries = F.array_sort(F.collect_list(F.struct("position", *fields)))
    return rows.agg(
        F.transform(entries, lambda e: F.struct(*[e[f].alias(f) for f in fields]))
    ).scalar()


def _row(one_row: DataFrame) -> Column:
    """A one-row table as a struct, as a scalar subquery."""
    return one_row.select(F.struct(*one_row.columns)).scalar()


def _document(spark: SparkSession, fields: dict[str, Column], indented: bool) -> DataFrame:
    columns = [value.alias(name) for name, value in fields.items()]
    return one_row(spark).select(to_document(F.struct(*columns), indented).alias("document"))


def kpi_summary(gold: Gold, indented: bool = False) -> DataFrame:
    """The whole KPI summary as one JSON document."""
    products = gold["gold_top_products"]
    rates = gold["gold_reorder_metrics"]
    departments = gold["gold_department_metrics"]
    baskets = gold["gold_basket_metrics"]
    customers = gold["gold_customer_metrics"]
    n = reports.SUMMARY_TOP

    def titled(title: str, field: str, rows: Column) -> Column:
        return F.struct(F.lit(title).alias("description"), rows.alias(field))

    sizes = reports.basket_figures(baskets).select(
        "mean_basket_size",
        "median_basket_size",
        "min_basket_size",
        "max_basket_size",
        "std_basket_size",
        F.col("buckets").alias("distribution_by_size_bucket"),
    )
    top_rates = _listed(reports.top_reorder(rates, n), *RATE_FIELDS)
    trends = reports.customer_trends(customers).select(
        "avg_orders_per_customer",
        "avg_products_per_customer",
        "avg_basket_size_per_customer",
        "median_orders_per_customer",
        _listed(
            reports.top_customers(customers, reports.SUMMARY_TOP_CUSTOMERS), *CUSTOMER_FIELDS
        ).alias("top_customers_by_orders"),
        "customers_with_single_order_pct",
        "customers_with_10plus_orders_pct",
    )
    highlights = reports.reorder_highlights(products).withColumn(
        "top_reorder_rate_products", top_rates
    )
    return _document(
        products.sparkSession,
        {
            "dataset_overview": _row(
                reports.dataset_overview(products, departments, baskets, customers)
            ),
            "top_performing_products": titled(
                TOP_PRODUCTS_TITLE,
                "products",
                _listed(reports.top_products(products, n), *PRODUCT_FIELDS),
            ),
            "most_reordered_products": titled(
                TOP_RATES_TITLE, "products", top_rates
            ),
            "best_performing_departments": titled(
                TOP_DEPARTMENTS_TITLE,
                "departments",
                _listed(reports.top_departments(departments, n), *DEPARTMENT_FIELDS),
            ),
            "basket_size_analysis": _row(sizes),
            "customer_purchasing_trends": _row(trends),
            "reorder_highlights": _row(highlights),
        },
        indented,
    )


def dashboards(gold: Gold, last_updated: str, indented: bool = True) -> dict[str, DataFrame]:
    """The five table-backed dashboard documents, by file name."""
    products = gold["gold_top_products"]
    rates = gold["gold_reorder_metrics"]
    departments = gold["gold_department_metrics"]
    baskets = gold["gold_basket_metrics"]
    customers = gold["gold_customer_metrics"]
    stamp = F.lit(last_updated)

    def rows(df: DataFrame, column: str) -> Column:
        return df.agg(F.count(column)).scalar()

    ranked = reports.department_rank(departments).withColumnRenamed("rank", "position")
    segments = reports.customer_segmentation(customers)
    segment_list = segments.agg(F.array_sort(F.collect_list(F.struct(*segments.columns))))
    frequency = reports.order_frequency(customers)
    frequency_list = frequency.agg(F.array_sort(F.collect_list(F.struct(*frequency.columns))))
    basket_row = reports.basket_figures(baskets)
    sizes = [name for name in basket_row.columns if name != "buckets"]
    histogram = F.transform(
        reports.bucket_list(), lambda b: F.struct(b["bucket"].alias("bucket"), b["orders"].alias("orders"))
    )
    basket_row = basket_row.select(
        F.struct(F.struct(*sizes).alias("summary"), histogram.alias("distribution"))
    ).scalar()
    customer_row = reports.customer_summary(customers).select(
        "total_customers",
        "avg_orders_per_customer",
        "median_orders_per_customer",
        "avg_products_per_customer",
        "avg_basket_size",
        "single_order_customer_pct",
        "power_user_pct",
    )
    documents = {
        "top_products.json": {
            "total_products": rows(products, "product_id"),
            "products": _listed(reports.top_products(products), *PRODUCT_FIELDS),
        },
        "reorder_metrics.json": {
            "total_products": rows(rates, "product_id"),
            "products": _listed(reports.top_reorder(rates), *RATE_FIELDS),
        },
        "department_metrics.json": {
            "total_departments": rows(departments, "department"),
            "departments": _listed(ranked, *DEPARTMENT_FIELDS),
        },
        "basket_metrics.json": {
            "summary": basket_row["summary"],
            "distribution": basket_row["distribution"],
        },
        "customer_metrics.json": {
            "summary": _row(customer_row),
            "segmentation": segment_list.scalar(),
            "order_frequency": frequency_list.scalar(),
            "top_customers": _listed(reports.top_customers(customers), *CUSTOMER_FIELDS),
        },
    }
    return {
        name: _document(products.sparkSession, {"last_updated": stamp, **fields}, indented)
        for name, fields in documents.items()
    }


def insight_document(
    reports_table: DataFrame, last_updated: str, indented: bool = True
) -> DataFrame:
    """Assembled reports as documents, one per row."""
    assembled = report_text.assemble_reports(reports_table, last_updated)
    fields = [name for name in assembled.columns if name != "doc_id"]
    return assembled.select(to_document(F.struct(*fields), indented).alias("document"))
