"""Every registered query: a name and a function of (session, table folder)."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder import adapters, tables
from larder import functions as fn
from larder.operators import cleaning, documents, kpis, quality, report_text, reports, star
from larder.operators.joins import most_rows
from larder.plans import export, gold, ingest, silver
from larder.plans.together import together
from larder.sources import csv, parquet
from larder.sources.workspace import staged, work_dir

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

# Stands for the run's time where a result must not depend on the clock.
STAMP = "2024-01-01T00:00:00+00:00"


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def _merged(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.merge_order_products(
        adapters.prior_lines(spark, folder), adapters.train_lines(spark, folder)
    )


def _fact(spark: SparkSession, folder: str, rows: int | None = None) -> DataFrame:
    return star.transactions_from_raw(
        _merged(spark, folder),
        adapters.orders(spark, folder),
        adapters.products(spark, folder),
        adapters.aisles(spark, folder),
        adapters.departments(spark, folder),
        rows=rows,
    )


def _products(spark: SparkSession, folder: str) -> DataFrame:
    return kpis.product_aggregates(_fact(spark, folder))


def _departments(spark: SparkSession, folder: str) -> DataFrame:
    rows = most_rows(_merged(spark, folder))
    return kpis.department_metrics(_fact(spark, folder, rows), rows)


def _baskets(spark: SparkSession, folder: str) -> DataFrame:
    return kpis.basket_metrics(kpis.order_level(_fact(spark, folder)))


def _customers(spark: SparkSession, folder: str) -> DataFrame:
    return kpis.customer_metrics(kpis.order_level(_fact(spark, folder)))


def _gold(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The KPI tables, written and read back, for documents that read them repeatedly."""
    fact = staged(_fact(spark, folder).select(*tables.KPI_FACT_COLUMNS))
    made = together(
        spark,
        {
            "products": lambda: staged(kpis.product_aggregates(fact)),
            "departments": lambda: staged(kpis.department_metrics(fact, most_rows(fact))),
            "orders": lambda: staged(kpis.order_level(fact)),
        },
    )
    return {
        "gold_top_products": made["products"],
        "gold_reorder_metrics": kpis.product_rates(made["products"]),
        "gold_department_metrics": made["departments"],
        "gold_basket_metrics": kpis.basket_metrics(made["orders"]),
        "gold_customer_metrics": staged(kpis.customer_metrics(made["orders"])),
    }


def _contents(parts: dict[str, DataFrame]) -> DataFrame:
    """Rows per named table and sums over all of its values, from one pass over each.

    Whole numbers are added modulo a prime, fractions in thousandths, texts as bytes.
    """

    def weight(df: DataFrame, *kinds: type[T.DataType]) -> Column:
        rules = {
            T.StringType: F.octet_length,
            T.DoubleType: lambda c: F.floor(c * 1000 + 0.5),
        }
        terms = [
            F.coalesce(rules.get(type(f.dataType), lambda c: c % 1_000_003)(F.col(f.name)), F.lit(0))
            for f in df.schema.fields
            if isinstance(f.dataType, kinds)
        ]
        return F.coalesce(F.sum(sum(terms, F.lit(0).cast("long"))), F.lit(0))

    return quality.union_checks(
        [
            df.agg(
                F.count("*").alias("n_rows"),
                weight(df, T.LongType, T.IntegerType, T.DoubleType).alias("numbers"),
                weight(df, T.StringType).alias("letters"),
            ).select(F.lit(name).alias("dataset"), "*")
            for name, df in parts.items()
        ]
    )


# --- sources and sinks -------------------------------------------------------

KEEP_SPACES = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def _write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(header=True, escape='"', **KEEP_SPACES).csv(path)


def _untidy_lines(lines: DataFrame) -> DataFrame:
    """Lines as text, those of some products with values that are no integers."""
    product = F.col("product_id")
    return lines.select(
        F.col("order_id").cast("string"),
        F.when(F.col("add_to_cart_order") == 2, "n/a")
        .otherwise(product.cast("string"))
        .alias("product_id"),
        F.when(F.col("add_to_cart_order") == 3, "3.5")
        .otherwise(F.col("add_to_cart_order").cast("string"))
        .alias("add_to_cart_order"),
        F.col("reordered").cast("string"),
    )


@query
def csv_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Orders written as CSV and read back with their schema."""
    path = work_dir(spark)
    _write_csv(adapters.orders(spark, folder), path)
    csv.require_file(spark, path)
    return csv.read_csv(spark, path, tables.ORDERS).valid


@query
def csv_malformed_split(spark: SparkSession, folder: str) -> DataFrame:
    """Line records that fit the schema, and the raw text of those that do not."""
    path = work_dir(spark)
    _write_csv(_untidy_lines(adapters.prior_lines(spark, folder)), path)
    parsed, _ = csv.split_csv(spark, path, tables.PRIOR_LINES, work_dir(spark))
    valid = parsed.valid.select(
        F.lit("valid").alias("side"), F.concat_ws(",", *tables.PRIOR_LINES.columns).alias("record")
    )
    return valid.unionByName(
        parsed.malformed.select(
            F.lit("malformed").alias("side"), F.col(csv.CORRUPT).alias("record")
        )
    )


def _ingested(spark: SparkSession, folder: str) -> str:
    """All six tables as CSV, the prior lines untidy, ingested; returns the bronze folder."""
    base = work_dir(spark)
    sources = {
        "orders": adapters.orders(spark, folder),
        "products": adapters.products(spark, folder),
        "departments": adapters.departments(spark, folder),
        "aisles": adapters.aisles(spark, folder),
        "order_products__prior": _untidy_lines(adapters.prior_lines(spark, folder)),
        "order_products__train": adapters.train_lines(spark, folder),
    }
    together(
        spark,
        {name: partial(_write_csv, df, f"{base}/raw/{name}.csv") for name, df in sources.items()},
    )
    ingest.ingest_all(spark, f"{base}/raw", f"{base}/bronze")
    return f"{base}/bronze"


@query
def ingest_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Rows and value sums per bronze table after ingestion, with the quarantined lines."""
    bronze = _ingested(spark, folder)
    names = [spec.name for spec in tables.RAW_TABLES]
    found = {name: parquet.read_table(spark, bronze, name) for name in names}
    bad = tables.PRIOR_LINES.name
    found[f"{bad}__malformed"] = parquet.read_table(spark, f"{bronze}/{csv.QUARANTINE}", bad)
    return _contents(found)


@query
def bronze_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Products written to the bronze layer; two columns read back."""
    root = work_dir(spark)
    parquet.write_table(adapters.products(spark, folder), root, "products")
    return parquet.read_table(spark, root, "products", ["product_id", "product_name"])


@query
def fact_projection(spark: SparkSession, folder: str) -> DataFrame:
    """The KPI columns of the stored transaction table."""
    root = work_dir(spark)
    parquet.write_table(_fact(spark, folder), root, tables.TRANSACTIONS)
    return gold.read_fact(spark, root)


@query
def silver_checkpoint(spark: SparkSession, folder: str) -> DataFrame:
    """Cleaned lines, continued from their written table."""
    lines = cleaning.clean_order_products(
        _merged(spark, folder),
        cleaning.clean_orders(adapters.orders(spark, folder)),
        cleaning.clean_products(adapters.products(spark, folder)),
    )
    table, _ = parquet.rewrite_table(lines, work_dir(spark), "clean_order_products")
    return table


def _built_silver(spark: SparkSession, folder: str) -> str:
    root = work_dir(spark)
    sources = {
        tables.ORDERS: adapters.messy_orders,
        tables.PRODUCTS: adapters.messy_products,
        tables.DEPARTMENTS: adapters.departments,
        tables.AISLES: adapters.aisles,
        tables.PRIOR_LINES: adapters.prior_lines,
        tables.TRAIN_LINES: adapters.train_lines,
    }
    together(
        spark,
        {
            spec.name: partial(
                parquet.write_table, adapter(spark, folder), f"{root}/bronze", spec.name
            )
            for spec, adapter in sources.items()
        },
    )
    silver.build_silver(spark, f"{root}/bronze", f"{root}/silver")
    return f"{root}/silver"


@query
def silver_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Rows and value sums per table of a whole silver run over untidy inputs."""
    root = _built_silver(spark, folder)
    names = [
        *[f"clean_{n}" for n in ("orders", "products", "departments", "aisles", "order_products")],
        tables.TRANSACTIONS,
    ]
    return _contents({name: parquet.read_table(spark, root, name) for name in names})


@query
def gold_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Rows and value sums per table of a whole gold run, read back from its files."""
    root = work_dir(spark)
    parquet.write_table(_fact(spark, folder), f"{root}/silver", tables.TRANSACTIONS)
    gold.build_gold(spark, f"{root}/silver", f"{root}/gold")
    return _contents(gold.read_gold(spark, f"{root}/gold"))


@query
def dashboard_export(spark: SparkSession, folder: str) -> DataFrame:
    """Silver, gold and export in one run; the six written documents, whole."""
    silver_root = _built_silver(spark, folder)
    root = work_dir(spark)
    gold.build_gold(spark, silver_root, f"{root}/gold")
    paths = export.export_dashboards(
        spark, f"{root}/gold", root, require_report=False, now=STAMP, indented=False
    )
    return quality.union_checks(
        [
            spark.read.text(path, wholetext=True).select(
                F.lit(name).alias("name"), F.btrim("value", F.lit("\n")).alias("document")
            )
            for name, path in paths.items()
        ]
    )


# --- expressions, cleaning, joins --------------------------------------------


@query
def normalize_text(spark: SparkSession, folder: str) -> DataFrame:
    texts = spark.read.parquet(f"{folder}/documents.parquet")
    return texts.select("doc_id", fn.normal_text(F.col("text")).alias("text"))


@query
def tolerant_cast(spark: SparkSession, folder: str) -> DataFrame:
    parts = spark.read.parquet(f"{folder}/part.parquet")
    number = F.substring_index("p_brand", "#", -1)
    written = F.when(F.col("p_type") == "PROMO", F.col("p_brand")).otherwise(number)
    return parts.select("p_partkey", fn.number_or_null(written).alias("brand_number"))


@query
def clean_orders(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.clean_orders(adapters.messy_orders(spark, folder))


@query
def clean_products(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.clean_products(adapters.messy_products(spark, folder))


@query
def clean_departments(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.clean_departments(adapters.departments(spark, folder))


@query
def clean_aisles(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.clean_aisles(adapters.aisles(spark, folder))


@query
def clean_order_products(spark: SparkSession, folder: str) -> DataFrame:
    """Untidy lines against orders and products that are partly unknown."""
    return cleaning.clean_order_products(
        adapters.messy_lines(spark, folder),
        cleaning.clean_orders(adapters.messy_orders(spark, folder)),
        cleaning.clean_products(adapters.messy_products(spark, folder)),
    )


@query
def dedup_by_key(spark: SparkSession, folder: str) -> DataFrame:
    """Merged lines, one per business key."""
    return cleaning.one_per_key(_merged(spark, folder), tables.MERGED_LINES.key)


@query
def merge_order_products(spark: SparkSession, folder: str) -> DataFrame:
    return _merged(spark, folder)


@query
def distinct_keys(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.distinct_keys(_merged(spark, folder), "order_id")


@query
def products_enriched(spark: SparkSession, folder: str) -> DataFrame:
    """Products with names of their aisle and of those departments that are known."""
    known = cleaning.clean_departments(adapters.departments(spark, folder))
    return star.products_enriched(
        cleaning.clean_products(adapters.products(spark, folder)),
        cleaning.clean_aisles(adapters.aisles(spark, folder)),
        known.filter(~F.col("department").endswith("5")),
    )


@query
def retail_transactions(spark: SparkSession, folder: str) -> DataFrame:
    return _fact(spark, folder)


@query
def star_join(spark: SparkSession, folder: str) -> DataFrame:
    """The transaction table from separately cleaned tables."""
    orders = cleaning.clean_orders(adapters.messy_orders(spark, folder))
    products = cleaning.clean_products(adapters.messy_products(spark, folder))
    lines = cleaning.clean_order_products(adapters.messy_lines(spark, folder), orders, products)
    return star.retail_transactions(
        staged(lines),
        orders,
        products,
        cleaning.clean_aisles(adapters.aisles(spark, folder)),
        cleaning.clean_departments(adapters.departments(spark, folder)),
    )


# --- data quality ------------------------------------------------------------


@query
def dq_profile(spark: SparkSession, folder: str) -> DataFrame:
    return quality.profile(adapters.messy_orders(spark, folder), tables.ORDERS)


@query
def dq_nulls(spark: SparkSession, folder: str) -> DataFrame:
    profiled = quality.profile(adapters.messy_orders(spark, folder), tables.ORDERS)
    return quality.null_checks(profiled, "orders")


@query
def dq_invalid_cast(spark: SparkSession, folder: str) -> DataFrame:
    """Orders whose gaps were stored as text, some of it no number."""
    days = F.coalesce(F.col("days_since_prior_order").cast("string"), F.lit("n/a"))
    stored = adapters.orders(spark, folder).withColumn("days_since_prior_order", days)
    return quality.cast_checks(quality.profile(stored, tables.ORDERS), "orders")


@query
def dq_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    spec = tables.MERGED_LINES
    return quality.duplicate_checks(_merged(spark, folder), spec.key, spec.name)


def _checks(spark: SparkSession, folder: str) -> DataFrame:
    bronze = {
        "orders": adapters.messy_orders(spark, folder),
        "products": adapters.messy_products(spark, folder),
        "departments": adapters.departments(spark, folder).withColumn("note", F.lit("x")),
        "aisles": adapters.aisles(spark, folder).withColumn(
            "aisle_id", F.col("aisle_id").cast("string")
        ),
        "order_products__prior": adapters.prior_lines(spark, folder),
        "order_products__train": adapters.train_lines(spark, folder).drop("reordered"),
    }
    return silver.check_bronze(bronze, _merged(spark, folder))


@query
def dq_report(spark: SparkSession, folder: str) -> DataFrame:
    """All checks of all inputs, among them an extra, a missing and a mistyped column."""
    return _checks(spark, folder)


@query
def dq_summary(spark: SparkSession, folder: str) -> DataFrame:
    return quality.summary(_checks(spark, folder))


# --- gold --------------------------------------------------------------------


@query
def product_aggregates(spark: SparkSession, folder: str) -> DataFrame:
    return _products(spark, folder)


@query
def gold_top_products(spark: SparkSession, folder: str) -> DataFrame:
    return kpis.gold_top_products(_products(spark, folder))


@query
def gold_reorder_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return kpis.gold_reorder_metrics(_products(spark, folder))


@query
def gold_department_metrics(spark: SparkSession, folder: str) -> DataFrame:
    rows = most_rows(_merged(spark, folder))
    return kpis.gold_department_metrics(_fact(spark, folder, rows), rows)


@query
def order_level(spark: SparkSession, folder: str) -> DataFrame:
    return kpis.order_level(_fact(spark, folder))


@query
def gold_basket_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return kpis.gold_basket_metrics(kpis.order_level(_fact(spark, folder)))


@query
def gold_customer_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return kpis.gold_customer_metrics(kpis.order_level(_fact(spark, folder)))


# --- reports -----------------------------------------------------------------


@query
def top_products_n(spark: SparkSession, folder: str) -> DataFrame:
    return reports.product_ranking(staged(_products(spark, folder)))


@query
def top_reorder_n(spark: SparkSession, folder: str) -> DataFrame:
    return reports.reorder_ranking(kpis.product_rates(staged(_products(spark, folder))))


@query
def department_ranking(spark: SparkSession, folder: str) -> DataFrame:
    return reports.department_ranking(staged(_departments(spark, folder)))


@query
def department_rank(spark: SparkSession, folder: str) -> DataFrame:
    return reports.department_rank(_departments(spark, folder))


@query
def department_share_top6(spark: SparkSession, folder: str) -> DataFrame:
    return reports.department_share(_departments(spark, folder))


@query
def top_reorder_mean(spark: SparkSession, folder: str) -> DataFrame:
    return reports.top_reorder_mean(_products(spark, folder))


@query
def basket_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return reports.basket_histogram(_baskets(spark, folder))


@query
def basket_summary(spark: SparkSession, folder: str) -> DataFrame:
    return reports.basket_summary(staged(_baskets(spark, folder)))


@query
def customer_segment(spark: SparkSession, folder: str) -> DataFrame:
    return reports.customer_segment(_customers(spark, folder)).select("user_id", "segment")


@query
def customer_segmentation(spark: SparkSession, folder: str) -> DataFrame:
    return reports.customer_segmentation(_customers(spark, folder))


@query
def order_frequency(spark: SparkSession, folder: str) -> DataFrame:
    return reports.order_frequency(_customers(spark, folder))


@query
def top_customers_n(spark: SparkSession, folder: str) -> DataFrame:
    return reports.top_customers(_customers(spark, folder))


@query
def customer_summary(spark: SparkSession, folder: str) -> DataFrame:
    return reports.customer_summary(staged(_customers(spark, folder)))


@query
def customer_trends(spark: SparkSession, folder: str) -> DataFrame:
    return reports.customer_trends(_customers(spark, folder))


def _overview(found: dict[str, DataFrame]) -> DataFrame:
    return reports.dataset_overview(
        found["gold_top_products"],
        found["gold_department_metrics"],
        found["gold_basket_metrics"],
        found["gold_customer_metrics"],
    )


@query
def dataset_overview(spark: SparkSession, folder: str) -> DataFrame:
    return _overview(_gold(spark, folder))


@query
def dashboard_overview(spark: SparkSession, folder: str) -> DataFrame:
    """The headline numbers, where the stored report knows only some."""
    fresh = _overview(_gold(spark, folder))
    stored = adapters.orders(spark, folder).agg(
        F.count("*").alias("total_orders"), F.lit(None).cast("long").alias("total_customers")
    )
    return reports.dashboard_overview(fresh, stored, STAMP)


@query
def reorder_highlights(spark: SparkSession, folder: str) -> DataFrame:
    return reports.reorder_highlights(_products(spark, folder))


@query
def kpi_top10_slices(spark: SparkSession, folder: str) -> DataFrame:
    found = _gold(spark, folder)
    return reports.top_slices(
        found["gold_top_products"],
        found["gold_reorder_metrics"],
        found["gold_department_metrics"],
    )


@query
def product_search(spark: SparkSession, folder: str) -> DataFrame:
    """Three searches: by name, by id text, and for everything sorted by name."""
    products = staged(_products(spark, folder))
    searches = [
        ("by name", reports.product_search(products, " Anvil")),
        ("by id", reports.product_search(products, "19", "reorder_rate", descending=False)),
        ("all", reports.product_search(products, "", "product_name", descending=False)),
    ]
    return quality.union_checks(
        [found.withColumn("search", F.lit(label)) for label, found in searches]
    )


@query
def kpi_summary_json(spark: SparkSession, folder: str) -> DataFrame:
    return documents.kpi_summary(_gold(spark, folder))


# --- report texts ------------------------------------------------------------


def _reports(spark: SparkSession, folder: str) -> DataFrame:
    return adapters.report_texts(spark, folder)


@query
def report_sections(spark: SparkSession, folder: str) -> DataFrame:
    return report_text.report_sections(_reports(spark, folder))


@query
def report_recommendations(spark: SparkSession, folder: str) -> DataFrame:
    return report_text.report_recommendations(_reports(spark, folder))


@query
def report_assembled(spark: SparkSession, folder: str) -> DataFrame:
    rows = report_text.assemble_reports(_reports(spark, folder), STAMP)
    return rows.select(
        "doc_id",
        "last_updated",
        "model",
        "executive_summary",
        F.array_join(
            F.transform(
                F.array_sort(F.map_entries("sections")),
                lambda s: F.concat(s["key"], F.lit("="), s["value"]),
            ),
            "\x1e",
        ).alias("sections"),
        F.array_join("recommendations", "\n").alias("recommendations"),
        "full_text",
    )
