"""Reporting tables: published checksums, conservation laws, ties and empty inputs."""

import json

import pytest
from pyspark.sql import functions as F

from larder import catalog
from larder.operators import documents, kpis, reports
from larder.sources.workspace import staged

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def gold(spark):
    return catalog._gold(spark, SF)


@pytest.fixture(scope="module")
def products(gold):
    return gold["gold_top_products"]


@pytest.fixture(scope="module")
def baskets(gold):
    return gold["gold_basket_metrics"]


@pytest.fixture(scope="module")
def customers(gold):
    return gold["gold_customer_metrics"]


@pytest.fixture(scope="module")
def departments(gold):
    return gold["gold_department_metrics"]


def rows(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.collect()]


# Checksums of FIXTURES.md.
def test_top_lists(products, customers, departments):
    top = rows(
        reports.top_products(products, 3),
        "product_id",
        "total_orders",
        "total_reorders",
        "reorder_rate",
    )
    assert top == [(558, 49, 21, 0.4286), (555, 48, 16, 0.3333), (817, 48, 14, 0.2917)]
    rates = rows(reports.top_reorder(products, 3), "product_id", "reorder_rate")
    assert rates == [(849, 0.6667), (1414, 0.619), (523, 0.6)]
    best = rows(reports.top_customers(customers, 5), "user_id", "total_orders", "total_products")
    assert best == [(605, 23, 88), (1242, 20, 92), (5, 19, 64), (87, 19, 77), (299, 19, 88)]
    ranked = rows(reports.department_rank(departments).filter("rank <= 3"), "department", "rank")
    assert sorted(ranked, key=lambda r: r[1]) == [("brand#2", 1), ("brand#19", 2), ("brand#4", 3)]
    shares = rows(reports.department_share(departments), "department", "share")
    assert dict(shares) == {
        "brand#2": 0.1747,
        "brand#19": 0.1712,
        "brand#4": 0.1703,
        "brand#16": 0.1629,
        "brand#17": 0.1609,
        "brand#8": 0.16,
    }
    assert reports.top_reorder_mean(products).first()[0] == 0.4481


def test_histogram_keeps_empty_buckets(baskets):
    found = dict(rows(reports.basket_histogram(baskets), "bucket", "orders"))
    assert list(found) == [label for label, _, _ in reports.BASKET_BUCKETS]
    assert list(found.values()) == [1120, 2130, 5980, 5416, 97, 0, 0, 0]


def test_summaries(baskets, customers, products):
    assert reports.basket_summary(baskets).first().asDict() == {
        "total_line_items": 59993,
        "mean_basket_size": 4.07,
        "median_basket_size": 4.0,
        "min_basket_size": 1,
        "max_basket_size": 13,
        "std_basket_size": 1.93,
        "total_orders": 14743,
    }
    found = reports.customer_summary(customers).first()
    assert found.median_orders_per_customer == 10.0
    assert found.avg_orders_per_customer == 9.83
    assert (found.single_order_customer_pct, found.power_user_pct) == (0.13, 0.07)
    assert reports.customer_trends(customers).first().customers_with_10plus_orders_pct == 52.33
    highlights = reports.reorder_highlights(products).first()
    assert tuple(highlights) == (0.3338, 57)


def test_segments(customers):
    found = {r.segment: tuple(r)[1:] for r in reports.customer_segmentation(customers).collect()}
    assert found == {
        "Loyal (11-20)": (591, 39.4, 4.08, 52.64),
        "Occasional (2-5)": (108, 7.2, 4.07, 17.44),
        "Power User (21+)": (1, 0.07, 3.83, 88.0),
        "Regular (6-10)": (798, 53.2, 4.06, 33.71),
        "Single Order": (2, 0.13, 4.0, 4.0),
    }
    spread = rows(reports.order_frequency(customers), "orders", "customers")
    counts = [2, 4, 18, 31, 55, 95, 153, 164, 193, 193, 165, 136, 103, 82, 43]
    assert spread == list(zip(range(1, 16), counts))


def test_search_counts_all_matches(products):
    named = reports.product_search(products, "  ANVIL ")
    assert named.count() == 100
    assert named.select("matches").distinct().collect() == [(230,)]
    by_id = reports.product_search(products, "19", "product_name", descending=False)
    assert by_id.select("matches").first()[0] == 139
    names = rows(by_id, "product_name", "product_id", "position")
    assert names == sorted(names)
    assert reports.product_search(products, "no such thing").isEmpty()


def test_totals_are_conserved(spark, gold, baskets, customers, departments):
    lines = baskets.agg(F.sum("basket_size")).first()[0]
    assert departments.agg(F.sum("total_products_sold")).first()[0] == lines
    assert customers.agg(F.sum("total_products")).first()[0] == lines
    assert gold["gold_top_products"].agg(F.sum("total_orders")).first()[0] == lines
    histogram = reports.basket_histogram(baskets).agg(F.sum("orders")).first()[0]
    assert histogram == baskets.count()
    segmented = reports.customer_segmentation(customers).agg(F.sum("customers")).first()[0]
    assert segmented == customers.count()


def test_edges(spark):
    none = spark.createDataFrame([], "order_id long, basket_size long")
    empty = reports.basket_summary(none).first()
    assert (empty.total_orders, empty.mean_basket_size, empty.max_basket_size) == (0, None, None)
    assert rows(reports.basket_histogram(none), "orders") == [(0,)] * 8
    one = spark.createDataFrame([(1, 4)], "order_id long, basket_size long")
    assert reports.basket_summary(one).first().std_basket_size is None
    odd = spark.createDataFrame([(1, 0), (2, None), (3, 250)], "order_id long, basket_size long")
    assert [n for (n,) in rows(reports.basket_histogram(odd), "orders")] == [0] * 7 + [1]


def test_ties_are_broken_by_id(spark):
    tied = spark.range(50).select(
        F.col("id").alias("user_id"),
        F.lit(100).cast("long").alias("total_orders"),
        F.col("id").alias("total_products"),
        F.lit(1.23456).alias("avg_basket_size"),
    )
    top = reports.top_customers(tied.repartition(7), 5)
    assert rows(top, "position", "user_id") == [(i + 1, i) for i in range(5)]
    assert top.first().avg_basket_size == 1.2346


def test_segment_borders(spark):
    orders = [1, 2, 5, 6, 10, 11, 20, 21]
    df = spark.createDataFrame([(n,) for n in orders], "total_orders long")
    assert [s for _, s in rows(reports.customer_segment(df), "total_orders", "segment")] == [
        "Single Order",
        *["Occasional (2-5)"] * 2,
        *["Regular (6-10)"] * 2,
        *["Loyal (11-20)"] * 2,
        "Power User (21+)",
    ]


def test_unknown_departments_count_for_products_only(spark):
    fact = spark.createDataFrame(
        [(1, 1, 5, "x", None, 1), (1, 1, 6, "y", "d", 0)],
        "order_id long, user_id long, product_id long, product_name string,"
        " department string, reordered int",
    )
    assert kpis.department_metrics(fact).collect() == [("d", 1, 1)]
    assert kpis.product_aggregates(fact).count() == 2
    assert kpis.order_level(fact).collect() == [(1, 1, 2)]


def test_overview_prefers_stored_numbers(spark, gold, products, departments, baskets, customers):
    fresh = staged(reports.dataset_overview(products, departments, baskets, customers))
    assert reports.dashboard_overview(fresh).first().total_products == 2000
    stored = spark.createDataFrame(
        [(7, None, "then")], "total_orders long, total_customers long, last_updated string"
    )
    shown = reports.dashboard_overview(fresh, stored, "now").first()
    assert (shown.total_transactions, shown.total_customers) == (7, 1500)
    assert shown.last_updated == "then"


def test_documents(gold):
    summary = json.loads(documents.kpi_summary(gold).first()[0])
    assert list(summary) == [
        "dataset_overview",
        "top_performing_products",
        "most_reordered_products",
        "best_performing_departments",
        "basket_size_analysis",
        "customer_purchasing_trends",
        "reorder_highlights",
    ]
    assert [p["product_id"] for p in summary["top_performing_products"]["products"]][:3] == [
        558,
        555,
        817,
    ]
    shown = {
        name: json.loads(df.first()[0]) for name, df in documents.dashboards(gold, "now").items()
    }
    assert len(shown["top_products.json"]["products"]) == 500
    assert shown["reorder_metrics.json"]["total_products"] == 2000
    assert shown["department_metrics.json"]["departments"][0]["department"] == "brand#2"
    assert shown["basket_metrics.json"]["distribution"][-1] == {"bucket": "100+", "orders": 0}
    customers = shown["customer_metrics.json"]
    assert [s["segment"] for s in customers["segmentation"]] == sorted(
        s["segment"] for s in customers["segmentation"]
    )
    assert len(customers["top_customers"]) == 50 and len(customers["order_frequency"]) == 15
    assert all(document["last_updated"] == "now" for document in shown.values())
