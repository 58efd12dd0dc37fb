import pytest
from pyspark.sql import functions as F

from larder import adapters, tables
from larder.functions import collapse_spaces, normal_text, number_or_null, ratio, rounded, strip
from larder.operators import cleaning, joins, star

SF = "/root/testdata/sf0.001"
ORDERS = (
    "order_id long, user_id long, eval_set string, order_number int, order_dow int,"
    " order_hour_of_day int, days_since_prior_order string"
)


@pytest.fixture
def orders(spark):
    return spark.createDataFrame(
        [
            (1, 1, "  Prior\t SET ", 1, 0, 0, None),
            (2, 1, "prior", 2, 6, 23, "7.5"),
            (3, 1, "prior", 3, 1, 5, "n/a"),
            (4, 1, "prior", 3, 7, 5, "1"),
            (5, 1, "prior", 3, 6, 24, "1"),
            (6, 1, "prior", 0, 6, 2, "1"),
            (7, None, "prior", 1, 6, 2, "1"),
            (8, 1, None, 1, 6, 2, "1"),
            (9, 2, "prior", 1, 3, 9, "4"),
            (9, 2, "prior", 1, 3, 11, "2"),
            (9, 2, "prior", 1, 3, 11, "3"),
        ],
        ORDERS,
    )


def test_orders(orders):
    found = {r.order_id: r for r in cleaning.clean_orders(orders).collect()}
    assert sorted(found) == [1, 2, 3, 9]
    assert found[1].eval_set == "prior set"
    assert found[2].days_since_prior_order == 7.5
    assert found[3].days_since_prior_order is None
    assert (found[9].order_hour_of_day, found[9].days_since_prior_order) == (11, 3.0)


def test_a_pruned_clean_keeps_the_same_rows(orders):
    columns = star.ORDER_CONTEXT
    whole = cleaning.clean_orders(orders).select(*columns)
    pruned = cleaning.clean_orders(orders, columns=columns)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, pruned.collect()))


def test_cleaning_twice_changes_nothing(spark):
    for adapter, spec in (
        (adapters.messy_orders, tables.ORDERS),
        (adapters.messy_products, tables.PRODUCTS),
        (adapters.departments, tables.DEPARTMENTS),
    ):
        once = cleaning.clean(adapter(spark, SF), spec)
        twice = cleaning.clean(once, spec)
        assert once.exceptAll(twice).isEmpty() and twice.exceptAll(once).isEmpty()


def test_products_and_names(spark):
    products = spark.createDataFrame(
        [(1, "  Big   Cheese ", 1, 1), (2, "   ", 1, 1), (3, "x", None, 1), (4, "Z", 9, 9)],
        "product_id long, product_name string, aisle_id long, department_id long",
    )
    kept = {r.product_id: r.product_name for r in cleaning.clean_products(products).collect()}
    assert kept == {1: "Big Cheese", 4: "Z"}
    departments = spark.createDataFrame(
        [(1, "  Dairy   Eggs "), (2, " "), (None, "x"), (3, None)],
        "department_id long, department string",
    )
    assert cleaning.clean_departments(departments).collect() == [(1, "dairy eggs")]
    aisles = departments.toDF("aisle_id", "aisle")
    assert cleaning.clean_aisles(aisles).collect() == [(1, "dairy eggs")]


@pytest.fixture
def lines(spark):
    return spark.createDataFrame(
        [
            (1, 1, 1, 0),
            (1, 1, 1, 1),  # the same key: the reordered one stays
            (1, 1, 2, 0),  # the same product at another position: stays
            (1, 4, 3, 1),
            (1, 1, 0, 1),
            (1, 1, 4, 2),
            (1, 99, 5, 0),
            (99, 1, 1, 0),
            (2, None, 1, 0),
        ],
        "order_id long, product_id long, add_to_cart_order int, reordered int",
    )


@pytest.fixture
def references(spark, orders):
    products = spark.createDataFrame(
        [(1, "Milk", 1, 1), (4, "Mystery", 9, 9)],
        "product_id long, product_name string, aisle_id long, department_id long",
    )
    aisles = spark.createDataFrame([(1, "Cold")], "aisle_id long, aisle string")
    departments = spark.createDataFrame([(1, "Dairy")], "department_id long, department string")
    return orders, products, aisles, departments


KEPT = [(1, 1, 1, 1), (1, 1, 2, 0), (1, 4, 3, 1)]
WIDE = [
    (1, 1, 1, "Milk", "cold", "dairy", 1, 1, 0, 0),
    (1, 1, 1, "Milk", "cold", "dairy", 2, 0, 0, 0),
    (1, 1, 4, "Mystery", None, None, 3, 1, 0, 0),
]


@pytest.mark.parametrize("hot_rows,broadcast", [(1_000_000, True), (2, False)])
def test_lines_and_transactions(lines, references, monkeypatch, hot_rows, broadcast):
    monkeypatch.setattr(joins, "fits_broadcast", lambda df: broadcast)
    monkeypatch.setattr(joins, "HOT_ROWS", hot_rows)
    orders, products, aisles, departments = references
    good_orders = cleaning.clean_orders(orders)
    good_products = cleaning.clean_products(products)
    cleaned = cleaning.clean_order_products(lines, good_orders, good_products)
    assert sorted(map(tuple, cleaned.collect())) == KEPT
    stepwise = star.retail_transactions(
        cleaned,
        good_orders,
        good_products,
        cleaning.clean_aisles(aisles),
        cleaning.clean_departments(departments),
    )
    in_one = star.transactions_from_raw(lines, orders, products, aisles, departments)
    assert stepwise.columns == in_one.columns == list(tables.TRANSACTION_COLUMNS)
    order = ("product_id", "add_to_cart_order")
    assert list(map(tuple, stepwise.orderBy(*order).collect())) == WIDE
    assert list(map(tuple, in_one.orderBy(*order).collect())) == WIDE


def test_many_copies_are_merged_before_they_travel(spark, lines, monkeypatch):
    monkeypatch.setattr(joins, "HOT_ROWS", 50)
    rule = tables.MERGED_LINES
    assert joins.find_hot_keys(lines, "order_id") is None
    plain = cleaning.mergeable_lines(lines, None)
    assert plain.count() == cleaning.acceptable(lines, rule).count()
    copies = lines.unionByName(spark.range(200).selectExpr(
        "1L AS order_id", "1L AS product_id", "1 AS add_to_cart_order", "0 AS reordered"
    ))
    merged = cleaning.mergeable_lines(copies, joins.find_hot_keys(copies, "order_id"))
    assert merged.filter("order_id = 1 AND product_id = 1 AND add_to_cart_order = 1").collect() == [
        (1, 1, 1, 1)
    ]


def test_union_and_keys(spark, lines):
    shuffled = lines.select("reordered", "product_id", "order_id", "add_to_cart_order")
    merged = cleaning.merge_order_products(lines, shuffled)
    assert merged.count() == 2 * lines.count()
    assert merged.columns == lines.columns
    assert cleaning.distinct_keys(merged, "order_id").count() == 3
    keys_only = cleaning.one_per_key(lines.select("order_id"), ["order_id"])
    assert keys_only.count() == 3


def test_rounding_is_that_of_the_exact_value(spark):
    values = [2.675, 1.005, 0.125, 0.375, -2.675, -0.001, 1234567.125, 0.00005, 1e17, 1e308, 0.0]
    values += [sign * (n + 0.5) / 10**p for n in range(1500) for p in (2, 4) for sign in (1, -1)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for places in (2, 4):
        found = [r[0] for r in df.select(rounded(F.col("v"), places)).collect()]
        assert found == [round(v, places) for v in values]
    odd = spark.sql("SELECT CAST('NaN' AS DOUBLE) AS a, CAST('-Infinity' AS DOUBLE) AS b, CAST(NULL AS DOUBLE) AS c")
    a, b, c = odd.select(*[rounded(F.col(n), 2) for n in "abc"]).first()
    assert a != a and b == float("-inf") and c is None


def test_broadcast_is_measured_with_its_names(spark):
    """Few products, but with an aisle name too long to be sent with each."""
    products = spark.range(200).selectExpr(
        "id AS product_id", "'p' AS product_name", "1L AS aisle_id", "1L AS department_id"
    )
    departments = spark.sql("SELECT 1L AS department_id, 'd' AS department")
    lines = spark.range(50).selectExpr(
        "id AS order_id", "id AS product_id", "1 AS add_to_cart_order", "0 AS reordered"
    )
    orders = spark.range(50).selectExpr(
        "id AS order_id", "id AS user_id", "1 AS order_dow", "1 AS order_hour_of_day"
    )
    for width, sent in ((10, True), (200_000, False)):
        aisles = spark.range(1).select(
            F.lit(1).cast("long").alias("aisle_id"), F.repeat(F.lit("x"), width).alias("aisle")
        )
        joined = star.retail_transactions(lines, orders, products, aisles, departments)
        plan = joined._jdf.queryExecution().optimizedPlan().toString()
        hinted = "rightHint=(strategy=broadcast)" in plan
        assert hinted == sent
        assert joined.count() == 50


def test_expressions(spark):
    row = spark.range(1).select(
        collapse_spaces(F.lit("\tfoo \n bar  ")).alias("a"),
        normal_text(F.lit("  Dairy   Eggs ")).alias("b"),
        number_or_null(F.lit("n/a")).alias("c"),
        number_or_null(F.lit("2.5")).alias("d"),
        ratio(F.lit(1), F.lit(0)).alias("e"),
        ratio(F.lit(1), F.lit(4)).alias("f"),
        rounded(F.lit(0.125), 2).alias("g"),
        rounded(F.lit(0.66666), 4).alias("h"),
        strip(F.lit("\x1f  x y\x85\n")).alias("i"),
    ).first()
    assert tuple(row) == ("foo bar", "dairy eggs", None, 2.5, 0.0, 0.25, 0.12, 0.6667, "x y")
