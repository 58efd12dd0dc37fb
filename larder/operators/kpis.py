"""Gold KPIs over the transaction table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder import functions as fn
from larder.operators.joins import SALT


def product_aggregates(fact: DataFrame) -> DataFrame:
    """Lines, reordered lines and their ratio per product.

    ``total_orders`` counts lines: a product at two positions of one basket
    counts twice.
    """
    totals = fact.groupBy("product_id", "product_name").agg(
        F.count("*").alias("total_orders"),
        F.sum("reordered").alias("total_reorders"),
    )
    return totals.withColumn(
        "reorder_rate", fn.ratio(F.col("total_reorders"), F.col("total_orders"))
    )


def product_rates(product_agg: DataFrame) -> DataFrame:
    return product_agg.select("product_id", "product_name", "reorder_rate")


# Customers with ids from 0 up to here are counted in bitmaps, 32,768 to each.
BITMAP_IDS = 1 << 25


# With more lines than this, customers are counted in words of 64.
BITMAP_ROWS = 1_000_000


def department_metrics(fact: DataFrame, rows: int | None = None) -> DataFrame:
    """Lines and exact number of customers per known department.

    Customers are bits.  ``rows`` is the number of lines, if the caller knows it: up to
    ``BITMAP_ROWS``, or if it is not known, they are counted in bitmaps, else in words.
    Bitmaps of many customers are mostly zeros, and as each task has its own, what is moved would
    grow with customers times tasks.
    """
    known = fact.filter(F.col("department").isNotNull())
    large = rows is not None and rows > BITMAP_ROWS
    counted = _customers_in_words(known) if large else _customers_in_bitmaps(known)
    return counted.groupBy("department").agg(
        F.sum("_lines").alias("total_products_sold"),
        F.sum("_customers").alias("unique_customers"),
    )


def _customers_in_words(known: DataFrame) -> DataFrame:
    """Lines and customers for each department and 64 neighbouring ids.

    A row for each of them and task, combined on the map side and without a sort, so a task
    holds no more than its lines or customers ask for, and no more is moved than there are lines.
    """
    bit = F.expr("shiftleft(1L, CAST(user_id & 63 AS INT))")
    words = known.groupBy("department", F.shiftright("user_id", 6).alias("_word")).agg(
        F.count("*").alias("_lines"), F.bit_or(bit).alias("_bits")
    )
    customers = F.coalesce(F.bit_count("_bits").cast("long"), F.lit(0))  # null: lines without a customer
    return words.select("department", "_lines", customers.alias("_customers"))


def _customers_in_bitmaps(known: DataFrame) -> DataFrame:
    """Lines and customers for each department and range of ids.

    One bitmap of 4 KB for each of them, combined
    on the map side, so what is shuffled grows with departments times ranges and not
    with departments times customers.  Ids outside ``BITMAP_IDS`` are counted row by row;
    the filter for them is pushed down, and files without such ids are skipped.
    """
    user = F.col("user_id")
    inside = (user >= 0) & (user < BITMAP_IDS)
    bits = known.groupBy(
        "department", F.when(inside, F.bitmap_bucket_number(user)).alias("_range")
    ).agg(
        F.count("*").alias("_lines"),
        F.bitmap_construct_agg(F.when(inside, F.bitmap_bit_position(user))).alias("_bits"),
    )
    counted = bits.select("department", "_lines", F.bitmap_count("_bits").alias("_customers"))
    others = (
        known.filter((user < 0) | (user >= BITMAP_IDS))
        .groupBy("department")
        .agg(F.count_distinct("user_id").alias("_customers"))
        .select("department", F.lit(0).cast("long").alias("_lines"), "_customers")
    )
    return counted.union(others)


def order_level(fact: DataFrame) -> DataFrame:
    """Basket size per order, the input of both basket and customer KPIs."""
    return fact.groupBy("order_id", "user_id").agg(F.count("*").alias("basket_size"))


def orders_by_customer(fact: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """The same rows as ``order_level``, partitioned by customer.

    The fact table moves once, by customer; baskets are counted inside that partitioning,
    and so are customers, if they are computed from this in one plan.  ``hot`` are customers
    with very many lines, as ``joins.find_hot_keys`` gives them: their orders are
    divided into shares, and ``customer_metrics`` adds the shares up.
    """
    lines = fact.select("order_id", "user_id")
    if hot is None:
        return order_level(lines.repartition("user_id"))
    shares = F.coalesce("_shares", F.lit(1))
    salted = lines.join(F.broadcast(hot), "user_id", "left").select(
        "order_id", "user_id", F.pmod(F.xxhash64("order_id"), shares).cast("int").alias(SALT)
    )
    return (
        salted.repartition("user_id", SALT)
        .groupBy("order_id", "user_id", SALT)
        .agg(F.count("*").alias("basket_size"))
    )


def basket_metrics(orders: DataFrame) -> DataFrame:
    return orders.select("order_id", "basket_size")


def customer_metrics(orders: DataFrame) -> DataFrame:
    if SALT in orders.columns:  # shares of a customer first
        orders = orders.groupBy("user_id", SALT).agg(
            F.count("*").alias("_orders"), F.sum("basket_size").alias("basket_size")
        )
        count = F.sum("_orders")
    else:
        count = F.count("*")
    return (
        orders.groupBy("user_id")
        .agg(count.alias("total_orders"), F.sum("basket_size").alias("total_products"))
        .withColumn("avg_basket_size", F.col("total_products") / F.col("total_orders"))
    )


# The stored tables are sorted for their readers.  Reports take the unsorted ones
# above: what follows a sort cannot always do without it, and it shuffles everything.


def gold_top_products(product_agg: DataFrame) -> DataFrame:
    return product_agg.orderBy(F.desc("total_orders"), "product_id")


def gold_reorder_metrics(product_agg: DataFrame) -> DataFrame:
    return product_rates(product_agg).orderBy(F.desc("reorder_rate"), "product_id")


def gold_department_metrics(fact: DataFrame, rows: int | None = None) -> DataFrame:
    return department_metrics(fact, rows).orderBy(F.desc("total_products_sold"), "department")


def gold_basket_metrics(orders: DataFrame) -> DataFrame:
    return basket_metrics(orders)


def gold_customer_metrics(orders: DataFrame) -> DataFrame:
    return customer_metrics(orders).orderBy(F.desc("total_orders"), "user_id")
