"""The denormalised transaction table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder import tables
from larder.operators import cleaning
from larder.operators.joins import (
    BROADCAST_ROWS,
    SALT,
    Size,
    find_hot_keys,
    fits_broadcast,
    lookup_join,
    lookup_tasks,
    most_rows,
    spread_join,
)
from larder.sources.footers import row_bound
from larder.sources.workspace import staged

ORDER_CONTEXT = ["order_id", "user_id", "order_dow", "order_hour_of_day"]


def products_enriched(
    products: DataFrame, aisles: DataFrame, departments: DataFrame
) -> DataFrame:
    """Products with their aisle and department names, null where unknown.

    No hints of its own: Spark broadcasts the two name lists while their measured size
    allows it and shuffles otherwise.
    """
    return (
        products.join(aisles, "aisle_id", "left")
        .join(departments, "department_id", "left")
        .select("product_id", "product_name", "aisle", "department")
    )


def retail_transactions(
    lines: DataFrame,
    orders: DataFrame,
    products: DataFrame,
    aisles: DataFrame,
    departments: DataFrame,
    size: Size | None = None,
    rows: int | None = None,
) -> DataFrame:
    """One row per line of a cleaned line table, with order and product context.

    ``size`` bounds the products with their names and ``rows`` is the number of lines,
    where the caller knows them.
    """
    rows = most_rows(lines) if rows is None else rows
    in_order = spread_join(
        lines,
        orders.select(*ORDER_CONTEXT),
        "order_id",
        spread_by=["product_id", "add_to_cart_order"],
        hot=find_hot_keys(lines, "order_id", rows=rows),
        rows=rows,
    )
    size = size or size_with_names(products, aisles, departments)
    return _with_products(in_order, products, aisles, departments, lines, size, rows)


def transactions_from_raw(
    lines: DataFrame,
    orders: DataFrame,
    products: DataFrame,
    aisles: DataFrame,
    departments: DataFrame,
    rows: int | None = None,
) -> DataFrame:
    """The same table straight from uncleaned inputs, as a single plan.

    The inner joins already drop lines of unknown orders and products, so the
    separate reference checks are left out, and duplicates are removed inside
    the partitions of the order join instead of after a shuffle of their own.  Large
    tables of orders and products are made one row per id in the tasks of their joins.
    ``rows`` is the number of lines, where the caller knows it.
    """
    rows = most_rows(lines) if rows is None else rows
    size = size_with_names(products, aisles, departments)
    order_tasks = lookup_tasks(orders, "order_id", rows)
    product_tasks = lookup_tasks(products, "product_id", rows, own=size.rows)
    aisles, departments = cleaning.clean_aisles(aisles), cleaning.clean_departments(departments)
    if product_tasks is not None:
        aisles, departments = _planned_names(aisles), _planned_names(departments)
    hot_orders = find_hot_keys(lines, "order_id", rows=rows)
    in_order = spread_join(
        cleaning.mergeable_lines(lines, hot_orders),
        cleaning.clean_orders(orders, columns=ORDER_CONTEXT, tasks=order_tasks),
        "order_id",
        spread_by=["product_id", "add_to_cart_order"],
        hot=hot_orders,
        rows=rows,
        placed=order_tasks,
    )
    context = [name for name in ORDER_CONTEXT if name != "order_id"]
    once = in_order.groupBy(
        "order_id", SALT, "product_id", "add_to_cart_order", *context
    ).agg(F.max("reordered").alias("reordered"))
    return _with_products(
        once,
        cleaning.clean_products(products, tasks=product_tasks),
        aisles,
        departments,
        counted=lines,
        size=size,
        rows=rows,
        placed=product_tasks,
    )


def _planned_names(names: DataFrame) -> DataFrame:
    """Names for very many products, written down and measured, with the join that this asks for.

    A filter on a name turns the outer join into an inner one, and where the products are small
    as a compressed file, Spark may then send all of them to every executor and into one task.
    """
    names = staged(names)
    return F.broadcast(names) if fits_broadcast(names) else names.hint("merge")


def size_with_names(products: DataFrame, aisles: DataFrame, departments: DataFrame) -> Size:
    """A bound of the products with their aisle and department names.

    The names of each product take no more than the longest aisle and the longest
    department name, so the three tables are measured on their own and not joined.
    Cleaning drops rows and shortens texts, but for a few letters whose lower case takes
    half as many bytes again; lengths count twice, so the bound of uncleaned tables
    holds for the cleaned ones.
    """
    rows = row_bound(products)
    if rows is None:
        rows = products.count()
    if rows > BROADCAST_ROWS:
        return Size(rows)
    longest = [
        table.agg(F.max(F.octet_length(name)).alias("n"))
        for table, name in ((aisles, "aisle"), (departments, "department"))
    ]
    own = products.agg(F.sum(F.octet_length("product_name")).alias("n"))
    found = own.union(longest[0]).union(longest[1]).collect()
    octets, *widest = (r["n"] or 0 for r in found)
    return Size(rows, 2 * (octets + rows * sum(widest)))


def _with_products(lines, products, aisles, departments, counted, size, rows=None, placed=None):
    """Lines with the names of their products, aisles and departments."""
    named = lookup_join(
        lines.drop(SALT),
        products_enriched(products, aisles, departments),
        "product_id",
        spread_by=["order_id", "add_to_cart_order"],
        counted=counted,
        size=size,
        rows=rows,
        placed=placed,
    )
    return named.select(*tables.TRANSACTION_COLUMNS)
