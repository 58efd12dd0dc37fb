"""Cleaning: standardise, filter, one row per key, references, union, keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder import functions as fn
from larder import tables
from larder.operators.joins import SALT, Size, find_hot_keys, lookup_join, most_rows, spread_join
from larder.tables import TableSpec

NULL_SHARES = 256  # parts of the lines that name no order


def standards(spec: TableSpec) -> dict[str, Column]:
    """The columns that a table's contract standardises, and how."""
    return {
        **{name: fn.normal_text(F.col(name)) for name in spec.lowered},
        **{name: fn.collapse_spaces(F.col(name)) for name in spec.collapsed},
        **{name: fn.number_or_null(F.col(name)) for name in spec.tolerant},
    }


def acceptable(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows that meet the table's contract, with its columns standardised."""
    standard = standards(spec)
    complete = df.filter(" AND ".join(f"{name} IS NOT NULL" for name in spec.required))
    kept = complete.withColumns(standard) if standard else complete
    return kept.filter(" AND ".join(f"({rule})" for rule in spec.domain))


def one_per_key(df: DataFrame, keys: Sequence[str], rank: Sequence[str] = ()) -> DataFrame:
    """One row per key: the one with the greatest remaining columns.

    The choice depends on values only, so a rerun or a retried task makes the
    same one.  Copies are merged before the shuffle, however many there are.
    """
    rest = list(rank) or [name for name in df.columns if name not in keys]
    if not rest:
        return df.select(*keys).distinct()
    if len(rest) == 1:
        return df.groupBy(*keys).agg(F.max(rest[0]).alias(rest[0]))
    best = df.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("_best"))
    return best.select(*keys, "_best.*")


# Of a key's rows: how many there are, and the best acceptable one, null if there is none.
ROWS, BEST = "_rows", "_best"


def _best_acceptable(spec: TableSpec) -> Column:
    """The greatest acceptable row of a group of standardised rows, without its key."""
    rules = [*(f"{name} IS NOT NULL" for name in spec.required), *(f"({rule})" for rule in spec.domain)]
    return F.max(F.when(F.expr(" AND ".join(rules)), F.struct(*spec.rank))).alias(BEST)


def grouped(df: DataFrame, spec: TableSpec) -> DataFrame:
    """One row for each key of ``df``, null keys too: the key, ROWS and BEST.

    One grouping that serves both the count of duplicates, which takes all rows, and
    the cleaned table, which takes the best acceptable row of each key.
    """
    standard = standards(spec)
    rows = df.withColumns(standard) if standard else df
    return rows.groupBy(*spec.key).agg(F.count("*").alias(ROWS), _best_acceptable(spec))


def best_rows(groups: DataFrame, spec: TableSpec) -> DataFrame:
    """The cleaned table from its groups."""
    return groups.filter(F.col(BEST).isNotNull()).select(*spec.key, f"{BEST}.*").select(*spec.columns)


def clean(
    df: DataFrame,
    spec: TableSpec,
    columns: Sequence[str] | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """Acceptable rows, one per key.

    With ``columns``, only the ranked columns up to the last one asked for are
    carried; the row chosen per key is the same as without.  With ``tasks``, rows first go by key
    to so many tasks, where a join by the key goes on; for tables without a key that has
    very many copies (``joins.lookup_tasks``).
    """
    rank = list(spec.rank)
    if columns is not None:
        asked = [name for name in rank if name in columns]
        rank = rank[: rank.index(asked[-1]) + 1] if asked else []
    rows = acceptable(df, spec).select(*spec.key, *rank)
    if tasks is not None:
        rows = rows.repartition(tasks, *spec.key)
    wanted = spec.columns if columns is None else columns
    return one_per_key(rows, spec.key, rank).select(*wanted)


def clean_orders(
    orders: DataFrame, columns: Sequence[str] | None = None, tasks: int | None = None
) -> DataFrame:
    return clean(orders, tables.ORDERS, columns, tasks)


def clean_products(
    products: DataFrame, columns: Sequence[str] | None = None, tasks: int | None = None
) -> DataFrame:
    return clean(products, tables.PRODUCTS, columns, tasks)


def clean_departments(departments: DataFrame) -> DataFrame:
    return clean(departments, tables.DEPARTMENTS)


def clean_aisles(aisles: DataFrame) -> DataFrame:
    return clean(aisles, tables.AISLES)


def merge_order_products(prior: DataFrame, train: DataFrame) -> DataFrame:
    """Both splits under one another; duplicates stay."""
    columns = tables.MERGED_LINES.columns
    return prior.select(*columns).unionByName(train.select(*columns))


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    return df.select(key).distinct()


def mergeable_lines(lines: DataFrame, hot_orders: DataFrame | None) -> DataFrame:
    """Acceptable lines; copies already merged if one line has very many of them.

    Duplicates are usually few, and removing them after the order join saves a
    shuffle.  But copies of one line all go the same way, however its order is
    spread.  Where they are many they are merged first, on the map side; that
    takes a hot order, so without one there is nothing to look for.
    """
    spec = tables.MERGED_LINES
    rows = acceptable(lines, spec)
    if hot_orders is None or find_hot_keys(lines, *spec.key) is None:
        return rows
    return one_per_key(rows, spec.key, spec.rank)


def grouped_lines(
    lines: DataFrame, orders: DataFrame, rows: int | None = None
) -> DataFrame:
    """One row for each key of the lines, as ``grouped`` gives, and ``known``: its order is known.

    The order join and the grouping share one partitioning, so lines move over the
    network once, for the count of duplicates and the cleaned table together.  Lines of hot orders are
    divided, and so are those without an order; where one line has very many copies
    they are merged before the join.  ``rows``: the number of lines, if it is known.
    """
    spec = tables.MERGED_LINES
    rows = most_rows(lines) if rows is None else rows
    hot_orders = find_hot_keys(lines, "order_id", rows=rows)
    copies = hot_orders is not None and find_hot_keys(lines, *spec.key, rows=rows) is not None
    counted = (
        lines.groupBy(*spec.columns).agg(F.count("*").alias("_n"))
        if copies
        else lines.select(*spec.columns, F.lit(1).cast("long").alias("_n"))
    )
    placed = spread_join(
        counted,
        orders.select("order_id", F.lit(True).alias("known")),
        "order_id",
        spread_by=["product_id", "add_to_cart_order"],
        hot=hot_orders,
        how="left",
        null_shares=NULL_SHARES,
        rows=rows,
    )
    return (
        placed.groupBy("order_id", SALT, "product_id", "add_to_cart_order", "known")
        .agg(F.sum("_n").alias(ROWS), _best_acceptable(spec))
        .drop(SALT)
    )


def known_lines(
    groups: DataFrame, products: DataFrame, size: Size | None = None, rows: int | None = None
) -> DataFrame:
    """The cleaned lines from their groups: of known orders and products, one for each key."""
    found = best_rows(groups.filter("known"), tables.MERGED_LINES)
    return lookup_join(
        found,
        products.select("product_id"),
        "product_id",
        spread_by=["order_id", "add_to_cart_order"],
        how="left_semi",
        counted=groups,
        size=size,
        rows=rows,
    ).select(*tables.MERGED_LINES.columns)


def clean_order_products(
    lines: DataFrame, orders: DataFrame, products: DataFrame
) -> DataFrame:
    """Acceptable lines of known orders and products, one per key.

    ``orders`` and ``products`` are cleaned tables with one row per id.  The
    order join comes last: its partitioning also serves the final grouping, so
    lines move over the network once.
    """
    spec = tables.MERGED_LINES
    rows = most_rows(lines)
    hot_orders = find_hot_keys(lines, "order_id", rows=rows)
    known = lookup_join(
        mergeable_lines(lines, hot_orders),
        products.select("product_id"),
        "product_id",
        spread_by=["order_id", "add_to_cart_order"],
        how="left_semi",
        counted=lines,
        rows=rows,
    )
    placed = spread_join(
        known,
        orders.select("order_id"),
        "order_id",
        spread_by=["product_id", "add_to_cart_order"],
        hot=hot_orders,
        how="left_semi",
        rows=rows,
    )
    once = one_per_key(
        placed, ["order_id", SALT, "product_id", "add_to_cart_order"], spec.rank
    )
    return once.select(*spec.columns)
