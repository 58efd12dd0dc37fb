"""Table contracts: one registry that ingestion, cleaning and checks share."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

_TYPES = {
    "long": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
}


def _schema(columns: dict[str, str], nullable: tuple[str, ...] = ()) -> T.StructType:
    return T.StructType(
        [T.StructField(name, _TYPES[kind], name in nullable) for name, kind in columns.items()]
    )


@dataclass(frozen=True)
class TableSpec:
    """What a table holds and what makes one of its rows acceptable.

    ``rank`` orders the non-key columns for choosing between rows that share a
    key: the row with the greatest values, compared in that order, stays.
    Because the comparison goes column by column, the winner's first *n* ranked
    columns can be found from those columns alone (see ``cleaning.clean``).
    """

    name: str
    schema: T.StructType
    key: tuple[str, ...]
    rank: tuple[str, ...] = ()
    required: tuple[str, ...] = ()
    lowered: tuple[str, ...] = ()  # whitespace collapsed and lower-cased
    collapsed: tuple[str, ...] = ()  # whitespace collapsed, case kept
    tolerant: tuple[str, ...] = ()  # read as double, null where it is none
    domain: tuple[str, ...] = ()  # SQL predicates on the standardised row
    multi_line: bool = False  # CSV values may hold line breaks

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()


# Names, types and value ranges of the input and output tables.
ORDERS = TableSpec(
    name="orders",
    schema=_schema(
        {
            "order_id": "long",
            "user_id": "long",
            "eval_set": "string",
            "order_number": "int",
            "order_dow": "int",
            "order_hour_of_day": "int",
            "days_since_prior_order": "double",
        },
        nullable=("days_since_prior_order",),
    ),
    key=("order_id",),
    rank=(
        "user_id",
        "order_dow",
        "order_hour_of_day",
        "order_number",
        "eval_set",
        "days_since_prior_order",
    ),
    required=(
        "order_id",
        "user_id",
        "eval_set",
        "order_number",
        "order_dow",
        "order_hour_of_day",
    ),
    lowered=("eval_set",),
    tolerant=("days_since_prior_order",),
    domain=(
        "order_number >= 1",
        "order_dow BETWEEN 0 AND 6",
        "order_hour_of_day BETWEEN 0 AND 23",
    ),
)

PRODUCTS = TableSpec(
    name="products",
    schema=_schema(
        {
            "product_id": "long",
            "product_name": "string",
            "aisle_id": "long",
            "department_id": "long",
        }
    ),
    key=("product_id",),
    rank=("product_name", "aisle_id", "department_id"),
    required=("product_id", "product_name", "aisle_id", "department_id"),
    collapsed=("product_name",),
    domain=("length(product_name) > 0",),
    multi_line=True,
)

DEPARTMENTS = TableSpec(
    name="departments",
    schema=_schema({"department_id": "long", "department": "string"}),
    key=("department_id",),
    rank=("department",),
    required=("department_id", "department"),
    lowered=("department",),
    domain=("length(department) > 0",),
    multi_line=True,
)

AISLES = TableSpec(
    name="aisles",
    schema=_schema({"aisle_id": "long", "aisle": "string"}),
    key=("aisle_id",),
    rank=("aisle",),
    required=("aisle_id", "aisle"),
    lowered=("aisle",),
    domain=("length(aisle) > 0",),
    multi_line=True,
)


def _lines(name: str) -> TableSpec:
    columns = {
        "order_id": "long",
        "product_id": "long",
        "add_to_cart_order": "int",
        "reordered": "int",
    }
    return TableSpec(
        name=name,
        schema=_schema(columns),
        key=("order_id", "product_id", "add_to_cart_order"),
        rank=("reordered",),
        required=tuple(columns),
        domain=("add_to_cart_order >= 1", "reordered IN (0, 1)"),
    )


PRIOR_LINES = _lines("order_products__prior")
TRAIN_LINES = _lines("order_products__train")
MERGED_LINES = _lines("order_products_merged")

RAW_TABLES = (ORDERS, PRODUCTS, DEPARTMENTS, AISLES, PRIOR_LINES, TRAIN_LINES)

TRANSACTIONS = "retail_transactions"
TRANSACTION_COLUMNS = (
    "order_id",
    "user_id",
    "product_id",
    "product_name",
    "aisle",
    "department",
    "add_to_cart_order",
    "reordered",
    "order_dow",
    "order_hour_of_day",
)
KPI_FACT_COLUMNS = (
    "order_id",
    "user_id",
    "product_id",
    "product_name",
    "department",
    "reordered",
)

QUALITY_REPORT = "data_quality_report"
QUALITY_SCHEMA = _schema(
    {
        "dataset": "string",
        "check_type": "string",
        "column_name": "string",
        "metric_name": "string",
        "metric_value": "string",
        "status": "string",
    }
)

# basket_size is a count, so it is a long.
GOLD_SCHEMAS: dict[str, T.StructType] = {
    "gold_top_products": _schema(
        {
            "product_id": "long",
            "product_name": "string",
            "total_orders": "long",
            "total_reorders": "long",
            "reorder_rate": "double",
        }
    ),
    "gold_department_metrics": _schema(
        {"department": "string", "total_products_sold": "long", "unique_customers": "long"}
    ),
    "gold_customer_metrics": _schema(
        {
            "user_id": "long",
            "total_orders": "long",
            "total_products": "long",
            "avg_basket_size": "double",
        }
    ),
    "gold_basket_metrics": _schema({"order_id": "long", "basket_size": "long"}),
    "gold_reorder_metrics": _schema(
        {"product_id": "long", "product_name": "string", "reorder_rate": "double"}
    ),
}
