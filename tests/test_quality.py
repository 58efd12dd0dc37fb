import json

import pytest
from pyspark.sql import functions as F

from larder import LarderError, adapters, tables
from larder.operators import quality
from larder.plans import silver

SF = "/root/testdata/sf0.001"


def facts(checks, *columns):
    return {tuple(r[c] for c in columns): (r.metric_value, r.status) for r in checks.collect()}


def test_schema_differences(spark):
    drifted = spark.createDataFrame(
        [(1, "x", 2, "y")], "order_id long, product_id string, add_to_cart_order int, note string"
    )
    found = facts(
        quality.schema_checks(drifted, tables.PRIOR_LINES), "column_name", "metric_name"
    )
    assert found[("*", "missing_columns")] == ("reordered", "FAIL")
    assert found[("*", "extra_columns")] == ("note", "WARN")
    assert found[("product_id", "expected_type")] == ("bigint", "FAIL")
    assert found[("product_id", "actual_type")] == ("string", "FAIL")
    assert found[("order_id", "actual_type")] == ("bigint", "PASS")
    assert ("reordered", "expected_type") not in found
    fine = quality.schema_checks(drifted.limit(0).select("order_id"), tables.PRIOR_LINES)
    assert fine.columns == tables.QUALITY_SCHEMA.fieldNames()


def test_values(spark):
    stored = spark.createDataFrame(
        [("1", "a"), ("x", None), (None, "b")], "aisle_id string, aisle string"
    )
    found = facts(quality.value_checks(stored, tables.AISLES), "column_name", "metric_name")
    assert found[("aisle_id", "null_count")] == ("1", "WARN")
    assert found[("aisle_id", "null_pct")] == ("33.3333", "WARN")
    assert found[("aisle_id", "invalid_cast_count")] == ("1", "FAIL")
    assert found[("aisle", "invalid_cast_count")] == ("0", "PASS")


def test_duplicates_count_null_as_a_key(spark):
    rows = spark.createDataFrame(
        [(1, 1), (1, 1), (1, 2), (None, 1), (None, 1), (None, 1)], "a int, b int"
    )
    found = facts(quality.duplicate_checks(rows, ["a", "b"], "t"), "column_name", "metric_name")
    assert found == {
        ("a,b", "total_rows"): ("6", "INFO"),
        ("a,b", "distinct_keys"): ("3", "INFO"),
        ("a,b", "duplicate_rows"): ("3", "WARN"),
    }


def test_an_empty_table_has_schema_and_duplicate_rows_only(spark):
    empty = spark.createDataFrame([], tables.AISLES.schema)
    checks = quality.check_table(empty, tables.AISLES)
    kinds = {r.check_type: r["count"] for r in checks.groupBy("check_type").count().collect()}
    assert kinds == {"schema": 6, "duplicate": 3}
    assert {r.metric_value for r in checks.filter("check_type = 'duplicate'").collect()} == {"0"}


def test_distinct_and_duplicate_rows_add_up(spark):
    lines = adapters.messy_lines(spark, SF)
    found = facts(
        quality.duplicate_checks(lines, tables.MERGED_LINES.key, "lines"), "metric_name"
    )
    total, distinct, excess = (
        int(found[(name,)][0]) for name in ("total_rows", "distinct_keys", "duplicate_rows")
    )
    assert total == lines.count() == distinct + excess
    assert distinct == lines.select(*tables.MERGED_LINES.key).distinct().count()


def test_report_and_summary(spark):
    bronze = {
        "orders": adapters.orders(spark, SF),
        "products": adapters.products(spark, SF),
        "departments": adapters.departments(spark, SF),
        "aisles": adapters.aisles(spark, SF),
        "order_products__prior": adapters.prior_lines(spark, SF),
        "order_products__train": adapters.train_lines(spark, SF),
    }
    merged = bronze["order_products__prior"].unionByName(bronze["order_products__train"])
    checks = silver.check_bronze(bronze, merged)
    kinds = {(r.dataset, r.check_type) for r in checks.collect()}
    assert {d for d, kind in kinds if kind == "duplicate"} == {
        "orders",
        "products",
        "departments",
        "aisles",
        "order_products_merged",
    }
    assert {kind for d, kind in kinds if d == "order_products__prior"} == {"schema"}
    document = json.loads(quality.summary_document(checks, "now").first()[0])
    summary = quality.summary(checks).first()
    assert document["summary"] == summary.asDict()
    assert document["generated_at"] == "now"
    assert len(document["checks"]) == summary.total_checks == checks.count()
    stamped = quality.report_table(checks, "now")
    assert stamped.columns == [*tables.QUALITY_SCHEMA.fieldNames(), "report_generated_at"]


def test_output_contract(spark):
    schema = tables.GOLD_SCHEMAS["gold_basket_metrics"]
    good = spark.range(1).select(F.col("id").alias("order_id"), F.lit(1).cast("long").alias("basket_size"))
    quality.require_columns(good, schema, "baskets")
    with pytest.raises(LarderError, match="lacks"):
        quality.require_columns(good.drop("basket_size"), schema, "baskets")
    with pytest.raises(LarderError, match="another type"):
        quality.require_columns(good.withColumn("basket_size", F.lit(1)), schema, "baskets")
