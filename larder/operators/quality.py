"""Data quality: schema, null, type and duplicate checks as a table of metrics."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder import LarderError
from larder.sources.json import one_row, to_document
from larder.tables import QUALITY_SCHEMA, TableSpec


def schema_checks(df: DataFrame, spec: TableSpec, dataset: str | None = None) -> DataFrame:
    """Compare column names and types with the contract; reads no data."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    expected = {f.name: f.dataType.simpleString() for f in spec.schema.fields}
    missing = ",".join(sorted(expected.keys() - actual.keys()))
    extra = ",".join(sorted(actual.keys() - expected.keys()))
    found = [
        ("*", "missing_columns", missing or "none", "FAIL" if missing else "PASS"),
        ("*", "extra_columns", extra or "none", "WARN" if extra else "PASS"),
    ]
    for name, wanted in expected.items():
        if name in actual:
            verdict = "PASS" if actual[name] == wanted else "FAIL"
            found.append((name, "expected_type", wanted, verdict))
            found.append((name, "actual_type", actual[name], verdict))
    metrics = [
        _metric(dataset or spec.name, "schema", column, metric, f"'{value}'", f"'{status}'")
        for column, metric, value, status in found
    ]
    return _rows(one_row(df.sparkSession), metrics)


# Prefixes of the profile's columns, which the checks name their metrics by.
NULLS, INVALID = "null__", "invalid__"


def profile(df: DataFrame, spec: TableSpec) -> DataFrame:
    """One row: total rows, nulls per column, failed casts per expected column."""
    nulls = [F.expr(f"count_if(`{c}` IS NULL) AS `{NULLS}{c}`") for c in df.columns]
    bad_casts = [
        F.expr(
            f"count_if(`{f.name}` IS NOT NULL"
            f" AND try_cast(`{f.name}` AS {f.dataType.simpleString()}) IS NULL)"
            f" AS `{INVALID}{f.name}`"
        )
        for f in spec.schema.fields
        if f.name in df.columns
    ]
    return df.agg(F.count("*").alias("total_rows"), *nulls, *bad_casts)


def _metric(dataset: str, check: str, column: str, metric: str, value: str, status: str) -> str:
    """A report row as a SQL struct; ``value`` and ``status`` are SQL expressions."""
    parts = [f"'{dataset}'", f"'{check}'", f"'{column}'", f"'{metric}'", value, status]
    named = [f"{part} AS {name}" for part, name in zip(parts, QUALITY_SCHEMA.fieldNames())]
    return f"struct({', '.join(named)})"


def _flag(count: str, otherwise: str) -> str:
    return f"CASE WHEN {count} = 0 THEN 'PASS' ELSE '{otherwise}' END"


def _text(count: str) -> str:
    return f"CAST({count} AS STRING)"


def _null_metrics(profiled: DataFrame, dataset: str) -> list[str]:
    found = []
    for label in profiled.columns:
        if label.startswith(NULLS):
            column, n = label.removeprefix(NULLS), f"`{label}`"
            share = f"format_string('%.4f', rint({n} / total_rows * 100 * 1e4D) / 1e4D)"
            status = _flag(n, "WARN")
            found.append(_metric(dataset, "null", column, "null_count", _text(n), status))
            found.append(_metric(dataset, "null", column, "null_pct", share, status))
    return found


def _cast_metrics(profiled: DataFrame, dataset: str) -> list[str]:
    return [
        _metric(
            dataset,
            "dtype",
            label.removeprefix(INVALID),
            "invalid_cast_count",
            _text(f"`{label}`"),
            _flag(f"`{label}`", "FAIL"),
        )
        for label in profiled.columns
        if label.startswith(INVALID)
    ]


def _rows(figures: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """The metrics as rows, computed from a table of at most one row."""
    return figures.selectExpr(f"inline(array({', '.join(metrics)}))")


def null_checks(profiled: DataFrame, dataset: str) -> DataFrame:
    """Null count and percentage per column; none for an empty table."""
    return _rows(profiled.filter("total_rows > 0"), _null_metrics(profiled, dataset))


def cast_checks(profiled: DataFrame, dataset: str) -> DataFrame:
    """Values that are not of the expected type; none for an empty table."""
    return _rows(profiled.filter("total_rows > 0"), _cast_metrics(profiled, dataset))


def value_checks(df: DataFrame, spec: TableSpec, dataset: str | None = None) -> DataFrame:
    """Null and cast checks from one pass over the data."""
    name = dataset or spec.name
    profiled = profile(df, spec)
    metrics = _null_metrics(profiled, name) + _cast_metrics(profiled, name)
    return _rows(profiled.filter("total_rows > 0"), metrics)


def duplicate_checks(df: DataFrame, keys: Sequence[str], dataset: str) -> DataFrame:
    """Rows, distinct keys and excess rows, from one grouping; null is a key too."""
    return duplicate_counts(df.groupBy(*keys).agg(F.count("*").alias("n")), "n", keys, dataset)


def duplicate_counts(
    groups: DataFrame, rows: str, keys: Sequence[str], dataset: str
) -> DataFrame:
    """The same from a table with one row for each key; ``rows`` says how many it stands for."""
    totals = groups.agg(
        F.coalesce(F.sum(rows), F.lit(0)).alias("total"),
        F.count("*").alias("distinct_keys"),
    )
    excess = "(total - distinct_keys)"
    metrics = [
        ("total_rows", "total", "'INFO'"),
        ("distinct_keys", "distinct_keys", "'INFO'"),
        ("duplicate_rows", excess, _flag(excess, "WARN")),
    ]
    column = ",".join(keys)
    return _rows(
        totals,
        [
            _metric(dataset, "duplicate", column, name, _text(value), status)
            for name, value, status in metrics
        ],
    )


def check_table(
    df: DataFrame,
    spec: TableSpec,
    dataset: str | None = None,
    duplicates: bool = True,
    groups: DataFrame | None = None,
    rows: str = "_rows",
) -> DataFrame:
    """All checks of one table.

    ``groups`` has one row for each key and, in ``rows``, how many rows it stands for: with
    it duplicates are counted without grouping the table again.
    """
    name = dataset or spec.name
    checks = schema_checks(df, spec, name).unionByName(value_checks(df, spec, name))
    if groups is not None:
        checks = checks.unionByName(duplicate_counts(groups, rows, spec.key, name))
    elif duplicates:
        checks = checks.unionByName(duplicate_checks(df, spec.key, name))
    return checks


def union_checks(checks: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def report_table(checks: DataFrame, generated_at: str) -> DataFrame:
    return checks.withColumn("report_generated_at", F.lit(generated_at))


def summary(checks: DataFrame) -> DataFrame:
    status = F.col("status")
    return checks.agg(
        F.count("*").alias("total_checks"),
        F.count_if(status == "FAIL").alias("failures"),
        F.count_if(status == "WARN").alias("warnings"),
    )


def summary_document(checks: DataFrame, generated_at: str, indented: bool = True) -> DataFrame:
    """The report as one JSON text; its length depends on columns, not on rows."""
    fields = QUALITY_SCHEMA.fieldNames()
    listed = F.array_sort(F.collect_list(F.struct(*fields))).alias("checks")
    status = F.col("status")
    return checks.agg(
        F.struct(
            F.count("*").alias("total_checks"),
            F.count_if(status == "FAIL").alias("failures"),
            F.count_if(status == "WARN").alias("warnings"),
        ).alias("summary"),
        listed,
    ).select(
        to_document(
            F.struct(F.lit(generated_at).alias("generated_at"), "summary", "checks"), indented
        ).alias("document")
    )


def require_columns(df: DataFrame, schema: T.StructType, dataset: str) -> None:
    """Raise unless ``df`` has every column of the contract, with its type."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    missing = sorted(set(schema.fieldNames()) - actual.keys())
    if missing:
        raise LarderError(f"{dataset} lacks columns {missing}")
    wrong = {
        f.name: actual[f.name]
        for f in schema.fields
        if actual[f.name] != f.dataType.simpleString()
    }
    if wrong:
        raise LarderError(f"{dataset} has columns of another type: {wrong}")
