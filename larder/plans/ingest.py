"""Raw CSV files to bronze tables."""

from __future__ import annotations

from collections.abc import Collection
from functools import partial

from pyspark.sql import SparkSession

from larder.plans.together import together
from larder.sources.csv import ingest_csv
from larder.tables import RAW_TABLES


def ingest_all(
    spark: SparkSession, raw: str, bronze: str, multi_line: Collection[str] | None = None
) -> dict[str, int]:
    """Ingest ``raw/<table>.csv`` of every table; returns rows per table.

    An input that is missing or empty ends the run with an error.  ``multi_line``
    names the tables whose quoted values may hold line breaks; those files are read
    by one task each.  Without it the tables' own settings hold.
    """
    jobs = {
        spec.name: partial(
            ingest_csv,
            spark,
            f"{raw}/{spec.name}.csv",
            spec,
            bronze,
            None if multi_line is None else spec.name in multi_line,
        )
        for spec in RAW_TABLES
    }
    return {name: count.valid for name, count in together(spark, jobs).items()}
