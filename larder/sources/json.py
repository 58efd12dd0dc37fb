"""One-row JSON documents."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from larder import LarderError
from larder.sources.workspace import file_system


def one_row(spark: SparkSession) -> DataFrame:
    """A table of a single row, in a single partition, to select results into."""
    return spark.range(0, 1, 1, 1)


def to_document(fields: Column, indented: bool = False) -> Column:
    options = {"ignoreNullFields": "false"}
    return F.to_json(fields, options | ({"pretty": "true"} if indented else {}))


def write_document(df: DataFrame, path: str) -> None:
    """Write a one-row, one-column document as one text file at ``path``.

    Spark writes folders, so the part file is written beside it and then takes the
    place of what was there.  Anything but one row is an error and changes nothing.
    """
    spark = df.sparkSession
    rows = Observation()
    counted = df.observe(rows, F.count(F.lit(1)).alias("n"))
    parts = f"{path}.parts"
    counted.coalesce(1).write.mode("overwrite").text(parts)
    files, folder = file_system(spark, parts)
    try:
        if rows.get["n"] != 1:
            raise LarderError(f"a document has one row, not {rows.get['n']}: {path}")
        _, target = file_system(spark, path)
        part = next(s.getPath() for s in files.listStatus(folder) if s.getPath().getName().startswith("part-"))
        files.delete(target, True)
        if not files.rename(part, target):
            raise LarderError(f"cannot write {path}")
    finally:
        files.delete(folder, True)


def read_document(spark: SparkSession, path: str) -> DataFrame:
    """A written document as one row, its fields as columns."""
    try:
        return spark.read.json(path, multiLine=True)
    except AnalysisException as problem:
        raise LarderError(f"no such document: {path}") from problem
