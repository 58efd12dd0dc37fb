"""How many rows stored tables have, from the footers of their files."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Files whose footers are read one after another; more are counted by a job.
MOST_FILES = 256

# Operators that give no more rows than they take.
_NARROWING = {"Project", "Filter", "Union", "Aggregate", "SubqueryAlias", "Distinct", "Deduplicate"}


def row_bound(df: DataFrame) -> int | None:
    """Rows that ``df`` has at most, without a job; None if its plan does not tell.

    For plans of projections, filters, unions and groupings over Parquet files: the
    rows of all files, those of a table that is read twice counted twice.
    """
    spark = df.sparkSession
    plan = df._jdf.queryExecution().optimizedPlan()
    waiting, paths = [plan], []
    while waiting:
        node = waiting.pop()
        children = node.children()
        if children.size():
            if node.nodeName() not in _NARROWING:
                return None
            # a grouping without keys has a row of its own
            if node.nodeName() == "Aggregate" and not node.groupingExpressions().size():
                return None
            waiting += [children.apply(i) for i in range(children.size())]
        elif node.getClass().getSimpleName() == "LogicalRelation":
            relation = node.relation()
            if relation.getClass().getSimpleName() != "HadoopFsRelation":
                return None
            if relation.fileFormat().getClass().getSimpleName() != "ParquetFileFormat":
                return None
            paths += relation.location().inputFiles()
            if len(paths) > MOST_FILES:
                return None
        elif not (node.getClass().getSimpleName() == "LocalRelation" and node.data().isEmpty()):
            return None
    return sum(_rows(spark, path) for path in paths)


def _rows(spark, path: str) -> int:
    """Rows of one Parquet file."""
    parquet, hadoop = spark._jvm.org.apache.parquet.hadoop, spark._jvm.org.apache.hadoop.fs
    at = hadoop.Path(spark._jvm.java.net.URI(path))
    file = parquet.util.HadoopInputFile.fromPath(at, spark._jsc.hadoopConfiguration())
    reader = parquet.ParquetFileReader.open(file)
    try:
        return reader.getRecordCount()
    finally:
        reader.close()
