"""Where intermediate tables go: a folder every executor can reach."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from larder import LarderError


_scopes: list[list[str]] = []


def file_system(spark: SparkSession, path: str):
    """The file system of a path, and the path as it wants it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file, or None where there is no such file."""
    files, at = file_system(spark, path)
    if not files.exists(at):
        return None
    stream = files.open(at)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Put a small file in the place of the former one, in one step."""
    files, target = file_system(spark, path)
    _, beside = file_system(spark, f"{path}.{uuid.uuid4().hex}")
    stream = files.create(beside, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    overwrite = getattr(hadoop, "Options$Rename").OVERWRITE
    options = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 1)
    options[0] = overwrite
    target = files.makeQualified(target)
    context = hadoop.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(files.makeQualified(beside), target, options)


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Work folders named within the block, by any of its threads, go when it ends.

    For stages that have written their results by then.  A stage's scope also takes
    the folders of whatever else runs in this process at the same time, so stages of
    one process run one after the other.
    """
    named: list[str] = []
    _scopes.append(named)
    try:
        yield
    finally:
        _scopes.remove(named)
        for path in named:
            files, at = file_system(spark, path)
            files.delete(at, True)


def work_dir(spark: SparkSession) -> str:
    """A fresh folder name below ``spark.checkpoint.dir``.

    Only a local session may go without that setting, since only there do
    driver and executors share one disk.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise LarderError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="larder-")
    path = f"{shared.rstrip('/')}/larder-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return path


def staged(df: DataFrame, folder: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet and read it back.

    For results that are used more than once: they are computed one time, the
    lineage behind them ends, and the written table outlives lost executors.
    """
    spark = df.sparkSession
    path = folder or work_dir(spark)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
