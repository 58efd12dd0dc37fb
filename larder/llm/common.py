"""What several operators share: reading, word splitting, order, word hashes."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from larder.sources.workspace import staged

# White space between words: space and the control characters 9 to 13.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = r"[ \t-\r]+"


def ready(spark: SparkSession) -> None:
    """Let Python workers import this package, wherever the session was started."""
    context = spark.sparkContext
    if getattr(context, "_larder_shipped", False):
        return
    home = Path(__file__).resolve().parents[2]
    archive = shutil.make_archive(tempfile.mkdtemp() + "/larder", "zip", home, "larder")
    context.addPyFile(archive)
    context._larder_shipped = True


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text: Column) -> Column:
    """The words of a text, an empty array for null or blank text."""
    bare = F.btrim(text, F.lit(BLANKS))
    return F.when(F.length(bare) > 0, F.split(bare, BLANK_RUN, -1)).otherwise(
        F.array().cast("array<string>")
    )


def in_order(df: DataFrame, *keys: str) -> DataFrame:
    """Stored copy of ``df`` with ``pos``, the gapless place of each row by ``keys``.

    Rows are range partitioned and numbered within their partition; only the
    partition sizes, one row each, are added up in one place.  Both the input and
    the numbered rows are written down, so that a recomputed task cannot draw
    other range bounds.  Meant for narrow rows: ids and sizes, not texts.
    """
    numbered = staged(
        staged(df)
        .repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_row", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftrightunsigned("_row", 33))
        .withColumn("_row", F.col("_row").bitwiseAND(F.lit((1 << 33) - 1)))
    )
    ahead = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        numbered.groupBy("_part")
        .agg(F.count("*").alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_before"))
    )
    return numbered.join(F.broadcast(before), "_part").withColumn(
        "pos", F.col("_before") + F.col("_row")
    )


def by_batch(
    df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str | StructType
) -> DataFrame:
    """``work`` on each Arrow batch of ``df``."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = work(batch)
            if out is not None and out.num_rows:
                yield out

    return df.mapInArrow(each, schema)


class WordHashes(dict):
    """Remembered 64-bit hashes of words; forgets all of them when it gets large."""

    LIMIT = 400_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BASE = np.uint64(0x9E3779B97F4A7C15)


def rolling(h: np.ndarray, width: int) -> np.ndarray:
    """Hash of every ``width`` consecutive word hashes."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = h[:n].copy()
    for i in range(1, width):
        out *= BASE
        out += h[i : i + n]
    return mixed(out)


def sorted_groups(
    batches: Iterator[pa.RecordBatch], key: list[str]
) -> Iterator[pa.Table]:
    """Whole groups, many at a time, of a partition that is sorted by ``key``.

    Only the last group of what has been read waits for the next batch.
    """
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in key]
        new = np.zeros(batch.num_rows, bool)
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
        if waiting:
            last = waiting[-1]
            new[0] = any(
                last.column(k)[last.num_rows - 1].as_py() != c[0]
                for k, c in zip(key, columns, strict=True)
            )
        starts = np.flatnonzero(new)
        if len(starts):
            cut = int(starts[-1])
            if waiting or cut:
                yield pa.Table.from_batches([*waiting, batch.slice(0, cut)])
            waiting = [batch.slice(cut)]
        else:
            waiting.append(batch)
    if waiting:
        yield pa.Table.from_batches(waiting)


def group_starts(columns: list[np.ndarray]) -> np.ndarray:
    """Where groups of equal values begin in sorted columns."""
    new = np.ones(len(columns[0]), bool)
    if len(new) > 1:
        new[1:] = False
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)
