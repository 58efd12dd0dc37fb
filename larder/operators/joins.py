"""Joining a large table to a lookup side that has one row per key."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.sources.footers import row_bound
from larder.sources.workspace import staged

# A key with this many rows on the large side is split over several tasks, unless that
# is less than the given part of a shuffle partition's share, so that at most about
# HOT_KEYS keys for each shuffle partition are hot, however large the table is.
HOT_ROWS = 1_000_000
HOT_KEYS = 4

# A task of a shuffled join takes about this many rows of the large side.  Spark alone puts
# partitions together by their compressed size, and rows that compress well then fill one
# task with many times the memory that small or plain tables suggest.
TASK_ROWS = 1_000_000

# A lookup side within both limits is sent to every executor.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 32 << 20

SALT = "_salt"


@dataclass(frozen=True)
class Size:
    """How many rows a table has at most, and how many bytes all of its texts take."""

    rows: int
    octets: int = 0

    def fits_broadcast(
        self, columns: int, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
    ) -> bool:
        return self.rows <= max_rows and 16 * self.rows * columns + self.octets <= max_bytes


def fits_broadcast(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> bool:
    """Measure whether ``df`` is small enough to broadcast.

    The number of rows is read from file footers where the plan allows it, without a job;
    text lengths are added up only if there are few enough rows.
    """
    rows = row_bound(df)
    if rows is None:
        rows = df.count()
    if rows > max_rows:
        return False
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    octets = 0
    if texts and rows:
        widths = " + ".join(f"coalesce(octet_length(`{name}`), 0)" for name in texts)
        octets = df.selectExpr(f"sum(CAST({widths} AS BIGINT))").first()[0] or 0
    return Size(rows, octets).fits_broadcast(len(df.columns), max_rows, max_bytes)


def hot_keys(df: DataFrame, *key: str, hot_rows: int | None = None) -> DataFrame:
    """Keys that hold about ``hot_rows`` rows or more, each with its number of shares.

    Keys are counted in a sample just large enough to tell: a key at the limit
    still has a thousand sampled rows or, where the limit is lower, all of its
    rows.  So next to nothing is shuffled to find them, and at most about
    ``rows / hot_rows`` keys qualify.
    """
    hot_rows = hot_rows or HOT_ROWS
    fraction = min(1.0, 1000.0 / hot_rows)
    counted = df.select(*key) if fraction == 1.0 else df.select(*key).sample(fraction, seed=7)
    estimate = f"_n / {fraction}D"
    return (
        counted.groupBy(*key)
        .agg(F.count("*").alias("_n"))
        .filter(f"{estimate} >= {0.9 * hot_rows}D")
        .selectExpr(*key, f"CAST(ceil({estimate} / {hot_rows}) AS INT) AS _shares")
    )


def most_rows(df: DataFrame) -> int:
    """Rows that ``df`` has at most, read from file footers where the plan allows it, else counted."""
    rows = row_bound(df)
    return df.count() if rows is None else rows


def tasks_for(spark: SparkSession, rows: int) -> int | None:
    """Into how many tasks a shuffle of so many rows goes; None where Spark's own number will do."""
    if rows <= TASK_ROWS:
        return None
    return max(-(-rows // TASK_ROWS), spark.sparkContext.defaultParallelism)


def lookup_tasks(lookup: DataFrame, key: str, rows: int, own: int | None = None) -> int | None:
    """Into how many tasks an uncleaned lookup table goes by its key before it is made one row per key.

    For a join to ``rows`` rows, whose tasks it then lies in; ``own`` is the number of its own
    rows, if it is known.  None where they are few, or where a key has very many copies:
    those are merged on the map side, and what is left goes to the tasks of the join.
    """
    own = most_rows(lookup) if own is None else own
    if tasks_for(lookup.sparkSession, own) is None or find_hot_keys(lookup, key, rows=own) is not None:
        return None
    return tasks_for(lookup.sparkSession, max(rows, own))


def find_hot_keys(df: DataFrame, *key: str, rows: int | None = None) -> DataFrame | None:
    """The hot keys of ``df``, written down, or None.

    The number of rows is ``rows`` if the caller knows it, else that of ``most_rows``.  A
    table smaller than one hot key is not looked at any further, so no job is started
    for it.  Written down, so
    that whoever uses them goes by the same list, whatever is recomputed later.
    """
    if rows is None:
        rows = most_rows(df)
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    partitions = max(partitions, tasks_for(df.sparkSession, rows) or 0)
    limit = max(HOT_ROWS, rows // (HOT_KEYS * partitions))
    if rows < 0.9 * limit:
        return None
    hot = staged(hot_keys(df, *key, hot_rows=limit))
    return None if hot.isEmpty() else hot


def spread_join(
    large: DataFrame,
    lookup: DataFrame,
    key: str,
    spread_by: Sequence[str],
    hot: DataFrame | None,
    how: str = "inner",
    null_shares: int = 1,
    rows: int | None = None,
    placed: int | None = None,
) -> DataFrame:
    """Equi-join that stays balanced when a few keys hold most of the rows.

    ``hot`` is what ``find_hot_keys`` gave for the large side.  Rows of a hot
    key are divided by a hash of ``spread_by`` into as many shares as the key
    needs, and its single lookup row is repeated once per share.  Other keys
    have one share, so nothing else grows: all repeats together number about
    twice ``rows / HOT_ROWS``.  The hot keys are broadcast: ``find_hot_keys`` bounds
    their number by that of shuffle partitions.  Which keys are hot decides how rows
    travel, never which match.  Without hot keys it is a plain join.

    The share number stays in the result as ``_salt``: with it in their keys,
    later groupings can go on from the partitioning this join leaves behind.
    Rows without a key, which an outer join keeps, have ``null_shares`` shares.

    ``rows`` is the number of rows of the large side, if the caller knows it.  More than
    ``TASK_ROWS`` are dealt to a number of tasks that grows with them, so that a task
    holds no more of a larger table.  ``placed`` is the number of tasks (``lookup_tasks``) that the
    lookup side lies in already, by its key; without hot keys it does not move again.
    """
    lone = F.when(F.col(key).isNull(), F.lit(null_shares))
    if hot is None and null_shares == 1:
        return _dealt_join(large.withColumn(SALT, F.lit(0)), lookup, [key], how, rows, placed)
    if hot is None:
        hashed = F.pmod(F.xxhash64(*spread_by), F.coalesce(lone, F.lit(1))).cast("int")
        once = lookup.withColumn(SALT, F.lit(0))
        return _dealt_join(large.withColumn(SALT, hashed), once, [key, SALT], how, rows)
    hot = F.broadcast(hot)
    shares = F.coalesce("_shares", F.lit(1))
    salted = large.join(hot, key, "left").withColumn(
        SALT, F.pmod(F.xxhash64(*spread_by), F.coalesce(lone, shares)).cast("int")
    )
    repeated = lookup.join(hot, key, "left").withColumn(
        SALT, F.explode(F.sequence(F.lit(0), shares - 1))
    )
    return _dealt_join(salted.drop("_shares"), repeated.drop("_shares"), [key, SALT], how, rows)


def _broadcast_for_sure(lookup: DataFrame) -> bool:
    """Whether Spark sends the lookup side to every executor whatever it finds out when it runs.

    Spark's estimate goes by compressed files and plans a broadcast; adaptive execution then
    measures the rows, and where they are too many it shuffles both sides into its own
    number of tasks.  So the rows decide, and the estimate only if they are few.
    """
    texts = any(isinstance(f.dataType, T.StringType) for f in lookup.schema.fields)
    rows = None if texts else row_bound(lookup)
    if rows is None:
        return False
    limit = lookup.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    stats = lookup._jdf.queryExecution().optimizedPlan().stats()
    fits = Size(rows).fits_broadcast(len(lookup.columns), max_bytes=limit)
    return fits and stats.sizeInBytes() <= limit


def _dealt_join(
    large: DataFrame,
    lookup: DataFrame,
    keys: list[str],
    how: str,
    rows: int | None,
    placed: int | None = None,
) -> DataFrame:
    """A join whose number of tasks follows the rows of the large side, if it moves them at all."""
    tasks = placed
    if placed is None:
        tasks = None if rows is None else tasks_for(large.sparkSession, rows)
        if tasks is None or _broadcast_for_sure(lookup):
            return large.join(lookup, keys, how)
        lookup = lookup.repartition(tasks, *keys)
    if how == "left_semi":
        # as an inner join: Spark would move a semi join below the exchange and a union,
        # into joins of their own for each part, which share a task
        lookup, how = lookup.select(*keys).distinct(), "inner"
    return large.repartition(tasks, *keys).join(lookup, keys, how)


def lookup_join(
    large: DataFrame,
    lookup: DataFrame,
    key: str,
    spread_by: Sequence[str],
    how: str = "inner",
    counted: DataFrame | None = None,
    size: Size | None = None,
    rows: int | None = None,
    placed: int | None = None,
) -> DataFrame:
    """Broadcast the lookup side if it is small, else a spread join.

    ``size`` bounds the lookup side where the caller knows a bound, which saves
    measuring it; ``counted`` is where to look for hot keys in place of ``large``, and
    ``rows`` how many rows that has; ``placed`` is as in ``spread_join``.
    """
    small = fits_broadcast(lookup) if size is None else size.fits_broadcast(len(lookup.columns))
    if small:
        return large.join(F.broadcast(lookup), key, how)
    counted = large if counted is None else counted
    rows = most_rows(counted) if rows is None else rows
    hot = find_hot_keys(counted, key, rows=rows)
    return spread_join(large, lookup, key, spread_by, hot, how, rows=rows, placed=placed).drop(SALT)
