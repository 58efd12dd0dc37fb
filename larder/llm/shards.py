"""Operator 4, sharding: contiguous shards of nearly equal bytes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.common import in_order


def shard_by_bytes(docs: DataFrame, shards: int = 8) -> DataFrame:
    """Cut all documents, in order of ``doc_id``, into shards of nearly equal bytes.

    A document takes the bytes of its text plus one.  The bytes before each
    document come from a running sum within its partition plus the totals of the
    partitions ahead; the document goes where the middle of its bytes falls among
    ``shards`` equal targets, so shards are contiguous and differ from the target
    by less than one document.

    Returns doc_id, size, text_crc32, law ('bytes'), shard, slot (gapless from 0 in
    each shard) and grown_shard (null: it belongs to the law 'key').

    Null text counts as empty (size 1, checksum 0).  Rows without a doc_id come
    first; rows that repeat a doc_id are rows of their own, ordered by size and
    checksum (rows equal in all three are alike).  Very long texts are rows like any
    other; one that exceeds a target leaves shards empty.  Equal texts have equal sizes and checksums and are not kept together.
    An empty table gives an empty result.
    """
    narrow = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
    )
    rows = in_order(narrow, "doc_id", "size", "text_crc32")
    ahead = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy("_part").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    totals = (
        rows.groupBy("_part")
        .agg(F.sum("size").alias("_bytes"))
        .select(
            "_part",
            F.coalesce(F.sum("_bytes").over(ahead), F.lit(0)).alias("_ahead"),
            F.sum("_bytes").over(whole).alias("_total"),
        )
    )
    running = Window.partitionBy("_part").orderBy("_row")
    middle = F.col("_ahead") + F.sum("size").over(running) - F.col("size") / 2
    placed = rows.join(F.broadcast(totals), "_part").withColumn(
        "shard",
        F.least(F.floor(middle * shards / F.col("_total")), F.lit(shards - 1)).cast("int"),
    )
    firsts = placed.groupBy("shard").agg(F.min("pos").alias("_first"))
    return placed.join(F.broadcast(firsts), "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("pos") - F.col("_first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
