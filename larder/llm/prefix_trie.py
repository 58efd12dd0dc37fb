"""Operator 13, conversation prefix trie: shared beginnings and what they save."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.centroids import BLOCK, LIMIT, blocks, subtree_sums
from larder.llm.common import in_order
from larder.operators.joins import find_hot_keys, spread_join
from larder.sources.workspace import staged

FAMILY = 5  # conversations c - c % 5 lend their first turns to c
HEADS = 9  # crc32(c) % 9 of them
IDS = 4096  # ids in a piece of a list that is hashed in order
LANES = ["_1", "_2", "_3", "_4"]
EMPTY = hashlib.sha256().hexdigest()


def _lanes(place: Column) -> dict[str, Column]:
    """Four words of 32 bits for a turn at a place; their running sums name a prefix."""
    x, y = F.xxhash64(place, "a", "b"), F.xxhash64("b", place, "a")
    low = F.lit((1 << 32) - 1)
    return {
        "_1": x.bitwiseAND(low), "_2": F.shiftrightunsigned(x, 32),
        "_3": y.bitwiseAND(low), "_4": F.shiftrightunsigned(y, 32),
    }


def _key(depth: Column, sums: list[Column]) -> Column:
    """128 bits that name a sequence of turns, from its length and its sums."""
    halves = (F.xxhash64(depth, *sums), F.xxhash64(*sums[::-1], depth))
    return F.unhex(F.concat(*[F.lpad(F.hex(h), 16, "0") for h in halves]))


def rebuilt_paths(turns: DataFrame, family: int = FAMILY, heads: int = HEADS) -> tuple[DataFrame, DataFrame]:
    """The rebuilt conversations as paths, and one row for each conversation.

    Paths: path (conv_id), depth, node, parent, octets (of the turn's text) and last;
    conversations: conv_id and n_turns.  Turns are put in order by range, so a very
    long conversation lies in many partitions; running sums go on from one to the next.
    """
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    narrow = turns.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"),
        F.xxhash64(role, text).alias("a"), F.xxhash64(text, F.lit(1), role).alias("b"),
        F.octet_length(text).cast("long").alias("octets"),
    )
    rows = in_order(narrow, "conv_id", "turn", "role", "a", "b").select(
        "conv_id", "pos", F.col("_part").alias("part"), "a", "b", "octets"
    )
    spans = staged(rows.groupBy("conv_id", "part").agg(F.min("pos").alias("_low"), F.count("*").alias("_n")))
    whole = spans.groupBy("conv_id").agg(F.min("_low").alias("_first"), F.sum("_n").alias("_turns"))
    base = F.col("conv_id") - F.col("conv_id") % family
    lent = (
        rows.filter(F.col("conv_id") == base)
        .join(spans.join(whole, "conv_id").select("conv_id", "part", "_first"), ["conv_id", "part"])
        .filter(F.col("pos") - F.col("_first") < heads - 1)
        .groupBy("conv_id")
        .agg(F.array_sort(F.collect_list(F.struct("pos", "a", "b", "octets"))).alias("_head"))
        .withColumnRenamed("conv_id", "_base")
    )
    none = F.array().cast("array<struct<pos:bigint,a:bigint,b:bigint,octets:bigint>>")
    convs = staged(
        whole.withColumn("_base", base)
        .withColumn("_h", F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(heads)).cast("int"))
        .join(lent, "_base", "left")
        .withColumn("_head", F.slice(F.coalesce("_head", none), F.lit(1), F.col("_h")))
        .withColumn("n_turns", F.size("_head") + F.greatest(F.col("_turns") - F.col("_h"), F.lit(0)))
        .select("conv_id", "_first", "_h", "_head", "n_turns")
    )
    begun = convs.select("conv_id", F.lit(-1).cast("long").alias("part"), "n_turns",
                         F.posexplode("_head").alias("_i", "_t")).select(
        "conv_id", "part", "n_turns", (F.col("_i") + 1).cast("long").alias("depth"), "_t.a", "_t.b", "_t.octets"
    )
    shift = F.size("_head") - F.col("_h") + 1 - F.col("_first")
    placed = spans.join(convs.withColumn("_shift", shift), "conv_id").select(
        "conv_id", "part", "n_turns", "_shift", (F.col("_first") + F.col("_h")).alias("_from")
    )
    own = (
        rows.join(placed, ["conv_id", "part"])
        .filter("pos >= _from")
        .select("conv_id", "part", "n_turns", (F.col("pos") + F.col("_shift")).alias("depth"), "a", "b", "octets")
    )
    turned = staged(begun.union(own).withColumns(_lanes(F.col("depth"))).drop("a", "b"))
    ahead = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        turned.groupBy("conv_id", "part")
        .agg(*[F.sum(c).alias(c) for c in LANES])
        .select("conv_id", "part", *[F.coalesce(F.sum(c).over(ahead), F.lit(0)).alias(f"o{c}") for c in LANES])
    )
    so_far = Window.partitionBy("conv_id", "part").orderBy("depth")
    summed = turned.withColumns({f"s{c}": F.sum(c).over(so_far) for c in LANES}).join(offsets, ["conv_id", "part"])
    here = [F.col(f"s{c}") + F.col(f"o{c}") for c in LANES]
    paths = staged(
        summed.select(
            F.col("conv_id").alias("path"), "depth", _key(F.col("depth"), here).alias("node"),
            _key(F.col("depth") - 1, [s - F.col(c) for s, c in zip(here, LANES, strict=True)]).alias("parent"),
            "octets", (F.col("depth") == F.col("n_turns")).alias("last"),
        )
    )
    return paths, convs.select("conv_id", "n_turns")


def prefix_trie(
    turns: DataFrame, family: int = FAMILY, heads: int = HEADS, limit: int = LIMIT
) -> DataFrame:
    """A row for each distinct beginning of the rebuilt conversations.

    Each conversation c is its base's (c - c % ``family``) first h turns and its own
    after its first h, h = crc32(c) % ``heads``.  conv_id (the smallest member), depth, parent_conv_id
    (null at the root), n_convs, n_children, n_leaves, saved_tokens and ends_sha256.
    Sums over subtrees (n_leaves, saved_tokens) come from ``centroids.subtree_sums``.

    Beginnings are named by 128 bits: sums of hashes of turn and place, which partitions
    add up on their own and which therefore need no conversation in one task.  The ids
    of conversations that end at a node are hashed in order: pieces of the list are
    made in parallel and one task after another takes them in, since SHA-256 has no
    other way; it holds one batch of pieces at a time.

    Null role or text is empty text.  Turns that are null come first; equal ones are
    ordered by role, then by a hash of role and text, so repeated rows are turns of their own and
    their order never matters.  Rows without a conv_id belong to no conversation and are left out.  Very
    long texts are read once, for hash and length.  An empty table gives an empty result.
    """
    paths, convs = rebuilt_paths(turns, family, heads)
    top = _key(F.lit(0).cast("long"), [F.lit(0).cast("long")] * 4)
    found = paths.groupBy("node").agg(
        F.min("path").alias("path"), F.min("depth").alias("depth"), F.count("*").alias("n_convs"),
        F.min("parent").alias("parent"), F.min("octets").alias("octets"),
    )
    root = convs.agg(F.min("conv_id").alias("path"), F.count("*").alias("n_convs")).filter("n_convs > 0").select(
        top.alias("node"), "path", F.lit(0).cast("long").alias("depth"), "n_convs",
        F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("long").alias("octets"),
    )
    nodes = staged(found.union(root))

    # nodes below a node: those that its members have alone, as the smallest of them
    alone = nodes.filter("depth > 0").groupBy("path").agg(
        F.count("*").alias("_own"), F.max("depth").alias("_last")
    )
    reach = paths.groupBy("path").agg(F.max("depth").alias("_end"))
    parts = blocks(reach.join(alone, "path", "left"), F.lit(1), F.col("_end"))
    counted = (
        paths.withColumn("block", F.floor(F.col("depth") / BLOCK))
        .join(parts.select("path", "block", F.coalesce("_own", F.lit(0)).alias("_own")), ["path", "block"])
        .groupBy("node").agg(F.sum("_own").alias("_all"))
    )
    children = nodes.filter("parent IS NOT NULL").groupBy("parent").agg(F.count("*").alias("n_children"))
    total = nodes.count()
    sized = staged(
        nodes.join(counted, "node", "left")
        .join(children.withColumnRenamed("parent", "node"), "node", "left")
        .withColumn("n_children", F.coalesce("n_children", F.lit(0)))
        .withColumn("block", F.floor(F.col("depth") / BLOCK))
        .join(blocks(alone, F.lit(0), F.col("_last")), ["path", "block"], "left")
        .withColumn(
            "size",
            F.when(F.col("depth") == 0, F.lit(total))
            .otherwise(F.col("_all") - F.col("_own") + F.col("_last") - F.col("depth") + 1),
        )
        .select("node", "parent", "path", "depth", "n_convs", "n_children", "octets", "size")
    )
    forest = sized.select(
        "node", "parent", "path", "depth", "size",
        (F.col("n_children") == 0).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("octets")).alias("saved_tokens"),
    )
    sums = subtree_sums(forest, paths.select("path", "depth", "node"), ["n_leaves", "saved_tokens"], limit)

    ends = staged(
        paths.filter("last").select("node", F.col("path").alias("conv_id"))
        .union(convs.filter("n_turns = 0").select(top.alias("node"), "conv_id"))
    )
    known = sized.select(F.col("node").alias("parent"), F.col("path").alias("parent_conv_id"))
    inner = spread_join(sized.filter("depth > 0"), known, "parent", ["node"], find_hot_keys(sized, "parent"))
    with_parent = inner.select(*sized.columns, "parent_conv_id").union(
        sized.filter("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long"))
    )
    return (
        with_parent.join(sums, "node")
        .join(list_digests(ends), "node", "left")
        .select(
            F.col("path").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children",
            "n_leaves", "saved_tokens", F.coalesce("digest", F.lit(EMPTY)).alias("ends_sha256"),
        )
    )


def list_digests(ends: DataFrame) -> DataFrame:
    """node and digest: SHA-256 of its ids, ascending, decimal, joined by commas."""
    dealt = ends.repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")
    cut = staged(dealt.mapInArrow(_pieces, "node binary, first long, digest string, piece binary"))
    parts = cut.filter("piece IS NOT NULL").select("node", "first", "piece")
    joined = parts.repartition("node").sortWithinPartitions("node", "first").mapInArrow(
        _hashed, "node binary, digest string"
    )
    return cut.filter("digest IS NOT NULL").select("node", "digest").union(joined)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of nodes that end within a batch; the others' lists in pieces."""
    for batch in batches:
        if not batch.num_rows:
            continue
        node, ids = batch.column("node").to_pylist(), batch.column("conv_id").to_pylist()
        starts = [k for k in range(len(node)) if not k or node[k] != node[k - 1]]
        rows = []
        for s, e in zip(starts, [*starts[1:], len(node)], strict=True):
            # the first and the last node of a batch may go on in another one
            if s and e < len(node):
                text = ",".join(map(str, ids[s:e])).encode()
                rows.append((node[s], ids[s], hashlib.sha256(text).hexdigest(), None))
            else:
                for k in range(s, e, IDS):
                    rows.append((node[s], ids[k], None, ",".join(map(str, ids[k : min(k + IDS, e)])).encode()))
        columns = zip(*rows, strict=True)
        kinds = [pa.binary(), pa.int64(), pa.string(), pa.binary()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["node", "first", "digest", "piece"]
        )


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each node's pieces, which come one after another."""
    now, state, done = None, None, []
    for batch in batches:
        for node, piece in zip(batch.column("node").to_pylist(), batch.column("piece").to_pylist(), strict=True):
            if node != now:
                if state is not None:
                    done.append((now, state.hexdigest()))
                now, state = node, hashlib.sha256(piece)
            else:
                state.update(b"," + piece)
        if done:
            yield pa.RecordBatch.from_pydict({"node": [n for n, _ in done], "digest": [d for _, d in done]})
            done = []
    if state is not None:
        yield pa.RecordBatch.from_pydict({"node": [now], "digest": [state.hexdigest()]})
