"""Sums over all subtrees of a forest by centroid decomposition."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import sorted_groups
from larder.operators.joins import find_hot_keys, spread_join
from larder.sources.workspace import staged

LIMIT = 4096  # nodes of a component that one task decomposes to the end
BLOCK = 4096  # depths of one path that travel under one key


def blocks(rows: DataFrame, lowest, highest) -> DataFrame:
    """``rows`` repeated for each block of depths from ``lowest`` to ``highest``."""
    first, last = (F.floor(d / F.lit(BLOCK)) for d in (lowest, highest))
    return rows.withColumn("block", F.explode(F.sequence(first, last)))


def subtree_sums(nodes: DataFrame, paths: DataFrame, values: list[str], limit: int = LIMIT) -> DataFrame:
    """node and, for each of ``values``, its sum over the node and all below it.

    ``nodes``: node, parent (null at a top), path (a path that runs from the top through
    the node), depth, size (nodes of its subtree) and the values (long).  ``paths``:
    path, depth, node: every node on every path, from depth 1 on; ``path`` is unique
    and so is ``node`` in ``nodes``.

    Every component gives its centroid: the deepest node with over half of the
    component below it.  What lies on its way up to the component's top are just the
    other nodes with over half, so one condition on a row finds them, and they
    get the centroid's total.  Without its centroid a component falls into parts of at most
    half its size: one above it, and one for each child.  A node is below the centroid
    if its path goes through it and it is deeper; the path also tells below which child.
    So a level is a few joins and groupings, and a row gets at most one addition in each
    level.  Components of ``limit`` nodes at most are decomposed to the end in one task,
    many at a time.

    Long paths travel in blocks of depths, and children that very many paths share are
    spread, so no key holds more than its share.  An empty table gives an empty result.
    """
    tops = nodes.filter("parent IS NULL").selectExpr("node AS comp", "size AS total")
    single = nodes.filter("parent IS NULL").limit(2).collect()
    if len(single) == 1:
        # no constant, as joins by a constant would have no key
        comp = F.when(F.col("node").isNotNull(), F.lit(single[0]["node"]))
        start = nodes.withColumn("comp", comp).withColumn("total", F.lit(single[0]["size"]))
    else:
        first = paths.filter("depth = 1").join(tops, F.col("node") == F.col("comp")).select("path", "comp", "total")
        start = nodes.join(first, "path")
    start = start.withColumns({f"got_{v}": F.lit(0).cast("long") for v in values})
    lengths = paths.groupBy("path").agg(F.max("depth").alias("_last"))
    hot = find_hot_keys(paths, "node")
    finished, small = [], []
    while True:
        small.append(start.filter(F.col("total") <= limit))
        large = start.filter(F.col("total") > limit)
        picks = staged(
            large.filter("2 * size > total")
            .groupBy("comp")
            .agg(F.min_by(F.struct("node", "depth", "size"), "size").alias("c"))
            .selectExpr("comp", "c.node AS _node", "c.depth AS _depth", "c.size AS _size")
        )
        if picks.isEmpty():
            break
        children = large.join(picks, large["parent"] == picks["_node"]).select(
            "node", large["size"].alias("_under"), "_node"
        )
        through = spread_join(paths.select("node", "path"), children, "node", ["path"], hot).select(
            "path", "_node", F.col("node").alias("_child"), "_under"
        )
        through = blocks(through.join(picks.select("_node", "_depth"), "_node").join(lengths, "path"),
                         F.col("_depth"), F.col("_last")).drop("_depth", "_last")
        marked = staged(
            large.join(picks, "comp")
            .withColumn("block", F.floor(F.col("depth") / BLOCK))
            .join(through, ["path", "_node", "block"], "left")
            .withColumn("_below", (F.col("depth") > F.col("_depth")) & F.col("_child").isNotNull())
            .withColumn("_up", (F.expr("2 * size > total")) & (F.col("node") != F.col("_node")))
            .drop("block")
        )
        under = F.col("_below") | (F.col("node") == F.col("_node"))
        sums = staged(
            marked.filter(under).groupBy("comp").agg(*[F.sum(v).alias(f"_{v}") for v in values])
        )
        known = marked.join(sums, "comp")
        finished.append(
            known.filter("node = _node").select(
                "node", *[(F.col(f"got_{v}") + F.col(f"_{v}")).alias(v) for v in values]
            )
        )
        start = known.filter("node <> _node").select(
            "node", "parent", "path", "depth",
            F.when(F.col("_up"), F.col("size") - F.col("_size")).otherwise(F.col("size")).alias("size"),
            *values,
            F.when(F.col("_below"), F.col("_child")).otherwise(F.col("comp")).alias("comp"),
            F.when(F.col("_below"), F.col("_under")).otherwise(F.col("total") - F.col("_size")).alias("total"),
            *[
                (F.col(f"got_{v}") + F.when(F.col("_up"), F.col(f"_{v}")).otherwise(F.lit(0))).alias(f"got_{v}")
                for v in values
            ],
        )
    rest = small[0]
    for more in small[1:]:
        rest = rest.union(more)
    kind = dict(nodes.dtypes)["node"]
    done = (
        rest.select("comp", "node", "parent", "depth", "size", *values, *[f"got_{v}" for v in values])
        .repartition("comp")
        .sortWithinPartitions("comp")
        .mapInArrow(
            lambda batches: _decomposed(batches, values),
            f"node {kind}, " + ", ".join(f"{v} long" for v in values),
        )
    )
    for more in finished:
        done = done.union(more)
    return done


def _decomposed(batches: Iterator[pa.RecordBatch], values: list[str]) -> Iterator[pa.RecordBatch]:
    for table in sorted_groups(batches, ["comp"]):
        nodes, parents = table.column("node").to_pylist(), table.column("parent").to_pylist()
        place = {node: i for i, node in enumerate(nodes)}
        parent = np.fromiter((place.get(p, -1) for p in parents), np.int64, len(nodes))
        depth, size = (table.column(c).to_numpy().astype(np.int64) for c in ("depth", "size"))
        own = np.stack([table.column(v).to_numpy() for v in values], 1).astype(np.int64)
        got = np.stack([table.column(f"got_{v}").to_numpy() for v in values], 1).astype(np.int64)
        sums = decompose(parent, depth, size, own, got)
        yield pa.RecordBatch.from_arrays(
            [table.column("node").combine_chunks(), *(pa.array(sums[:, k]) for k in range(len(values)))],
            ["node", *values],
        )


def preorder(parent: np.ndarray, depth: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A number for each node, so that a subtree has consecutive ones from its top on."""
    n = len(parent)
    by_parent = np.argsort(parent, kind="stable")
    ahead = np.cumsum(size[by_parent]) - size[by_parent]
    new = np.ones(n, bool)
    new[1:] = parent[by_parent][1:] != parent[by_parent][:-1]
    before = np.empty(n, np.int64)  # sizes of the siblings ahead; of the tops ahead
    before[by_parent] = ahead - np.repeat(ahead[new], np.diff(np.append(np.flatnonzero(new), n)))
    number = before.copy()
    by_depth = np.argsort(depth, kind="stable")
    cuts = np.flatnonzero(np.diff(depth[by_depth])) + 1
    for level in np.split(by_depth, cuts):
        inner = level[parent[level] >= 0]
        number[inner] = number[parent[inner]] + 1 + before[inner]
    return number


def decompose(
    parent: np.ndarray, depth: np.ndarray, size: np.ndarray, own: np.ndarray, got: np.ndarray
) -> np.ndarray:
    """Subtree sums of ``own`` plus ``got`` for a forest; ``parent`` is -1 at the tops."""
    n = len(parent)
    number, span = preorder(parent, depth, size), size.copy()
    size, got = size.copy(), got.copy()
    # every node starts in the component of its top
    tops = np.flatnonzero(parent < 0)
    tops = tops[np.argsort(number[tops])]
    comp = tops[np.searchsorted(number[tops], number, "right") - 1]
    total = np.zeros(n, np.int64)
    total[tops] = size[tops]
    left = np.arange(n)
    centroid = np.zeros(n, np.int64)
    sums = np.zeros_like(got)
    while len(left):
        heavy = left[2 * size[left] > total[comp[left]]]
        order = heavy[np.lexsort((size[heavy], comp[heavy]))]
        first = np.ones(len(order), bool)
        first[1:] = comp[order][1:] != comp[order][:-1]
        found = order[first]
        centroid[comp[found]] = found
        mid = centroid[comp[left]]
        below = left[(number[left] > number[mid]) & (number[left] < number[mid] + span[mid])]
        of_comp = np.zeros_like(got)
        of_comp[comp[found]] = own[found]
        np.add.at(of_comp, comp[below], own[below])
        sums[found] = got[found] + of_comp[comp[found]]
        up = heavy[centroid[comp[heavy]] != heavy]
        got[up] += of_comp[comp[up]]
        size[up] -= size[centroid[comp[up]]]
        total[comp[found]] -= size[found]
        # parts below: named by the child they hang on, found by its number
        child = below[parent[below] == centroid[comp[below]]]
        keys = comp[child] * (n + 1) + number[child]
        child, keys = child[np.argsort(keys)], np.sort(keys)
        total[child] = size[child]
        at = np.searchsorted(keys, comp[below] * (n + 1) + number[below], "right") - 1
        comp[below] = child[at]
        gone = np.zeros(n, bool)
        gone[found] = True
        left = left[~gone[left]]
    return sums
