"""Operator 5, SimHash near-dedup: generalised pigeonhole with unequal thresholds."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.common import ascii_lower, group_starts, sorted_groups, words_of
from larder.llm.links import components
from larder.llm.simhash import hex16, majority, vote_sums
from larder.sources.workspace import staged

BITS = 64
PROBE_COST = 30.0  # of a shuffled probe, in verified pairs
HEAVY = 20_000  # fingerprints under one key before it is divided
PAIRED = 24  # groups up to this size are compared in one go


def shingle_fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """Distinct (doc_id, fp): fp is the bitwise majority of the shingles' hashes.

    Words are lower-cased (A-Z); a shingle is ``shingle`` words, repeats included, or
    all words where there are fewer.  Without words fp is 0.
    """
    split = docs.select(
        "doc_id",
        F.xxhash64("text").alias("_k"),
        words_of(ascii_lower(F.coalesce("text", F.lit("")))).alias("_w"),
    )
    last = F.greatest(F.size("_w") - shingle, F.lit(0))
    at = split.select("doc_id", "_k", "_w", F.explode(F.sequence(F.lit(0), last)).alias("_i"))
    word = [F.get("_w", F.col("_i") + i) for i in range(shingle)]
    hashed = at.select(
        "doc_id",
        "_k",
        F.when(F.size("_w") > 0, F.xxhash64(F.concat_ws(" ", *word))).alias("_h"),
    )
    votes = hashed.groupBy("doc_id", "_k").agg(
        F.count("_h").alias("_total"), *vote_sums(F.col("_h"), None, "_h")
    )
    fp = F.coalesce(majority("_h", F.col("_total")), F.lit(0).cast("long"))
    return votes.select("doc_id", fp.alias("fp"))


def bit_counts(fps: DataFrame) -> tuple[int, np.ndarray]:
    """How many fingerprints there are, and how many have bits i and j both set."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((BITS, BITS)), 0
        shifts = np.arange(BITS, dtype=np.uint64)
        for batch in batches:
            x = batch.column("fp").to_numpy().view(np.uint64)
            bits = ((x[:, None] >> shifts) & np.uint64(1)).astype(np.float32)
            total += bits.T @ bits
            n += len(x)
        at = np.arange(BITS * BITS + 1)
        values = np.append(total.ravel(), n).astype(np.int64)
        yield pa.RecordBatch.from_pydict({"at": at, "n": values})

    rows = fps.select("fp").mapInArrow(count, "at long, n long").groupBy("at").agg(F.sum("n")).collect()
    flat = np.zeros(BITS * BITS + 1)
    for at, n in rows:  # 4,097 numbers whatever the input
        flat[at] = n
    return int(flat[-1]), flat[:-1].reshape(BITS, BITS)


def group_bits(n: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """Put correlated bits together: each group takes the bits closest to those it has."""
    p = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    near = np.abs(both / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread)
    left, groups = list(range(BITS)), []
    for k in range(parts):
        size = len(left) // (parts - k)
        group = [left.pop(0)]
        while len(group) < size:
            best = max(left, key=lambda b: (near[b, group].sum(), -b))
            left.remove(best)
            group.append(best)
        groups.append(sorted(group))
    return groups


def agree_within(p: np.ndarray, most: int) -> list[float]:
    """Chance that two fingerprints differ in at most t of some bits, t from 0 to ``most``."""
    chance = np.zeros(most + 2)
    chance[0] = 1
    for q in p:
        differ = 2 * q * (1 - q)
        chance[1:] = chance[1:] * (1 - differ) + chance[:-1] * differ
        chance[0] *= 1 - differ
    return list(np.minimum(np.cumsum(chance)[: most + 1], 1.0))


def allocate(n: int, both: np.ndarray, radius: int) -> list[tuple[list[int], int]]:
    """Groups of bits with their thresholds, at the least estimated cost.

    If two fingerprints differ in ``radius`` bits at most, then for thresholds that
    add up to ``radius - groups + 1`` some group differs within its own (a threshold
    of -1 leaves its group out).  The cost of a group is its probes plus the pairs
    expected to meet in it; a dynamic programme over the groups spends the sum.
    """
    p = np.diag(both) / max(n, 1)
    best: tuple[float, list] | None = None
    for parts in range(1, radius + 2):
        groups = group_bits(n, both, parts)
        spend = radius - parts + 1
        table: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
        for group in groups:
            chance = agree_within(p[group], radius)
            step: dict[int, tuple[float, list[int]]] = {}
            for used, (cost, chosen) in table.items():
                for t in range(-1, radius + 1):
                    ball = sum(comb(len(group), i) for i in range(t + 1))
                    if ball > 3000:
                        break
                    pairs = n * n / 2 * chance[t] * (1 + t) if t >= 0 else 0
                    total = cost + PROBE_COST * n * ball + pairs
                    if used + t not in step or total < step[used + t][0]:
                        step[used + t] = (total, [*chosen, t])
            table = step
        if spend in table and (best is None or table[spend][0] < best[0]):
            best = (table[spend][0], list(zip(groups, table[spend][1], strict=True)))
    return best[1]


def signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def probes(plan: list[tuple[list[int], int]]) -> Column:
    """For each group of bits its mask and every change of its bits within the threshold."""
    rows = []
    for k, (group, threshold) in enumerate(plan):
        mask = sum(1 << b for b in group)
        for t in range(threshold + 1):
            for changed in combinations(group, t):
                flip = sum(1 << b for b in changed)
                rows.append((k, signed(mask), signed(flip)))
    entry = "named_struct('part', {}, 'mask', {}L, 'flip', {}L)"
    smallest = -(1 << 63)
    text = ", ".join(
        entry.format(*r).replace(f"{smallest}L", f"(-{(1 << 63) - 1}L - 1L)") for r in rows
    )
    return F.expr(f"explode(array({text}))")


def linked(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Links within the groups of a partition sorted by part and key.

    Small groups are compared pair by pair, all of them at once.  A large one is
    walked: each fingerprint is compared with those not yet reached, so a group of
    near copies costs about as many links as it has members, not their square.
    """
    for table in sorted_groups(batches, ["part", "key"]):
        part, key, node = (table.column(c).to_numpy() for c in ("part", "key", "node"))
        fp = table.column("fp").to_numpy().view(np.uint64)
        starts = group_starts([part, key])
        sizes = np.diff(np.append(starts, len(fp)))
        group = np.repeat(np.arange(len(starts)), sizes)
        a, b = [], []
        small = np.repeat(sizes <= PAIRED, sizes) & np.repeat(sizes > 1, sizes)
        at = np.flatnonzero(small)
        f, g, v = fp[at], group[at], node[at]
        for d in range(1, PAIRED):
            if len(f) <= d:
                break
            meet = np.flatnonzero(g[d:] == g[:-d])
            if not len(meet):
                break
            close = meet[np.bitwise_count(f[meet] ^ f[meet + d]) <= radius]
            a.append(v[close])
            b.append(v[close + d])
        for s, n in zip(starts[sizes > PAIRED], sizes[sizes > PAIRED], strict=True):
            x, y = walked(fp[s : s + n], node[s : s + n], radius)
            a.append(x)
            b.append(y)
        if a and sum(map(len, a)):
            yield pa.RecordBatch.from_pydict({"a": np.concatenate(a), "b": np.concatenate(b)})


def walked(fp: np.ndarray, node: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links among fingerprints."""
    a, b = [], []
    left = np.arange(len(fp))
    while len(left):
        todo, left = [left[0]], left[1:]
        while todo and len(left):
            x = todo.pop()
            close = np.bitwise_count(fp[left] ^ fp[x]) <= radius
            if close.any():
                found = left[close]
                left = left[~close]
                a.append(np.full(len(found), node[x]))
                b.append(node[found])
                todo.extend(found)
    if not a:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(a), np.concatenate(b)


def close_links(fps: DataFrame, radius: int = 4, heavy: int = HEAVY) -> DataFrame:
    """Links (a, b) that join all fingerprints (node, fp) within ``radius`` bits.

    Not every close pair is listed, but two fingerprints are connected by the result
    exactly if they are by all close pairs.  A key that more than ``heavy`` of the
    fingerprints have is divided by ``radius + 1`` blocks of the other bits, of which
    close fingerprints share one.
    """
    n, both = bit_counts(fps)
    plan = [(g, t) for g, t in allocate(n, both, radius) if t >= 0]
    masks = [signed(sum(1 << b for b in g)) for g, _ in plan]
    rows = fps.select("node", "fp", probes(plan).alias("_p")).select(
        F.col("_p.part").alias("part"),
        F.col("fp").bitwiseXOR(F.col("_p.flip")).bitwiseAND(F.col("_p.mask")).alias("key"),
        "node",
        "fp",
    )
    own = F.array(*[F.struct(F.lit(k).alias("part"), F.col("fp").bitwiseAND(F.lit(m).cast("long")).alias("key")) for k, m in enumerate(masks)])
    large = staged(
        fps.select(F.explode(own).alias("_k"))
        .groupBy("_k.part", "_k.key")
        .agg(F.count("*").alias("_n"))
        .filter(F.col("_n") > heavy)
    )
    if not large.isEmpty():
        parted = rows.join(large, ["part", "key"], "left")
        rest = parted.filter("_n IS NULL").select("part", "key", "node", "fp")
        for k, (group, _) in enumerate(plan):
            others = [b for b in range(BITS) if b not in group]
            blocks = [others[i :: radius + 1] for i in range(radius + 1)]
            keys = F.array(*[
                F.xxhash64("key", F.lit(i), F.col("fp").bitwiseAND(F.lit(signed(sum(1 << b for b in block))).cast("long")))
                for i, block in enumerate(blocks)
            ])
            divided = parted.filter((F.col("part") == k) & F.col("_n").isNotNull()).select(
                F.posexplode(keys).alias("_i", "key"), "node", "fp"
            )
            rest = rest.union(
                divided.select((F.col("_i") + 100 * (k + 1)).alias("part"), "key", "node", "fp")
            )
        rows = rest
    dealt = rows.repartition("part", "key").sortWithinPartitions("part", "key")
    return dealt.mapInArrow(lambda it: linked(it, radius), "a long, b long")


def near_components(docs: DataFrame, shingle: int = 4, radius: int = 4) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every document.

    Documents whose fingerprints differ in ``radius`` bits at most are linked;
    component_id is the smallest doc_id that can be reached, itself included.

    Documents of equal fingerprint are one node from the start.  Null, empty and
    blank texts have fingerprint zero and are linked like any other.  Rows of equal
    doc_id and text are one document; a doc_id with several texts has a row for each.
    Rows without a doc_id are left out: there is no id to report.  An empty table
    gives an empty result.
    """
    prints = staged(shingle_fingerprints(docs.filter("doc_id IS NOT NULL"), shingle))
    nodes = staged(prints.groupBy("fp").agg(F.min("doc_id").alias("node")))
    # a doc_id with several texts joins their fingerprints under one node
    shared = prints.join(nodes, "fp").filter("doc_id <> node")
    twice = (
        prints.groupBy("doc_id").agg(F.count("*").alias("_n")).filter("_n > 1").select("doc_id")
    )
    extra = shared.join(twice, "doc_id").selectExpr("doc_id AS a", "node AS b")
    edges = close_links(nodes, radius).union(extra)
    found = components(staged(edges))
    placed = nodes.join(found, "node", "left").select(
        "fp", F.coalesce("component", "node").alias("component_id")
    )
    return prints.join(staged(placed), "fp").select(
        "doc_id", hex16(F.col("fp")).alias("fingerprint"), "component_id"
    )


def one_of_each(docs: DataFrame, shingle: int = 4, radius: int = 4) -> DataFrame:
    """The documents without near copies: of each component the smallest doc_id stays.

    All columns stay.  Rows without a doc_id stay, as nothing can be linked to them;
    of rows with equal doc_id all stay if that id does.
    """
    found = near_components(docs.select("doc_id", "text"), shingle, radius)
    gone = found.filter("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(staged(gone), "doc_id", "left_anti")
