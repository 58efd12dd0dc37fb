"""Near-dedup of the pipeline: operator 5 over five-word shingles, bands, exact similarity.

Documents are linked whose sets of shingles are similar.  Operator 5 proposes all whose
fingerprints differ in few bits; MinHash bands propose the rest, as 64-bit fingerprints of
similar sets often differ in more.  Proposals only say who is compared with whom.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import BASE, WordHashes, by_batch, group_starts, mixed, rolling, sorted_groups
from larder.llm.links import components
from larder.llm.near import close_links, shingle_fingerprints
from larder.sources.workspace import staged

SHINGLE = 5
SIMILAR = 0.8
ROWS = 8  # lanes of a band
BANDS = 56  # a pair of similarity 0.8 has no band in common once in 30,000 times
LANES = ROWS * BANDS
FACTORS = mixed(np.arange(1, LANES + 1, dtype=np.uint64)) | np.uint64(1)
SHIFTS = mixed(np.arange(LANES + 1, 2 * LANES + 1, dtype=np.uint64))
AT_ONCE = 1 << 17  # lanes times shingles


def shingle_set(text: bytes, hashes: WordHashes, shingle: int) -> np.ndarray:
    """Sorted hashes of the distinct shingles (A-Z lower-cased); zero alone without words."""
    words = text.lower().split()
    if not words:
        return np.zeros(1, np.uint64)
    return np.unique(rolling(hashes.of(words), min(shingle, len(words))))


def set_id(x: np.ndarray) -> int:
    value = xxhash.xxh64_intdigest(x.tobytes())
    return value - (1 << 64) if value >= 1 << 63 else value


def bands(x: np.ndarray) -> np.ndarray:
    """One hash for each band of the smallest images of a set."""
    least = np.empty(LANES, np.uint64)
    step = max(1, AT_ONCE // len(x))
    for at in range(0, LANES, step):
        end = min(at + step, LANES)
        least[at:end] = (FACTORS[at:end, None] * x + SHIFTS[at:end, None]).min(1)
    out = np.arange(1, BANDS + 1, dtype=np.uint64)
    for lane in least.reshape(BANDS, ROWS).T:
        out = out * BASE + mixed(lane)
    return mixed(out)


def texts_of(batch: pa.RecordBatch) -> list[bytes]:
    return pc.cast(pc.fill_null(batch.column("text"), ""), pa.large_binary()).to_pylist()


def fingerprint_links(named: DataFrame, shingle: int = SHINGLE, radius: int = 4) -> DataFrame:
    """Operator 5 over sets: links (a, b) that join all sets within ``radius`` bits."""

    def with_sid(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            sid = [set_id(shingle_set(t, hashes, shingle)) for t in texts_of(batch)]
            yield pa.RecordBatch.from_arrays([pa.array(sid, pa.int64()), batch.column("text")], ["doc_id", "text"])

    sets = named.mapInArrow(with_sid, "doc_id long, text string")
    prints = staged(shingle_fingerprints(sets, shingle).withColumnRenamed("doc_id", "sid").distinct())
    nodes = staged(prints.groupBy("fp").agg(F.min("sid").alias("node")))
    equal = prints.join(nodes, "fp").filter("sid <> node").selectExpr("sid AS a", "node AS b")
    return equal.union(close_links(nodes, radius))


def linked(batches: Iterator[pa.RecordBatch], similar: float) -> Iterator[pa.RecordBatch]:
    """A spanning forest of the links within each group of a partition sorted by group."""
    for table in sorted_groups(batches, ["component"]):
        starts = group_starts([table.column("component").to_numpy()])
        sid = table.column("sid").to_numpy()
        sets = table.column("shingles")
        for s, e in zip(starts, np.append(starts[1:], len(sid)), strict=True):
            group = [np.frombuffer(x.as_buffer(), np.uint64) for x in sets[s:e]]
            a, b = walked(group, similar)
            if len(a):
                yield pa.RecordBatch.from_pydict({"a": sid[s + a], "b": sid[s + b]})


def ranges(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of several runs, one after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(first - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


def walked(sets: list[np.ndarray], similar: float) -> tuple[np.ndarray, np.ndarray]:
    """Links (places of both sets) that connect what all similar pairs connect.

    Each set that is reached is compared with those not yet reached that may be similar:
    two similar sets share at least ``similar`` of either one, so they share one of the
    rarest others of both.  A group of near copies costs about as many comparisons as it
    has members, and sets that only share what many have are not compared at all.
    """
    sizes = np.array([len(x) for x in sets])
    first = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, number, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.empty(len(often), np.int64)
    rank[np.argsort(often, kind="stable")] = np.arange(len(often))
    flat = rank[number]
    flat = flat[np.lexsort((flat, owner))]  # each set from its rarest shingle on
    rare = sizes - np.ceil(similar * sizes - 1e-9).astype(np.int64) + 1
    at = ranges(first, rare)
    at = at[np.argsort(flat[at], kind="stable")]
    holders = owner[at]
    bounds = np.searchsorted(flat[at], np.arange(len(often) + 1))
    shared_with = np.zeros(len(often), bool)
    waiting = np.ones(len(sets), bool)
    a, b = [], []
    for start in range(len(sets)):
        todo = [start] if waiting[start] else []
        waiting[start] = False
        while todo:
            x = todo.pop()
            own = flat[first[x] : first[x] + sizes[x]]
            keys = own[: rare[x]]
            near = np.unique(holders[ranges(bounds[keys], bounds[keys + 1] - bounds[keys])])
            near = near[waiting[near]]
            if not len(near):
                continue
            shared_with[own] = True
            ends = np.cumsum(sizes[near])
            shared = np.add.reduceat(shared_with[flat[ranges(first[near], sizes[near])]].astype(np.int64), ends - sizes[near])
            shared_with[own] = False
            found = near[shared / (sizes[near] + len(own) - shared) >= similar - 1e-12]
            waiting[found] = False
            a += [x] * len(found)
            b += found.tolist()
            todo += found.tolist()
    return np.array(a, np.int64), np.array(b, np.int64)


def similar_components(docs: DataFrame, shingle: int = SHINGLE, similar: float = SIMILAR) -> DataFrame:
    """doc_id and component_id of every document.

    Documents are linked if their distinct shingles (``shingle`` words, A-Z
    lower-cased; all words where there are fewer) have a Jaccard similarity of
    ``similar`` at least; component_id is the smallest doc_id that can be reached,
    itself included.

    Documents of equal sets are one node from the start.  Nodes that operator 5 links or that
    have a common band are put in one group, and within groups links are decided by whole
    sets of 64-bit shingle hashes, which only members of a group send.

    Null, empty and blank texts are copies of each other.  A doc_id with several texts
    joins what they are linked to.  Rows without a doc_id are left out.  An empty
    table gives an empty result.
    """
    named = docs.filter("doc_id IS NOT NULL").select("doc_id", "text")

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            sets = [shingle_set(t, hashes, shingle) for t in texts_of(batch)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([set_id(x) for x in sets], pa.int64()),
                    pa.array([bands(x).tobytes() for x in sets], pa.binary()),
                ],
                ["doc_id", "sid", "bands"],
            )

    def keys(batch: pa.RecordBatch) -> pa.RecordBatch:
        every = np.frombuffer(b"".join(batch.column("bands").to_pylist()), np.int64)
        sid = np.repeat(batch.column("sid").to_numpy(), BANDS)
        return pa.RecordBatch.from_pydict({"sid": sid, "key": every})

    rows = staged(named.mapInArrow(sketch, "doc_id long, sid long, bands binary"))
    prints = rows.select("doc_id", "sid").distinct()
    nodes = staged(prints.groupBy("sid").agg(F.min("doc_id").alias("node")))
    once = nodes.join(rows, (rows["doc_id"] == nodes["node"]) & (rows["sid"] == nodes["sid"])).select(
        nodes["sid"], "bands"
    )
    proposed = by_batch(once, keys, "sid long, key long")
    # a band that only one set has proposes nothing
    lowest = staged(
        proposed.groupBy("key").agg(F.min("sid").alias("low"), F.max("sid").alias("high")).filter("low < high")
    )
    pairs = proposed.join(lowest.select("key", "low"), "key").filter("sid <> low")
    proposals = pairs.selectExpr("sid AS a", "low AS b").union(fingerprint_links(named, shingle))
    groups = staged(components(staged(proposals.distinct())))
    members = groups.withColumnRenamed("node", "sid").join(nodes, "sid")

    def sets_of(batch: pa.RecordBatch) -> pa.RecordBatch:
        hashes = WordHashes()
        sets = [shingle_set(t, hashes, shingle) for t in texts_of(batch)]
        return pa.RecordBatch.from_arrays(
            [pa.array([set_id(x) for x in sets], pa.int64()), pa.array([x.tobytes() for x in sets], pa.binary())],
            ["sid", "shingles"],
        )

    chosen = named.join(members.select(F.col("node").alias("doc_id")).distinct(), "doc_id", "left_semi").distinct()
    sets = by_batch(chosen, sets_of, "sid long, shingles binary").join(groups.withColumnRenamed("node", "sid"), "sid")
    dealt = sets.repartition("component").sortWithinPartitions("component")
    links = staged(dealt.mapInArrow(lambda it: linked(it, similar), "a long, b long"))
    first, second = nodes.toDF("a", "_a"), nodes.toDF("b", "_b")
    joined = links.join(first, "a").join(second, "b").selectExpr("_a AS a", "_b AS b")
    # a doc_id with several texts joins their nodes
    twice = prints.groupBy("doc_id").agg(F.count("*").alias("_n")).filter("_n > 1").select("doc_id")
    extra = (
        prints.join(twice, "doc_id").join(nodes, "sid").filter("doc_id <> node").selectExpr("doc_id AS a", "node AS b")
    )
    found = components(staged(joined.union(extra)))
    placed = nodes.join(found, "node", "left").select("sid", F.coalesce("component", "node").alias("component_id"))
    return prints.join(staged(placed), "sid").select("doc_id", "component_id").distinct()


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, similar: float = SIMILAR) -> DataFrame:
    """The documents without near copies: of each component the smallest doc_id stays.

    All columns stay.  Rows without a doc_id stay, as nothing can be linked to them;
    of rows with equal doc_id all stay if that id does.
    """
    found = similar_components(docs, shingle, similar)
    gone = found.filter("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(staged(gone), "doc_id", "left_anti")
