"""Operator 3, benchmark decontamination: MinHash containment by item size."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import WordHashes, by_batch, rolling

SHINGLE = 5
CONTAINED = 0.8
BLOCK_BYTES = 24 << 20  # benchmark text that one pass over the documents carries


def lower_words(text: bytes) -> list[bytes]:
    return text.lower().split()  # bytes: only A-Z change, only ASCII white space divides


def shingles(words: list[bytes], width: int) -> set[bytes]:
    return {b" ".join(words[i : i + width]) for i in range(len(words) - width + 1)}


def missing(n: int, contained: float) -> int:
    """How many of ``n`` shingles a text may lack and still contain the item."""
    return max(k for k in range(n + 1) if (n - k) / n >= contained - 1e-12)


class Sketches:
    """MinHash sketches of benchmark items, in partitions by size.

    An item of n distinct shingles is contained in a text if at most m of them are
    missing.  Its sketch is the m + 1 shingles with the smallest hashes: a text that
    contains the item has at least one of these, whatever the text's own length, so
    the search finds every item.  Items of few words have shingles as long as they are.
    """

    def __init__(self, items: list[tuple[int, bytes]], shingle: int, contained: float) -> None:
        hashes = WordHashes()
        self.items: list[tuple[int, set[bytes], int, int]] = []
        by_size: dict[tuple[int, int], list[tuple[int, int]]] = defaultdict(list)
        for item, text in items:
            words = lower_words(text)
            if not words:
                continue
            width = min(shingle, len(words))
            every = shingles(words, width)
            keep = missing(len(every), contained) + 1
            all_hashes = np.unique(rolling(hashes.of(words), width))
            at = len(self.items)
            self.items.append((item, every, width, len(every) - keep + 1))
            by_size[width, len(every).bit_length()] += [(int(h), at) for h in all_hashes[:keep]]
        self.parts = []
        for (width, _), pairs in sorted(by_size.items()):
            pairs.sort()
            found = np.array([h for h, _ in pairs], np.uint64)
            self.parts.append((width, found, np.array([i for _, i in pairs])))
        self.widths = sorted({w for w, _, _ in self.parts})
        # a coarse first look: the low bits of all sketch hashes of a width
        self.seen = {}
        for w in self.widths:
            bits = np.zeros(1 << 22, bool)
            for width, found, _ in self.parts:
                if width == w:
                    bits[found & np.uint64((1 << 22) - 1)] = True
            self.seen[w] = bits

    def within(self, words: list[bytes], hashed: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(item, shared shingles, all shingles) of the items that a text contains."""
        for w in self.widths:
            rolled = rolling(hashed, w)
            hits = rolled[self.seen[w][rolled & np.uint64((1 << 22) - 1)]]
            if not len(hits):
                continue
            hits = np.unique(hits)
            candidates: set[int] = set()
            for width, found, owner in self.parts:
                if width == w:
                    a, b = (np.searchsorted(found, hits, side) for side in ("left", "right"))
                    for x, y in zip(a[b > a], b[b > a], strict=True):
                        candidates.update(owner[x:y].tolist())
            if not candidates:
                continue
            own = shingles(words, w)
            for c in sorted(candidates):
                item, every, _, least = self.items[c]
                shared = len(every & own)
                if shared >= least:
                    yield item, shared, len(every)


def contained_items(
    docs: DataFrame,
    benchmark: DataFrame,
    shingle: int = SHINGLE,
    contained: float = CONTAINED,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """doc_id, item_id, n_shared, n_item, containment of all contained benchmark items.

    A document contains an item if at least ``contained`` of the item's distinct
    shingles of ``shingle`` words (A-Z lower-cased) are among its own.  The benchmark
    is the query set: it is sent to the tasks in blocks of at most ``block_bytes`` of
    text, each of which searches all documents in one pass without a shuffle.
    Candidates by sketch are verified by their shingles' texts.

    Null, empty and blank texts contain nothing and are contained in nothing.  Items
    shorter than a shingle are looked for as a run of their words.  Rows that repeat
    give a row each for documents; items that share an item_id are items of their own.
    Rows without a doc_id are reported with a null.  Empty tables give empty results.
    """
    return _found(docs.select("doc_id", "text"), benchmark, shingle, contained, block_bytes).select(
        "doc_id", "item_id", "n_shared", "n_item", (F.col("n_shared") / F.col("n_item")).alias("containment")
    )


def _found(docs, benchmark, shingle, contained, block_bytes) -> DataFrame:
    schema = "doc_id long, item_id long, n_shared long, n_item long"
    out = None
    for block in blocks(benchmark, block_bytes):
        sent = docs.sparkSession.sparkContext.broadcast(block)  # block_bytes at most

        def search(batch: pa.RecordBatch, sent=sent, name=uuid4().hex) -> pa.RecordBatch:
            index, hashes = _index(name, sent, shingle, contained)
            rows: list[tuple] = []
            texts = pc.cast(pc.fill_null(batch.column("text"), ""), pa.large_binary())
            for doc, text in zip(batch.column("doc_id").to_pylist(), texts.to_pylist(), strict=True):
                words = lower_words(text)
                rows += [(doc, *r) for r in index.within(words, hashes.of(words))]
            columns = list(zip(*rows, strict=True)) if rows else [[], [], [], []]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], ["doc_id", "item_id", "n_shared", "n_item"]
            )

        found = by_batch(docs, search, schema)
        out = found if out is None else out.union(found)
    return out if out is not None else docs.sparkSession.createDataFrame([], schema)


_indexes: dict[tuple, tuple[Sketches, WordHashes]] = {}


def _index(name: str, sent, shingle: int, contained: float) -> tuple[Sketches, WordHashes]:
    """The sketches of the block of this name, built once in each Python worker."""
    key = (name, shingle, contained)
    if key not in _indexes:
        _indexes.clear()
        _indexes[key] = (Sketches(sent.value, shingle, contained), WordHashes())
    return _indexes[key]


def blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[list[tuple[int, bytes]]]:
    """The benchmark in blocks of bounded bytes, read one after another."""
    rows = benchmark.select("item_id", "text").filter("text IS NOT NULL").toLocalIterator()
    block: list[tuple[int, bytes]] = []
    size = 0
    for item, text in rows:
        data = text.encode()
        if block and size + len(data) > block_bytes:
            yield block
            block, size = [], 0
        block.append((item, data))
        size += len(data)
    if block:
        yield block


def without_benchmark(
    docs: DataFrame,
    benchmark: DataFrame,
    shingle: int = SHINGLE,
    contained: float = CONTAINED,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The documents that contain no benchmark item.

    Each row is judged by its own text, whatever its doc_id: rows without one, or with
    one that a contaminated row has too, stay if they contain no item.  All columns
    stay.  Blocks of items filter the rows one after another, without a shuffle.
    """
    for block in blocks(benchmark, block_bytes):
        sent = docs.sparkSession.sparkContext.broadcast(block)  # block_bytes at most

        def clean(batch: pa.RecordBatch, sent=sent, name=uuid4().hex) -> pa.RecordBatch:
            index, hashes = _index(name, sent, shingle, contained)
            keep = []
            for text in pc.cast(pc.fill_null(batch.column("text"), ""), pa.large_binary()).to_pylist():
                words = lower_words(text)
                keep.append(next(index.within(words, hashes.of(words)), None) is None)
            return batch.filter(pa.array(keep, pa.bool_()))

        docs = by_batch(docs, clean, docs.schema)
    return docs
