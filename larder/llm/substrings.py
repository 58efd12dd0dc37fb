"""Operator 2, substring dedup: sparse suffix trees under variable-length prefixes.

A window is 50 words.  Suffixes are taken where the hash of 8 words is smallest among
all places of a window (its anchor), so equal windows have their anchor at the same
offset, and only one suffix in about twenty words travels.  The 8 words are the first
prefix: suffixes that share them meet in one subtree, and a prefix that only one
document has is dropped at once.  In a subtree, suffixes are sorted and cut where
neighbours share too little; two suffixes under a node of depth d that also agree in
the o words ahead of the anchor share the window that starts there if o + d >= 50.
A prefix with too many different suffixes for one task is lengthened to the whole
window, whose smallest doc_id is a plain grouped minimum.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import (
    BASE,
    WordHashes,
    by_batch,
    group_starts,
    mixed,
    rolling,
    sorted_groups,
)
from larder.sources.workspace import staged

WINDOW = 50
PREFIX = 8
SUBTREE = 1_000  # different suffixes that one subtree may hold

INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


class Powers:
    """Powers of a hash base, as many as the longest text has needed."""

    def __init__(self, base: np.uint64) -> None:
        self.base, self.values = base, np.ones(1, np.uint64)

    def upto(self, n: int) -> np.ndarray:
        while len(self.values) < n:
            with np.errstate(over="ignore"):
                step = self.values[-1] * self.base
            self.values = np.concatenate([self.values, self.values * step])
        return self.values[:n]


_hashes, _up, _down = WordHashes(), Powers(BASE), Powers(INVERSE)


class Runs:
    """The anchors of a text and the run of windows that belongs to each."""

    def __init__(self, h: np.ndarray) -> None:
        n = len(h)
        self.h = h
        places = WINDOW - PREFIX + 1
        grams = rolling(h, PREFIX)
        at = np.arange(len(grams))
        width = 1
        while width < places:  # leftmost smallest place of ever wider ranges
            step = min(width, places - width)
            a, b = at[:-step], at[step:]
            at = np.where(grams[a] <= grams[b], a, b)
            width += step
        starts = group_starts([at])
        self.first = starts  # first window of each run
        self.count = np.diff(np.append(starts, n - WINDOW + 1))
        self.anchor = at[starts]
        self.key = grams[self.anchor]
        with np.errstate(over="ignore"):
            self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * _up.upto(n))])
            self.span = mixed(
                self.stretch(starts, self.count + WINDOW - 1)
                ^ mixed((self.anchor - starts).astype(np.uint64) * np.uint64(64) + self.count.astype(np.uint64))
            )

    def stretch(self, start: np.ndarray, size: np.ndarray | int) -> np.ndarray:
        """Hash of ``size`` words from each start."""
        return (self.sums[start + size] - self.sums[start]) * _down.upto(len(self.h))[start]


def word_lists(column: pa.Array) -> Iterator[list[bytes]]:
    for text in pc.cast(pc.fill_null(column, ""), pa.large_binary()).to_pylist():
        yield text.split()


def anchored(docs: DataFrame) -> DataFrame:
    """A row for each anchor: key (its 8 words), span (all words of its windows), place."""

    def find(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: dict[str, list[np.ndarray]] = defaultdict(list)
        for doc, words in zip(batch.column("doc_id").to_numpy(), word_lists(batch.column("text")), strict=True):
            if len(words) < WINDOW:
                continue
            runs = Runs(_hashes.of(words))
            out["doc_id"].append(np.full(len(runs.first), doc))
            out["start"].append(runs.first.astype(np.int32))
            out["size"].append(runs.count.astype(np.int32))
            out["key"].append(runs.key.view(np.int64))
            out["span"].append(runs.span.view(np.int64))
        if not out:
            return None
        return pa.RecordBatch.from_pydict({k: np.concatenate(v) for k, v in out.items()})

    return by_batch(docs, find, "doc_id long, start int, size int, key long, span long")


def spans_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Word hashes around the wanted anchors, read from the documents that hold them.

    ``wanted``: key, span, first (a document with that span), start, size, heavy.
    """
    asked = wanted.groupBy(F.col("first").alias("_id")).agg(
        F.collect_list(F.struct("key", "span", "start", "size", "heavy")).alias("asked")
    )

    def look(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: dict[str, list] = defaultdict(list)
        rows = zip(batch.column("doc_id").to_pylist(), word_lists(batch.column("text")), batch.column("asked").to_pylist(), strict=True)
        for doc, words, wants in rows:
            runs = Runs(_hashes.of(words)) if len(words) >= WINDOW else None
            for w in wants if runs else ():
                k = int(np.searchsorted(runs.first, w["start"]))
                # a doc_id may have several texts: take the one that has this span
                if k >= len(runs.first) or int(runs.span[k : k + 1].view(np.int64)[0]) != w["span"]:
                    continue
                out["key"].append(w["key"])
                out["span"].append(w["span"])
                out["first"].append(doc)
                out["size"].append(w["size"])
                out["lead"].append(int(runs.anchor[k]) - w["start"])
                out["heavy"].append(w["heavy"])
                a, n = w["start"], w["size"]
                if w["heavy"]:
                    values = mixed(runs.stretch(np.arange(a, a + n), WINDOW))
                else:
                    values = runs.h[a : a + n + WINDOW - 1]
                out["words"].append(values.tobytes())
        if not out:
            return None
        types = {"key": pa.int64(), "span": pa.int64(), "first": pa.int64(), "size": pa.int32(), "lead": pa.int32(), "heavy": pa.bool_(), "words": pa.binary()}
        return pa.RecordBatch.from_arrays([pa.array(out[k], t) for k, t in types.items()], list(types))

    joined = docs.join(asked, docs["doc_id"] == asked["_id"]).select("doc_id", "text", "asked")
    return by_batch(
        joined,
        look,
        "key long, span long, first long, size int, lead int, heavy boolean, words binary",
    )


def subtree(rows: list[tuple[np.ndarray, int, int, int]]) -> list[np.ndarray]:
    """Smallest document of every window of the suffixes under one prefix.

    ``rows``: word hashes of a span, words ahead of the anchor, windows, document.
    """
    firsts = [np.full(size, doc) for _, _, size, doc in rows]
    if len(rows) <= 6:
        for x in range(len(rows)):
            for y in range(x + 1, len(rows)):
                (hx, lx, nx, dx), (hy, ly, ny, dy) = rows[x], rows[y]
                right = common(hx[lx:], hy[ly:])
                left = common(hx[:lx][::-1], hy[:ly][::-1])
                # windows start o words ahead of the anchor
                far, near = min(left, lx, ly), max(WINDOW - right, lx - nx + 1, ly - ny + 1, 0)
                if near <= far:
                    low = min(dx, dy)
                    for f, lead in ((firsts[x], lx), (firsts[y], ly)):
                        part = f[lead - far : lead - near + 1]
                        np.minimum(part, low, out=part)
        return firsts
    depth = WINDOW
    right = np.zeros((len(rows), depth), np.uint64)
    left = np.zeros((len(rows), WINDOW - PREFIX + 1), np.uint64)
    for r, (h, lead, _, _) in enumerate(rows):
        tail = h[lead : lead + depth]
        right[r, : len(tail)] = tail
        left[r, 1 : lead + 1] = mixed(np.cumsum(h[:lead][::-1] * _up.upto(lead)))
    order = np.lexsort(right.T[::-1])
    same = right[order][1:] == right[order][:-1]
    shared = np.where(same.all(1), depth, same.argmin(1))  # with the suffix before
    leads = np.array([r[1] for r in rows])[order]
    sizes = np.array([r[2] for r in rows])[order]
    docs = np.array([r[3] for r in rows])[order]
    for o in range(WINDOW - PREFIX + 1):
        node = np.concatenate([[0], np.cumsum(shared < WINDOW - o)])  # nodes this deep
        has = np.flatnonzero((leads >= o) & (leads - o < sizes))
        if len(has) < 2:
            continue
        ahead = left[order[has], o]
        _, group = np.unique(np.stack([node[has].astype(np.uint64), ahead]), axis=1, return_inverse=True)
        low = np.full(group.max() + 1, np.iinfo(np.int64).max)
        np.minimum.at(low, group.ravel(), docs[has])
        for r, d in zip(has, low[group.ravel()], strict=True):
            firsts[order[r]][leads[r] - o] = d
    return firsts


def common(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the common beginning."""
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    return int(differ[0]) if len(differ) else n


def trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``firsts`` for each span of a partition sorted by key."""
    for table in sorted_groups(batches, ["key"]):
        key = table.column("key").to_numpy()
        span = table.column("span").to_numpy()
        words = table.column("words").to_pylist()
        lead, size, doc = (table.column(c).to_pylist() for c in ("lead", "size", "first"))
        edges = np.append(group_starts([key]), len(key))
        firsts: list[np.ndarray] = []
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            firsts += subtree(
                [(np.frombuffer(words[r], np.uint64), lead[r], size[r], doc[r]) for r in range(a, b)]
            )
        offsets = np.concatenate([[0], np.cumsum([len(f) for f in firsts])]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(firsts)))
        yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(span), lists], ["key", "span", "firsts"])


def window_owners(docs: DataFrame, anchors: DataFrame, subtree_limit: int) -> DataFrame:
    """(key, span, firsts): the smallest doc_id of every window of spans that repeat."""
    spans = staged(
        anchors.groupBy("key", "span").agg(
            F.min(F.struct("doc_id", "start", "size")).alias("_m"), F.max("doc_id").alias("last")
        ).select("key", "span", "_m.*", "last")
        .withColumnRenamed("doc_id", "first")
    )
    keys = (
        spans.groupBy("key")
        .agg(F.count("*").alias("n"), F.min("first").alias("_a"), F.max("last").alias("_b"))
        .filter("_a < _b")
        .select("key", "n")
    )
    repeated = staged(spans.join(keys, "key").drop("last"))
    alone = repeated.filter("n = 1").select(
        "key", "span", F.array_repeat("first", F.col("size")).alias("firsts")
    )
    wanted = repeated.filter("n > 1").withColumn("heavy", F.col("n") > subtree_limit)
    read = staged(spans_of(docs, wanted))  # texts travel once for both ways
    light = (
        read.filter("NOT heavy")
        .repartition("key")
        .sortWithinPartitions("key")
        .mapInArrow(trees, "key long, span long, firsts array<long>")
    )
    if wanted.filter("heavy").isEmpty():
        return alone.union(light)
    each = read.filter("heavy").select(
        "key",
        "span",
        "first",
        F.explode(F.sequence(F.lit(0), F.col("size") - 1)).alias("_i"),
        "lead",
        "words",
    ).select(
        "key",
        "span",
        "first",
        "_i",
        (F.col("lead") - F.col("_i")).alias("_o"),
        F.substring("words", F.col("_i") * 8 + 1, F.lit(8)).alias("_window"),
    )
    each = staged(each)
    lows = each.groupBy("key", "_o", "_window").agg(F.min("first").alias("low"))
    divided = (
        each.join(lows, ["key", "_o", "_window"])
        .groupBy("key", "span")
        .agg(F.array_sort(F.collect_list(F.struct("_i", "low"))).alias("_l"))
        .select("key", "span", F.col("_l.low").alias("firsts"))
    )
    return alone.union(light).union(divided)


def remove_repeats(docs: DataFrame, subtree_limit: int = SUBTREE) -> DataFrame:
    """Every text without the words of windows that a document of smaller id also has.

    Returns doc_id, n_words, n_removed, kept_sha256 and kept (the words that stay,
    joined by one space).  Words are runs of anything but space and the control
    characters 9 to 13, unchanged; a window is 50 words in a row of one document and
    is judged on the input.  The smallest doc_id that has a window keeps it, also
    where it has it twice.

    Null, empty and blank texts have no words and keep the empty text; texts of fewer
    than 50 words keep all.  Rows that repeat a doc_id count as the same document and
    each has its own row.  Rows without a doc_id keep all words.  An empty table gives
    an empty result.
    """
    texts = docs.select("doc_id", "text")
    anchors = staged(anchored(texts.filter("doc_id IS NOT NULL")))
    owners = window_owners(texts, anchors, subtree_limit)
    cuts = (
        anchors.join(owners, ["key", "span"])
        .filter("doc_id > array_min(firsts)")
        .groupBy(F.col("doc_id").alias("_id"))
        .agg(F.collect_list(F.struct("start", "span", "firsts")).alias("cuts"))
    )

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: dict[str, list] = defaultdict(list)
        ids, found = batch.column("doc_id").to_pylist(), batch.column("cuts")
        for r, (doc, words) in enumerate(zip(ids, word_lists(batch.column("text")), strict=True)):
            n = len(words)
            some = found[r].as_py() if found[r].is_valid else None
            removed = 0
            if some and n >= WINDOW:
                edge = np.zeros(n + 1, np.int64)
                runs = Runs(_hashes.of(words))
                own = dict(zip(runs.first.tolist(), runs.span.view(np.int64).tolist(), strict=True))
                for c in some:
                    if own.get(c["start"]) != c["span"]:
                        continue  # of another text with this doc_id
                    at = c["start"] + np.flatnonzero(np.array(c["firsts"]) < doc)
                    np.add.at(edge, at, 1)
                    np.add.at(edge, at + WINDOW, -1)
                gone = np.cumsum(edge[:-1]) > 0
                removed = int(gone.sum())
                if removed:
                    words = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
            kept = b" ".join(words)
            out["doc_id"].append(doc)
            out["n_words"].append(n)
            out["n_removed"].append(removed)
            out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
            out["kept"].append(kept.decode())
        types = {"doc_id": pa.int64(), "n_words": pa.int64(), "n_removed": pa.int64(), "kept_sha256": pa.string(), "kept": pa.string()}
        return pa.RecordBatch.from_arrays([pa.array(out[k], t) for k, t in types.items()], list(types))

    joined = texts.join(cuts, texts["doc_id"] == cuts["_id"], "left").select("doc_id", "text", "cuts")
    return by_batch(
        joined, cut, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string"
    )
