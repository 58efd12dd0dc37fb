"""Operator 10, best-fit packing: token sequences filled by swaps between bins."""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import by_batch, group_starts, sorted_groups
from larder.sources.workspace import staged

CAPACITY = 4096
SIGNS = bytes(set(range(33, 127)) - set(b"0123456789") - set(range(65, 91)) - set(range(97, 123)))
PLAIN = "\u0180"  # letters before this one have one simple lower case
END = 1  # id after each document
GROUP = 8192  # pieces that one packing task works on, on average


class WordIds(dict):
    """Token ids of words, as little-endian 32-bit integers; bounded by starting over.

    The vocabulary works on runs of letters, digits and other signs in lower case.
    Many rare words are one known word with signs behind it, so the ids of a new word
    are put together from those of its stem and its last signs.
    """

    LIMIT = 500_000

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # words hold none of their strings
        self.unaltered = Tokenizer.from_file(path)
        self.special = [t.content.encode() for t in self.unaltered.get_added_tokens_decoder().values()]
        self.run = self.tokenizer.model.tokenize
        self.parts: dict[bytes, bytes] = {}
        # the vocabulary writes a byte that prints as itself, the others in order from 256
        printed = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in printed]
        signs = {b: chr(b) for b in printed} | {b: chr(256 + i) for i, b in enumerate(others)}
        self.sign = [signs[b] for b in range(256)]

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= self.LIMIT:
            self.clear()
        stem = word.rstrip(SIGNS)
        if stem and len(stem) < len(word) and stem.decode()[-1].isalpha():
            ids = self.part(stem) + self.part(word[len(stem) :])
        else:
            ids = self.part(word)
        self[word] = ids
        return ids

    def of(self, text: bytes) -> bytes:
        """Ids of a whole text; one that holds a special token's string goes to the tokenizer whole."""
        lowered = text.lower()
        if any(s in lowered for s in self.special):
            ids = self.unaltered.encode(text.decode(), add_special_tokens=False).ids
            return np.array(ids, "<u4").tobytes()
        return b"".join(map(self.__getitem__, lowered.split()))

    def part(self, word: bytes) -> bytes:
        ids = self.parts.get(word)
        if ids is None:
            if len(self.parts) >= self.LIMIT:
                self.parts.clear()
            text = word.decode().lower()
            if text.isalpha() and max(text) < PLAIN and is_normalized("NFC", text):
                coded = [t.id for t in self.run("".join([self.sign[b] for b in text.encode()]))]
            else:
                coded = self.tokenizer.encode(word.decode(), add_special_tokens=False).ids
            self.parts[word] = ids = np.array(coded, "<u4").tobytes()
        return ids


# One per Python worker: learning words is most of the work.
_ids: dict[str, WordIds] = {}


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length and ids_crc32 of the pieces of all documents.

    ``tokenizer``: file of a vocabulary that works word by word and drops white
    space, so ids of a text are those of its words one after another; it also writes
    all in lower case.  Texts that hold the string of one of its special tokens are
    given to it whole.
    """

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        known = _ids.get(tokenizer) or _ids.setdefault(tokenizer, WordIds(tokenizer))
        texts = pc.cast(pc.fill_null(batch.column("text"), ""), pa.large_binary())
        out: dict[str, list] = defaultdict(list)
        end = END.to_bytes(4, "little")
        for doc, text in zip(batch.column("doc_id").to_pylist(), texts.to_pylist(), strict=True):
            ids = known.of(text) + end
            for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                part = ids[at : at + 4 * capacity]
                out["doc_id"].append(doc)
                out["piece"].append(k)
                out["start"].append(at // 4)
                out["length"].append(len(part) // 4)
                out["ids_crc32"].append(zlib.crc32(part))
        types = {"doc_id": pa.int64(), "piece": pa.int32(), "start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64()}
        return pa.RecordBatch.from_arrays(
            [pa.array(out[k], t) for k, t in types.items()], list(types)
        )

    return by_batch(
        docs.select("doc_id", "text"),
        cut,
        "doc_id long, piece int, start long, length long, ids_crc32 long",
    )


def best_fit(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """The bin of each item: longest first, each into the fullest bin that has room for it."""
    bins = np.zeros(len(lengths), np.int64)
    open_bins: list[tuple[int, int]] = []  # (room, bin), sorted
    used = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[i])
        at = bisect_left(open_bins, (need, -1))
        if at < len(open_bins):
            room, b = open_bins.pop(at)
        else:
            room, b = capacity, used
            used += 1
        bins[i] = b
        if room > need:
            insort(open_bins, (room - need, b))
    return bins


def offers(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What a bin can give, by total length: one item or two, as places (-1: no second).

    Items of equal length are alike, so a bin has few different offers however many
    items it holds: the lengths of k different items add up to over k * k / 2.
    """
    sizes, first, n = np.unique(lengths, return_index=True, return_counts=True)
    a, b = np.triu_indices(len(sizes))
    twin = np.append(np.argsort(lengths, kind="stable"), -1)[np.cumsum(n) - 1]
    keep = (a != b) | (n[a] > 1)
    a, b = a[keep], b[keep]
    total = np.append(sizes, sizes[a] + sizes[b])
    one = np.append(first, first[a])
    two = np.append(np.full(len(sizes), -1), np.where(a == b, twin[b], first[b]))
    total, at = np.unique(total, return_index=True)  # one item before two
    return total, one[at], two[at]


def improved(lengths: np.ndarray, bins: np.ndarray, capacity: int) -> np.ndarray:
    """The bins after exchanges that raise the sum of squared fills, as long as any does.

    The emptiest bin gives first: one or two of its items go to another underfull bin,
    for one item of that bin or for none.  All its items, and all items of all
    underfull bins, are looked at, and of the exchanges that fit, the one that raises
    the sum most is made.  Bins become empty on the way.  The search ends when there
    are no more bins than the items need, or when no bin has an exchange left.
    """
    bins = bins.copy()
    fill = np.bincount(bins, lengths).astype(np.int64)
    least = -(-int(lengths.sum()) // capacity)
    changed = True
    while changed:
        changed = False
        for giver in np.argsort(fill, kind="stable").tolist():
            while 0 < fill[giver] < capacity:
                if np.count_nonzero(fill) <= least:
                    return bins
                mine = np.flatnonzero(bins == giver)
                total, one, two = offers(lengths[mine])
                taken = np.flatnonzero(fill[bins] < capacity)  # for an item of these, or for none
                taken = taken[bins[taken] != giver]
                others = np.flatnonzero((fill > 0) & (fill < capacity))
                others = others[others != giver]
                back = np.append(lengths[taken], np.zeros(len(others), np.int64))
                taker = np.append(bins[taken], others)
                at = np.searchsorted(total, back + capacity - fill[taker], "right") - 1
                gain = np.where(at >= 0, total[at] - back, 0)
                raised = np.where(gain > 0, gain * (fill[taker] - fill[giver] + gain), 0)
                if raised.max(initial=0) <= 0:
                    break
                best = int(raised.argmax())
                to, offer = taker[best], at[best]
                bins[mine[one[offer]]] = to
                if two[offer] >= 0:
                    bins[mine[two[offer]]] = to
                if best < len(taken):
                    bins[taken[best]] = giver
                fill[to] += gain[best]
                fill[giver] -= gain[best]
                changed = True
    return bins


def pack_lengths(lengths: list[int], capacity: int = CAPACITY, swaps: bool = True) -> list[int]:
    """The bin of each item: best fit decreasing, then exchanges."""
    sizes = np.array(lengths, np.int64)
    bins = best_fit(sizes, capacity)
    if swaps and len(bins):
        bins = improved(sizes, bins, capacity)
    return np.unique(bins, return_inverse=True)[1].tolist()


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """Pack all documents into as few token sequences of ``capacity`` as the search finds.

    Returns per piece doc_id, piece, start, length, ids_crc32, sequence_id and offset.
    Documents are tokenised whole, end with id 1, and only longer ones are cut.  Full
    pieces are sequences of their own; the others are dealt by a hash into groups of
    about ``group`` pieces, each packed by one task, which loses part of a sequence
    for each group and nothing else.  Ties go by doc_id and piece.  A very long text is
    tokenised by one task, one text at a time.

    Null and empty texts have one piece, the end id.  Rows that repeat a doc_id, or
    have none, are packed like any other and keep their doc_id.  An empty table gives
    an empty result.
    """
    cut = staged(pieces(docs, tokenizer, capacity))
    counted = cut.agg(F.count(F.when(F.col("length") < capacity, 1)), F.count("*")).first()
    groups = max(1, -(-counted[0] // group))
    names = cut.columns
    full = cut.filter(F.col("length") >= capacity).select(
        *names,
        (-1 - F.monotonically_increasing_id()).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    salt = F.xxhash64("doc_id", "piece", "start", "length", "ids_crc32")
    dealt = (
        cut.filter(F.col("length") < capacity)
        .withColumn("_group", F.pmod(F.xxhash64(salt, F.monotonically_increasing_id()), F.lit(groups)))
        .repartition("_group")
        .sortWithinPartitions("_group", F.desc("length"), "doc_id", "piece")
    )

    def filled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in sorted_groups(batches, ["_group"]):
            which = table.column("_group").to_numpy()
            lengths = table.column("length").to_numpy()
            edges = np.append(group_starts([which]), len(which))
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                bins = np.array(pack_lengths(lengths[a:b].tolist(), capacity))
                order = np.argsort(bins, kind="stable")
                ends = np.cumsum(lengths[a:b][order])
                first = group_starts([bins[order]])
                sizes = np.diff(np.append(first, b - a))
                offsets = ends - lengths[a:b][order]
                offsets -= np.repeat(offsets[first], sizes)
                rows = table.slice(a, b - a).take(pa.array(order)).select(names)
                rows = rows.append_column(
                    "sequence_id", pa.array(which[a] * (1 << 32) + bins[order], pa.int64())
                ).append_column("offset", pa.array(offsets, pa.int64()))
                yield from rows.to_batches()

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in full.schema.fields)
    return full.union(dealt.mapInArrow(filled, schema))
