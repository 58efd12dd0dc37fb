"""Operator 11, cross-tokenizer alignment: which tokens of two vocabularies overlap."""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.sources.workspace import staged

RADIX = 64  # parts of the first side's ids
SPREAD = 16  # groups of chunks that are counted on their own before all are
RECORDS = 2_000_000  # links that a chunk holds before its runs are written
DOCS = 1 << 16  # documents of a chunk, at most
FAN_IN = 64  # runs that are merged at a time
SLICE = 1 << 20  # characters that are split at a time
LEVEL = 1

# Pre-tokens of the byte-level vocabulary (fixed value)
BYTE_PATTERN = (
    r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
# Other white space before more than one space, or a space at the end: splitting would show.
_CROSSING = re.compile(r"[^\S ]  | \Z")
_UNITS = re.compile(r" ( *[^ ]+)")


def byte_symbols() -> dict[str, int]:
    """What a byte-level vocabulary writes for each byte: itself if it prints, else the next from 256."""
    printed = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printed]
    return {chr(b): b for b in printed} | {chr(256 + i): b for i, b in enumerate(others)}


class Units:
    """Both tokenizations of text units, remembered.

    A unit is one or more spaces and what follows up to the next space.  Neither vocabulary
    has a token over the start of a unit, so a text's tokens, groups and links are
    those of its units.  Named without the first space.
    """

    LIMIT = 250_000
    CHARACTERS = 16 << 20

    def __init__(self, byte_file: str, piece_file: str) -> None:
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        vocabulary = Tokenizer.from_file(byte_file)
        symbols = byte_symbols()
        added = {t.content for t in vocabulary.get_added_tokens_decoder().values()}
        ranks = {
            bytes(symbols[c] for c in token): i
            for token, i in vocabulary.get_vocab().items()
            if token not in added
        }
        # ids of a byte-level vocabulary are the order in which its pairs merge
        self.bytes_ids = tiktoken.Encoding(
            "side_a", pat_str=BYTE_PATTERN, mergeable_ranks=ranks, special_tokens={}
        ).encode_ordinary
        self.a_bytes = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.a_bytes[i] = token
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=piece_file)
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.pieces.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(map(self.pieces.id_to_piece, range(self.pieces.get_piece_size())))
        ]
        self.a_size, self.b_size = (np.array([len(x) for x in side]) for side in (self.a_bytes, self.b_bytes))
        self.n_b = len(self.b_bytes)
        self.forget()

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.held = 0  # characters
        self.groups: list[str | None] = []  # None: the unit's bytes do not come back
        self.counts = np.zeros((1024, 3), np.int64)  # tokens of A, of B, groups
        self.start, self.size = np.zeros((2, 1024), np.int64)
        self.codes, self.used = np.zeros(1 << 16, np.int64), 0

    def learn(self, units: list[str]) -> None:
        """Tokenize units that are new, all in one go."""
        a_ids = [self.bytes_ids(" " + u) for u in units]
        b_ids = self.pieces.encode(units, num_threads=1)
        texts = [(" " + u).encode() for u in units]
        good = [
            k for k, text in enumerate(texts)
            if b"".join([self.b_bytes[i] for i in b_ids[k]]) == text
            and b"".join([self.a_bytes[i] for i in a_ids[k]]) == text
        ]
        at = len(self.groups)
        self.place |= {u: at + k for k, u in enumerate(units)}
        self.held += sum(map(len, units))
        self.groups += [None] * len(units)
        while len(self.counts) < len(self.groups):
            self.counts = np.concatenate([self.counts, np.zeros_like(self.counts)])
            self.start, self.size = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.size))
        if not good:
            return
        # the good units as one long text
        a = np.array([i for k in good for i in a_ids[k]], np.int64)
        b = np.array([i for k in good for i in b_ids[k]], np.int64)
        a_end, b_end = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        unit_end = np.cumsum([len(texts[k]) for k in good])
        both = np.intersect1d(a_end, b_end, assume_unique=True)
        every = np.union1d(a_end, b_end)
        codes = a[np.searchsorted(a_end, every)] * self.n_b + b[np.searchsorted(b_end, every)]
        a_cut, b_cut = (np.searchsorted(e, both, "right").tolist() for e in (a_end, b_end))
        a_text, b_text = list(map(str, a.tolist())), list(map(str, b.tolist()))
        written = [
            ",".join(a_text[i:j]) + "|" + ",".join(b_text[k:l])
            for i, j, k, l in zip([0, *a_cut], a_cut, [0, *b_cut], b_cut)  # noqa: E741
        ]
        unit_cuts = [np.searchsorted(e, unit_end, "right") for e in (a_end, b_end, both, every)]
        placed = at + np.array(good)
        for k, cut in enumerate(unit_cuts[:3]):
            self.counts[placed, k] = np.diff(cut, prepend=0)
        self.size[placed] = np.diff(unit_cuts[3], prepend=0)
        self.start[placed] = self.used + unit_cuts[3] - self.size[placed]
        while self.used + len(codes) > len(self.codes):
            self.codes = np.concatenate([self.codes, np.zeros_like(self.codes)])
        self.codes[self.used : self.used + len(codes)] = codes
        self.used += len(codes)
        ends = unit_cuts[2].tolist()
        for k, i, j in zip(placed.tolist(), [0, *ends], ends):
            self.groups[k] = ";".join(written[i:j])

    def split(self, text: str) -> list[str]:
        whole = " " + text
        if _CROSSING.search(whole):
            return [text]
        return _UNITS.findall(whole) if "  " in whole else text.split(" ")

    def of(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, str]]:
        """(counts, link codes, groups) of each text; a text without tokens has no codes."""
        none = np.zeros(3, np.int64), np.zeros(0, np.int64), ""
        split = [self.split(t) if t else [] for t in texts]
        if len(self.groups) > self.LIMIT or self.held > self.CHARACTERS:
            self.forget()
        new = {u for units in split for u in units if u not in self.place}
        if new:
            self.learn(list(new))
        for units in split:
            at = np.fromiter(map(self.place.__getitem__, units), np.int64, len(units))
            groups = [self.groups[k] for k in at.tolist()]
            if not units or None in groups:
                yield none
                continue
            size = self.size[at]
            where = np.repeat(self.start[at] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            yield self.counts[at].sum(0), self.codes[where], ";".join(groups)


# One for each Python worker: learning units is most of the work.
_units: dict[tuple[str, str], Units] = {}


def packed(*columns: np.ndarray) -> bytes:
    """Columns of numbers as one zstd frame: lengths and widths, then the numbers."""
    parts = []
    for c in columns:
        width = next(w for w in (1, 2, 4, 8) if not len(c) or int(c.max()) < 1 << (8 * w))
        parts += [np.array([len(c), width], "<u8").tobytes(), c.astype(f"<u{width}").tobytes()]
    return zstandard.ZstdCompressor(level=LEVEL).compress(b"".join(parts))


def unpacked(frame: bytes) -> list[np.ndarray]:
    data, at, columns = zstandard.ZstdDecompressor().decompress(frame), 0, []
    while at < len(data):
        n, width = np.frombuffer(data, "<u8", 2, at).tolist()
        columns.append(np.frombuffer(data, f"<u{width}", n, at + 16).astype(np.int64))
        at += 16 + n * width
    return columns


def pair_run(codes: np.ndarray, counts: np.ndarray) -> bytes:
    """A run of pairs in order of their codes, with a count for each."""
    return packed(np.diff(codes, prepend=0), counts)


def read_pairs(frame: bytes) -> tuple[np.ndarray, np.ndarray]:
    gaps, counts = unpacked(frame)
    return np.cumsum(gaps), counts


class Chunk:
    """Links of some documents, which leave as one sorted run for each radix."""

    def __init__(self, n_b: int, radix: int) -> None:
        self.n_b, self.radix = n_b, radix
        self.empty()

    def empty(self) -> None:
        self.keys, self.n, self.docs = [], 0, []

    def add(self, codes: np.ndarray, doc: tuple) -> None:
        self.keys.append((codes << 16) | len(self.docs))
        self.n += len(codes)
        self.docs.append(doc)

    @property
    def full(self) -> bool:
        return self.n >= RECORDS or len(self.docs) >= DOCS

    def runs(self) -> Iterator[tuple[int, bytes, bytes]]:
        """(radix, pairs with their numbers of documents, documents with their links)."""
        key = np.concatenate(self.keys)
        part = (key >> 16) // self.n_b % self.radix
        key = np.sort((part << 48) | key)  # codes take 32 bits at most
        first = np.flatnonzero(np.diff(key, prepend=-1))
        key, links = key[first], np.diff(first, append=len(key))
        cuts = np.searchsorted(key, np.arange(self.radix + 1) << 48)
        for r, (s, e) in enumerate(zip(cuts, cuts[1:])):
            if s < e:
                code = (key[s:e] >> 16) & ((1 << 32) - 1)
                new = np.flatnonzero(np.diff(code, prepend=-1))
                yield (
                    r,
                    pair_run(code[new], np.diff(new, append=e - s)),
                    packed(key[s:e] & (DOCS - 1), links[s:e]),
                )


FIELDS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
DOC_SCHEMA = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
KINDS = {
    "chunk": pa.int64(), "radix": pa.int32(), "pairs": pa.binary(), "links": pa.binary(), "place": pa.int32(),
    "doc_id": pa.int64(), "n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(),
    "n_links": pa.int64(), "groups_sha256": pa.string(),
}


def as_batch(rows: list[tuple], kinds: dict[str, pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * len(kinds)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, kinds.values(), strict=True)], list(kinds)
    )


def align(docs: DataFrame, byte_file: str, piece_file: str, radix: int = RADIX, spread: int = SPREAD) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of each document.

    ``byte_file``: a byte-level vocabulary (side A, of space and text); ``piece_file``: a
    piece vocabulary (side B, which adds the space itself).  Byte offsets where tokens of both
    sides end cut the tokens into groups.  Tokens of both sides that share bytes are linked; the count of a pair of ids
    is the number of documents that hold it linked.  n_best: links whose count is the
    highest of their A id; count_sum: the counts of all links.

    External counting in four steps.  A task turns its documents into chunks of
    records (pair, document), sorted and written as one zstd run for each radix of the A
    id, with the pairs and their numbers of documents ahead.  The pair parts of runs
    are merged through a heap in order of A, first within groups of chunks, then over all, so
    the highest count of an A id is known when its pairs have passed.  Counts go back to each run,
    pair by pair; there they meet the run's documents and are added up chunk by chunk.  So a pair
    is sent once for each chunk, however many documents hold it, and what a task
    holds is one chunk, or the distinct pairs of one radix.

    Null and empty texts, and those whose bytes do not come back from either side, have zeros and an empty
    groups_sha256.  A very long text is a chunk of its own size.  Ties for the highest
    count are all best.  Rows that repeat or have no doc_id are documents like others.  Other columns
    are not read.  An empty table gives an empty result.
    """

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = byte_file, piece_file
        units = _units.get(names) or _units.setdefault(names, Units(*names))
        chunk, number = Chunk(units.n_b, radix), TaskContext.get().partitionId() << 32

        def written() -> pa.RecordBatch:
            rows = [(number, r, p, x, *[None] * 7) for r, p, x in chunk.runs()]
            rows += [(number, radix, None, None, k, *doc) for k, doc in enumerate(chunk.docs)]
            return as_batch(rows, KINDS)

        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text")
            sizes = np.array([len(x) if x else 0 for x in texts.to_pylist()], np.int64)
            cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // SLICE, prepend=0))
            for s, e in zip([0, *cuts], [*cuts, len(ids)]):
                found = units.of(texts.slice(s, e - s).to_pylist())
                for doc, (counts, codes, groups) in zip(ids[s:e], found, strict=True):
                    digest = hashlib.sha256(groups.encode()).hexdigest() if groups else ""
                    chunk.add(codes, (doc, *counts.tolist(), len(codes), digest))
                    if chunk.full:
                        yield written()
                        chunk.empty()
                        number += 1
        if chunk.docs:
            yield written()

    every = staged(
        docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
            tokenize, f"chunk long, radix int, pairs binary, links binary, place int, {DOC_SCHEMA}"
        )
    )
    runs = every.filter(F.col("radix") < radix).withColumn("share", F.pmod(F.xxhash64("chunk"), F.lit(spread)))
    pairs = runs.select("radix", "share", "pairs")
    vocabulary = "radix int, share long, pairs binary"
    n_b = _pieces(piece_file)
    by_share = (
        pairs.repartition("radix", "share").sortWithinPartitions("radix", "share")
        .mapInArrow(lambda it: _merged(it, n_b, False), vocabulary)
    )
    totals = staged(
        by_share.repartition("radix").sortWithinPartitions("radix")
        .mapInArrow(lambda it: _merged(it, n_b, True), vocabulary)
    )
    asked = runs.select("radix", "share", "chunk", "pairs").union(
        totals.select("radix", F.explode(F.sequence(F.lit(0), F.lit(spread - 1)).cast("array<long>")),
                      F.lit(-1).cast("long"), "pairs")
    )
    answers = (
        asked.repartition("radix", "share").sortWithinPartitions("radix", "share", "chunk")
        .mapInArrow(_answers, "chunk long, radix int, pairs binary")
    )
    none = [F.lit(None).alias(c) for c in ("links", "place", *FIELDS)]
    together = every.withColumn("_step", F.lit(1)).unionByName(
        answers.select("chunk", "radix", "pairs", *none, F.lit(0).alias("_step"))
    )
    return (
        together.repartition("chunk").sortWithinPartitions("chunk", "radix", "_step", "place")
        .mapInArrow(_summed, DOC_SCHEMA + ", n_best long, count_sum long")
        .select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    )


def _pieces(piece_file: str) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=piece_file).get_piece_size()


def heap_merged(runs: list[tuple[np.ndarray, np.ndarray]], n_b: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Codes and added counts of sorted runs, one A id after another."""
    cuts = []
    for codes, _ in runs:
        a = codes // n_b
        starts = np.flatnonzero(np.diff(a, prepend=-1))
        cuts.append((a[starts].tolist(), [*starts.tolist(), len(codes)]))
    heap = [(ids[0], r, 0) for r, (ids, _) in enumerate(cuts) if ids]
    heapq.heapify(heap)
    while heap:
        a, found = heap[0][0], []
        while heap and heap[0][0] == a:
            _, r, k = heap[0]
            ids, at = cuts[r]
            found.append((runs[r][0][at[k] : at[k + 1]], runs[r][1][at[k] : at[k + 1]]))
            if k + 1 < len(ids):
                heapq.heapreplace(heap, (ids[k + 1], r, k + 1))
            else:
                heapq.heappop(heap)
        if len(found) == 1:
            yield found[0]
            continue
        codes = np.concatenate([c for c, _ in found])
        order = np.argsort(codes, kind="stable")
        codes = codes[order]
        first = np.flatnonzero(np.diff(codes, prepend=-1))
        yield codes[first], np.add.reduceat(np.concatenate([n for _, n in found])[order], first)


def _merged(batches: Iterator[pa.RecordBatch], n_b: int, last: bool) -> Iterator[pa.RecordBatch]:
    """One run for each group of rows; the last merge doubles counts and adds one to the highest of an A id."""
    kinds = {"radix": pa.int32(), "share": pa.int64(), "pairs": pa.binary()}

    def result(key: tuple, runs: list) -> pa.RecordBatch:
        parts = []
        for codes, counts in heap_merged(runs, n_b):
            parts.append((codes, 2 * counts + (counts == counts.max()) if last else counts))
        run = pair_run(*(np.concatenate(c) for c in zip(*parts, strict=True)))
        return as_batch([(*key, run)], kinds)

    now, runs = None, []
    for batch in batches:
        for radix, share, pairs in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            key = (radix, 0 if last else share)
            if key != now:
                if runs:
                    yield result(now, runs)
                now, runs = key, []
            runs.append(read_pairs(pairs))
            if len(runs) == FAN_IN:
                parts = list(heap_merged(runs, n_b))
                runs = [tuple(np.concatenate(c) for c in zip(*parts, strict=True))]
    if runs:
        yield result(now, runs)


def _answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The totals of the pairs of each run; the totals of a radix come ahead of its runs."""
    kinds = {"chunk": pa.int64(), "radix": pa.int32(), "pairs": pa.binary()}
    codes = counts = None
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("radix", "chunk", "pairs")]
        for radix, chunk, pairs in zip(*columns, strict=True):
            if chunk < 0:
                codes, counts = read_pairs(pairs)
            else:
                asked = read_pairs(pairs)[0]
                yield as_batch([(chunk, radix, packed(counts[np.searchsorted(codes, asked)]))], kinds)


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with the sums over their links; a chunk's answers and runs come ahead of them."""
    kinds = {name: KINDS[name] for name in FIELDS} | {"n_best": pa.int64(), "count_sum": pa.int64()}
    now, answer = None, None
    for batch in batches:
        rows, doc = [], list(zip(*(batch.column(c).to_pylist() for c in FIELDS), strict=True))
        columns = [batch.column(c).to_pylist() for c in ("chunk", "_step", "pairs", "links", "place")]
        for k, (chunk, step, pairs, links, place) in enumerate(zip(*columns, strict=True)):
            if chunk != now:
                now, sums = chunk, np.zeros((DOCS, 2), np.int64)
            if step == 0:
                answer = unpacked(pairs)[0]
            elif links is not None:
                at, times = unpacked(links)
                total = np.repeat(answer, read_pairs(pairs)[1])
                np.add.at(sums, at, np.stack([times * (total & 1), times * (total >> 1)], 1))
            else:
                rows.append((*doc[k], *sums[place].tolist()))
        if rows:
            yield as_batch(rows, kinds)
