"""Operator 8, LM scoring: prediction by partial matching with exclusion.

A document is coded as its words, lower-cased, with a blank between them, and one end
sign.  Each byte is predicted from the ORDER bytes before it, over the borders of words; if it
was never seen after them, from one byte less, and so on down to none, and at last
evenly.  A context of which q different bytes were seen n times in all is left with chance q / (n + q), and
bytes that a longer context has are excluded from the shorter ones.

A byte's chance depends on it and the ORDER bytes before it alone, so it is worked out once for each such gram: Spark
counts the grams of all training texts, adds them up to those of shorter contexts, and joins them
with the totals of their contexts.  The most frequent grams are sent to tasks, the
others meet their documents in a join.  No context has over 256 rows, so no key is hot.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from math import log10

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.sources.workspace import staged

ORDER = 5  # bytes of the longest context; a gram has one more and fits 48 bits
COUNTED = 400_000  # different words that a task counts before it passes them on
GRAMS = 2_000_000  # different grams likewise
SLICE = 1_000  # texts whose rare words and grams are held at a time
SLICE_BYTES = 1 << 20
HEAD = 600_000  # frequent words that every task knows, at most
CELLS = (2_097_143, 1_048_573)  # of the tables of frequent grams that every task knows
END = b"\n"  # no word holds it
SYMBOLS = 256


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 7, is 2; rows without an id are not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 7 == 2, F.lit(False))


def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts of batches with few texts and, unless one text alone has more, few bytes."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for k, n in enumerate(size.tolist()):
            if k > start and (held + n > SLICE_BYTES or k - start == SLICE):
                yield batch.slice(start, k - start)
                start, held = k, 0
            held += n
        if batch.num_rows:
            yield batch.slice(start)


def words_of(column: pa.Array) -> list[list[bytes]]:
    texts = pc.cast(pc.fill_null(column, ""), pa.large_binary()).to_pylist()
    return [t.lower().split() for t in texts]


def grams(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """A gram for each byte of the coded texts, and the place of its text.

    The byte is the lowest of the gram, the ones before it follow; end signs stand
    ahead of each text.
    """
    coded = [b" ".join(words) + END for words in texts]
    data = np.frombuffer((END * ORDER).join([b"", *coded]), np.uint8).astype(np.int64)
    every = data[ORDER:].copy()
    for k in range(1, ORDER + 1):
        every |= data[ORDER - k : -k] << (8 * k)
    owner = np.repeat(np.arange(len(coded)), [len(c) for c in coded])
    return every[np.arange(len(owner)) + ORDER * owner], owner


def added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys of several tables of counts, and the sums of their counts."""
    keys = np.concatenate([k for k, _ in parts])
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[first], np.add.reduceat(np.concatenate([n for _, n in parts])[order], first)


def count_grams(train: DataFrame) -> DataFrame:
    """g, n: how often each gram is in the texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def told() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict(dict(zip(("g", "n"), added(held), strict=True)))

        for batch in sliced(batches):
            held.append(np.unique(grams(words_of(batch.column("text")))[0], return_counts=True))
            if sum(len(k) for k, _ in held) > GRAMS:
                held = [added(held)]
                if len(held[0][0]) > GRAMS // 2:
                    yield told()
                    held = []
        if held:
            yield told()

    return train.select("text").mapInArrow(count, "g long, n long").groupBy("g").agg(F.sum("n").alias("n"))


def part_of(gram: Column | str, order: int) -> Column:
    """The gram with a context of ``order`` bytes only."""
    gram = F.col(gram) if isinstance(gram, str) else gram
    return gram.bitwiseAND(F.lit((1 << 8 * (order + 1)) - 1))


class Model:
    """Counts of grams by order, and of each context its totals.

    ``levels[k]``: g, n.  ``contexts[k]``: c, total and kinds (occurrences and different
    bytes after it), below (how often these bytes follow the next shorter context).
    """

    def __init__(self, counted: DataFrame) -> None:
        self.levels = [counted]
        for k in range(ORDER - 1, -1, -1):
            longer = self.levels[0]
            self.levels.insert(
                0, staged(longer.groupBy(part_of("g", k).alias("g")).agg(F.sum("n").alias("n")))
            )
        self.contexts = [staged(self._totals(k)) for k in range(ORDER + 1)]

    def _totals(self, k: int) -> DataFrame:
        rows = self.levels[k].withColumn("_m", F.lit(0).cast("long"))
        if k:
            shorter = self.levels[k - 1].select(F.col("g").alias("_s"), F.col("n").alias("_m"))
            rows = self.levels[k].withColumn("_s", part_of("g", k - 1)).join(_sent(shorter, k - 1), "_s")
        return rows.groupBy(F.shiftright("g", 8).alias("c")).agg(
            F.sum("n").alias("total"), F.count("*").alias("kinds"), F.sum("_m").alias("below")
        )

    def known(self) -> DataFrame:
        """g, n and v, the log10 chance of its byte, of all grams of the training texts."""
        found = self.levels[ORDER].withColumn("c", F.shiftright("g", 8)).join(self.contexts[ORDER], "c")
        return found.select("g", "n", F.log10(F.col("n") / (F.col("total") + F.col("kinds"))).alias("v"))

    def unseen(self, asked: DataFrame) -> DataFrame:
        """g and v of distinct grams that no training text has.

        From the longest context to the shortest: what is left (``v`` so far) goes on with
        the number of bytes that are excluded (``out``) and how often they follow the
        context of this order (``gone``).
        """
        nothing = F.lit(0).cast("long")
        state = asked.select("g", F.lit(0.0).alias("v"), nothing.alias("out"), nothing.alias("gone"))
        found = None
        for k in range(ORDER, -1, -1):
            level = self.levels[k].select(F.col("g").alias("_g"), "n")
            context = self.contexts[k].withColumnRenamed("c", "_c")
            met = staged(
                state.withColumn("_g", part_of("g", k))
                .withColumn("_c", F.shiftright("_g", 8))
                .join(_sent(context, k), "_c", "left")
                .join(_sent(level, k), "_g", "left")
            )
            new = F.col("kinds") - F.col("out")
            free = F.col("total") - F.col("gone") + new
            seen = met.filter("n IS NOT NULL").select("g", (F.col("v") + F.log10(F.col("n") / free)).alias("v"))
            found = seen if found is None else found.union(seen)
            left_with = F.when(new > 0, F.log10(new / free)).otherwise(F.lit(0.0))
            state = met.filter("n IS NULL").select(
                "g",
                (F.col("v") + left_with).alias("v"),
                F.coalesce("kinds", "out").alias("out"),
                F.coalesce("below", nothing).alias("gone"),
            )
        even = F.log10(F.greatest(F.lit(SYMBOLS) - F.col("out"), F.lit(1)).cast("double"))
        return found.union(state.select("g", F.col("v") - even))


def _sent(table: DataFrame, order: int) -> DataFrame:
    """Tables of one byte of context at most have 65,536 rows at most and are sent to all."""
    return F.broadcast(table) if order < 2 else table


def count_words(docs: DataFrame) -> DataFrame:
    """word, c: its count in training texts, 0 for words of held-out texts only."""

    def told(train: Counter, other: set[bytes]) -> pa.RecordBatch:
        names = [*train, *(w for w in other if w not in train)]
        return pa.RecordBatch.from_arrays(
            [pa.array(names, pa.binary()), pa.array([train.get(w, 0) for w in names], pa.int64())],
            ["word", "c"],
        )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        train, other = Counter(), set()
        for batch in sliced(batches):
            texts = words_of(batch.column("text"))
            for out, words in zip(batch.column("held_out").to_pylist(), texts, strict=True):
                if out:
                    other.update(words)
                else:
                    train.update(words)
                    train[END] += 1
            if len(train) + len(other) > COUNTED:
                yield told(train, other)
                train, other = Counter(), set()
        yield told(train, other | {END})

    rows = docs.select("held_out", "text").mapInArrow(count, "word binary, c long")
    return rows.groupBy("word").agg(F.sum("c").alias("c"))


def frequent_words(counted: DataFrame, head: int) -> dict[bytes, float]:
    """At most ``head`` of the most frequent words, each with log10 of its count plus one."""
    # the smallest count (a power of two) that at most ``head`` words reach
    level = F.floor(F.log2(F.col("c") + 1) * 4)
    steps = counted.filter("c > 0").groupBy(level.alias("k")).agg(F.count("*").alias("n")).collect()
    least, room = 1 << 62, head
    for k, n in sorted(((r[0], r[1]) for r in steps), reverse=True):  # at most 252 levels
        if n > room:
            break
        least, room = k, room - n
    if least == 1 << 62:
        return {}
    table = counted.filter(level >= F.lit(least)).toArrow()
    own = [log10(c + 1) for c in table.column("c").to_pylist()]
    return dict(zip(table.column("word").to_pylist(), own, strict=True))


class Cells:
    """Values of frequent grams in tables with one cell for each remainder of a gram."""

    def __init__(self, known: DataFrame, sizes: tuple[int, ...]) -> None:
        self.tables = []
        for size in sizes:
            best = staged(
                known.groupBy((F.col("g") % size).alias("cell"))
                .agg(F.max(F.struct("n", "g", "v")).alias("b"))
                .select("b.g", "b.v")
            )
            rows = best.toArrow()  # at most ``size`` rows
            g, v = (rows.column(c).to_numpy() for c in ("g", "v"))
            keys, values = np.full(size, -1, np.int64), np.zeros(size)
            keys[g % size], values[g % size] = g, v
            self.tables.append((keys, values))
            known = known.join(best.select("g"), "g", "left_anti")

    def of(self, g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values of grams, and which of them are known."""
        value, hit = np.zeros(len(g)), np.zeros(len(g), bool)
        left = np.arange(len(g))
        for keys, values in self.tables:
            cell = g[left] % len(keys)
            found = keys[cell] == g[left]
            value[left[found]] = values[cell[found]]
            hit[left[found]] = True
            left = left[~found]
        return value, hit


def score_texts(docs: DataFrame, head: int = HEAD, cells: tuple[int, ...] = CELLS) -> DataFrame:
    """Code length of every document under the byte model and under a word model.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score (word counts
    plus one) and score (the byte model's log10 chance of the text).  The training
    texts are all those that are not held out.  Counts grow with the corpus: at most
    ``head`` of the most frequent words and a gram for each of ``cells`` are sent to every task, the others
    meet their documents in joins.

    Null, empty and blank texts are the end sign alone.  Rows that repeat, or have no
    doc_id, count and are scored each.  Ties between equally frequent grams go to the greater one,
    and decide only which of them is sent.  A very long text is held once, with eight
    bytes for each of its own.  Without training texts bytes are equally
    likely.  Other columns are not read.  An empty table gives an empty result.
    """
    marked = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    counted = staged(count_words(marked))
    total = counted.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.when(F.col("c") > 0, 1))).first()
    train_tokens, distinct = total
    model = Model(staged(count_grams(marked.filter("NOT held_out"))))
    known = staged(model.known())
    # ``head`` words and ``cells`` grams at most
    sent = docs.sparkSession.sparkContext.broadcast((frequent_words(counted, head), Cells(known, cells)))

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, table = sent.value
        row = TaskContext.get().partitionId() << 33
        for batch in sliced(batches):
            texts = words_of(batch.column("text"))
            ids, out = batch.column("doc_id").to_pylist(), batch.column("held_out").to_pylist()
            g, owner = grams(texts)
            value, hit = table.of(g)
            lines = np.bincount(owner, value, len(texts)).tolist()
            sums: list[tuple] = []
            rest: list[tuple] = []
            for k, words in enumerate(texts):
                words.append(END)
                found = list(map(frequent.get, words))
                others = found.count(None)
                if others:
                    rare = Counter(w for w, b in zip(words, found) if b is None)
                    rest += [(row + k, None, None, w, None, n, 0, 0.0, 0.0) for w, n in rare.items()]
                    found = [b for b in found if b is not None]
                n = len(words)
                sums.append((row + k, ids[k], out[k], None, None, n, n - others, sum(found), lines[k]))
            columns = [pa.array(c, t) for c, t in zip(zip(*sums, *rest, strict=True), TYPES, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, NAMES)
            # a text's place and a gram fit 63 bits
            pairs, times = np.unique((owner[~hit] << 48) | g[~hit], return_counts=True)
            if len(pairs):
                none = [pa.nulls(len(pairs), t) for t in TYPES]
                none[0] = pa.array(row + (pairs >> 48))
                none[4], none[5] = pa.array(pairs & ((1 << 48) - 1)), pa.array(times)
                yield pa.RecordBatch.from_arrays(none, NAMES)
            row += len(texts)

    # written, as the numbers of the rows must not change
    parts = staged(marked.mapInArrow(add_up, SCHEMA))
    own = parts.filter("word IS NULL AND g IS NULL").select("row", "doc_id", "held_out", "n", "known", "base", "lp")
    words = (
        parts.filter("word IS NOT NULL")
        .select("row", "word", "n")
        .join(counted, "word")
        .groupBy("row")
        .agg(
            F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("_known"),
            F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("_base"),
        )
    )
    rare = parts.filter("g IS NOT NULL").select("row", "g", "n")
    asked = staged(rare.select("g").distinct().join(known.select("g", "v"), "g", "left"))
    values = asked.filter("v IS NOT NULL").union(model.unseen(asked.filter("v IS NULL").select("g")))
    others = rare.join(values, "g").groupBy("row").agg(F.sum(F.col("n") * F.col("v")).alias("_plus"))
    zero = lambda c: F.coalesce(c, F.lit(0))
    each = log10(train_tokens + distinct + 1)
    return own.join(words, "row", "left").join(others, "row", "left").select(
        "doc_id",
        "held_out",
        F.col("n").alias("n_tokens"),
        (F.col("known") + zero("_known")).alias("n_known"),
        F.lit(train_tokens).cast("long").alias("train_tokens"),
        (F.col("base") + zero("_base") - F.col("n") * each).alias("base_score"),
        (F.col("lp") + zero("_plus")).alias("score"),
    )


NAMES = ["row", "doc_id", "held_out", "word", "g", "n", "known", "base", "lp"]
TYPES = [
    pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(),
]
SCHEMA = (
    "row long, doc_id long, held_out boolean, word binary, g long, n long, known long, base double, lp double"
)
