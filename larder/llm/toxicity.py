"""Operator 7, toxicity: a linear classifier on character n-grams scaled by log-count ratios."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.common import by_batch
from larder.sources.workspace import staged

TRAIN_ROWS = 12_000  # labelled documents that are learnt from, at most
KEPT = 3_000  # n-grams with the clearest difference between the classes
SIZES = (3, 4, 5)
SMOOTH = 1.0


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5, is 0; rows without an id are not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def grams(word: bytes) -> set[bytes]:
    """Character n-grams of a word with a blank at either end."""
    w = " " + word.decode() + " "
    return {w[i : i + n].encode() for n in SIZES for i in range(len(w) - n + 1)}


def words_in(column: pa.Array) -> Iterator[set[bytes]]:
    for text in pc.cast(pc.fill_null(column, ""), pa.large_binary()).to_pylist():
        yield set(text.lower().split())


class Known(dict):
    """Which kept n-grams a word has, as 32-bit integers; bounded by starting over."""

    LIMIT = 500_000

    def __init__(self, kept: dict[bytes, int]) -> None:
        self.kept = kept

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= self.LIMIT:
            self.clear()
        found = [self.kept[g] for g in grams(word) if g in self.kept]
        self[word] = out = np.array(found, np.int32).tobytes()
        return out

    def of(self, words: set[bytes]) -> np.ndarray:
        return np.unique(np.frombuffer(b"".join(map(self.__getitem__, words)), np.int32))


_known: dict[str, Known] = {}


def known(name: str, sent) -> Known:
    """The word memory of this Python worker for the broadcast list of n-grams of this name."""
    if name not in _known:
        _known.clear()
        _known[name] = Known({g: i for i, g in enumerate(sent.value)})
    return _known[name]


def count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many texts of either class each n-gram is; one row per n-gram and task."""
    seen = (Counter(), Counter())
    for batch in batches:
        for label, words in zip(batch.column("toxic").to_pylist(), words_in(batch.column("text")), strict=True):
            seen[label].update(set().union(*map(grams, words)))
    every = list(seen[0] | seen[1])
    for at in range(0, len(every), 50_000):
        some = every[at : at + 50_000]
        yield pa.RecordBatch.from_arrays(
            [pa.array(some, pa.binary()), *[pa.array([seen[k][g] for g in some], pa.int64()) for k in (0, 1)]],
            ["gram", "clean", "toxic"],
        )


def fit(rows: list[np.ndarray], y: np.ndarray, ratio: np.ndarray, ridge: float = 0.05, steps: int = 150) -> tuple[np.ndarray, float]:
    """Logistic regression on present n-grams times their log-count ratio.

    Gradient steps with momentum.  Returns the weights times the ratios, and the constant.
    """
    sizes = np.array([len(r) for r in rows])
    at = np.concatenate(rows) if len(rows) else np.zeros(0, np.int32)
    owner = np.repeat(np.arange(len(rows)), sizes)
    value = ratio[at]
    w, speed = np.zeros(len(ratio) + 1), np.zeros(len(ratio) + 1)
    w[-1] = np.log(y.mean() / (1 - y.mean()))
    steep = np.bincount(owner, value * value, len(rows)).mean() + 1
    rate = 4 / steep
    for t in range(steps):
        look = w + t / (t + 3) * speed
        z = np.bincount(owner, value * look[at], len(rows)) + look[-1]
        off = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / len(rows)
        slope = np.append(np.bincount(at, value * off[owner], len(ratio)), off.sum())
        slope[:-1] += ridge / len(rows) * look[:-1]
        new = look - rate * slope
        speed, w = new - w, new
    return w[:-1] * ratio, float(w[-1])


def score_toxicity(
    docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, kept: int = KEPT
) -> DataFrame:
    """doc_id, held_out, score (0 to 1) and predicted (score at least a half) of every row.

    Learns from at most ``train_rows`` labelled documents that are not held out,
    chosen by a hash of doc_id: in how many texts of either class each n-gram is, the
    log ratio of these (smoothed) counts (ties in clearness: the smaller n-gram), and a logistic regression on the ``kept``
    n-grams that differ most, each scaled by its ratio.  Only texts enter a score.

    Very long texts count each n-gram once.  Null, empty and blank texts have no n-grams and the score of the constant.  Rows
    that repeat, or have no doc_id, each have a result.  Without labels of both kinds
    all scores are the share of toxic labels, or zero without any.  An empty table
    gives an empty result.
    """
    rated = labels.select("doc_id", "toxic").filter("toxic IN (0, 1) AND doc_id IS NOT NULL")
    rated = rated.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    sample = staged(
        rated.filter(~held_out(F.col("doc_id")))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(train_rows)
    )
    # train_rows ids at most, by its own parameter
    texts = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("toxic", "text")
    train = staged(texts.limit(2 * train_rows).repartition(docs.sparkSession.sparkContext.defaultParallelism))
    count = train.agg(F.count("*").alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("t")).first()
    answer = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    if not 0 < count["t"] < count["n"]:
        share = float(count["t"] / count["n"]) if count["n"] else 0.0
        return answer.select(
            "doc_id", "held_out", F.lit(share).alias("score"), F.lit(int(share >= 0.5)).alias("predicted")
        )
    toxic, clean = float(count["t"]), float(count["n"] - count["t"])
    p, q = F.col("toxic") / toxic, F.col("clean") / clean
    both = (F.col("toxic") + F.col("clean")) / (toxic + clean)
    clear = F.abs(p - q) / F.sqrt((both * (1 - both) + 1e-6) * (1 / toxic + 1 / clean))
    table = (
        train.mapInArrow(count_grams, "gram binary, clean long, toxic long")
        .groupBy("gram")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .orderBy(clear.desc(), "gram")
        .limit(kept)
        .collect()
    )
    names = [bytes(r["gram"]) for r in table]
    ahead = np.array([r["toxic"] for r in table]) + SMOOTH
    behind = np.array([r["clean"] for r in table]) + SMOOTH
    ratio = np.log(ahead / (toxic + 2 * SMOOTH)) - np.log(behind / (clean + 2 * SMOOTH))
    context = docs.sparkSession.sparkContext
    sent, name = context.broadcast(names), uuid4().hex  # ``kept`` n-grams

    def present(batch: pa.RecordBatch) -> pa.RecordBatch:
        memory = known(name, sent)
        rows = [memory.of(w).tolist() for w in words_in(batch.column("text"))]
        return pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(rows, pa.list_(pa.int32()))], ["toxic", "x"])

    rows = by_batch(train, present, "toxic int, x array<int>").toArrow()
    x = [np.array(r, np.int32) for r in rows.column("x").to_pylist()]
    weights, constant = fit(x, rows.column("toxic").to_numpy().astype(float), ratio)

    def score(batch: pa.RecordBatch) -> pa.RecordBatch:
        memory = known(name, sent)
        line = np.array([weights[memory.of(w)].sum() + constant for w in words_in(batch.column("text"))])
        s = 1 / (1 + np.exp(-np.clip(line, -500, 500)))
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("held_out"), pa.array(s), pa.array((s >= 0.5).astype(np.int32))],
            ["doc_id", "held_out", "score", "predicted"],
        )

    return by_batch(answer, score, "doc_id long, held_out boolean, score double, predicted int")
