"""Operator 6, quality classifier: document evidence with site posteriors above it."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.common import by_batch
from larder.sources.workspace import staged

TRAIN_ROWS = 20_000  # labelled documents the evidence is fitted on, at most
LIMIT_STRENGTH = 1e4  # documents that a prior may weigh, at most

_UPPER, _LOWER, _DIGIT = np.zeros((3, 256))
_UPPER[65:91] = _LOWER[97:123] = _DIGIT[48:58] = 1
_HIGH = (np.arange(256) >= 128).astype(float)
_STOP = np.isin(np.arange(256), list(b".,;:'\"()-")).astype(float)
_SHOUT = np.isin(np.arange(256), list(b"!?")).astype(float)
_BAR = np.isin(np.arange(256), list(b"|")).astype(float)
_BLANK = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r")).astype(float)
_SIGN = 1 - np.clip(_UPPER + _LOWER + _DIGIT + _HIGH + _STOP + _SHOUT + _BAR + _BLANK, 0, 1)
_CLASSES = np.stack([_UPPER, _LOWER, _DIGIT, _HIGH, _STOP, _SHOUT, _BAR, _SIGN])
FEATURES = 14


def features(text: bytes) -> np.ndarray:
    """Shares of kinds of bytes and words in a whole text; zeros and a flag if it is blank."""
    x = np.zeros(FEATURES)
    words = text.split()
    if not words:
        x[13] = 1
        return x
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    shares = _CLASSES @ counts
    inside = max(shares.sum(), 1)
    x[:8] = shares / inside
    letters = shares[0] + shares[1]
    x[8] = shares[0] / letters if letters else 0
    x[9] = len(set(words)) / len(words)
    x[10] = np.log1p(len(words)) / 10
    x[11] = min(inside / len(words), 30) / 10
    lines = text.split(b"\n")
    x[12] = len(set(lines)) / len(lines)
    return x


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weights (the last one is the constant), centre and scale of a logistic regression."""
    centre, scale = x.mean(0), x.std(0) + 1e-9
    z = np.hstack([(x - centre) / scale, np.ones((len(x), 1))])
    w = np.zeros(z.shape[1])
    keep = np.diag([ridge] * x.shape[1] + [1e-6])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + keep, z.T @ (y - p) - keep @ w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w, centre, scale


def logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def strength(groups: DataFrame, mean: str, above: str) -> float:
    """How many documents a prior weighs, from the spread of group means about it.

    Moments: a group of n documents differs from its prior by m(1-m)/n of chance and
    m(1-m)/(strength+1) of its own.  All groups enter, weighed by their size.
    """
    row = groups.select(
        F.sum("n").alias("n"),
        F.sum(F.col("n") * F.pow(F.col(mean) - F.col(above), 2)).alias("spread"),
        F.sum(F.col("n") * F.col(above) * (1 - F.col(above))).alias("chance"),
        F.count("*").alias("groups"),
        F.sum(F.col(above) * (1 - F.col(above))).alias("each"),
    ).first()
    if not row["n"] or not row["chance"]:
        return 1.0
    own = (row["spread"] - row["each"]) / row["n"]
    if own <= 0:
        return LIMIT_STRENGTH
    return float(min(max(row["chance"] / row["n"] / own - 1, 1.0), LIMIT_STRENGTH))


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    host: Column | None = None,
    path: Column | None = None,
    train_rows: int = TRAIN_ROWS,
) -> DataFrame:
    """doc_id, evidence, host_rate, path_rate, score (chance of good quality) and kept.

    Evidence: the log-odds by which a logistic regression on the whole text moves the
    base rate; it is fitted on at most ``train_rows`` labelled documents, chosen by a
    hash of doc_id.  Sites are judged by all their documents: the rate of a host is
    the mean chance of its documents shrunk toward the base rate, that of a path
    (``host`` and ``path``; source and lang unless given) is shrunk toward its host,
    each leaving out the document itself.  How strongly is estimated from the spread
    of the groups.  The score is the path's rate moved by the evidence; documents
    with a score of at least a half are kept.

    Very long texts have shares of all their bytes.  Null, empty and blank texts have features of their own.  Documents without host
    or path share a group.  Every row has its result, also rows that repeat or have
    no doc_id.  Without labels of both kinds the evidence is zero and all documents
    are kept.  An empty table gives an empty result.
    """
    found = _scored(docs, labels, host, path, train_rows)
    return found.select("doc_id", "evidence", "host_rate", "path_rate", "score", "kept")


def _scored(docs, labels, host=None, path=None, train_rows=TRAIN_ROWS, carried=()) -> DataFrame:
    """``score_quality`` beside the columns of ``docs`` that are to be ``carried``, as _own_ and their name."""
    sites = docs.select(
        *[F.col(name).alias(f"_own_{name}") for name in carried],
        "doc_id",
        (F.col("source") if host is None else host).cast("string").alias("host"),
        (F.col("lang") if path is None else path).cast("string").alias("path"),
        "text",
    )
    judged = _judged(sites, labels, train_rows)
    base = judged.agg(F.avg("chance")).first()[0] or 0.5
    none = F.lit("")
    filled = judged.withColumns({
        "_h": F.coalesce("host", none), "_hn": F.col("host").isNull(),
        "_p": F.coalesce("path", none), "_pn": F.col("path").isNull(),
    })
    paths = staged(
        filled.groupBy("_h", "_hn", "_p", "_pn").agg(F.count("*").alias("n"), F.sum("chance").alias("s"))
    )
    hosts = paths.groupBy("_h", "_hn").agg(F.sum("n").alias("hn"), F.sum("s").alias("hs"))
    of_host = strength(
        hosts.select(F.col("hn").alias("n"), (F.col("hs") / F.col("hn")).alias("m"), F.lit(base).alias("a")),
        "m", "a",
    )
    shrunk = hosts.withColumn("rate", (F.col("hs") + of_host * base) / (F.col("hn") + of_host))
    both = paths.join(shrunk, ["_h", "_hn"])
    of_path = strength(both.withColumn("m", F.col("s") / F.col("n")), "m", "rate")
    table = staged(both.select("_h", "_hn", "_p", "_pn", "n", "s", "hn", "hs"))
    own = F.col("chance")
    host_rate = (F.col("hs") - own + of_host * base) / (F.col("hn") - 1 + of_host)
    path_rate = (F.col("s") - own + of_path * F.col("host_rate")) / (F.col("n") - 1 + of_path)
    safe = lambda c: F.greatest(F.lit(1e-9), F.least(c, F.lit(1 - 1e-9)))
    return (
        filled.join(table, ["_h", "_hn", "_p", "_pn"])
        .withColumn("host_rate", safe(host_rate))
        .withColumn("path_rate", safe(path_rate))
        .withColumn("score", 1 / (1 + F.exp(-(logit(F.col("path_rate")) + F.col("evidence")))))
        .select(
            *[f"_own_{name}" for name in carried],
            "doc_id", "evidence", "host_rate", "path_rate", "score",
            (F.col("score") >= 0.5).alias("kept"),
        )
    )


def _judged(sites: DataFrame, labels: DataFrame, train_rows: int) -> DataFrame:
    """Every row with its evidence and the chance that follows from it alone."""
    rated = labels.select("doc_id", "quality").filter("quality IN (0, 1) AND doc_id IS NOT NULL")
    rated = rated.groupBy("doc_id").agg(F.max("quality").alias("quality"))
    sample = staged(rated.orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows))

    names = sites.columns[:-1]

    def measure(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = pc.cast(pc.fill_null(batch.column("text"), ""), pa.large_binary()).to_pylist()
        rows = [features(t).tolist() for t in texts]
        return pa.RecordBatch.from_arrays(
            [*[batch.column(c) for c in names], pa.array(rows, pa.list_(pa.float64()))], [*names, "x"]
        )

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in sites.schema.fields[:-1])
    measured = staged(by_batch(sites, measure, f"{kinds}, x array<double>"))
    # train_rows ids at most, by its own parameter
    train = measured.join(F.broadcast(sample), "doc_id").select("quality", "x")
    rows = train.limit(2 * train_rows).collect()
    y = np.array([r[0] for r in rows], float)
    if len(set(y.tolist())) < 2:
        return measured.drop("x").withColumns({"evidence": F.lit(0.0), "chance": F.lit(0.5 + 1e-6)})
    w, centre, scale = fit(np.array([r[1] for r in rows]), y)
    line = F.lit(float(w[-1] - (w[:-1] * centre / scale).sum()))
    for i in range(FEATURES):
        line = line + F.col("x")[i] * float(w[i] / scale[i])
    prior = float(np.log(y.mean() / (1 - y.mean())))
    return (
        measured.withColumn("_line", line)
        .withColumns({"evidence": F.col("_line") - prior, "chance": 1 / (1 + F.exp(-F.col("_line")))})
        .drop("x", "_line")
    )


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier keeps, with all their columns.

    Each row is judged by its own text and site, whatever its doc_id.  Rows carry their
    columns through the scoring, so texts are written once and never shuffled.
    """
    scored = _scored(docs, labels, carried=docs.columns)
    return scored.filter("kept").select(*[F.col(f"_own_{name}").alias(name) for name in docs.columns])
