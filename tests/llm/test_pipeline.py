"""The pipeline's stages, each on what the one before kept."""

import corpus_pipeline as pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from larder.llm import decontaminate, quality, similar
from larder.llm.near import shingle_fingerprints
from larder.sources.workspace import staged

FOLDER = "/root/testdata/sf0.001"


def smallest_of_groups(docs):
    """By brute force over all pairs: five-word shingles, similarity of 0.8 or more."""
    words = {r["doc_id"]: (r["text"] or "").lower().split() for r in docs.collect()}
    sets = {i: {tuple(w[k : k + 5]) for k in range(max(len(w) - 4, 1))} for i, w in words.items()}
    left, smallest = set(sets), set()
    while left:
        first = min(left)
        smallest.add(first)
        left.remove(first)
        reached = [first]
        while reached:
            own = sets[reached.pop()]
            close = {i for i in left if len(own & sets[i]) >= 0.8 * len(own | sets[i])}
            left -= close
            reached += close
    return smallest


def joined(n, links):
    """The smallest member of each one's component."""
    least = list(range(n))
    for _ in range(n):
        for x, y in links:
            least[x] = least[y] = min(least[x], least[y])
    return least


@pytest.mark.parametrize("limit", [0.5, 0.8, 1.0])
def test_walk_of_a_group(limit):
    """Links found through rare shingles connect what all similar pairs connect."""
    chance = np.random.default_rng(7)
    for _ in range(60):
        common = chance.integers(0, 60, (3, 30)).astype(np.uint64)
        sets = []
        for _ in range(chance.integers(1, 20)):
            x = common[chance.integers(3)][: chance.integers(1, 30)].copy()
            x[chance.integers(0, len(x), chance.integers(0, 4))] = chance.integers(0, 200)
            sets.append(np.unique(x))
        whole = [set(x.tolist()) for x in sets]
        close = [
            (i, j)
            for i in range(len(sets))
            for j in range(i)
            if len(whole[i] & whole[j]) >= limit * len(whole[i] | whole[j]) - 1e-9
        ]
        a, b = similar.walked(sets, limit)
        assert joined(len(sets), list(zip(a.tolist(), b.tolist(), strict=True))) == joined(len(sets), close)
        assert len(a) < len(sets)


def test_near_dedup_goes_through_operator_5(spark, monkeypatch):
    """Its proposals connect exactly the sets whose fingerprints are connected by 4 bits."""
    calls = []

    def proposed(*args):
        calls.append(staged(near_links(*args)))
        return calls[-1]

    near_links = similar.fingerprint_links
    monkeypatch.setattr(similar, "fingerprint_links", proposed)
    docs = pipeline.documents(spark, FOLDER).limit(150)
    again = docs.selectExpr("doc_id + 1000 AS doc_id", "concat(text, ' again') AS text")
    blank = spark.createDataFrame([(5000, None), (5001, " ")], "doc_id long, text string")
    docs = staged(docs.select("doc_id", "text").union(again).union(blank))
    pipeline.near_dedup(spark, docs, FOLDER).count()
    assert len(calls) == 1
    links = [(r["a"], r["b"]) for r in calls[0].collect()]
    hashes = similar.WordHashes()
    sid = {
        r["doc_id"]: similar.set_id(similar.shingle_set((r["text"] or "").encode(), hashes, 5))
        for r in docs.collect()
    }
    fps = {sid[r["doc_id"]]: r["fp"] & (1 << 64) - 1 for r in shingle_fingerprints(docs, 5).collect()}
    place = {x: i for i, x in enumerate(sorted(fps))}
    close = [(place[x], place[y]) for x in fps for y in fps if (fps[x] ^ fps[y]).bit_count() <= 4]
    assert len(close) > len(fps)
    assert joined(len(fps), [(place[x], place[y]) for x, y in links]) == joined(len(fps), close)


def test_stages(spark):
    docs = pipeline.documents(spark, FOLDER)
    columns = docs.columns
    items = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    assert len(pipeline.STAGES) == 5
    for name, stage in pipeline.STAGES[:-1]:
        out = staged(stage(spark, docs, FOLDER))
        assert out.columns == columns
        before, after = ({r["doc_id"] for r in x.select("doc_id").collect()} for x in (docs, out))
        assert after <= before and after
        if name == "near_dedup":
            assert after == smallest_of_groups(docs)
        if name == "decontaminate":
            found = {r["doc_id"] for r in decontaminate.contained_items(docs, items).collect()}
            assert before - after == found
        if name == "pii":
            assert before == after
        docs = out
    last = pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert {r["doc_id"] for r in last.select("doc_id").distinct().collect()} == after


def test_quality_judges_rows_by_their_own_text(spark):
    """Rows that share a doc_id, or have none, do not share a verdict."""
    docs = pipeline.documents(spark, FOLDER)
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    found = quality.score_quality(docs, labels).collect()
    bad = next(r["doc_id"] for r in found if not r["kept"])
    good = next(r["doc_id"] for r in found if r["kept"])
    for shared in (None, good):
        moved = docs.withColumn(
            "doc_id", F.when(~F.col("doc_id").isin(bad, good), F.col("doc_id")).otherwise(F.lit(shared))
        )
        kept = quality.keep_good(moved, labels.filter(~F.col("doc_id").isin(bad, good)))
        assert kept.columns == docs.columns
        texts = {r["text"] for r in kept.collect()}
        of = {r["doc_id"]: r["text"] for r in docs.filter(F.col("doc_id").isin(bad, good)).collect()}
        assert of[good] in texts and of[bad] not in texts
