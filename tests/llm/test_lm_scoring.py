"""The byte model against a plain PPM in dictionaries."""

import random
import zlib
from collections import defaultdict
from math import log10

import pytest
from pyspark.sql import functions as F

from larder.llm import compression
from larder.llm.common import ready
from larder.sources.workspace import staged

SCHEMA = "doc_id long, text string, n long, score string"


class Ppm:
    """Counts of bytes after every context of up to five bytes."""

    def __init__(self, texts):
        self.after = defaultdict(lambda: defaultdict(int))
        for text in texts:
            for context, byte in self.steps(text):
                for k in range(compression.ORDER + 1):
                    self.after[context[len(context) - k :]][byte] += 1

    @staticmethod
    def steps(text):
        data = b"\n" * compression.ORDER + b" ".join((text or "").encode().lower().split()) + b"\n"
        return [(data[i - compression.ORDER : i], data[i]) for i in range(compression.ORDER, len(data))]

    def chance(self, context, byte):
        p, excluded = 1.0, set()
        for k in range(compression.ORDER, -1, -1):
            seen = {b: n for b, n in self.after.get(context[len(context) - k :], {}).items() if b not in excluded}
            if not seen:
                continue
            total = sum(seen.values()) + len(seen)
            if byte in seen:
                return p * seen[byte] / total
            p, excluded = p * len(seen) / total, excluded | set(seen)
        return p / (256 - len(excluded))

    def score(self, text):
        return sum(log10(self.chance(*step)) for step in self.steps(text))


def texts():
    rng = random.Random(7)
    words = ["".join(rng.choices("abcdé", k=rng.randint(1, 5))) for _ in range(40)]
    rows = [(k, " ".join(rng.choices(words, k=rng.randint(0, 60)))) for k in range(150)]
    rows += [(400 + k, " ".join("".join(rng.choices("abxyZ漢", k=4)) for _ in range(20))) for k in range(30)]
    return [*rows, (200, None), (201, ""), (202, " \t "), (203, "A\x00b"), (None, "ab cd"), (0, "ab twice")]


def held(doc):
    return doc is not None and zlib.crc32(str(doc).encode()) % 7 == 2


@pytest.mark.parametrize("cells", [(1,), (97, 31), compression.CELLS])
def test_scores_are_those_of_a_plain_ppm(spark, cells):
    ready(spark)
    rows = texts()
    model = Ppm([t for i, t in rows if not held(i)])
    docs = spark.createDataFrame([(i, t, 1, "clash") for i, t in rows], SCHEMA)
    got = sorted((r["doc_id"] or -1, r["n_tokens"], r["score"]) for r in compression.score_texts(docs, 20, cells).collect())
    want = sorted((i or -1, len((t or "").encode().split()) + 1, model.score(t)) for i, t in rows)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert [g[2] for g in got] == pytest.approx([w[2] for w in want])


def test_the_order_of_words_counts(spark):
    ready(spark)
    rows = [(i, t) for i, t in texts() if t]
    shuffled = [(i, " ".join(sorted(t.split()))) if held(i) else (i, t) for i, t in rows]
    scores = []
    for some in (rows, shuffled):
        docs = spark.createDataFrame([(i, t, 1, "clash") for i, t in some], SCHEMA)
        found = compression.score_texts(docs).filter("held_out").collect()
        scores.append({r["doc_id"]: r["score"] for r in found})
    changed = [i for i in scores[0] if abs(scores[0][i] - scores[1][i]) > 1e-6]
    assert len(changed) > len(scores[0]) / 2


def test_chances_of_all_bytes_add_up_to_one(spark):
    """After contexts of all lengths that were seen, and after one that never was."""
    ready(spark)
    rows = [(i, t) for i, t in texts() if i is None or i < 150]
    docs = spark.createDataFrame([(i, t, 1, "clash") for i, t in rows], SCHEMA)
    model = compression.Model(staged(compression.count_grams(docs)))
    known = model.known()
    seen = [r["g"] >> 8 for r in known.orderBy(F.xxhash64("g")).limit(3).collect()]
    strange = int.from_bytes(b"\xff\xfeqqq", "big")
    half = [(strange << 8 * k | c & ((1 << 8 * k) - 1)) & ((1 << 40) - 1) for k, c in zip((1, 2, 4), seen)]
    for context in [*seen, *half, strange]:
        every = spark.range(256).select((F.col("id") + F.lit(context << 8)).alias("g"))
        own = every.join(known.select("g", "v"), "g")
        rest = model.unseen(every.join(known.select("g"), "g", "left_anti"))
        values = [r["v"] for r in own.union(rest).collect()]
        assert len(values) == 256
        assert sum(10**v for v in values) == pytest.approx(1)


def test_without_training_texts_and_without_texts(spark):
    ready(spark)
    out = next(i for i in range(100) if held(i))
    docs = spark.createDataFrame([(out, "ab", 1, "clash")], SCHEMA)
    row = compression.score_texts(docs).first()
    assert row["score"] == pytest.approx(-3 * log10(256)) and row["train_tokens"] == 0
    assert compression.score_texts(docs.limit(0)).collect() == []
