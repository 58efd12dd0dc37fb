"""Quality rules: counts against plain loops, bands by example."""

import base64
import random
import re
from collections import Counter

import pytest

from larder.llm import bands
from larder.llm.common import ready

SCHEMA = "doc_id long, text string, n_words string, kept string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {k + j for k in range(len(words) - 2) if windows[tuple(words[k : k + 3])] > 1 for j in range(3)}
    seen, doubled = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            doubled += line in seen
            seen.add(line)
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), doubled, len(covered),
        len(words) < 50 or 100 * len(covered) > 50 * len(words),
    )


def prose(rng, n):
    return " ".join("".join(rng.choices("etaoinshrdlu", k=rng.randint(2, 8))) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    signs = ["a", "b", "c", "é", "漢字", "🙂", "#", "|", "\n", "\n\n", "\t", "\x1c", " ", "\x0b"]
    rows = [(i, " ".join(rng.choices(signs, k=rng.randint(0, 80)))) for i in range(150)]
    rows += [(200, None), (201, ""), (202, " \n\t"), (203, "x y\nx y\n x y\nx y"), (None, "a b c a b c")]
    rows += [(204, prose(rng, 300)), (204, prose(rng, 300)), (205, prose(rng, 20_000)), (206, "word " * 400)]
    return rows + [(207, "x" * 100_000), (208, prose(rng, 49)), (209, prose(rng, 50))]


def test_counts(spark, rows):
    ready(spark)
    docs = spark.createDataFrame([(i, t, "clash", "clash") for i, t in rows], SCHEMA)
    found = bands.judge_rules(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"
    )
    key = lambda r: tuple(-1 if v is None else v for v in r)
    assert sorted(map(tuple, found.collect()), key=key) == sorted([(i, *base(t)) for i, t in rows], key=key)


def test_bands_reject_repetitive_and_incompressible_texts(spark):
    ready(spark)
    rng = random.Random(8)
    good = prose(rng, 2000)
    noise = base64.b64encode(rng.randbytes(9000)).decode()
    noise = " ".join(noise[k : k + 60] for k in range(0, len(noise), 60))
    # new words each time, so the base rules do not see the repetition
    template = "\n".join(f"item{k:05} was sold on the usual day to the usual place for no more" for k in range(400))
    half = prose(rng, 1000) + " " + noise
    long = [(1, good), (2, noise), (3, template), (4, half), (5, good[:400]), (6, prose(rng, 20_000))]
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in long], SCHEMA)
    verdict = {r.doc_id: (r.base_failed, r.kept) for r in bands.judge_rules(docs).collect()}
    assert {i: kept for i, (_, kept) in verdict.items()} == {1: True, 2: False, 3: False, 4: False, 5: True, 6: True}
    assert not verdict[2][0] and not verdict[4][0]
    stay = bands.without_rejects(docs)
    assert stay.columns == docs.columns
    assert sorted(r.doc_id for r in stay.collect()) == [1, 5, 6]


def test_limits_depend_on_length():
    assert bands.in_band(300, 200) and not bands.in_band(3000, 2500)
    assert bands.in_band(3000, 3000 // 4) and not bands.in_band(300, 300 // 5)


def test_empty_table(spark):
    ready(spark)
    docs = spark.createDataFrame([], SCHEMA)
    assert bands.judge_rules(docs).collect() == []
    assert bands.without_rejects(docs).collect() == []
