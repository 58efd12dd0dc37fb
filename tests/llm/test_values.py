"""Values recomputed outside Spark: fingerprints with their likeness, and token ids."""

import hashlib
import random

import pytest
import xxhash

from larder.llm import fingerprints, packing
from larder.llm.common import ready
from larder.llm.queries import word_bpe

SCHEMA = "doc_id long, text string, n_chars string, fingerprint int"


def chained(*values):
    """Spark's hash of several columns: each one is the seed of the next; nulls are left out."""
    seed = 42
    for v in values:
        if v is not None:
            data = v.to_bytes(4, "little") if isinstance(v, int) else v.encode()
            seed = xxhash.xxh64_intdigest(data, seed)
    return seed


def simhash(text):
    words = text.encode().split()
    words = [w.decode() for w in words]
    if not words:
        return 0
    total, votes = 0, [0] * 128
    for k in range(max(len(words) - 1, 1)):
        one, two = words[k], words[k + 1] if k + 1 < len(words) else None
        weight = min(len(one.encode()) + len((two or "").encode()), fingerprints.LONGEST_TERM)
        total += weight
        both = chained(one, two) << 64 | chained(1, one, two)
        for bit in range(128):
            votes[bit] += weight * (both >> bit & 1)
    return sum(1 << bit for bit in range(128) if 2 * votes[bit] > total)


def brute(rows):
    texts = [t or "" for _, t in sorted(rows)]
    out = {}
    for k, (doc, _) in enumerate(sorted(rows)):
        text, after = texts[k], texts[(k + 1) % len(texts)]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        prints = [simhash(t) for t in (text, edited, after)]
        like = [1 - (prints[0] ^ p).bit_count() / 128 for p in prints[1:]]
        digest = hashlib.sha256(edited.encode()).hexdigest()
        out[doc] = (len(text), digest, f"{prints[0]:032x}", f"{prints[1]:032x}", *like)
    return out


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(6)
    words = ["".join(rng.choices("abcé漢🙂", k=rng.randint(1, 20))) for _ in range(30)]
    rows = [(k, " ".join(rng.choices(words, k=rng.randint(0, 60)))) for k in range(0, 120, 3)]
    return [*rows, (1, None), (2, " \t"), (4, "one"), (5, "w" * 500 + " x")]


def test_fingerprints_by_brute_force(spark, rows):
    docs = spark.createDataFrame([(i, t, "clash", 1) for i, t in rows], SCHEMA)
    got = fingerprints.fingerprint_report(docs).collect()
    found = {
        r["doc_id"]: (
            r["n_chars"], r["edited_sha256"], r["fingerprint"], r["edited_fingerprint"],
            r["near_edited"], r["near_next"],
        )
        for r in got
    }
    assert len(got) == len(rows) and found == brute(rows)


def test_repeated_rows_do_not_multiply(spark, rows):
    many = rows[:3] * 60
    docs = spark.createDataFrame([(i, t, "clash", 1) for i, t in many], SCHEMA)
    assert fingerprints.edited_pairs(docs).count() == 3
    got = fingerprints.fingerprint_report(docs).collect()
    assert {r["doc_id"]: r["fingerprint"] for r in got} == {i: v[2] for i, v in brute(rows[:3]).items()}


def test_texts_with_special_tokens_have_the_tokenizers_ids(spark):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(word_bpe())
    texts = ["x <|endoftext|> y", "<|startoftext|>a b", "x<|EndOfText|>", "no <| special", "<|endoftext|>" * 3]
    known = packing.WordIds(word_bpe())
    for text in texts:
        want = plain.encode(text, add_special_tokens=False).ids
        assert [int.from_bytes(known.of(text.encode())[k : k + 4], "little") for k in range(0, 4 * len(want), 4)] == want
        assert len(known.of(text.encode())) == 4 * len(want)
    ready(spark)
    docs = spark.createDataFrame([(k, t, "clash", 1) for k, t in enumerate(texts)], SCHEMA)
    got = {r["doc_id"]: r["length"] for r in packing.pieces(docs, word_bpe()).collect()}
    assert got == {k: len(plain.encode(t, add_special_tokens=False).ids) + 1 for k, t in enumerate(texts)}
