"""Cross-tokenizer alignment against a plain walk over both tokenizations."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from larder.llm import alignment
from larder.llm.common import ready

public_tokenizers = pytest.importorskip("public_tokenizers")
BYTES, PIECES = map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model"))
SCHEMA = "doc_id long, text string, n_a string, chunk int"


def spans(parts):
    ends = np.cumsum([len(p) for p in parts]).tolist()
    return list(zip([0, *ends], ends))


def brute(rows):
    import sentencepiece
    from tokenizers import Tokenizer

    side_a = Tokenizer.from_file(BYTES)
    side_a.encode_special_tokens = True
    side_b = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    symbols, token = alignment.byte_symbols(), {i: t for t, i in side_a.get_vocab().items()}

    def piece(i):
        name = side_b.id_to_piece(i)
        return bytes([int(name[3:5], 16)]) if side_b.is_byte(i) else name.replace("▁", " ").encode()

    found = []
    for doc, text in rows:
        a = side_a.encode(f" {text}", add_special_tokens=False).ids if text else []
        b = side_b.encode(text) if text else []
        a_parts, b_parts = [bytes(symbols[c] for c in token[i]) for i in a], [piece(i) for i in b]
        if not text or not b"".join(a_parts) == b"".join(b_parts) == f" {text}".encode():
            found.append((doc, 0, 0, [], ""))
            continue
        a_spans, b_spans = spans(a_parts), spans(b_parts)
        ends = sorted({e for _, e in a_spans} & {e for _, e in b_spans})
        groups = [
            "|".join(
                ",".join(str(i) for i, (s, e) in zip(ids, where) if low <= s and e <= high)
                for ids, where in ((a, a_spans), (b, b_spans))
            )
            for low, high in zip([0, *ends], ends)
        ]
        links = [
            (i, j)
            for i, (s, e) in zip(a, a_spans)
            for j, (t, f) in zip(b, b_spans)
            if s < f and t < e
        ]
        found.append((doc, len(a), len(b), links, ";".join(groups)))
    count = Counter(pair for *_, links, _ in found for pair in set(links))
    best = defaultdict(int)
    for (i, _), n in count.items():
        best[i] = max(best[i], n)
    return [
        (
            doc, n_a, n_b, groups.count(";") + 1 if groups else 0, len(links),
            sum(count[p] == best[p[0]] for p in links), sum(count[p] for p in links),
            hashlib.sha256(groups.encode()).hexdigest() if groups else "",
        )
        for doc, n_a, n_b, links, groups in found
    ]


def in_order(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[0] is None, *(v or 0 for v in r[:-1]), r[-1]))


def check(spark, rows, **options):
    ready(spark)
    docs = spark.createDataFrame([(i, t, "clash", 1) for i, t in rows], SCHEMA)
    found = alignment.align(docs, BYTES, PIECES, **options)
    assert found.columns == [
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256",
    ]
    assert in_order(found.collect()) == in_order(brute(rows))


def test_awkward_texts(spark):
    rng = random.Random(1)
    signs = "ab cde  \n\t  é漢🙂́ ▁'s'll1234,.!<|endoftext|>\x1c\x00"
    rows = [(i, "".join(rng.choices(signs, k=rng.randint(0, 60)))) for i in range(300)]
    rows += [(1000, None), (None, "x y"), (None, "x y"), (5, ""), (7, "x <|endoftext|> y"), (7, "x y")]
    rows += [(8, "x" * 3000), (9, " "), (10, "a "), (11, " a"), (12, "\n"), (13, "a\n  b"), (14, "a\n b"), (15, "a\n")]
    check(spark, rows)


def test_documents_in_many_chunks(spark, monkeypatch):
    """Small chunks and few runs at a time, so that every merge is taken."""
    monkeypatch.setattr(alignment.Chunk, "full", property(lambda chunk: chunk.n >= 300))
    monkeypatch.setattr(alignment, "FAN_IN", 3)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(120)
    check(spark, [(r.doc_id, r.text[:1500]) for r in docs.collect()], radix=3, spread=2)


def test_empty_table(spark):
    check(spark, [])


def test_columns_of_numbers_come_back():
    columns = [np.arange(5), np.array([], np.int64), np.array([1 << 40, 3]), np.array([70000])]
    back = alignment.unpacked(alignment.packed(*columns))
    assert [c.tolist() for c in back] == [c.tolist() for c in columns]


def test_heap_merge_adds_counts():
    runs = [(np.array([1, 7, 12]), np.array([1, 2, 3])), (np.array([7, 30]), np.array([5, 1]))]
    merged = [(c.tolist(), n.tolist()) for c, n in alignment.heap_merged(runs, 10)]
    assert merged == [([1, 7], [1, 7]), ([12], [3]), ([30], [1])]
