"""Operator 12, quality rules: word and line counts, and bands of compression ratios."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame

from larder.llm.common import BLANKS, by_batch

LEVEL = 3
CHUNK = 2048  # bytes
BAD_SHARE = 0.2  # of the chunks that may lie outside their band
# (fewer bytes than this, least ratio, greatest ratio); short texts compress less
BANDS = (
    (512, 1.1, 4.0),
    (1024, 1.2, 4.0),
    (8192, 1.4, 5.0),
    (65536, 1.5, 6.0),
    (None, 1.6, 8.0),
)
SYMBOLS = b"#*$%&|<>"
_BLANK = BLANKS.encode()


def in_band(size: int, packed: int, bands: tuple = BANDS) -> bool:
    """Whether ``size`` bytes that take ``packed`` compressed lie within their limits."""
    for below, least, greatest in bands:
        if below is None or size < below:
            return least * packed <= size <= greatest * packed
    return True


def repeated_words(words: list[bytes]) -> int:
    """How many words lie in a window of three that the text holds twice or more."""
    n = len(words)
    if n < 4:
        return 0
    # words, pairs and triples become numbers below n one after another, so none clash
    code = pd.factorize(np.array(words, object))[0].astype(np.int64)
    pair = pd.factorize(code[:-1] * n + code[1:])[0].astype(np.int64)
    triple = pd.factorize(pair[:-1] * n + code[2:])[0]
    often = np.bincount(triple)[triple] > 1
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[k : n - 2 + k] |= often
    return int(covered.sum())


def repeated_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split(b"\n") if line.strip(_BLANK)]
    return len(lines) - len(set(lines))


def judged(text: bytes, squeeze, bands: tuple, chunk: int) -> tuple:
    """Columns n_words and n_symbols to n_bad_chunks of one text, in their order."""
    words = text.split()
    repeats = repeated_words(words)
    failed = len(words) < 50 or 100 * repeats > 50 * len(words)
    size, packed = len(text), len(squeeze(text))
    parts = [text[at : at + chunk] for at in range(0, size, chunk)]
    bad = sum(not in_band(len(p), len(squeeze(p)), bands) for p in parts)
    fits = in_band(size, packed, bands) and bad <= BAD_SHARE * len(parts)
    symbols = size - len(text.translate(None, SYMBOLS))
    return (
        len(words), symbols, repeated_lines(text), repeats, failed, fits and not failed,
        size / packed, len(parts), bad,
    )


COLUMNS = {
    "n_words": pa.int64(), "n_symbols": pa.int64(), "n_dup_lines": pa.int64(),
    "n_repeat_words": pa.int64(), "base_failed": pa.bool_(), "kept": pa.bool_(),
    "ratio": pa.float64(), "n_chunks": pa.int64(), "n_bad_chunks": pa.int64(),
}


def judge_rules(docs: DataFrame, bands: tuple = BANDS, chunk: int = CHUNK) -> DataFrame:
    """Counts of every whole text and the verdict of the rules, a row for each document.

    n_words, word_chars (code points in words), n_symbols, n_dup_lines, n_repeat_words
    and base_failed (fewer than 50 words, or more than half of them in repeated windows
    of three) are plain counts.  kept is false if base_failed; else it asks two things
    of zstandard: the ratio of the whole text lies within the limits for its length,
    and of its chunks of ``chunk`` bytes (the last one may be shorter and has the limits
    of its own length) at most a fifth lie outside theirs.  Ratios above say repetitive,
    below incompressible.  ratio (0 for texts without bytes), n_chunks and n_bad_chunks
    show what was measured; ``bands`` is a list of (fewer bytes than, least, greatest).

    Null, empty and blank texts have no words and fail.  A very long text is held once,
    in the task that reads it, and is compressed chunk by chunk as any other.  Each
    row is judged on its own, so there are no ties, rows that repeat or have no doc_id
    have results like others, and other columns are not read.  An empty table gives an
    empty result.
    """

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        squeeze = zstandard.ZstdCompressor(level=LEVEL).compress
        filled = pc.fill_null(batch.column("text"), "")
        texts = pc.cast(filled, pa.large_binary()).to_pylist()
        found = zip(*[judged(t, squeeze, bands, chunk) for t in texts], strict=True)
        out = {"doc_id": batch.column("doc_id")}
        out |= {name: pa.array(c, COLUMNS[name]) for name, c in zip(COLUMNS, found, strict=True)}
        blanks = [len(t) - len(t.translate(None, _BLANK)) for t in texts]
        out["word_chars"] = pc.subtract(pc.cast(pc.utf8_length(filled), pa.int64()), pa.array(blanks, pa.int64()))
        return pa.RecordBatch.from_pydict(out)

    return by_batch(
        docs.select("doc_id", "text"),
        work,
        "doc_id long, n_words long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "base_failed boolean, kept boolean, ratio double, n_chunks long, n_bad_chunks long, "
        "word_chars long",
    )


def without_rejects(docs: DataFrame, bands: tuple = BANDS, chunk: int = CHUNK) -> DataFrame:
    """The documents that the rules keep, as ``judge_rules`` says, with all their columns.

    Each row is decided by its own text.
    """
    at = docs.columns.index("text")
    verdict = list(COLUMNS).index("kept")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        squeeze = zstandard.ZstdCompressor(level=LEVEL).compress
        texts = pc.cast(pc.fill_null(batch.column(at), ""), pa.large_binary()).to_pylist()
        return batch.filter(pa.array([judged(t, squeeze, bands, chunk)[verdict] for t in texts], pa.bool_()))

    return by_batch(docs, work, docs.schema)
