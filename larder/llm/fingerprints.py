"""Operator 1, document fingerprints: SimHash and permuted block tables."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.common import in_order, words_of
from larder.llm.simhash import hex16, majority, vote_sums
from larder.sources.workspace import staged

BITS = 128
LONGEST_TERM = 31  # a term weighs its bytes, at most this


def identity() -> list[Column]:
    """What tells documents apart: doc_id, or that there is none, and a hash of the text."""
    return [
        F.coalesce(F.col("doc_id"), F.lit(0)).alias("_id"),
        F.col("doc_id").isNull().alias("_none"),
        F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("_k"),
    ]


def fingerprints(texts: DataFrame, *ids: str) -> DataFrame:
    """128-bit SimHash of ``text``, as 32 hex digits, for each distinct ``ids``.

    Terms are pairs of adjacent words (a single word where there is only one), as
    often as they occur.  A term weighs its bytes, so pairs of short, frequent words
    say little.  Each bit of its two 64-bit hashes votes with that weight; a bit is
    set if over half of the weight is for it.  Null, empty and blank texts have no
    terms and the fingerprint of zeros.
    """
    split = texts.select(*ids, words_of(F.col("text")).alias("_w"))
    last = F.greatest(F.size("_w") - 2, F.lit(0))
    terms = split.select(*ids, "_w", F.explode(F.sequence(F.lit(0), last)).alias("_i"))
    one, two = F.get("_w", F.col("_i")), F.get("_w", F.col("_i") + 1)
    size = F.coalesce(F.octet_length(one), F.lit(0)) + F.coalesce(F.octet_length(two), F.lit(0))
    hashed = terms.select(
        *ids,
        F.xxhash64(one, two).alias("_a"),
        F.xxhash64(F.lit(1), one, two).alias("_b"),
        F.least(size, F.lit(LONGEST_TERM)).cast("long").alias("_weight"),
    )
    votes = hashed.groupBy(*ids).agg(
        F.sum("_weight").alias("_total"),
        *vote_sums(F.col("_a"), F.col("_weight"), "_a"),
        *vote_sums(F.col("_b"), F.col("_weight"), "_b"),
    )
    total = F.col("_total")
    return votes.select(
        *ids,
        F.concat(hex16(majority("_a", total)), hex16(majority("_b", total))).alias("fingerprint"),
    )


def distance(a: Column, b: Column) -> Column:
    """Differing bits of two fingerprints of 32 hex digits."""
    return sum(
        F.bit_count(half(a, i).bitwiseXOR(half(b, i))) for i in (0, 1)
    )


def half(fingerprint: Column, i: int) -> Column:
    """64 of the 128 bits as a long."""
    digits = F.substring(fingerprint, 16 * i + 1, 16)
    high = F.conv(F.substring(digits, 1, 8), 16, 10).cast("long")
    low = F.conv(F.substring(digits, 9, 8), 16, 10).cast("long")
    return F.shiftleft(high, 32).bitwiseOR(low)


def within_radius(queries: DataFrame, table: DataFrame, radius: int = 3) -> DataFrame:
    """All (query, match) pairs of distinct fingerprints at ``radius`` bits or fewer.

    The 32 hex digits are cut into ``radius + 2`` blocks.  Fingerprints within the
    radius differ in at most ``radius`` blocks, so at least two agree: there is one
    table for each two blocks, keyed by them, as if the bits were permuted to bring
    the two to the front.  A pair is reported by the first table in which it meets.
    """
    count = radius + 2
    edges = [round(BITS // 4 * i / count) for i in range(count + 1)]
    tables = list(combinations(range(count), 2))

    def block(fingerprint: Column, k: int) -> Column:
        return F.substring(fingerprint, edges[k] + 1, edges[k + 1] - edges[k])

    def keyed(df: DataFrame, name: str) -> DataFrame:
        f = F.col("fingerprint")
        keys = F.array(*[F.concat(block(f, i), block(f, j)) for i, j in tables])
        return df.select("fingerprint").distinct().select(
            f.alias(name), F.posexplode(keys).alias("_table", "_key")
        )

    q, t = F.col("query"), F.col("match")
    met = F.coalesce(
        *[
            F.when((block(q, i) == block(t, i)) & (block(q, j) == block(t, j)), F.lit(n))
            for n, (i, j) in enumerate(tables)
        ]
    )
    left, right = keyed(queries, "query"), keyed(table, "match")
    same = (left["_table"] == right["_table"]) & (left["_key"] == right["_key"])
    close = (met == left["_table"]) & (distance(q, t) <= radius)
    return left.join(right, same & close).select("query", "match")


def edited_pairs(docs: DataFrame) -> DataFrame:
    """Each document's text, its edited text and the identity of the next document.

    Edited: the last floor(n/2) code points give way to the first as many (or all)
    of the next document's text, by ascending doc_id, the first after the last.
    Rows of equal doc_id and text are one document, here already.  Ids and lengths are
    put in order without the texts; then each text sends its first part to the
    document before it.  Columns: the key, next_ and the key, n,
    text, edited.
    """
    texts = docs.select(
        *identity(),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    key = ["_id", "_none", "_k"]
    ids = texts.select(*key, F.length("text").cast("long").alias("n")).distinct()
    order = in_order(ids.withColumn("_has", ~F.col("_none")), "_has", "_id", "_k")
    order = order.select(*key, "n", "pos")
    if order.count() < docs.count():  # rows that repeat would meet in both joins
        texts = texts.dropDuplicates(key)
    count = order.agg(F.count("*").alias("_count"))
    turned = order.crossJoin(F.broadcast(count)).withColumn(  # one row: the count
        "_next", F.pmod(F.col("pos") + 1, F.col("_count"))
    )
    nexts = order.select(*[F.col(k).alias(f"next{k}") for k in key], F.col("pos").alias("_next"))
    next_key = [f"next{k}" for k in key]
    links = staged(turned.join(nexts, "_next").select(*key, "n", *next_key))

    senders = links.select(
        *[F.col(f"next{k}").alias(k) for k in key], *[F.col(k).alias(f"to{k}") for k in key], "n"
    )
    parts = texts.join(senders, key).select(
        *[F.col(f"to{k}").alias(k) for k in key],
        *[F.col(k).alias(f"next{k}") for k in key],
        "n",
        F.substring("text", F.lit(1), F.floor(F.col("n") / 2).cast("int")).alias("_part"),
    )
    kept = (F.col("n") - F.floor(F.col("n") / 2)).cast("int")
    return texts.join(parts, key).select(
        *key,
        *next_key,
        "n",
        "text",
        F.concat(F.substring("text", F.lit(1), kept), F.col("_part")).alias("edited"),
    )


def fingerprint_report(docs: DataFrame, radius: int = 3, every: int = 100) -> DataFrame:
    """Fingerprints of all documents, of their edited texts, and close fingerprints.

    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next (share of equal bits with the edited text's and with the
    next document's fingerprint) and n_within: for documents whose id is divisible
    by ``every`` the number of documents, itself included, whose fingerprint differs
    in ``radius`` bits at most; null for the others.

    Null text counts as empty.  Rows of equal doc_id and text are one document; a
    doc_id with several texts gives a row for each, ordered by a hash of the text.
    A row without a doc_id comes first in the order.  A single document is its own
    next.  An empty table gives an empty result.
    """
    pairs = edited_pairs(docs)
    key = ["_id", "_none", "_k"]
    ids = [*key, *[f"next{k}" for k in key], "n", "sha"]
    texts = F.array(
        F.struct(F.lit(0).alias("edited"), F.col("text").alias("text")),
        F.struct(F.lit(1).alias("edited"), F.col("edited").alias("text")),
    )
    both = (
        pairs.withColumn("sha", F.sha2("edited", 256))
        .select(*ids, F.explode(texts).alias("_v"))
        .select(*ids, F.col("_v.edited").alias("_edited"), F.col("_v.text").alias("text"))
    )
    prints = fingerprints(both, *ids, "_edited")
    own = staged(
        prints.groupBy(*ids).agg(
            F.max(F.when(F.col("_edited") == 0, F.col("fingerprint"))).alias("fingerprint"),
            F.max(F.when(F.col("_edited") == 1, F.col("fingerprint"))).alias("edited_fingerprint"),
        )
    )
    after = own.select(
        *[F.col(k).alias(f"next{k}") for k in key], F.col("fingerprint").alias("_after")
    )
    joined = own.join(after, [f"next{k}" for k in key])
    counts = own.groupBy("fingerprint").agg(F.count("*").alias("_copies"))
    asked = own.filter((F.col("_id") % every == 0) & ~F.col("_none"))
    close = (
        within_radius(asked, counts, radius)
        .join(counts.withColumnRenamed("fingerprint", "match"), "match")
        .groupBy(F.col("query").alias("fingerprint"))
        .agg(F.sum("_copies").alias("n_within"))
    )
    found = asked.join(close, "fingerprint").select(*key, "n_within")
    like = lambda other: 1 - distance(F.col("fingerprint"), F.col(other)) / BITS
    return joined.join(found, key, "left").select(
        F.when(~F.col("_none"), F.col("_id")).alias("doc_id"),
        F.col("n").alias("n_chars"),
        F.col("sha").alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        like("edited_fingerprint").alias("near_edited"),
        like("_after").alias("near_next"),
        "n_within",
    )
