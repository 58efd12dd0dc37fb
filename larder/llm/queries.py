"""The registered queries of the text operators, and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from larder.llm import (
    alignment,
    bands,
    compression,
    decontaminate,
    fingerprints,
    near,
    packing,
    pii,
    prefix_trie,
    quality,
    shards,
    substrings,
    toxicity,
)
from larder.llm.common import documents, ready


def word_bpe() -> str:
    """The vocabulary file for packing, from the installed package of public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_report(documents(spark, sf_dir))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    return substrings.remove_repeats(documents(spark, sf_dir)).drop("kept")


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.contained_items(documents(spark, sf_dir), items)


def op4_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.shard_by_bytes(documents(spark, sf_dir))


def op5_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    return near.near_components(documents(spark, sf_dir))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.score_quality(documents(spark, sf_dir), labels)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.score_toxicity(documents(spark, sf_dir), labels)


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    return compression.score_texts(documents(spark, sf_dir))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(documents(spark, sf_dir))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    return packing.pack(documents(spark, sf_dir), word_bpe())


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ready(spark)
    files = map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.align(documents(spark, sf_dir), *files)


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    return bands.judge_rules(documents(spark, sf_dir))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    return prefix_trie.prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


QUERIES = {
    "op1_fingerprints": op1_fingerprints,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_decontaminate": op3_decontaminate,
    "op4_shards": op4_shards,
    "op5_simhash_dedup": op5_simhash_dedup,
    "op6_quality": op6_quality,
    "op7_toxicity": op7_toxicity,
    "op8_lm_scoring": op8_lm_scoring,
    "op9_pii": op9_pii,
    "op10_packing": op10_packing,
    "op11_alignment": op11_alignment,
    "op12_quality_rules": op12_quality_rules,
    "op13_prefix_trie": op13_prefix_trie,
}

# the table of CRC-32 (a one-row relation), and the checksum of a list of bytes
_CRC_TABLE = """
        SELECT list_transform(range(256), lambda n: list_reduce(
          list_prepend(n, range(8)), lambda x, k: xor(x >> 1, (x & 1) * 3988292384))) AS crc"""


def _crc32(octets: str) -> str:
    return (
        f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {octets}), "
        "lambda x, o: xor(x >> 8, crc[(xor(x, o) & 255) + 1])), 4294967295)"
    )


# the bytes of a document, as a list of numbers
_OCTETS = """list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
                 lambda h: CAST(concat('0x', h) AS BIGINT))"""

# words of a document, as a list
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^ \t\n\v\f\r]+')"

ORACLES = {
    "op2_substring_dedup": rf"""
        WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
        s AS (
          SELECT doc_id, unnest(range(1, len(w) - 48)) AS i, w FROM d WHERE len(w) >= 50
        ),
        windows AS (SELECT doc_id, i, array_to_string(w[i : i + 49], ' ') AS x FROM s),
        owned AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY x) AS low FROM windows),
        gone AS (
          SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS k FROM owned WHERE low < doc_id
        ),
        lists AS (SELECT doc_id, list(k) AS ks FROM gone GROUP BY doc_id),
        kept AS (
          SELECT d.doc_id, len(w) AS n, coalesce(len(ks), 0) AS r,
                 CASE WHEN ks IS NULL THEN w
                      ELSE list_filter(w, lambda x, j: NOT list_contains(ks, j)) END AS k
          FROM d LEFT JOIN lists USING (doc_id)
        )
        SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(r AS BIGINT) AS n_removed,
               sha256(array_to_string(k, ' ')) AS kept_sha256
        FROM kept""",
    "op3_decontaminate": rf"""
        WITH d AS (SELECT doc_id, {_WORDS.replace("text", "lower(text)")} AS w FROM documents),
        b AS (SELECT item_id, {_WORDS.replace("text", "lower(text)")} AS w FROM benchmark),
        bs AS (
          SELECT DISTINCT item_id, least(5, len(w)) AS k,
                 array_to_string(w[i : i + least(5, len(w)) - 1], ' ') AS x
          FROM (SELECT item_id, w, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS i
                FROM b WHERE len(w) > 0)
        ),
        ks AS (SELECT DISTINCT k FROM bs),
        ds AS (
          SELECT DISTINCT doc_id, k, array_to_string(w[i : i + k - 1], ' ') AS x
          FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i
                FROM d, ks WHERE len(w) >= k)
        ),
        n AS (SELECT item_id, count(*) AS n_item FROM bs GROUP BY item_id),
        m AS (
          SELECT doc_id, item_id, count(*) AS n_shared
          FROM ds JOIN bs USING (k, x) GROUP BY doc_id, item_id
        )
        SELECT doc_id, item_id, n_shared, n_item, n_shared / n_item AS containment
        FROM m JOIN n USING (item_id) WHERE n_shared / n_item >= 0.8""",
    # shards by running bytes: the same sums as windows over the whole table
    "op4_shards": rf"""
        WITH crcs AS ({_CRC_TABLE}),
        d AS (
          SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 1 AS size,
                 {_crc32(_OCTETS)} AS crc
          FROM documents CROSS JOIN crcs
        ),
        r AS (
          SELECT *, sum(size) OVER (ORDER BY doc_id NULLS FIRST, size, crc ROWS UNBOUNDED PRECEDING) AS upto,
                 sum(size) OVER () AS total
          FROM d
        ),
        s AS (
          SELECT *, CAST(least(floor((upto - size / 2) * 8 / total), 7) AS INTEGER) AS shard FROM r
        )
        SELECT doc_id, size, crc AS text_crc32, 'bytes' AS law, shard,
               row_number() OVER (PARTITION BY shard ORDER BY upto) - 1 AS slot,
               CAST(NULL AS INTEGER) AS grown_shard
        FROM s""",
    "op13_prefix_trie": rf"""
        WITH crcs AS ({_CRC_TABLE}),
        t AS (
          SELECT conv_id AS c, md5(concat(length(coalesce(role, '')), ':', role, text)) AS m,
                 octet_length(encode(coalesce(text, ''))) AS octets,
                 row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS i
          FROM conversations WHERE conv_id IS NOT NULL
        ),
        n AS (SELECT c, count(*) AS n FROM t GROUP BY c),
        h AS (
          SELECT n.c, n.c - n.c % 5 AS base, coalesce(b.n, 0) AS n_base,
                 {_crc32("list_transform(string_split(CAST(n.c AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT))")}
                 % 9 AS h
          FROM n CROSS JOIN crcs LEFT JOIN n b ON b.c = n.c - n.c % 5
        ),
        turns AS (
          SELECT h.c, i AS d, m, octets FROM h JOIN t ON t.c = base AND i <= h
          UNION ALL
          SELECT h.c, least(h, n_base) + i - h, m, octets FROM h JOIN t ON t.c = h.c AND i > h
        ),
        paths AS (
          SELECT c, d, md5(string_agg(m, '') OVER (PARTITION BY c ORDER BY d)) AS k, octets FROM turns
          UNION ALL SELECT c, 0, '', 0 FROM h
        ),
        linked AS (SELECT *, lag(k) OVER (PARTITION BY c ORDER BY d) AS p,
                          d = max(d) OVER (PARTITION BY c) AS last FROM paths),
        nodes AS (
          SELECT k, min(c) AS c, min(d) AS d, min(p) AS p, count(*) AS n,
                 (count(*) - 1) * min(octets) AS saved,
                 string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE last) AS ends
          FROM linked GROUP BY k
        ),
        kids AS (SELECT p AS k, count(*) AS kids FROM nodes GROUP BY p),
        pairs AS (SELECT DISTINCT a.k, b.k AS under FROM paths a JOIN paths b ON a.c = b.c AND b.d >= a.d),
        sums AS (
          SELECT pairs.k, count(*) FILTER (WHERE kids IS NULL) AS leaves, sum(saved) AS saved
          FROM pairs JOIN nodes u ON u.k = under LEFT JOIN kids ON kids.k = under GROUP BY pairs.k
        )
        SELECT v.c AS conv_id, CAST(v.d AS BIGINT) AS depth, up.c AS parent_conv_id, v.n AS n_convs,
               CAST(coalesce(kids, 0) AS BIGINT) AS n_children, CAST(leaves AS BIGINT) AS n_leaves,
               CAST(sums.saved AS BIGINT) AS saved_tokens, sha256(coalesce(v.ends, '')) AS ends_sha256
        FROM nodes v JOIN sums USING (k) LEFT JOIN kids USING (k) LEFT JOIN nodes up ON up.k = v.p""",
}
