import pytest
from pyspark.sql import functions as F

from larder import catalog
from larder.operators import joins

SF = "/root/testdata/sf0.001"


@pytest.fixture
def skewed(spark):
    """A third of all rows under key 7, and some keys that the lookup lacks."""
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 200).alias("k"),
        F.col("id").alias("v"),
    )
    lookup = spark.range(150).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    return rows, lookup


def values(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()))


def test_hot_keys_get_shares_in_proportion(skewed):
    rows, _ = skewed
    hot = {r.k: r._shares for r in joins.hot_keys(rows, "k", hot_rows=100).collect()}
    n = rows.filter("k = 7").count()
    assert hot == {7: -(-n // 100)}
    assert joins.hot_keys(rows, "k", hot_rows=10_000).isEmpty()


def test_sampling_finds_hot_keys(spark):
    rows = spark.range(400_000).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k")
    )
    hot = joins.hot_keys(rows, "k", hot_rows=20_000).collect()
    assert [r.k for r in hot] == [-1]
    assert 5 <= hot[0]._shares <= 9


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("hot_rows", [50, 1_000_000])
def test_spread_join_equals_a_plain_join(skewed, how, hot_rows, monkeypatch):
    monkeypatch.setattr(joins, "HOT_ROWS", hot_rows)
    rows, lookup = skewed
    hot = joins.find_hot_keys(rows, "k")
    assert (hot is None) == (hot_rows > 50)
    joined = joins.spread_join(rows, lookup, "k", ["v"], hot, how)
    plain = rows.join(lookup, "k", how)
    assert values(joined, *plain.columns) == values(plain, *plain.columns)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("hot_rows", [50, 1_000_000])
@pytest.mark.parametrize("null_shares", [1, 4])
def test_tasks_of_a_join_follow_the_rows(spark, skewed, how, hot_rows, null_shares, monkeypatch):
    """However well rows compress, a task takes no more than its number of them."""
    monkeypatch.setattr(joins, "HOT_ROWS", hot_rows)
    rows, lookup = skewed
    rows = rows.union(spark.range(40).selectExpr("CAST(NULL AS BIGINT) AS k", "id AS v"))
    hot = joins.find_hot_keys(rows, "k")
    plain = rows.join(lookup, "k", how)
    expected = sorted(map(str, plain.collect()))
    monkeypatch.setattr(joins, "TASK_ROWS", 100)
    assert joins.tasks_for(spark, 100) is None
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        joined = joins.spread_join(
            rows, lookup, "k", ["v"], hot, how, null_shares=null_shares, rows=rows.count()
        )
        text = joined._jdf.queryExecution().executedPlan().toString()
        assert text.count("SortMergeJoin") == 1 or how == "left_anti"  # not one for each part of the union
        assert text.count(", 31), REPARTITION_BY_NUM") == 2 or how == "left_anti"
        assert sorted(map(str, joined.select(*plain.columns).collect())) == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_rows_decide_whether_a_join_is_dealt(spark, tmp_path, monkeypatch):
    """A lookup that is small only as a compressed file does not keep Spark's number of tasks."""
    monkeypatch.setattr(joins, "TASK_ROWS", 1000)
    path = str(tmp_path / "lookup")
    spark.range(0, 20_000, 1, 1).selectExpr("id AS k", "7L AS w", "'a' AS name").write.parquet(path)
    numbers, texts = spark.read.parquet(path).select("k", "w"), spark.read.parquet(path)
    few = spark.read.parquet(path).select("k", "w").filter("k < 10")
    rows = spark.range(30_000).selectExpr("id % 25000 AS k", "id AS v")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "300000")
        for lookup in (numbers, texts, few):  # the file bounds the rows, not the filter
            estimate = lookup._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
            assert estimate <= 300_000 < 20_000 * 24
            joined = joins.spread_join(rows, lookup, "k", ["v"], None, rows=30_000)
            text = joined._jdf.queryExecution().executedPlan().toString()
            assert text.count(", 30), REPARTITION_BY_NUM") == 2
            plain = rows.join(lookup, "k")
            assert values(joined, *plain.columns) == values(plain, *plain.columns)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1000000")
        joined = joins.spread_join(rows, numbers, "k", ["v"], None, rows=30_000)
        assert "REPARTITION" not in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_large_lookups_are_cleaned_in_the_tasks_of_their_joins(spark, monkeypatch):
    """Orders and products are not grouped in Spark's own number of tasks, and move once."""
    plain = catalog._fact(spark, SF)
    expected = sorted(map(str, plain.collect()))
    monkeypatch.setattr(joins, "TASK_ROWS", 150)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        # the names are sent, the products not
        monkeypatch.setattr(joins.Size, "fits_broadcast", lambda size, *limits: size.rows < 200)
        found = catalog._fact(spark, SF)
        text = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    lines = joins.most_rows(catalog._merged(spark, SF))
    for key in ("order_id", "product_id"):  # the lines and the lookup, and no exchange besides
        moves = [move for move in text.split("Exchange ") if move.startswith(f"hashpartitioning({key}#")]
        assert len(moves) == 2
        assert all(f", {-(-lines // 150)}), REPARTITION_BY_NUM" in move for move in moves)
    assert text.count("SortMergeJoin") == 2 and text.count("BroadcastHashJoin") == 2
    assert sorted(map(str, found.collect())) == expected


def test_many_copies_of_a_lookup_key_are_merged_before_they_move(spark, monkeypatch):
    monkeypatch.setattr(joins, "TASK_ROWS", 1000)
    monkeypatch.setattr(joins, "HOT_ROWS", 500)
    even = spark.range(30_000).select(F.col("id").alias("k"))
    copies = even.selectExpr("if(k % 3 = 0, 7, k) AS k")
    assert joins.lookup_tasks(even, "k", 50_000) == 50
    assert joins.lookup_tasks(even, "k", 10) == 30
    assert joins.lookup_tasks(even.limit(900), "k", 50_000) is None
    assert joins.lookup_tasks(copies, "k", 50_000) is None


def test_hot_keys_are_bounded_by_partitions(spark, monkeypatch):
    """However many keys are large, few are hot, since the limit follows the table."""
    monkeypatch.setattr(joins, "HOT_ROWS", 50)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = spark.range(100_000).select((F.col("id") % 1000).alias("k"))  # 100 rows each
    assert joins.hot_keys(rows, "k", hot_rows=50).count() == 1000
    assert joins.find_hot_keys(rows, "k") is None
    skewed = rows.union(spark.range(100_000).selectExpr("-1L AS k"))
    hot = joins.find_hot_keys(skewed, "k")
    assert [r.k for r in hot.collect()] == [-1]
    assert hot.first()._shares <= joins.HOT_KEYS * partitions


def test_a_hot_key_is_divided(skewed):
    rows, lookup = skewed
    joined = joins.spread_join(rows, lookup, "k", ["v"], joins.hot_keys(rows, "k", hot_rows=100))
    shares = joined.filter("k = 7").groupBy(joins.SALT).count().collect()
    total = rows.filter("k = 7").count()
    assert len(shares) == -(-total // 100)
    assert max(r["count"] for r in shares) < total / 4
    assert joined.filter("k != 7").select(joins.SALT).distinct().collect()[0][0] == 0


def test_small_sides_are_measured_before_they_are_broadcast(spark, skewed):
    _, lookup = skewed
    assert joins.fits_broadcast(lookup)
    assert not joins.fits_broadcast(lookup, max_rows=149)
    wide = spark.range(10).select(F.repeat(F.lit("x"), 1000).alias("text"))
    assert not joins.fits_broadcast(wide, max_bytes=5000)
    assert joins.fits_broadcast(wide.limit(0))


@pytest.mark.parametrize("how", ["inner", "left_semi"])
def test_a_lookup_beyond_the_limit_takes_the_other_way(skewed, monkeypatch, how):
    rows, lookup = skewed
    plain = rows.join(lookup, "k", how)
    small = joins.lookup_join(rows, lookup, "k", ["v"], how)
    monkeypatch.setattr(joins, "fits_broadcast", lambda df: False)
    large = joins.lookup_join(rows, lookup, "k", ["v"], how)
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
    assert joins.SALT not in large.columns
    assert values(small, *plain.columns) == values(large, *plain.columns)
    assert values(small, *plain.columns) == values(plain, *plain.columns)
