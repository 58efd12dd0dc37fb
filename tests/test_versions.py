"""Versions of tables, stages that go on after a break, and plans without measuring jobs."""

import subprocess
import sys
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from larder import LarderError, adapters, catalog, tables
from larder.operators import cleaning, joins, kpis, quality, star
from larder.plans import gold, ingest, silver
from larder.plans.stage import Stage
from larder.sources import csv, footers, parquet
from larder.sources.workspace import staged

SF = "/root/testdata/sf0.001"
REPO = Path(__file__).resolve().parents[1]


class Jobs:
    """Counts the jobs that a block starts, in its threads too."""

    def __init__(self, spark):
        self.context = spark.sparkContext

    def __enter__(self):
        self.group = uuid.uuid4().hex
        self.context.setLocalProperty("spark.jobGroup.id", self.group)
        return self

    def __exit__(self, *_):
        self.context.setLocalProperty("spark.jobGroup.id", None)

    @property
    def number(self):
        return len(self.context.statusTracker().getJobIdsForGroup(self.group))


def versions(root, name):
    return {p.name for p in (Path(root) / name).glob(f"{parquet.VERSION}*")}


# --- sinks -------------------------------------------------------------------


def test_a_write_that_fails_leaves_the_former_table(spark, tmp_path):
    root = str(tmp_path)
    assert parquet.write_table(spark.range(5), root, "t") == 5
    broken = spark.range(100).selectExpr("if(id = 99, raise_error('lost'), id) AS id")
    with pytest.raises(Exception, match="lost"):
        parquet.write_table(broken, root, "t")
    assert parquet.read_table(spark, root, "t").count() == 5
    reader = parquet.read_table(spark, root, "t")
    assert parquet.write_table(spark.range(7), root, "t") == 7
    # who has planned on the former version can still read it; what was left half-way is gone
    assert reader.count() == 5 and parquet.read_table(spark, root, "t").count() == 7
    shown = parquet.published(spark, root, "t")
    assert versions(root, "t") == {shown.id, shown.former}
    assert not (tmp_path / "t" / parquet.READY).exists()


KILLED = """
import os, signal, sys, threading, time
from pathlib import Path
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
from larder.sources import parquet
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
parquet.write_table(spark.range(5), {root!r}, "t")

def slow(batches):
    for batch in batches:
        yield batch
        time.sleep(60)

def end():
    # two folders, the second one still being written
    while len(list(Path({root!r}, "t").glob("v-*"))) < 2:
        time.sleep(0.1)
    time.sleep(2)
    os.kill(os.getpid(), signal.SIGKILL)

threading.Thread(target=end, daemon=True).start()
parquet.write_table(spark.range(1000).mapInArrow(slow, "id long"), {root!r}, "t")
"""


def test_a_run_killed_in_mid_write_leaves_the_former_table(spark, tmp_path):
    script = KILLED.format(repo=str(REPO), root=str(tmp_path))
    done = subprocess.run([sys.executable, "-c", script], capture_output=True, timeout=120)
    assert done.returncode == -9
    assert len(versions(tmp_path, "t")) == 2
    assert parquet.read_table(spark, str(tmp_path), "t").count() == 5
    assert parquet.write_table(spark.range(3), str(tmp_path), "t") == 3
    assert len(versions(tmp_path, "t")) == 2  # the new one and the one before


def test_plain_folders_are_tables_too(spark, tmp_path):
    spark.range(4).write.parquet(f"{tmp_path}/t")
    assert parquet.read_table(spark, str(tmp_path), "t").count() == 4
    before = parquet.identity(spark, str(tmp_path), "t")
    assert before == parquet.identity(spark, str(tmp_path), "t")
    parquet.write_table(spark.range(2), str(tmp_path), "t")
    assert parquet.read_table(spark, str(tmp_path), "t").count() == 2
    assert parquet.identity(spark, str(tmp_path), "t") != before
    with pytest.raises(LarderError, match="nowhere"):
        parquet.identity(spark, str(tmp_path), "nowhere")


def test_versions_know_their_size(spark, tmp_path):
    rows = spark.createDataFrame([("é", "abc", 1), (None, "x", 2)], "a string, b string, c int")
    found = parquet.write_version(rows, str(tmp_path), "t")
    assert (found.rows, found.octets, found.widest) == (2, 6, 5)
    empty = parquet.write_version(rows.limit(0), str(tmp_path), "none")
    assert (empty.rows, empty.octets, empty.widest) == (0, 0, 0)
    assert empty.read(spark, str(tmp_path)).collect() == []


# --- stages ------------------------------------------------------------------


@pytest.fixture
def bronze(spark, tmp_path):
    sources = {
        tables.ORDERS: adapters.messy_orders,
        tables.PRODUCTS: adapters.messy_products,
        tables.DEPARTMENTS: adapters.departments,
        tables.AISLES: adapters.aisles,
        tables.PRIOR_LINES: adapters.prior_lines,
        tables.TRAIN_LINES: adapters.train_lines,
    }
    for spec, adapter in sources.items():
        parquet.write_table(adapter(spark, SF), f"{tmp_path}/bronze", spec.name)
    return f"{tmp_path}/bronze"


def test_silver_goes_on_where_a_run_was_ended(spark, bronze, tmp_path, monkeypatch):
    root = f"{tmp_path}/silver"
    with monkeypatch.context() as m:
        m.setattr(star, "retail_transactions", lambda *a, **b: 1 / 0)
        with Jobs(spark) as first, pytest.raises(ZeroDivisionError):
            silver.build_silver(spark, bronze, root)
    # nothing is shown before all is whole
    assert parquet.published(spark, root, "clean_orders") is None
    left = {n: parquet.prepared(spark, root, n) for n in ("clean_orders", silver.LINES)}
    assert all(left.values())
    with Jobs(spark) as second:
        rows = silver.build_silver(spark, bronze, root)
    # the transactions are all that was missing
    assert 0 < second.number < first.number / 2
    assert rows[tables.TRANSACTIONS] == parquet.read_table(spark, root, tables.TRANSACTIONS).count() > 0
    assert {n: parquet.published(spark, root, n).id for n in left} == {n: v.id for n, v in left.items()}
    with Jobs(spark) as third:
        assert silver.build_silver(spark, bronze, root) == rows
    assert third.number == 0
    # one new input: what does not depend on it stays
    parquet.write_table(adapters.aisles(spark, SF).limit(3), bronze, "aisles")
    silver.build_silver(spark, bronze, root)
    assert parquet.published(spark, root, silver.LINES).id == left[silver.LINES].id
    assert parquet.read_table(spark, root, "clean_aisles").count() == 3


def test_gold_goes_on_where_a_run_was_ended(spark, tmp_path, monkeypatch):
    parquet.write_table(catalog._fact(spark, SF), f"{tmp_path}/silver", tables.TRANSACTIONS)
    with monkeypatch.context() as m:
        m.setitem(gold.GOLD, "gold_customer_metrics", (lambda orders: 1 / 0, "orders"))
        with pytest.raises(ZeroDivisionError):
            gold.build_gold(spark, f"{tmp_path}/silver", f"{tmp_path}/gold")
    with pytest.raises(LarderError):
        gold.read_gold(spark, f"{tmp_path}/gold")
    ready = parquet.prepared(spark, f"{tmp_path}/gold", "gold_top_products")
    paths = gold.build_gold(spark, f"{tmp_path}/silver", f"{tmp_path}/gold")
    assert paths["gold_top_products"].endswith(ready.id)
    with Jobs(spark) as again:
        assert gold.build_gold(spark, f"{tmp_path}/silver", f"{tmp_path}/gold") == paths
    assert again.number == 0
    for name, path in paths.items():
        assert spark.read.parquet(path).count() == parquet.read_table(spark, f"{tmp_path}/gold", name).count()


def test_another_revision_makes_tables_anew(spark, tmp_path, monkeypatch):
    stage = Stage(spark, str(tmp_path))
    first = stage.table("t", {"a": "1"}, lambda: spark.range(2))
    stage.publish()
    assert Stage(spark, str(tmp_path)).table("t", {"a": "1"}, lambda: 1 / 0).id == first.id
    monkeypatch.setattr("larder.plans.stage.REVISION", "next")
    assert Stage(spark, str(tmp_path)).table("t", {"a": "1"}, lambda: spark.range(3)).rows == 3


# --- one parse ---------------------------------------------------------------

LINES = "order_id,product_id,add_to_cart_order,reordered\n1,10,1,0\n1,ten,2,1\n3,10,1,\n"


def test_both_sides_of_a_file_come_from_one_parse(spark, tmp_path):
    (tmp_path / "lines.csv").write_text(LINES)
    bronze, path = f"{tmp_path}/bronze", str(tmp_path / "lines.csv")
    spec = tables.PRIOR_LINES
    with Jobs(spark) as jobs:
        assert csv.ingest_csv(spark, path, spec, bronze) == csv.IngestCount(2, 1)
    assert jobs.number == 1
    bad = parquet.read_table(spark, f"{bronze}/{csv.QUARANTINE}", spec.name)
    assert [tuple(r) for r in bad.collect()] == [("1,ten,2,1",)]
    assert parquet.read_table(spark, bronze, spec.name).columns == spec.columns
    with Jobs(spark) as jobs:
        assert csv.ingest_csv(spark, path, spec, bronze) == csv.IngestCount(2, 1)
    assert jobs.number == 0
    # mended: the quarantine goes; nothing but bad records: an empty table
    (tmp_path / "lines.csv").write_text(LINES.replace("ten", "10"))
    assert csv.ingest_csv(spark, path, spec, bronze) == csv.IngestCount(3, 0)
    assert not (Path(bronze) / csv.QUARANTINE / spec.name).exists()
    (tmp_path / "lines.csv").write_text(LINES.replace("1", "x").replace("3,", "y,"))
    assert csv.ingest_csv(spark, path, spec, bronze) == csv.IngestCount(0, 3)
    assert parquet.read_table(spark, bronze, spec.name).collect() == []


def test_unchanged_files_are_not_ingested_again(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ingest, "RAW_TABLES", [tables.AISLES, tables.DEPARTMENTS])
    (tmp_path / "aisles.csv").write_text("aisle_id,aisle\n1,a\n")
    (tmp_path / "departments.csv").write_text("department_id,department\n1,a\n")
    found = ingest.ingest_all(spark, str(tmp_path), f"{tmp_path}/bronze")
    (tmp_path / "aisles.csv").write_text("aisle_id,aisle\n1,a\n2,b\n")
    with Jobs(spark) as jobs:
        again = ingest.ingest_all(spark, str(tmp_path), f"{tmp_path}/bronze")
    assert (found, again) == ({"aisles": 1, "departments": 1}, {"aisles": 2, "departments": 1})
    assert jobs.number == 1
    # another way to read a file is another input
    whole = ingest.ingest_all(spark, str(tmp_path), f"{tmp_path}/bronze", [])
    assert whole == again


# --- one grouping for duplicates and cleaning --------------------------------


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_lines_move_once_for_duplicates_and_cleaning(spark):
    lines, orders = adapters.messy_lines(spark, SF), adapters.orders(spark, SF)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        groups = cleaning.grouped_lines(lines, orders)
        assert exchanges(groups) == 2  # lines, orders
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    kept = staged(groups)
    counts = quality.duplicate_counts(kept, cleaning.ROWS, tables.MERGED_LINES.key, "lines")
    assert "l_orderkey" not in counts._jdf.queryExecution().toString()
    wanted = quality.duplicate_checks(lines, tables.MERGED_LINES.key, "lines")
    assert sorted(counts.collect()) == sorted(wanted.collect())


@pytest.mark.parametrize("hot_rows", [1_000_000, 2])
def test_grouped_lines_give_both_results(spark, monkeypatch, hot_rows):
    """Also with null keys, hot orders and many copies of a line."""
    monkeypatch.setattr(joins, "HOT_ROWS", hot_rows)
    monkeypatch.setattr(joins, "HOT_KEYS", 1)
    rows = [(1, 1, 1, 0), (1, 1, 1, 1), (1, 1, 1, 2), (1, 2, 1, None), (None, 2, 1, 0), (None, 2, 1, 0)]
    rows += [(9, 1, 1, 0), (2, 7, 1, 1), (2, 2, 0, 1), (None, None, None, None)] + [(2, 1, 3, 1)] * 20
    lines = spark.createDataFrame(rows, "order_id long, product_id long, add_to_cart_order int, reordered int")
    orders = spark.createDataFrame([(1,), (2,)], "order_id long")
    products = spark.createDataFrame([(1,), (2,)], "product_id long")
    groups = staged(cleaning.grouped_lines(lines, orders))
    found = cleaning.known_lines(groups, products)
    assert found.columns == tables.MERGED_LINES.columns
    assert sorted(map(tuple, found.collect())) == [(1, 1, 1, 1), (2, 1, 3, 1)]
    same = cleaning.clean_order_products(lines, orders, products)
    assert sorted(map(tuple, same.collect())) == [(1, 1, 1, 1), (2, 1, 3, 1)]
    counts = quality.duplicate_counts(groups, cleaning.ROWS, tables.MERGED_LINES.key, "lines")
    values = {r.metric_name: r.metric_value for r in counts.collect()}
    assert values == {"total_rows": "30", "distinct_keys": "8", "duplicate_rows": "22"}


@pytest.mark.parametrize("spec, adapter", [(tables.ORDERS, "messy_orders"), (tables.PRODUCTS, "messy_products")])
def test_groups_of_single_tables(spark, spec, adapter):
    raw = getattr(adapters, adapter)(spark, SF)
    groups = staged(cleaning.grouped(raw, spec))
    clean = cleaning.best_rows(groups, spec)
    assert clean.columns == spec.columns
    order = [F.col(c) for c in spec.key]
    assert clean.orderBy(*order).collect() == cleaning.clean(raw, spec).orderBy(*order).collect()
    with_groups = quality.check_table(raw, spec, groups=groups)
    assert sorted(with_groups.collect()) == sorted(quality.check_table(raw, spec).collect())


# --- bitmaps -----------------------------------------------------------------


def test_customers_are_counted_exactly_by_bitmaps(spark):
    edge = kpis.BITMAP_IDS
    ids = [0, 1, 2, 2, 32767, 32768, 32769, 65536, edge - 1, edge, edge, edge + 1, -1, -5, -5, 1 << 60, None]
    rows = [("a", i) for i in ids] + [("b", None), ("c", edge), ("d", 0), ("d", 0), (None, 4)]
    fact = spark.createDataFrame(rows, "department string, user_id long")
    found = {r.department: (r.total_products_sold, r.unique_customers) for r in kpis.department_metrics(fact).collect()}
    assert found == {"a": (17, len(set(ids)) - 1), "b": (1, 0), "c": (1, 1), "d": (2, 1)}


def test_departments_and_customers_are_not_shuffled_in_pairs(spark, tmp_path):
    parquet.write_table(catalog._fact(spark, SF), str(tmp_path), tables.TRANSACTIONS)
    fact = gold.read_fact(spark, str(tmp_path))
    found = kpis.department_metrics(fact)
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "bitmap_construct_agg" in text and "Or(LessThan(user_id,0),GreaterThanOrEqual(user_id" in text
    plain = fact.filter("department IS NOT NULL").groupBy("department").agg(
        F.count("*").alias("total_products_sold"), F.count_distinct("user_id").alias("unique_customers")
    )
    assert sorted(found.collect()) == sorted(plain.collect())


def test_customers_of_large_tables_are_counted_in_words(spark, monkeypatch):
    """What a task of the last grouping holds does not grow with customers times tasks."""
    ids = [0, 1, 63, 64, 64, 65, 127, 128, kpis.BITMAP_IDS, -1, -1, -64, -65, (1 << 63) - 1, -(1 << 63), None]
    rows = [("a", i) for i in ids] + [("b", None), ("c", 5), ("d", 0), ("d", 0), (None, 4)]
    fact = spark.createDataFrame(rows, "department string, user_id long")
    found = kpis.department_metrics(fact, kpis.BITMAP_IDS).collect()
    assert sorted(found) == [("a", 16, len(set(ids)) - 1), ("b", 1, 0), ("c", 1, 1), ("d", 2, 1)]
    few = [sorted(catalog._departments(spark, SF).collect()), catalog.gold_department_metrics(spark, SF).collect()]
    monkeypatch.setattr(kpis, "BITMAP_ROWS", 1000)
    many = [catalog._departments(spark, SF), catalog.gold_department_metrics(spark, SF)]
    for found in many:
        text = found._jdf.queryExecution().executedPlan().toString()
        assert "bit_or" in text and "bitmap" not in text
        assert text.count("orders.parquet") == 1
    assert [sorted(many[0].collect()), many[1].collect()] == few


# --- sizes without jobs ------------------------------------------------------


def test_rows_come_from_footers(spark, tmp_path):
    spark.range(10).repartition(3).write.parquet(f"{tmp_path}/t")
    table = spark.read.parquet(f"{tmp_path}/t")
    with Jobs(spark) as jobs:
        assert footers.row_bound(table) == 10
        assert footers.row_bound(table.filter("id > 3").select("id")) == 10
        assert footers.row_bound(table.union(table)) == 20
        assert footers.row_bound(table.groupBy("id").count()) == 10
        assert footers.row_bound(table.filter("false")) == 0
        # plans that may give more rows than they take
        assert footers.row_bound(table.selectExpr("explode(sequence(1, id + 1))")) is None
        assert footers.row_bound(table.join(table.toDF("other"))) is None
        assert footers.row_bound(table.agg(F.count("*"))) is None
        assert footers.row_bound(spark.range(3)) is None
    assert jobs.number == 0


def test_star_queries_are_built_without_join_jobs(spark, tmp_path, monkeypatch):
    names = ("orders", "products", "aisles", "departments")
    raw = [getattr(adapters, name)(spark, SF) for name in names]
    lines = adapters.prior_lines(spark, SF)
    with Jobs(spark) as jobs:
        star.retail_transactions(lines, *raw, size=joins.Size(200, 10_000), rows=6_000)
        assert jobs.number == 0
        star.transactions_from_raw(lines, *raw)
        # the lengths of names: one result and the shuffles of the two distinct lists
        assert jobs.number <= 5
    size = star.size_with_names(*raw[1:])
    wide = star.products_enriched(*raw[1:]).selectExpr(
        "sum(octet_length(product_name) + octet_length(aisle) + octet_length(department)) AS n", "count(*) AS rows"
    ).first()
    assert size.rows >= wide.rows and size.octets >= wide.n
    monkeypatch.setattr(star, "BROADCAST_ROWS", 3)
    assert not star.size_with_names(*raw[1:]).fits_broadcast(4, max_rows=3)


# --- orders and customers in one exchange ------------------------------------


@pytest.mark.parametrize("hot_rows", [None, 3])
def test_orders_and_customers_share_an_exchange(spark, tmp_path, monkeypatch, hot_rows):
    parquet.write_table(catalog._fact(spark, SF), str(tmp_path), tables.TRANSACTIONS)
    fact = gold.read_fact(spark, str(tmp_path))
    hot = None if hot_rows is None else joins.hot_keys(fact, "user_id", hot_rows=hot_rows)
    orders = kpis.orders_by_customer(fact, hot)
    customers = kpis.customer_metrics(orders)
    text = customers._jdf.queryExecution().executedPlan().toString()
    if hot is None:
        assert text.count("Exchange") == 1
    else:
        assert "Exchange hashpartitioning(order_id" not in text
        assert orders.groupBy("user_id").agg(F.count_distinct(joins.SALT).alias("n")).filter("n > 1").count()
    plain = kpis.order_level(fact)
    assert sorted(kpis.basket_metrics(orders).collect()) == sorted(kpis.basket_metrics(plain).collect())
    assert sorted(customers.collect()) == sorted(kpis.customer_metrics(plain).collect())
