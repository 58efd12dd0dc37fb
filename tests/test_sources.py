import json

import pytest

from larder import LarderError, tables
from larder.plans import ingest
from larder.sources import csv, parquet
from larder.sources.json import read_document, write_document
from larder.sources.workspace import staged, work_dir

LINES = (
    "order_id,product_id,add_to_cart_order,reordered\n"
    "1,10,1,0\n"
    "1,ten,2,1\n"
    "2,5\n"
    "3,10,1,\n"
    '4,"11",2,1\n'
)


@pytest.fixture
def lines_csv(tmp_path):
    path = tmp_path / "lines.csv"
    path.write_text(LINES)
    return str(path)


def test_records_that_do_not_fit_are_set_aside_whole(spark, lines_csv):
    parsed = csv.read_csv(spark, lines_csv, tables.PRIOR_LINES)
    assert sorted(map(tuple, parsed.valid.collect())) == [
        (1, 10, 1, 0),
        (3, 10, 1, None),
        (4, 11, 2, 1),
    ]
    assert {r[0] for r in parsed.malformed.collect()} == {"1,ten,2,1", "2,5"}
    assert parsed.malformed.columns == [csv.CORRUPT]


def test_pruned_columns_are_still_judged(spark, lines_csv):
    parsed = csv.read_csv(spark, lines_csv, tables.PRIOR_LINES)
    assert parsed.valid.count() == 3
    assert parsed.malformed.count() == 2
    assert sorted(r[0] for r in parsed.valid.select("order_id").collect()) == [1, 3, 4]


def test_quotes_commas_and_line_breaks_in_values(spark, tmp_path):
    path = tmp_path / "products.csv"
    path.write_text(
        "product_id,product_name,aisle_id,department_id\n"
        '1,"Say ""Cheese"", please",1,2\n'
        '2,"two\nlines",1,2\n'
        "3,,1,2\n"
    )
    valid = csv.read_csv(spark, str(path), tables.PRODUCTS).valid
    names = {r.product_id: r.product_name for r in valid.collect()}
    assert names == {1: 'Say "Cheese", please', 2: "two\nlines", 3: None}
    single = csv.read_csv(spark, str(path), tables.PRODUCTS, multi_line=False)
    assert single.malformed.count() == 2


def test_corrupt_column_is_added_once():
    schema = csv.with_corrupt_column(tables.AISLES.schema)
    assert schema.fieldNames() == ["aisle_id", "aisle", csv.CORRUPT]
    assert csv.with_corrupt_column(schema) == schema


def test_inputs_must_exist_and_hold_something(spark, tmp_path):
    with pytest.raises(LarderError, match="no such input"):
        csv.require_file(spark, str(tmp_path / "absent.csv"))
    (tmp_path / "empty.csv").write_text("")
    with pytest.raises(LarderError, match="empty"):
        csv.require_file(spark, str(tmp_path / "empty.csv"))
    (tmp_path / "some.csv").write_text("abc")
    assert csv.require_file(spark, str(tmp_path / "some.csv")) == 3


def test_ingest_counts_and_quarantines(spark, lines_csv, tmp_path):
    bronze = str(tmp_path / "bronze")
    found = csv.ingest_csv(spark, lines_csv, tables.PRIOR_LINES, bronze)
    assert found == csv.IngestCount(valid=3, malformed=2)
    assert parquet.read_table(spark, bronze, "order_products__prior").count() == 3
    bad = parquet.read_table(spark, f"{bronze}/{csv.QUARANTINE}", "order_products__prior")
    assert bad.count() == 2


def test_clean_input_leaves_no_quarantine(spark, tmp_path):
    (tmp_path / "aisles.csv").write_text("aisle_id,aisle\n1,a\n2,b\n")
    bronze = tmp_path / "bronze"
    found = csv.ingest_csv(spark, str(tmp_path / "aisles.csv"), tables.AISLES, str(bronze))
    assert found == csv.IngestCount(valid=2, malformed=0)
    assert not (bronze / csv.QUARANTINE).exists()


def test_ingestion_stops_at_a_missing_table(spark, tmp_path):
    with pytest.raises(LarderError, match="orders.csv"):
        ingest.ingest_all(spark, str(tmp_path), str(tmp_path / "bronze"))


def test_tables_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id long, name string")
    root = str(tmp_path)
    assert parquet.write_table(df, root, "t") == 2
    assert parquet.read_table(spark, root, "t", ["name"]).columns == ["name"]
    assert parquet.write_table(df.limit(0), root, "none") == 0
    again, rows = parquet.rewrite_table(df, root, "u")
    assert rows == 2 and again.count() == 2
    with pytest.raises(LarderError, match="absent"):
        parquet.read_table(spark, root, "absent")


def test_documents_round_trip(spark, tmp_path):
    path = str(tmp_path / "d.json")
    write_document(spark.sql("""SELECT '{"a": 1, "b": [2, 3]}' AS document"""), path)
    row = read_document(spark, path).first()
    assert (row.a, row.b) == (1, [2, 3])
    assert json.loads((tmp_path / "d.json").read_text()) == {"a": 1, "b": [2, 3]}
    # written again, and not at all unless there is one row
    write_document(spark.sql("SELECT '{}' AS document"), path)
    for n in (0, 2):
        with pytest.raises(LarderError, match="one row"):
            write_document(spark.range(n).selectExpr("'x' AS document"), path)
    assert (tmp_path / "d.json").read_text() == "{}\n"
    assert [p.name for p in tmp_path.iterdir() if not p.name.endswith(".crc")] == ["d.json"]


def test_work_folders_lie_below_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = work_dir(spark), work_dir(spark)
    assert first.startswith(shared) and first != second
    df = staged(spark.range(5))
    assert df.count() == 5 and shared in df.inputFiles()[0]


def test_two_reads_of_one_table_in_a_plan(spark, lines_csv):
    a, b = (csv.read_csv(spark, lines_csv, tables.PRIOR_LINES) for _ in range(2))
    assert a.valid.union(b.valid).count() == 6
    assert a.malformed.union(b.malformed).count() == 4


def test_ingest_all_takes_line_breaks_where_told(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ingest, "RAW_TABLES", [tables.ORDERS])
    header = ",".join(tables.ORDERS.columns)
    (tmp_path / "orders.csv").write_text(f'{header}\n1,2,"pri\nor",1,2,3,\n')
    apart = ingest.ingest_all(spark, str(tmp_path), str(tmp_path / "a"))
    whole = ingest.ingest_all(spark, str(tmp_path), str(tmp_path / "b"), ["orders"])
    assert (apart, whole) == ({"orders": 0}, {"orders": 1})
