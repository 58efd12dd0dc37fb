"""The whole way from CSV files to dashboard documents, and the shape of the plans."""

import json
from pathlib import Path

import pytest

import __spark_entry__ as driver
from larder import LarderError, adapters, catalog, tables
from larder.__main__ import main
from larder.operators import cleaning, joins, quality, reports
from larder.plans import export, gold, ingest, silver
from larder.plans.together import together
from larder.sources import parquet
from larder.sources.json import read_document

SF = "/root/testdata/sf0.01"
RAW = {
    "orders": """order_id,user_id,eval_set,order_number,order_dow,order_hour_of_day,days_since_prior_order
1,1,prior,1,2,8,
2,1,prior,2,3,7,15.0
3,2,train,1,0,23,
4,2,train,2,7,23,
5,3,prior,one,2,8,
""",
    "products": '''product_id,product_name,aisle_id,department_id
1,"Milk, ""whole""",1,1
2,Bread,2,2
3,Mystery,9,9
''',
    "departments": "department_id,department\n1,Dairy  Eggs\n2,bakery\n",
    "aisles": "aisle_id,aisle\n1,milk\n2,bread\n",
    "order_products__prior": """order_id,product_id,add_to_cart_order,reordered
1,1,1,0
1,2,2,0
1,2,2,1
2,1,1,1
2,3,2,0
2,x,3,0
9,1,1,0
""",
    "order_products__train": """order_id,product_id,add_to_cart_order,reordered
3,1,1,1
4,1,1,1
3,77,2,1
""",
}


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("stages")
    raw = root / "raw"
    raw.mkdir()
    for name, text in RAW.items():
        (raw / f"{name}.csv").write_text(text)
    ingested = ingest.ingest_all(spark, str(raw), f"{root}/bronze")
    cleaned = silver.build_silver(spark, f"{root}/bronze", f"{root}/silver")
    written = gold.build_gold(spark, f"{root}/silver", f"{root}/gold")
    return root, ingested, cleaned, written


def test_rows_per_stage(spark, stages):
    root, ingested, cleaned, written = stages
    assert ingested == {
        "orders": 4,
        "products": 3,
        "departments": 2,
        "aisles": 2,
        "order_products__prior": 6,
        "order_products__train": 3,
    }
    assert cleaned["clean_orders"] == 3
    assert cleaned["clean_order_products"] == cleaned["retail_transactions"] == 5
    assert cleaned["clean_products"] == 3
    report = parquet.read_table(spark, f"{root}/silver", tables.QUALITY_REPORT)
    assert report.count() == cleaned[tables.QUALITY_REPORT]
    checks = read_document(spark, f"{root}/silver/{tables.QUALITY_REPORT}.json").first()
    assert checks.summary.total_checks == report.count()
    assert set(written) == set(tables.GOLD_SCHEMAS)


def test_gold_values(spark, stages):
    root = stages[0]
    found = gold.read_gold(spark, f"{root}/gold")
    assert found["gold_top_products"].collect() == [
        (1, 'Milk, "whole"', 3, 2, 2 / 3),
        (2, "Bread", 1, 1, 1.0),
        (3, "Mystery", 1, 0, 0.0),
    ]
    assert found["gold_department_metrics"].collect() == [
        ("dairy eggs", 3, 2),
        ("bakery", 1, 1),
    ]
    assert found["gold_customer_metrics"].collect() == [(1, 2, 4, 2.0), (2, 1, 1, 1.0)]
    for name, schema in tables.GOLD_SCHEMAS.items():
        quality.require_columns(found[name], schema, name)


def test_export(spark, stages, tmp_path):
    root = stages[0]
    with pytest.raises(LarderError, match="no report"):
        export.export_dashboards(spark, f"{root}/gold", str(tmp_path))
    report = spark.createDataFrame(
        [(1, "## Executive Summary\nfine", "m", (3,))],
        "doc_id long, text string, model string, kpi_overview struct<total_orders: long>",
    )
    paths = export.export_dashboards(spark, f"{root}/gold", str(tmp_path), report)
    assert len(paths) == 6
    shown = {name: json.loads(Path(path).read_text()) for name, path in paths.items()}
    assert shown["basket_metrics.json"]["summary"]["total_orders"] == 3
    insights = shown["ai_insights.json"]
    assert insights["sections"] == {"executive_summary": "fine"}
    assert insights["kpi_overview"] == {"total_orders": 3}
    overview = export.read_overview(spark, str(tmp_path)).first()
    assert overview.last_updated == insights["last_updated"]
    # the report stored 3 orders only; the other numbers are those of the tables
    assert overview[:5] == (2, 3, 2, 3, 5)
    paths = export.export_dashboards(spark, f"{root}/gold", str(tmp_path), require_report=False)
    assert export.read_overview(spark, str(tmp_path)).first()[:5] == overview[:5]
    assert read_document(spark, paths["ai_insights.json"]).first().model == "pending"


def test_summary_and_stored_report(spark, stages, tmp_path):
    """The summary, a report written from it, and the overview stored with the report."""
    root = stages[0]
    paths = export.export_summary(spark, f"{root}/gold", str(tmp_path))
    summary = json.loads(Path(paths[export.SUMMARY]).read_text())
    assert summary["dataset_overview"]["total_orders"] == 3
    summary["dataset_overview"]["total_orders"] = 8  # as of an earlier day
    stored = {
        "generated_at": "2024-05-01T00:00:00",
        "model": "m",
        "executive_insights": "## Executive Summary\nfine\n1. do it",
        "kpi_summary": summary,
    }
    (tmp_path / "report.json").write_text(json.dumps(stored))
    out = tmp_path / "out"
    main(["export", f"{root}/gold", str(out), "--report", str(tmp_path / "report.json")])
    insights = json.loads((out / "ai_insights.json").read_text())
    assert insights["last_updated"] == "2024-05-01T00:00:00" and insights["model"] == "m"
    assert insights["executive_summary"] == "fine\n1. do it"
    assert insights["recommendations"] == ["do it"]
    assert insights["kpi_overview"] == summary["dataset_overview"]
    overview = export.read_overview(spark, str(out)).first()
    assert overview.total_transactions == 8 and overview.last_updated == insights["last_updated"]
    # a report without any known field
    (tmp_path / "bare.json").write_text('{"note": 1}')
    report = export.stored_report(spark, str(tmp_path / "bare.json"))
    assert report.first().asDict() == {"doc_id": 0, "text": ""}


def test_silver_leaves_no_work_folders(spark, stages, tmp_path, monkeypatch):
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(shared.iterdir())
    made = []
    staged = joins.staged
    monkeypatch.setattr(joins, "HOT_ROWS", 1)
    monkeypatch.setattr(joins, "staged", lambda df: made.append(df) or staged(df))
    silver.build_silver(spark, f"{stages[0]}/bronze", str(tmp_path))
    assert made and set(shared.iterdir()) == before


def test_command_line(spark, stages, tmp_path, capsys):
    root = stages[0]
    main(["gold", f"{root}/silver", str(tmp_path / "gold")])
    main(["export", str(tmp_path / "gold"), str(tmp_path / "out")])
    printed = capsys.readouterr().out
    assert "gold_top_products: " in printed and "ai_insights.json: " in printed
    with pytest.raises(LarderError, match="no such document"):
        export.read_overview(spark, str(tmp_path / "nowhere"))


def test_jobs_run_together_and_fail_together(spark):
    assert together(spark, {"a": lambda: spark.range(3).count(), "b": lambda: 2}) == {
        "a": 3,
        "b": 2,
    }
    with pytest.raises(ZeroDivisionError):
        together(spark, {"a": lambda: 1, "b": lambda: 1 // 0})


def test_missing_gold_is_an_error(spark, tmp_path):
    with pytest.raises(LarderError, match="gold_top_products"):
        gold.read_gold(spark, str(tmp_path))


def plan(df):
    df.collect()
    return df._jdf.queryExecution().toString()


def test_no_query_leaves_the_jvm(spark):
    for name in ("retail_transactions", "dq_report", "customer_segmentation", "report_sections"):
        text = plan(catalog.QUERIES[name](spark, "/root/testdata/sf0.001"))
        assert "Python" not in text and "CartesianProduct" not in text
        assert "BroadcastNestedLoopJoin" not in text


def test_scans_read_what_is_needed(spark, tmp_path):
    lines = cleaning.acceptable(adapters.prior_lines(spark, SF), tables.PRIOR_LINES)
    spark.conf.set("spark.sql.maxMetadataStringLength", 4000)
    text = plan(lines.select("order_id"))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "IsNotNull(l_orderkey)" in text and "GreaterThanOrEqual(l_linenumber,1)" in text
    parquet.write_table(catalog._fact(spark, SF), str(tmp_path), tables.TRANSACTIONS)
    fact = gold.read_fact(spark, str(tmp_path))
    text = plan(fact.groupBy("department").count())
    assert "ReadSchema: struct<department:string>" in text


def test_lines_are_shuffled_once_up_to_the_product_join(spark):
    """Order join and removal of duplicates share one partitioning."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = catalog._fact(spark, SF)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert text.count("Exchange hashpartitioning(order_id") == 2  # lines, orders
    assert "SortMergeJoin [order_id" in text
    assert "Exchange hashpartitioning(product_id" in text  # the products, for their own key


def test_top_lists_sort_no_more_than_they_show(spark):
    text = plan(reports.top_products(catalog._products(spark, SF), 10))
    assert "TakeOrderedAndProject(limit=10" in text


def test_entry_has_rows(spark):
    found = driver.entry(spark)
    assert found.columns == ["department", "total_products_sold", "unique_customers"]
    assert not found.isEmpty()
