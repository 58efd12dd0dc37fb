import re
import time

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from larder.operators import documents, report_text


def reports(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def sections(spark, text):
    found = report_text.report_sections(reports(spark, text)).orderBy("section_no").collect()
    assert [r.section_no for r in found] == list(range(len(found)))
    return {r.section: r.body for r in found}


@pytest.mark.parametrize(
    "text,wanted",
    [
        ("", {}),
        ("\n", {"introduction": ""}),
        ("hello\nyou", {"introduction": "hello\nyou"}),
        ("## A\nx", {"a": "x"}),
        ("## A\n", {}),
        ("## A\n\n", {"a": ""}),
        ("## A\n## B\nb", {"b": "b"}),
        ("\n## A\nx", {"introduction": "", "a": "x"}),
        ("in\r\n## Top-5 Things \r\n x \r\ny\r\n", {"introduction": "in", "top_5_things": "x \ny"}),
        ("## A\none\n## B\ntwo\n## A\nthree", {"b": "two", "a": "three"}),
        ("x\n## Introduction\ny", {"introduction": "y"}),
        ("### no\n##no\n ## no", {"introduction": "### no\n##no\n ## no"}),
        ("## A\rx\x0by z", {"a": "x\ny\nz"}),
    ],
)
def test_sections(spark, text, wanted):
    assert sections(spark, text) == wanted


@pytest.mark.parametrize(
    "text,wanted",
    [
        ("1. one\n2) two\n three\n", ["one", "two"]),
        ("  10.ten\n\n\n 11.  \n eleven", ["ten", "eleven"]),
        ("1 no\na 2. no\n3.", []),
        ("1. \x1f\n", []),
        ("1. a\r\n2. b\r\n", ["a", "b"]),
        ("١. arabic digit", ["arabic digit"]),
        ("", []),
    ],
)
def test_recommendations(spark, text, wanted):
    found = report_text.report_recommendations(reports(spark, text)).orderBy("item_no")
    assert [r.recommendation for r in found.collect()] == wanted


PIECES = ["## ", "##", "A", "b c", "-", " ", "\n", "\r\n", "\r", "\x85", "1. ", "2) ", "\t", "\x1c"]


def brute_sections(text):
    """Last body per heading, from the text cut at heading lines."""
    flat = "".join(line + "\n" for line in text.splitlines())
    cut = re.split(r"^## (.*)\n", flat, flags=re.MULTILINE)
    names = ["introduction"] + [
        re.sub("[ -]", "_", name.strip().lower()) for name in cut[1::2]
    ]
    return {name: body.strip() for name, body in zip(names, cut[::2]) if body}


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=25).map("".join), min_size=20, max_size=60))
def test_sections_and_items_by_brute_force(spark, texts):
    table = reports(spark, *texts)
    found = {i: {} for i in range(len(texts))}
    for r in report_text.report_sections(table).collect():
        found[r.doc_id][r.section] = r.body
    assert found == {i: brute_sections(text) for i, text in enumerate(texts)}
    items = {i: [] for i in range(len(texts))}
    for r in report_text.report_recommendations(table).orderBy("doc_id", "item_no").collect():
        items[r.doc_id].append(r.recommendation)
    pattern = re.compile(r"^\s*\d+[.)]\s*(.+)$", re.MULTILINE)
    assert items == {
        i: [x.strip() for x in pattern.findall(text) if x.strip()] for i, text in enumerate(texts)
    }


def test_assembled_rows(spark):
    table = spark.createDataFrame(
        [
            (1, "## Executive Summary\ngood\n## Key Business Recommendations\n1. sell", "m", "then"),
            (2, "x" * 600 + "\n1. buy", None, None),
            (3, None, "m", "then"),
        ],
        "doc_id long, text string, model string, generated_at string",
    )
    one, two, three = report_text.assemble_reports(table, "now").orderBy("doc_id").collect()
    assert (one.last_updated, one.model, one.executive_summary) == ("then", "m", "good")
    assert one.recommendations == ["sell"] and list(one.sections) == [
        "executive_summary",
        "key_business_recommendations",
    ]
    assert (two.last_updated, two.model) == ("now", "unknown")
    assert two.executive_summary == "x" * 500 and two.recommendations == ["buy"]
    assert (three.last_updated, three.model) == ("now", "pending")
    assert (three.full_text, three.sections, three.recommendations) == ("", {}, [])
    assert three.executive_summary == report_text.PENDING_SUMMARY
    shown = documents.insight_document(table, "now", indented=False).collect()
    assert len(shown) == 3 and '"model":"pending"' in shown[2][0]


def test_a_heading_that_comes_back_keeps_its_first_place(spark):
    text = "## A\none\n## B\ntwo\n## A\nthree\n"
    reports = spark.createDataFrame([(1, text)], "doc_id long, text string")
    rows = report_text.report_sections(reports).orderBy("section_no").collect()
    assert [(r.section, r.body) for r in rows] == [("a", "three"), ("b", "two")]


def test_many_blank_lines_take_no_square_of_time(spark):
    text = "\n" * 200_000 + "1. last"
    reports = spark.createDataFrame([(1, text)], "doc_id long, text string")
    started = time.perf_counter()
    rows = report_text.report_recommendations(reports).collect()
    assert [r.recommendation for r in rows] == ["last"]
    assert time.perf_counter() - started < 20
