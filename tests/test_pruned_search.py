"""Searches, fetches and lookups over saved tables read what they need, and find what plain ones find."""

import random

import pytest
from plan_metrics import scans

from textgraph import (
    bool_search,
    build_postings,
    fetch_lines,
    load_block_index,
    lookup_postings,
    lookup_terms,
    save_block_index,
    save_collection,
    save_lookup,
    save_wide_table,
    search_index,
)
from textgraph.operators.search import leading_terms

TERMS = ["a", "b", "c", "rare", "twice", "gone"]


def nested(draw, depth):
    if depth == 0 or draw.random() < 0.2:
        return draw.choice(TERMS)
    return f"{nested(draw, depth - 1)} {nested(draw, depth - 1)} {draw.choice(['AND', 'OR'])}"


def holds(query, words):
    stack = []
    for token in query.split():
        if token in ("AND", "OR"):
            right, left = stack.pop(), stack.pop()
            stack.append((left and right) if token == "AND" else (left or right))
        else:
            stack.append(token in words)
    return stack[-1]


@pytest.fixture(scope="module")
def texts():
    draw = random.Random(3)
    rows = [" ".join(draw.choices(["a", "b", "c"], k=draw.randrange(6))) for _ in range(400)]
    rows[17] += " rare"
    rows[18] += " twice"
    rows[333] += " twice"
    return rows


@pytest.fixture(scope="module")
def postings(spark, texts):
    return build_postings(spark.createDataFrame(list(enumerate(texts)), "docid bigint, line string")).persist()


@pytest.fixture(scope="module")
def index(spark, postings, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("blocks"))
    save_block_index(postings, path, 4, span=16)
    return load_block_index(spark, path)


def test_nested_searches_are_those_of_sets(index, postings, texts):
    draw = random.Random(11)
    queries = {f"q{i}": nested(draw, 4) for i in range(60)}
    expected = {(q, d) for q, text in queries.items() for d, line in enumerate(texts) if holds(text, line.split())}
    assert {tuple(r) for r in search_index(index, queries).collect()} == expected
    assert {tuple(r) for r in bool_search(postings, queries).collect()} == expected


def test_the_rarest_side_leads():
    df = {"a": 100, "b": 50, "rare": 1}
    assert leading_terms("a rare AND", df) == {"rare"}
    assert leading_terms("a b OR rare AND", df) == {"rare"}
    assert leading_terms("a rare AND b rare AND OR", df) == {"rare"}
    assert leading_terms("a b AND rare OR", df) == {"b", "rare"}
    assert leading_terms("a gone AND", df) == {"gone"}


def test_common_terms_are_read_in_few_blocks(spark, index, texts):
    folders = index.postings.select("block").distinct().count()
    found = []
    read = scans(spark, lambda: found.extend(search_index(index, {"q": "a b OR rare AND"}).collect()))
    common = [s for s in read if "/postings]" in s["what"] and "term#" in s["what"] and "IN (a,b)" in s["what"]]
    assert [r.docid for r in found] == ([17] if {"a", "b"} & set(texts[17].split()) else [])
    assert common and all(s["number of partitions read"] == 1 and s["static number of files read"] >= folders for s in common)
    assert folders == 25


def test_a_fetch_reads_few_texts(spark, texts, tmp_path):
    lines = spark.createDataFrame([(d, f"{t} of {d}") for d, t in enumerate(texts)], "docid bigint, line string")
    save_collection(lines, str(tmp_path), 40)
    saved = spark.read.parquet(str(tmp_path))
    hits = spark.createDataFrame([("q", 3), ("q", 211), ("r", 211), ("r", 9999)], "query_id string, docid bigint")
    found = []
    read = scans(spark, lambda: found.extend(map(tuple, fetch_lines(hits, saved).collect())))
    assert sorted(found) == [("q", 3, f"{texts[3]} of 3"), ("q", 211, f"{texts[211]} of 211"), ("r", 211, f"{texts[211]} of 211")]
    collection = [s for s in read if "line" in s["what"]]
    assert collection and all(s["number of output rows"] <= 40 for s in collection)
    assert fetch_lines(hits.filter("docid < 0"), saved).count() == 0


def test_a_batch_of_terms_leaves_other_folders_alone(spark, tmp_path):
    rows = [(f"t{i}", i % 7, 1) for i in range(3000)]
    save_lookup(spark.createDataFrame(rows, "term string, docid bigint, tf bigint"), str(tmp_path), 8, 64)
    saved = spark.read.schema("term string, docid bigint, tf bigint, bucket bigint").parquet(str(tmp_path))
    asked = spark.createDataFrame([("t5",), ("t6",), ("t6",), ("unknown",)], "term string")
    found = []
    read = scans(spark, lambda: found.extend(map(tuple, lookup_terms(saved, asked, 64).collect())))
    assert sorted(found) == [("t5", 5, 1), ("t6", 6, 1)]
    table = [s for s in read if "tf" in s["what"]]
    assert table and all(s["number of partitions read"] <= 3 for s in table)


def test_a_hundred_thousand_terms_are_no_literals(spark, tmp_path):
    rows = spark.range(150_000).selectExpr("concat('t', id) AS term", "id AS docid", "1L AS tf")
    save_lookup(rows, str(tmp_path), 4, 8)
    saved = spark.read.schema("term string, docid bigint, tf bigint, bucket bigint").parquet(str(tmp_path))
    asked = spark.range(50_000, 150_000).selectExpr("concat('t', id) AS term")
    found = lookup_terms(saved, asked, 8)
    assert "t50001" not in found._jdf.queryExecution().toString()
    assert found.agg({"docid": "min", "term": "count"}).first().asDict() == {"min(docid)": 50_000, "count(term)": 100_000}


def test_a_catalog_table_joins_and_groups_without_exchange(spark, postings, tmp_path):
    for _ in range(2):  # dropped and made anew
        save_wide_table(postings, "wide_index", 4, 16, str(tmp_path / "wide"))
    saved = spark.table("wide_index")
    cells = saved.selectExpr("term", "explode(cells) AS (docid, tf)")
    assert {tuple(r) for r in cells.collect()} == {tuple(r) for r in postings.select("term", "docid", "tf").collect()}
    grouped = saved.groupBy("term").agg({"block": "count"})
    joined = saved.join(saved.selectExpr("term", "block AS other").hint("merge"), "term")
    by_term = saved.join(grouped.hint("merge"), "term")
    for plan in (grouped, joined, by_term):
        assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()
    spark.sql("DROP TABLE wide_index")


def test_a_literal_lookup_uses_the_written_filters(spark, postings, tmp_path):
    from textgraph import write_index

    write_index(postings, str(tmp_path), 3)
    found = lookup_postings(spark.read.parquet(str(tmp_path)), ["rare"])
    assert [(r.docid, r.tf) for r in found.collect()] == [(17, 1)]
