import pytest
from table_rows import as_dict

import __spark_entry__ as contract
from check_oracle import compare, connect
from textgraph.operators import cooccur, pagerank, postings, search
from textgraph.plans import durable
from textgraph.queries import registered
from textgraph.sources import lines as line_reader
from textgraph.plans.sizing import broadcast_if_small, measured_bytes
from textgraph.plans.skew import lookup_join

FOLDER = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def plans(monkeypatch):
    """The plans of all that is written on the way to a result, in order."""
    found = []

    def noted(df, name):
        found.append(plan_of(df))
        return durable.durable(df, name)

    for module in (cooccur, line_reader, pagerank, postings, search):
        if hasattr(module, "durable"):
            monkeypatch.setattr(module, "durable", noted)
    return found


@pytest.fixture(scope="module")
def db():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(contract.oracle_sql()))
def test_query_agrees_with_its_sql(spark, db, name):
    assert compare(spark, db, name, FOLDER) == ""


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(registered()))
def test_no_query_pairs_whole_tables(spark, plans, name):
    last = plan_of(contract.queries()[name](spark, FOLDER))
    for plan in [*plans, last]:
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
        assert "Python" not in plan and "Pandas" not in plan


def test_scans_read_only_the_columns_used(spark):
    plan = plan_of(contract.queries()["hourly_counts"](spark, FOLDER))
    assert "ReadSchema: struct<ts:timestamp_ntz>" in plan
    plan = plan_of(contract.queries()["graph_duplicate_nodes"](spark, FOLDER))
    assert "ReadSchema: struct<l_orderkey:bigint>" in plan


def test_postings_lookup_is_pushed_to_the_scan(spark, lines, tmp_path):
    from textgraph import build_postings, lookup_postings, write_index

    path = str(tmp_path / "index")
    write_index(build_postings(lines("a b", "b c")), path, 2)
    assert "PushedFilters: [In(term, [a,c])]" in plan_of(lookup_postings(spark.read.parquet(path), ["a", "c"]))


def test_lookup_join_forms_agree(spark):
    big = spark.range(1000).selectExpr("case when id < 400 then 'hot' when id < 900 then 'k' || id % 50 else 'gone' end key", "id")
    counts = as_dict(big.groupBy("key").count(), "key")
    lookup = spark.createDataFrame([(k, n, i) for i, (k, n) in enumerate(counts.items()) if k != "gone"], "key string, n bigint, v int")
    expected = as_dict(big.join(lookup, "key").select("id", "v"), "id")
    assert len(expected) == 900
    for options in ({}, {"broadcast_bytes": 0}, {"broadcast_bytes": 0, "head_keys": 1}, {"broadcast_bytes": 0, "head_keys": 3}):
        assert as_dict(lookup_join(big, lookup, "key", "n", **options).select("id", "v"), "id") == expected


def test_broadcast_only_what_measures_small(spark):
    df = spark.createDataFrame([("x" * 100,)] * 10, "s string")
    assert measured_bytes(df) == 10 * 164
    assert "Broadcast" in plan_of(df.join(broadcast_if_small(df.distinct()), "s"))
    assert measured_bytes(df.limit(0)) == 0
    hinted = broadcast_if_small(df.distinct(), limit=10)._jdf.queryExecution().logical().toString()
    assert "ResolvedHint" not in hinted and "UnresolvedHint" not in hinted
