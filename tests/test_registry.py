"""Registered queries against their SQL at the smallest scale, and the plans of the main ones."""

import glob
import os
import re

import pytest

import __spark_entry__ as entry
from terraloom.registry import graphs
from tools.check import bag

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the given tables")


@pytest.fixture(scope="module")
def db():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_agrees_with_sql(spark, db, name):
    df = entry.queries()[name](spark, SF)
    cur = db.execute(entry.oracle_sql()[name])
    want = bag([d[0] for d in cur.description], cur.fetchall())
    assert bag(df.columns, [tuple(r) for r in df.collect()]) == want


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_plan_stays_in_the_jvm(spark):
    text = plan(entry.entry(spark))
    assert "Python" not in text and "CartesianProduct" not in text and "NestedLoop" not in text and "Window" not in text


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(entry.queries()["scan_physical_schema"](spark, SF))
    assert "GreaterThan(l_quantity,30.0)" in text and "l_comment" not in text and "l_extendedprice" not in text


@pytest.mark.parametrize("name", ["spatial_neighbors", "latest_pivot", "rule_report", "keyed_ranges", "knowledge_graph"])
def test_no_cross_joins(spark, name):
    text = plan(entry.queries()[name](spark, SF))
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_landed_streams_read_every_order_and_nothing_behind_the_end(spark):
    for sf in (SF, SF.replace("0.001", "0.01")):
        got = entry.queries()["landed_streams"](spark, sf).collect()
        assert sum(r.rows for r in got) == spark.read.parquet(f"{sf}/orders.parquet").count()
        assert all(r.c != "stale" for r in got) and max(r.page for r in got) >= 1


def test_a_dimension_row_with_several_polygons_is_one_row(spark, tmp_path):
    """Customers beyond 99,999 share the five characters of others; the row of the dimension stays one."""
    spark.range(1).selectExpr("10000L c_custkey").union(spark.range(100_000, 100_010)).write.parquet(f"{tmp_path}/customer.parquet")
    spark.read.parquet(f"{SF}/events.parquet").limit(1).selectExpr("* except (user_id)", "10000L user_id").write.parquet(f"{tmp_path}/events.parquet")
    spark.read.parquet(f"{SF}/nation.parquet").write.parquet(f"{tmp_path}/nation.parquet")
    assert [tuple(r) for r in entry.queries()["with_geometry"](spark, str(tmp_path)).collect()] == [("10000", "M10000", 1)]


def test_questions_are_never_sent_through_the_driver(spark):
    text = plan(entry.queries()["retrieval_context"](spark, SF))
    assert len(re.findall(r"SortMergeJoin \[question_id#\d+\], \[question_id#\d+\], LeftSemi", text)) == 2


@pytest.mark.parametrize("name", ["datapoint_triples", "adjacency_triples", "knowledge_graph", "relation_round_trip", "query_entity_indicator",
                                  "query_entity_year", "query_neighbors", "query_province_neighbors", "query_top_of_comarca"])
def test_tables_that_grow_are_never_sent_through_the_driver(spark, monkeypatch, name):
    """Files say little about the size of rows, so only nations, their regions and the keys of over-long lists may be broadcast."""
    seen = []
    monkeypatch.setattr("terraloom.sources.relations.write_relations", lambda lines, path: (seen.append(lines), lines.write.text(path)))
    df = entry.queries()[name](spark, SF)
    text = plan(seen[0] if seen else df)
    by = {re.sub(r"#\d+L?", "", keys) for keys in re.findall(r"BroadcastHashJoin (\[[^]]*\])", text)}
    assert "SortMergeJoin" in text and by <= {"[c_nationkey]", "[n_nationkey]", "[(user_id % 25)]", "[n_regionkey]", "[comarca_name]", "[id, name]"}


@pytest.mark.parametrize("name, wanted", [("score_transe", r"BroadcastHashJoin \[p#"), ("index_triples", r"BroadcastHashJoin \[p#"), ("split_triples", "REPARTITION_BY_NUM"),
                                          ("grid_split", "REPARTITION_BY_NUM"), ("message_pass", "REBALANCE_PARTITIONS_BY_COL"), ("message_pass_weighted", "REBALANCE_PARTITIONS_BY_COL")])
def test_links_are_dealt_by_entities_and_in_bounded_parts(spark, name, wanted):
    """No task holds a relation, no table of entities is broadcast, and aggregates that sort get parts of a bounded size."""
    text = plan(entry.queries()[name](spark, SF))
    assert re.search(wanted, text)
    assert not re.search(r"SortMergeJoin \[p#\d+\],", text) and not re.search(r"BroadcastHashJoin \[(?!p#|_part#)", text)


def test_split_in_many_tasks_is_the_same(spark, monkeypatch):
    rows = lambda name: sorted(tuple(r) for r in entry.queries()[name](spark, SF).collect())
    before = {name: rows(name) for name in ("split_triples", "grid_split")}
    monkeypatch.setattr("terraloom.operators.embeddings._COVER_ROWS", 300)
    assert {name: rows(name) for name in before} == before and len(before["grid_split"]) > len(before["split_triples"])


@pytest.mark.parametrize("name", ["links", "transe", "transh", "transr", "rotate", "complex", "distmult"])
def test_line_items_meet_only_orders(spark, name):
    """Tails without a vector go after the links are made: dealing every line item by its supplier as well costs more than the links."""
    df = graphs._vector_links(spark, SF) if name == "links" else entry.queries()[f"score_{name}"](spark, SF)
    joins = [line for line in df._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join " in line]
    assert any("o_orderkey" in j for j in joins) and not any("l_suppkey" in j for j in joins)
