"""Plan-shape guards for the properties that matter at scale (static plans, AQE off)."""

import contextlib
import io
import re

import pytest

from areatab.plans.registry import QUERIES

SF = "/root/testdata/sf0.01"


def _plan(spark, name):
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            QUERIES[name](spark, SF).explain("formatted")
        return buf.getvalue()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)


@pytest.fixture(scope="module")
def freq_all_plan(spark):
    # fact tables must not be broadcast implicitly, whatever their size here
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1m")
    try:
        return _plan(spark, "freq_all")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_one_aggregation_shuffle_for_all_entities(freq_all_plan):
    top = freq_all_plan.split("\n\n")[0]
    agg_exchanges = re.findall(r"hashpartitioning\(id_geo#\d+, codigo_variable#\d+, valor_categoria#\d+", freq_all_plan)
    assert len(agg_exchanges) == 1
    assert top.count("HashAggregate") == 2  # partial + final, above the Union


def test_entity_joins_build_on_parent_and_reuse_dwelling_map(freq_all_plan):
    joins = re.findall(r"ShuffledHashJoin Inner (Build\w+)", freq_all_plan)
    assert joins and set(joins) == {"BuildRight"}
    assert "ReusedExchange" in freq_all_plan
    assert "SortMergeJoin" not in freq_all_plan


def test_fact_scans_are_pruned_and_not_broadcast(freq_all_plan):
    li = re.search(r"Location: .*lineitem.parquet\]\nPushedFilters: \[(.*)\]\nReadSchema: struct<(.*)>", freq_all_plan)
    assert li is not None
    assert set(c.split(":")[0] for c in li.group(2).split(",")) == {"l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus"}
    assert "IsNotNull(l_orderkey)" in li.group(1)
    # broadcast exchanges only carry the small dimensions (nation, region)
    for m in re.finditer(r"\((\d+)\) BroadcastExchange\nInput \[\d+\]: \[(.*)\]", freq_all_plan):
        cols = m.group(2)
        assert not any(k in cols for k in ("l_orderkey", "o_orderkey", "o_custkey", "c_custkey")), cols


def test_tile_and_label_aggregates_are_partial(spark):
    for name in ("tile_counts", "clean_labels"):
        plan = _plan(spark, name)
        assert re.search(r"partial_(count|min_by)", plan), name


def test_linked_pipeline_entity_joins_are_parent_built(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1m")
    try:
        plan = _plan(spark, "linked_model")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    body = plan.split("\n\n")[0]
    joins = re.findall(r"ShuffledHashJoin (?:Inner|LeftOuter) (Build\w+)", body)
    assert len(joins) >= 4 and set(joins) == {"BuildRight"}
    # sort-merge joins may only appear on label tables (small aggregates that
    # AQE broadcasts from measured sizes), never on entity keys
    smj_keys = re.findall(r"\) SortMergeJoin.*\nLeft keys \[\d+\]: \[(.*)\]", plan)
    assert all(k.startswith("codigo_variable#") for k in smj_keys), smj_keys


def test_metadata_queries_do_not_read_the_facts(spark):
    for name in ("variable_catalog", "duplicate_variable_names", "pending_variables", "run_manifest", "resume_counts", "publish_metadata", "dataset_stats"):
        plan = _plan(spark, name)
        assert "lineitem.parquet" not in plan and "orders.parquet" not in plan, name


def test_totals_read_and_join_each_table_once(spark):
    plan = _plan(spark, "total_check")
    assert plan.count("lineitem.parquet]") == 1 and plan.count("orders.parquet]") == 1


def test_building_a_plan_runs_no_size_check(spark):
    from areatab.plans.census import Census
    from areatab.plans.registry import _long

    c = Census(spark, SF)
    spark.sparkContext.setJobGroup("plan-only", "building")
    try:
        _long(c)
        c.linked_tables()
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("plan-only")
    finally:
        spark.sparkContext._jsc.sc().clearJobGroup()
    # opening a table reads its schema; nothing counts rows
    assert len(jobs) <= 6


def test_salted_join_reads_the_same_columns(spark):
    columns = {}
    for name in ("freq_salted", "freq_drop_nulls"):
        plan = _plan(spark, name)
        found = re.findall(r"lineitem.parquet\][^\n]*(?:\n(?!ReadSchema)[^\n]*)*\nReadSchema: struct<([^>]*)>", plan)
        columns[name] = set().union(*({c.split(":")[0] for c in f.split(",") if c.startswith("l_")} for f in found))
    assert columns["freq_salted"] == columns["freq_drop_nulls"]


def test_polygon_join_shuffles_geometry_once_and_last(spark):
    """No exchange before the last join carries the binary column, and the counts' side never does."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(spark, "join_geometry_polygons")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    carrying = [m.group(1) for m in re.finditer(r"\d+\) Exchange\nInput \[\d+\]: \[(.*)\]", plan) if "geometry" in m.group(1)]
    assert len(carrying) == 1 and "conteo" not in carrying[0], carrying
    scans = re.findall(r"tract-polygons[^\n]*\n(?:Pushed[^\n]*\n|Partition[^\n]*\n)*ReadSchema: struct<([^>]*)>", plan)
    assert any("geometry" not in s and "min_lon" in s for s in scans) and any("geometry" in s and "min_lon" not in s for s in scans), scans


def test_polygon_tiles_meet_as_partial_sums(spark):
    plan = _plan(spark, "tile_cover_polygons")
    assert "partial_sum(change" in plan and "Cartesian" not in plan
