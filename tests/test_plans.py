"""Plans: no cross joins, pruned and filtered scans, rules in one lazy plan."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from quotelift.operators import features, joins, profile, temporal
from quotelift.plans import flows
from quotelift.sources.standins import base_table, view


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


LAZY = [
    "segment_status_share",
    "clean_quotes",
    "temporal_incremental",
    "join_retention_1key",
    "join_retention_3key",
    "status_share",
    "threshold_sweep",
    "topk_curves",
    "average_precision",
    "local_rank",
    "feature_histogram",
    "rank_score",
    "mutual_information",
    "class_weights",
    "incremental_candidates",
]


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_joins(spark, small, name):
    plan = plan_of(contract.queries()[name](spark, small))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_one_shuffle_for_latest_and_entries(spark, small):
    df = view(spark, small, "v_snapshots")
    plan = plan_of(temporal.latest_with_entries(df, "quote_id", "ts_arq", "event_id", "status", {"i": "EMITIDA"}, ["quote_id", "status"]))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "partial_max_by" in plan
    assert "value#" not in plan.split("ReadSchema:")[1]


def test_split_needs_no_shuffle_and_prunes(spark, small):
    df = features.hash_split(base_table(spark, small, "orders"), ["o_orderkey"]).filter("is_valid")
    plan = plan_of(df.select("o_orderkey"))
    assert "Exchange" not in plan and "ReadSchema: struct<o_orderkey:bigint>" in plan


def test_filters_reach_the_scan(spark, small):
    df = base_table(spark, small, "orders").filter(F.col("o_orderstatus") == "F")
    plan = plan_of(profile.rows_by_quote_date(df, "o_orderdate"))
    assert "EqualTo(o_orderstatus,F)" in plan and "o_totalprice" not in plan


def test_null_keys_spread_in_the_join(spark, small):
    left = view(spark, small, "v_quotes")
    right = view(spark, small, "v_broker")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(joins.join_retention(left, right, ["broker_id"], ["broker_id"], "_r", [F.col("gwp")]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin [_first#" in plan


def test_cleaning_stays_lazy(spark, small):
    tracker = spark.sparkContext.statusTracker()
    bronze = view(spark, small, "v_bronze")  # reads the file schema
    spark.sparkContext.setJobGroup("lazy", "no job may start")
    try:
        flows.clean_quotes(bronze, tie="SEQ")
        assert list(tracker.getJobIdsForGroup("lazy")) == []
    finally:
        spark.sparkContext.setJobGroup("tests", "")


def test_dropped_columns_stay_if_the_rule_is_off(spark, small):
    off = {"cotacao_generico": {"GEN_R08": False}}
    out, _ = flows.clean_quotes(view(spark, small, "v_bronze"), tie="SEQ", toggles=off)
    assert {"CD_NUM_PROPOSTA", "DS_STATUS", "REF_DATE"} <= set(out.columns)
    out, log = flows.clean_quotes(view(spark, small, "v_bronze"), tie="SEQ")
    assert not {"CD_NUM_PROPOSTA", "DS_STATUS", "REF_DATE"} & set(out.columns)
    assert "CD_NUM_PROPOSTA" in next(e for e in log if e.rule_id == "GEN_R07").columns_dropped
