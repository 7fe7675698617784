"""The plans that matter at scale: what is pushed down, pre-aggregated, broadcast and shuffled."""

import pytest
from conftest import plan_of

from tidefeed import operators as op
from tidefeed.plans.catalogue import QUERIES
from tidefeed.sinks import write_csv, write_json_arrays
from tidefeed.sources import load

SMALL = "/root/testdata/sf0.001"


@pytest.fixture
def items(spark):
    return spark.read.parquet(f"{SMALL}/lineitem.parquet")


def final(plan):
    return plan.split("Initial Plan")[0]


def test_totals_read_two_columns_and_aggregate_before_the_shuffle(items):
    plan = final(plan_of(op.group_sum(items, "l_suppkey", "l_quantity")))
    assert "ReadSchema: struct<l_suppkey:bigint,l_quantity:double>" in plan
    assert "PushedFilters: [IsNotNull(l_suppkey)]" in plan
    assert plan.count("partial_sum") >= 1 and plan.count("Exchange") == 1


def test_alerts_reuse_the_shuffled_totals_and_broadcast_one_row(items):
    totals = op.group_sum(items, "l_suppkey", "l_quantity")
    plan = final(plan_of(op.mean_alert(totals, "Total_l_quantity")))
    assert "BroadcastNestedLoopJoin" in plan
    assert "ReusedExchange" in plan
    assert "Window" not in plan


def test_lookup_does_not_shuffle_the_left_side(items):
    codes = op.group_sum_island(items, "l_suppkey", "l_quantity").withColumnRenamed(
        "l_suppkey", "l_partkey"
    )
    plan = final(plan_of(op.lookup_join(items, codes, "l_partkey", "Total_l_quantity", "_B")))
    join = plan.index("BroadcastHashJoin")
    left = plan[join : plan.index("BroadcastQueryStage")]
    assert "Exchange" not in left and "ShuffleQueryStage" not in left


def test_long_key_lists_are_joined_without_a_broadcast_hint(spark, items, monkeypatch):
    monkeypatch.setattr("tidefeed.operators.table.BROADCAST_BYTES", -1)
    kept = op.drop_keys(items, items.select("l_suppkey").limit(3), "l_suppkey")
    logical = kept._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in logical


def test_a_hot_key_is_split_when_the_key_list_is_long(spark, rows, monkeypatch):
    monkeypatch.setattr("tidefeed.operators.table.BROADCAST_BYTES", -1)
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        facts = spark.range(20000).selectExpr("if(id % 3 = 0, 7, id) as k", "id as v")
        keys = spark.range(1000, 3000).selectExpr("id as k")
        kept = op.drop_keys(facts.repartition(8), keys, "k")
        plan = final(plan_of(kept))
        assert "skew=true" in plan
        assert kept.count() == 20000 - sum(1 for i in range(1000, 3000) if i % 3)
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_validation_is_one_filter_over_the_scan(items):
    rules = [op.Rule("l_linenumber", minimum=0, maximum=5), op.Rule("l_tax", boolean=True)]
    accepted = op.check_rows(items.select("l_linenumber", "l_tax"), rules).accepted
    plan = plan_of(accepted)
    assert "Exchange" not in plan and "Python" not in plan
    assert "*(1) Filter" in plan and "CASE" not in plan
    assert "GreaterThanOrEqual(l_linenumber,0)" in plan.split("PushedFilters")[1]


def test_cleaned_tables_prune_columns(spark):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    cleaned = op.clean(labels, 0.8)
    assert cleaned.columns == ["doc_id", "quality"]
    assert "ReadSchema: struct<doc_id:bigint,quality:int>" in plan_of(cleaned)


def test_sampling_stops_early_or_takes_the_top(items):
    top = items.orderBy("l_orderkey").select("l_tax").limit(20)
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()


def test_loading_checks_rows_without_building_reasons(spark, rows, tmp_path):
    df = rows("id int, v double, s string", (1, 2.0, "a"))
    write_csv(df, f"{tmp_path}/a.csv")
    plan = plan_of(load(spark, f"{tmp_path}/a.csv", df.schema).select("s"))
    assert "CASE" not in plan and "to_json" not in plan
    assert "id#" in plan and "v#" in plan  # the check reads all numbers, whatever is selected


def test_json_arrays_are_parsed_once(spark, rows, tmp_path):
    df = rows("id int, s string", (1, "a"))
    write_json_arrays(df, f"{tmp_path}/a.json")
    plan = plan_of(load(spark, f"{tmp_path}/a.json", df.schema))
    assert plan.count("from_json(") == 1


@pytest.mark.parametrize("name", ["weekly_outputs", "merge_abc", "stats_by_key", "clean_full"])
def test_no_python_and_no_single_partition_window(spark, name):
    plan = plan_of(QUERIES[name](spark, SMALL))
    for bad in ("Window", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct"):
        assert bad not in plan
