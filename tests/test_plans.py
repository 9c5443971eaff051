"""The physical plans are the ones the design counts on."""

import pytest
from pyspark.sql import functions as F

from vigil.functions.codec import to_readings
from vigil.operators.scoring import score
from vigil.operators.training import fit_models, history_at_triggers
from vigil.plans import stages
from vigil.plans.inputs import as_device_events, read_events
from vigil.plans.queries import QUERIES, REPLAY
from vigil.session import materialize, shared_folder

SF = "/root/testdata/sf0.001"
LIVE = {n for n in QUERIES if n.endswith("_stream")}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    done = df.agg(F.count("*"))
    done.collect()
    return plan_of(done).split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", sorted(set(QUERIES) - LIVE))
def test_no_cross_or_loop_joins(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in plan
    assert "NestedLoopJoin" not in plan
    assert "SinglePartition" not in plan


def test_scan_reads_only_what_is_needed(spark):
    plan = plan_of(QUERIES["count_per_device"](spark, SF))
    assert "ReadSchema: struct<user_id:bigint>" in plan


def test_limit_comes_before_the_shuffle(spark):
    plan = plan_of(QUERIES["training_history"](spark, SF))
    assert plan.count("WindowGroupLimit") == 4
    assert plan.rindex("WindowGroupLimit") > plan.rindex("Exchange hashpartitioning")


def test_message_is_parsed_once(spark):
    assert plan_of(QUERIES["decode_events"](spark, SF)).count("from_json") == 1


def test_upsert_is_hash_aggregated(spark):
    plan = plan_of(QUERIES["stored_readings"](spark, SF))
    assert plan.count("HashAggregate") == 2 and "SortAggregate" not in plan and "Join" not in plan


def test_history_scans_the_readings_once(spark):
    events = as_device_events(read_events(spark, SF))
    triggers = materialize(QUERIES["collection_triggers"](spark, SF))
    history = history_at_triggers(stages.stored_readings(events), triggers, 30, 10, REPLAY.slice_ms)
    plan = final_plan(history)
    assert plan.count("events.parquet") == 1
    assert "ReusedExchange" in plan


def test_skewed_device_is_split_when_models_are_too_many_to_broadcast(spark):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    hot = F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 1000).cast("int")
    events = spark.range(0, 300_000, 1, 16).select(
        hot.alias("id"), F.col("id").alias("eventtime"), F.rand(1).alias("value"), F.rand(2).alias("base")
    )
    models = fit_models(to_readings(events))
    try:
        for name, value in conf.items():
            spark.conf.set(name, value)
        plan = final_plan(score(events, models).filter("distance >= 0"))
    finally:
        for name in conf:
            spark.conf.unset(name)
    assert "SortMergeJoin(skew=true)" in plan, plan


def test_scratch_goes_where_the_cluster_says(spark):
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        assert shared_folder(spark) == folder
    table = materialize(spark.range(5), "probe")
    assert table.count() == 5
    assert shared_folder(spark).split(":")[-1] in table.inputFiles()[0]
