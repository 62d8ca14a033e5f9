"""Physical plans: what must be pushed down, broadcast or shuffled, and what must never appear."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from logweir import operators as O
from logweir.operators.joins import skew_safe_join
from logweir.streaming import bronze_rows
from logweir_queries import bindings as B

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().toString()


@pytest.mark.parametrize("name", ["usage_enrich", "usage_enrich_shuffled", "usage_enrich_concat", "metadata_upsert",
                                  "metadata_upsert_shuffled", "price_status", "price_status_shuffled", "late_rows_unseen",
                                  "usage_gold_rows", "query_log_envelope", "layer_validation", "candidate_files"])
def test_no_cross_join_and_no_python(spark, name):
    text = plan(entry_module.queries()[name](spark, SF))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "EvalPython"):
        assert word not in text


def test_watermark_filter_and_columns_reach_the_scan(spark):
    text = plan(entry_module.queries()["log_since_watermark"](spark, SF))
    assert "GreaterThan(ts,2024-01-15" in text
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,event_type:string>" in text


def test_message_is_parsed_once(spark):
    good = bronze_rows(B.usage_messages(B.table(spark, SF, "events").limit(5)), "bus")
    physical = plan(good).split("== Physical Plan ==")[1]
    assert physical.count("from_json(") == 1


def test_envelope_is_one_stage_without_a_shuffle(spark):
    events = B.table(spark, SF, "events").select("event_id", "ts", F.lit("s").alias("source"))
    rows = O.envelope(events, time="ts", source="source", tenant="t", log_type="a", table_type="b")
    assert "Exchange" not in plan(rows).split("== Physical Plan ==")[1]


def test_size_decides_between_broadcast_and_shuffle(spark):
    usage = B.usage(B.table(spark, SF, "events"))
    part = B.metadata(B.table(spark, SF, "part"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        small = plan(O.enrich_usage(usage, part))
        large = plan(O.enrich_usage(usage, part, max_broadcast_bytes=10))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in small and "SortMergeJoin" not in small
    assert "SortMergeJoin" in large and "BroadcastHashJoin" not in large


def test_rows_without_a_key_do_not_enter_the_shuffle(spark):
    left = spark.range(8).select(F.when(F.col("id") > 4, F.col("id")).alias("k"), "id")
    right = spark.range(8).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    joined = skew_safe_join(left, right, ["k"])
    assert plan(joined).split("== Physical Plan ==")[1].lstrip().splitlines()[1].strip(" +-") == "Union"
    assert joined.count() == 8
