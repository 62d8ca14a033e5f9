"""How the jobs behave as their inputs grow; prints one JSON line per measurement.

Everything is derived from the tables in $BENCH_SF_DIR, enlarged by repeating rows.
"""

import json
import os
import sys
import time
from datetime import timedelta
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import functions as F

import logweir_queries.bindings as B
from logweir import operators as O
from logweir.operators.joins import skew_safe_join
from logweir.plans import (
    QueryLogJob,
    run_query_log_etl,
    run_usage_bronze,
    run_usage_silver,
)
from logweir.session import build_session, work_folder
from logweir.sources import stream_messages

SF = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")


def report(name, **values):
    print(json.dumps({"measurement": name, **values}), flush=True)


def timed(action):
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def sink(df):
    df.write.format("noop").mode("overwrite").save()


def streams(spark, n_files):
    """Messages to silver, with the input cut into n_files."""
    inbox, folder = work_folder(spark, "inbox"), work_folder(spark, "stream")
    messages = B.usage_messages(B.table(spark, SF, "events"))
    n_rows = messages.count()
    messages.repartition(n_files).write.parquet(inbox)

    def run():
        source = stream_messages(spark, "parquet", inbox, "event_id long, body binary")
        for query in run_usage_bronze(source, f"{folder}/bronze", "bus"):
            query.awaitTermination()
        run_usage_silver(spark, f"{folder}/bronze", f"{folder}/silver", "t").awaitTermination()

    run_time = timed(run)
    report("streams", files=n_files, rows=n_rows, sec=run_time, rows_per_sec=int(n_rows / run_time))


def upserts(spark, factor):
    """A target `factor` times the source: the source's size is what should count."""
    part = B.metadata(B.table(spark, SF, "part"))
    n_source = part.count()
    copies = F.explode(F.sequence(F.lit(0), F.lit(factor - 1))).alias("copy")
    target = part.select("*", copies).withColumn(
        "ontology", F.concat_ws("_", "ontology", "copy")
    )
    source = part.withColumn("ontology", F.concat("ontology", F.lit("_0")))
    place = f"{work_folder(spark, 'upsert')}/target"
    target.drop("copy").write.parquet(place)
    stored = spark.read.parquet(place)
    run_time = timed(lambda: sink(O.upsert(stored, source, ["ontology"])))
    rows = n_source * (factor + 1)
    report("upserts", target_per_source=factor, rows=rows, sec=run_time, rows_per_sec=int(rows / run_time))


def incremental(spark):
    """One new day on top of the days before it, against all days at once."""
    source = B.stage_json_logs(spark, SF)
    first, last = (
        B.table(spark, SF, "events").agg(F.min(F.to_date("ts")), F.max(F.to_date("ts"))).first()
    )

    def job(name):
        folder = work_folder(spark, name)
        return QueryLogJob(
            source=source,
            table=f"{folder}/queries",
            checkpoint=f"{folder}/mark",
            tenant="t",
            first_day=first,
            layout=B.STAGED_LAYOUT,
            day_pattern=B.STAGED_DAY,
        )

    whole, daily = job("whole"), job("daily")
    full = timed(lambda: run_query_log_etl(spark, whole, last))
    run_query_log_etl(spark, daily, last - timedelta(days=1))
    day = timed(lambda: run_query_log_etl(spark, daily, last))
    report("incremental", days=(last - first).days + 1, full_sec=full, one_day_sec=day)


def hot_key(spark, copies):
    """A left side with a third of its rows under one key, joined to a large right side."""
    usage = B.usage(B.table(spark, SF, "events"))
    repeat = F.explode(F.sequence(F.lit(1), F.lit(copies))).alias("copy")
    key = F.when(F.col("copy") % 3 == 0, F.lit("onto_0")).otherwise(
        F.concat("ontology", F.lit("_"), F.col("copy"))
    )
    place = work_folder(spark, "hot")
    usage.select("*", repeat).withColumn("ontology", key).repartition(32).write.parquet(place)
    left = spark.read.parquet(place)
    right = B.metadata(B.table(spark, SF, "part"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    plain = timed(lambda: sink(left.join(right, "ontology", "left")))
    split = timed(
        lambda: sink(skew_safe_join(left, right, ["ontology"], "left", rows_per_task=500_000))
    )
    report("hot_key", rows=left.count(), plain_sec=plain, split_sec=split)
    for name, df in (
        ("plain", left.join(right, "ontology", "left")),
        ("split", skew_safe_join(left, right, ["ontology"], "left", rows_per_task=500_000)),
    ):
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        sizes = df.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        report("hot_key_largest_task", join=name, rows=sizes[0])
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def main():
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = build_session(
        "scaling",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": "32",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    streams(spark, 1)
    for n_files in (1, 10, 100):
        streams(spark, n_files)
    upserts(spark, 1)
    for factor in (1, 10, 100):
        upserts(spark, factor)
    incremental(spark)
    incremental(spark)
    hot_key(spark, 100)
    spark.stop()


if __name__ == "__main__":
    main()
