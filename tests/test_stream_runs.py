"""Captures bounded by time, and rows on what streams did."""

import json
import time

import pytest
from pyspark.sql import functions as F

from logweir.plans import MetadataJob, run_metadata_upsert, run_usage_bronze_split
from logweir.schemas import METADATA_GOLD
from logweir.sources import capture_for, read_table, stream_messages
from logweir.streaming.outcomes import read_outcomes, watch_outcomes

SCHEMA = "body binary, seq long"


def backlog(spark, inbox, n_files, start=0, bad=()):
    for at in range(start, start + n_files):
        body = b"{" if at in bad else json.dumps({"ontology": f"o{at % 4}", "filename": f"f{at}", "size_in_kb": "1"}).encode()
        spark.createDataFrame([(body, at)], SCHEMA).coalesce(1).write.mode("append").parquet(inbox)


def stream(spark, inbox):
    return stream_messages(spark, "parquet", inbox, SCHEMA, maxFilesPerTrigger=1)


def test_a_backlog_larger_than_the_bound_is_drained_over_captures(spark, folder):
    inbox, taken, captures = f"{folder}/in", [], 0
    backlog(spark, inbox, 6)

    def slowly(rows, name):
        taken.append((name, [r.seq for r in rows.collect()]))
        time.sleep(0.8)

    while not capture_for(stream(spark, inbox), slowly, f"{folder}/c", 1.0):
        captures += 1
        assert captures < 20
    names = [name for name, _ in taken]
    assert captures >= 2 and len(set(names)) == len(names) == 6
    assert sorted(seq for _, some in taken for seq in some) == list(range(6))
    backlog(spark, inbox, 1, 6)
    assert capture_for(stream(spark, inbox), slowly, f"{folder}/c", 60)
    assert taken[-1][1] == [6] and len(taken) == 7


def test_a_batch_that_fails_is_no_end_of_time(spark, folder):
    inbox = f"{folder}/in"
    backlog(spark, inbox, 2)

    def broken(rows, name):
        raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        capture_for(stream(spark, inbox), broken, f"{folder}/c", 30)
    seen = []
    assert capture_for(stream(spark, inbox), lambda rows, name: seen.extend(r.seq for r in rows.collect()), f"{folder}/c", 30)
    assert sorted(seen) == [0, 1]


def test_metadata_captures_of_bounded_time(spark, folder):
    inbox = f"{folder}/in"
    backlog(spark, inbox, 5)
    job = MetadataJob(table=f"{folder}/t", tenant="t", label="bus", order_by=["seq"], buckets=4)
    for _ in range(30):
        if run_metadata_upsert(stream(spark, inbox), job, seconds=0.5):
            break
    rows = read_table(spark, job.table, schema=METADATA_GOLD).collect()
    assert {r.ontology: r.filename for r in rows} == {"o0": "f4", "o1": "f1", "o2": "f2", "o3": "f3"}


def test_counts_of_good_and_malformed_rows_per_batch(spark, folder):
    inbox, table = f"{folder}/in", f"{folder}/outcomes"

    def run():
        outcomes = watch_outcomes(spark, table)
        query = run_usage_bronze_split(stream(spark, inbox), f"{folder}/b", f"{folder}/bad", "bus", outcomes=outcomes)
        query.awaitTermination()
        rows = read_outcomes(outcomes).orderBy(F.asc_nulls_last("batch_id"), "ended_at").collect()
        spark.streams.removeListener(outcomes)
        return [(r.batch_id, r.status, r.n_good, r.n_malformed) for r in rows]

    backlog(spark, inbox, 3, bad=(1,))
    first = run()
    assert [r[:2] for r in first] == [(0, "OK"), (1, "OK"), (2, "OK")]
    assert sorted(r[2:] for r in first) == [(0, 1), (1, 0), (1, 0)]
    assert run() == [*first, (None, "EMPTY", 0, 0)]
    spark.createDataFrame([], SCHEMA).coalesce(1).write.mode("append").parquet(inbox)
    again = run()
    assert len(again) == 5 and again[3][1] == again[4][1] == "EMPTY"


def test_a_failed_run_is_a_row(spark, folder):
    inbox, table = f"{folder}/in", f"{folder}/outcomes"
    backlog(spark, inbox, 1)
    outcomes = watch_outcomes(spark, table)
    open(f"{folder}/b", "w").close()  # no folder can be made here
    query = run_usage_bronze_split(stream(spark, inbox), f"{folder}/b", f"{folder}/bad", "bus", outcomes=outcomes)
    with pytest.raises(Exception):
        query.awaitTermination()
    assert [(r.status, r.batch_id) for r in read_outcomes(outcomes).collect()] == [("FAILED", None)]
    spark.streams.removeListener(outcomes)
