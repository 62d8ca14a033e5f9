"""Streams that read once, take events once, and keep gold current."""

import json
import os
import shutil
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

import logweir.sinks.streams as streams
from logweir.operators.changes import changed_keys
from logweir.plans import (
    correct_usage_gold,
    read_usage_gold,
    run_usage_bronze,
    run_usage_bronze_split,
    run_usage_gold_stream,
)
from logweir.schemas import MESSAGE_QUARANTINE, METADATA_GOLD, USAGE_BRONZE, USAGE_SILVER
from logweir.sinks import replace_table, upsert_buckets
from logweir.sources import read_table, stream_messages, stream_table

MESSAGE = "body binary, arrived timestamp"


def body(**fields):
    base = {"start_date": "02/Jan/2024", "start_time": "10:00", "id": "np1", "ontology": "onto_1", "activity": "Login"}
    return json.dumps(base | fields).encode()


def deliver(spark, inbox, rows):
    frame = spark.createDataFrame(rows, "body binary, arrived string")
    frame.withColumn("arrived", F.col("arrived").cast("timestamp")).write.mode("append").parquet(inbox)


def inbox_stream(spark, inbox):
    return stream_messages(spark, "parquet", inbox, MESSAGE)


# ---- redelivered events ----


def test_duplicates_over_two_restarts_and_state_that_shrinks(spark, folder):
    inbox, table = f"{folder}/in", f"{folder}/bronze"
    states = []

    def run():
        queries = run_usage_bronze(inbox_stream(spark, inbox), table, "bus", once_within="10 minutes", arrived="arrived")
        for query in queries:
            query.awaitTermination()
        states.append(queries[0].lastProgress.stateOperators[0].numRowsTotal)
        return sorted(r.id for r in read_table(spark, table, schema=USAGE_BRONZE).collect())

    first = [(body(id=f"a{i}"), f"2024-01-01 00:00:{i:02d}") for i in range(20)]
    deliver(spark, inbox, first + first[:5])
    want = [f"a{i}" for i in range(20)]
    assert run() == sorted(want)
    deliver(spark, inbox, [(text, "2024-01-01 00:05:00") for text, _ in first] + [(body(id="b"), "2024-01-01 00:05:01")])
    assert run() == sorted([*want, "b"])
    deliver(spark, inbox, [(text, "2024-01-01 00:06:00") for text, _ in first[:3]] + [(body(id="b"), "2024-01-01 00:06:00")])
    assert run() == sorted([*want, "b"])
    assert states[-1] >= 21
    # the watermark goes past what is kept, and then an old content counts as new
    deliver(spark, inbox, [(body(id="c"), "2024-01-01 03:00:00")])
    run()
    deliver(spark, inbox, [(body(id="a1"), "2024-01-01 03:01:00"), (None, None), (None, None)])
    assert run() == sorted([*want, "b", "c", "a1"])
    assert states[-1] < 10


def test_malformed_messages_are_taken_once_too(spark, folder):
    inbox = f"{folder}/in"
    rows = [(text, "2024-01-01 00:00:00") for text in (b"nonsense", b"nonsense", b"", None, None, body(), body())]
    deliver(spark, inbox, rows)
    query = run_usage_bronze_split(
        inbox_stream(spark, inbox), f"{folder}/b", f"{folder}/bad", "bus", once_within="1 hour", arrived="arrived"
    )
    query.awaitTermination()
    assert read_table(spark, f"{folder}/b", schema=USAGE_BRONZE).count() == 1
    bad = read_table(spark, f"{folder}/bad", schema=MESSAGE_QUARANTINE).collect()
    # no body and an empty one tell nothing apart
    assert sorted(bytes(r.body or b"") for r in bad) == [b"", b"nonsense"]


# ---- one read for good and bad rows ----


@pytest.fixture
def split(spark, folder):
    inbox, good, bad = f"{folder}/in", f"{folder}/bronze", f"{folder}/bad"
    deliver(spark, inbox, [(body(id=f"a{i}") if i % 3 else b"{", "2024-01-01 00:00:00") for i in range(30)])

    def run():
        query = run_usage_bronze_split(inbox_stream(spark, inbox), good, bad, "bus")
        query.awaitTermination()
        return query

    def counts():
        return tuple(
            read_table(spark, p, schema=s).count() if os.path.isdir(p) else 0
            for p, s in ((good, USAGE_BRONZE), (bad, MESSAGE_QUARANTINE))
        )

    return SimpleNamespace(run=run, counts=counts, inbox=inbox, good=good, bad=bad)


def test_the_source_is_read_once(spark, split):
    progress = split.run().lastProgress
    assert progress.numInputRows == 30 and split.counts() == (20, 10)
    deliver(spark, split.inbox, [(body(), "2024-01-01 00:00:00"), (b"[", "2024-01-01 00:00:00")])
    split.run()
    assert split.counts() == (21, 11)
    assert read_table(spark, split.good, schema=USAGE_BRONZE).where("id IS NULL").count() == 0


def test_a_failure_between_the_two_writes_leaves_no_second_copy(spark, split, monkeypatch):
    write, calls = streams.write_run, []

    def failing(rows, path, name, **more):
        calls.append(path)
        if len(calls) == 2:
            raise RuntimeError("lost between the writes")
        write(rows, path, name, **more)

    monkeypatch.setattr(streams, "write_run", failing)
    with pytest.raises(Exception, match="lost between the writes"):
        split.run()
    assert split.counts() == (20, 0)
    split.run()
    assert split.counts() == (20, 10) and calls == [split.good, split.bad, split.bad]


def test_bronze_in_runs_is_a_stream_for_silver(spark, split, folder):
    split.run()
    rows = stream_table(spark, split.good, USAGE_BRONZE).select(*USAGE_BRONZE.names)
    query = rows.writeStream.format("parquet").option("checkpointLocation", f"{folder}/c").trigger(availableNow=True).start(f"{folder}/o")
    query.awaitTermination()
    assert spark.read.schema(USAGE_BRONZE).parquet(f"{folder}/o").count() == 20


# ---- gold kept current ----


def metadata(spark, sizes):
    rows = [{"ontology": f"onto_{k}", "filename": f"f{k}", "size_in_kb": v} for k, v in sizes.items()]
    return spark.createDataFrame(rows, METADATA_GOLD)


def silver_rows(spark, batch, pairs):
    rows = [{"start_date": "d", "start_time": "t", "id": f"{batch}-{i}", "ontology": o, "activity": a} for i, (o, a) in enumerate(pairs)]
    frame = spark.createDataFrame(rows, "start_date string, start_time string, id string, ontology string, activity string")
    for field in USAGE_SILVER.fields[5:]:
        frame = frame.withColumn(field.name, F.lit(None).cast(field.dataType))
    return frame.withColumn("MetadataLogTimeGenerated", F.lit("2024-01-01 00:00:00").cast("timestamp"))


PAIRS = [(f"onto_{i % 12}", "Download" if i % 2 else "Login") for i in range(48)] + [(None, "Download"), ("onto_99", "Download")]


@pytest.fixture
def gold(spark, folder):
    silver, known, table = f"{folder}/silver", f"{folder}/metadata", f"{folder}/gold"

    def batch(name, pairs=PAIRS):
        silver_rows(spark, name, pairs).coalesce(2).write.mode("append").parquet(silver)
        run_usage_gold_stream(spark, silver, known, table, parts=8).awaitTermination()

    def sizes():
        return sorted((r.id, r.ontology, r.activity, r.size_in_kb) for r in read_usage_gold(spark, table).fillna("").collect())

    def want(by_batch):
        out = []
        for name, known_sizes in by_batch.items():
            for i, (o, a) in enumerate(PAIRS):
                size = known_sizes.get(int(o[5:]), "") if o and a == "Download" else ""
                out.append((f"{name}-{i}", o or "", a, size))
        return sorted(out)

    return SimpleNamespace(batch=batch, sizes=sizes, want=want, silver=silver, known=known, table=table)


def files(path):
    return {
        os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
        for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")
    }


OLD = {k: str(k) for k in range(12)}
NEW = {**{k: str(k) for k in range(12) if k != 5}, 3: "300", 99: "999"}


def test_metadata_replaced_between_two_batches(spark, gold):
    replace_table(metadata(spark, OLD), gold.known)
    gold.batch("a")
    replace_table(metadata(spark, NEW), gold.known)
    gold.batch("b")
    assert gold.sizes() == gold.want({"a": OLD, "b": NEW})


def test_metadata_in_buckets_counts_from_the_next_batch(spark, gold):
    upsert_buckets(metadata(spark, OLD), gold.known, ["ontology"], n_buckets=4)
    gold.batch("a")
    upsert_buckets(metadata(spark, {3: "300"}), gold.known, ["ontology"])
    gold.batch("b")
    assert gold.sizes() == gold.want({"a": OLD, "b": {**OLD, 3: "300"}})
    twice = metadata(spark, OLD).unionByName(metadata(spark, {3: "1"}))
    shutil.rmtree(gold.known)
    replace_table(twice, gold.known)
    with pytest.raises(Exception, match="more than one row"):
        gold.batch("c")


def test_correction_equals_a_rebuild_and_leaves_other_partitions(spark, gold):
    replace_table(metadata(spark, OLD), gold.known)
    gold.batch("a")
    gold.batch("b")
    before = files(gold.table)
    old, new = metadata(spark, OLD), metadata(spark, NEW)
    assert correct_usage_gold(spark, gold.table, old, new, "v2", parts=8) == 3
    assert gold.sizes() == gold.want({"a": NEW, "b": NEW})
    after = files(gold.table)
    ontologies = spark.createDataFrame([(f"onto_{k}",) for k in (3, 5, 99)], "ontology string")
    stale = {r[0] for r in ontologies.select(F.pmod(F.xxhash64("ontology"), F.lit(8))).collect()}
    kept = {f for f in before if int(f.split("ontology_part=")[1].split("/")[0]) not in stale}
    assert kept and all(after.get(f) == before[f] for f in kept)
    assert not {f for f in before if f not in kept} & set(after)
    assert correct_usage_gold(spark, gold.table, new, new, "v3", parts=8) == 0 and files(gold.table) == after


def test_a_correction_that_died_is_completed(spark, gold, monkeypatch):
    import logweir.sinks.tables as tables

    replace_table(metadata(spark, OLD), gold.known)
    gold.batch("a")
    old, new = metadata(spark, OLD), metadata(spark, NEW)
    monkeypatch.setattr(tables, "remove", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):
        correct_usage_gold(spark, gold.table, old, new, "v2", parts=8)
    monkeypatch.undo()
    # lost while partitions were being exchanged: one is gone
    gone = next(f for f in files(gold.table) if "ontology_part" in f and spark.read.parquet(f).where("size_in_kb = '300'").count())
    shutil.rmtree(os.path.dirname(gone))
    assert gold.sizes() != gold.want({"a": NEW})
    correct_usage_gold(spark, gold.table, old, new, "v2", parts=8)
    assert gold.sizes() == gold.want({"a": NEW})


def test_changed_keys(spark):
    schema = "k string, v string, w int"
    old = spark.createDataFrame([("a", "1", 1), ("b", None, 2), ("c", "3", 3), (None, "x", 4), ("e", "", 5)], schema)
    new = spark.createDataFrame([("a", "1", 9), ("b", "2", 2), ("d", "4", 3), (None, "y", 4), ("e", None, 5)], schema)
    got = {r.k: r.change for r in changed_keys(old, new, ["k"], ["v"]).collect()}
    assert got == {"b": "updated", "c": "removed", "d": "added", "e": "updated"}
    assert changed_keys(old, old, ["k"], ["v", "w"]).isEmpty()
