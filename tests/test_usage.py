"""Messages, the three usage layers and their streams."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from logweir.functions import source_label
from logweir.operators.parse import parse_messages, split_malformed
from logweir.plans.metadata import MetadataJob, metadata_rows, run_metadata_upsert
from logweir.plans.usage import run_usage_bronze, run_usage_gold, run_usage_silver
from logweir.schemas import METADATA_GOLD, USAGE_BRONZE, USAGE_EVENT, USAGE_GOLD, USAGE_SILVER
from logweir.sinks.streams import stream_append
from logweir.sources.messages import stream_messages
from logweir.sources.tables import read_table, rows_table
from logweir.streaming.layers import bronze_rows, gold_rows, malformed_rows, silver_rows

BAD = [None, "", "nonsense", "[1]", '[{"id":"np1"}]', '"text"', "7", '{"id":"np1"', "null"]


def event(**fields):
    base = {"start_date": "02/Jan/2024", "start_time": "10:00", "id": "np1", "ontology": "onto_1", "activity": "Login"}
    return json.dumps(base | fields)


def bodies(spark, texts):
    return spark.createDataFrame([(None if t is None else t.encode(),) for t in texts], "body binary")


def shape(schema):
    return [(f.name, f.dataType) for f in schema]


def test_malformed_messages_are_split_off(spark):
    good = [event(), event(extra=1), '{"id":"np2"}', "{}", event(id=5)]
    rows, bad = split_malformed(parse_messages(bodies(spark, good + BAD), USAGE_EVENT))
    assert rows.columns == USAGE_EVENT.names and rows.count() == len(good)
    assert bad.count() == len(BAD)
    assert {row.id for row in rows.collect()} == {"np1", "np2", None, "5"}
    assert {row.ontology for row in rows.collect()} == {"onto_1", None}


def test_malformed_rows_can_be_kept_as_null_rows(spark):
    messages = bodies(spark, [event(), *BAD])
    assert bronze_rows(messages, "bus").count() == 1
    kept = bronze_rows(messages, "bus", keep_malformed=True)
    assert kept.count() == 1 + len(BAD)
    assert kept.where("id IS NULL AND activity IS NULL").count() == len(BAD)
    assert malformed_rows(messages).count() == len(BAD)


def test_layer_schemas(spark):
    metadata = spark.createDataFrame([("onto_1", "f.owl", "7")], "ontology string, filename string, size_in_kb string")
    bronze = bronze_rows(bodies(spark, [event(), event(activity="Download")]), "bus-1")
    silver = silver_rows(bronze, "t1")
    gold = gold_rows(silver, metadata)
    assert shape(bronze.schema) == shape(USAGE_BRONZE)
    assert shape(silver.schema) == shape(USAGE_SILVER)
    assert shape(gold.schema) == shape(USAGE_GOLD)
    files = {row.activity: (row.filename, row.size_in_kb) for row in gold.collect()}
    assert files == {"Login": (None, None), "Download": ("f.owl", "7")}
    row = silver.first()
    assert (row.MetadataLogType, row.Type) == ("logm.omp.metadata", "LOGM_OMP_MEATADATA_CL")
    assert (row.MetadataLogFileName, row.TenantId) == ("bus-1", "t1")


def test_gold_content_id_covers_the_silver_row(spark):
    import hashlib

    now = F.lit("2024-01-02 03:04:05.678").cast("timestamp")
    metadata = spark.createDataFrame([], "ontology string, filename string, size_in_kb string")
    silver = silver_rows(bronze_rows(bodies(spark, [event(ontology=None)]), "b", now=now), "t1", now=now)
    row = gold_rows(silver, metadata).first()
    body = {name: row[name] for name in USAGE_SILVER.names if row[name] is not None}
    body["MetadataLogTimeGenerated"] = "2024-01-02T03:04:05.678Z"
    text = json.dumps(body, separators=(",", ":")).replace("/", "/")
    assert row.MetadataLogDate == 20240102030405678
    assert row.MetadataLogId == hashlib.sha512(text.encode()).hexdigest()


def test_gold_dedupe_is_off_by_default(spark):
    metadata = spark.createDataFrame([], "ontology string, filename string, size_in_kb string")
    silver = silver_rows(bronze_rows(bodies(spark, [event(), event()]), "b"), "t1")
    assert gold_rows(silver, metadata).count() == 2
    assert gold_rows(silver, metadata, dedupe=True).count() == 1


def test_source_label():
    assert source_label("bus", datetime(2024, 1, 2, 3, 4, 5)) == "bus-2024-01-02 03:04:05"


def write_messages(folder, name, texts):
    from pathlib import Path

    path = Path(folder)
    path.mkdir(parents=True, exist_ok=True)
    (path / name).write_text("".join(text + "\n" for text in texts))


def finish(queries):
    for query in queries:
        query.awaitTermination()


def test_streams_restart_without_loss_or_repeats(spark, folder):
    inbox = f"{folder}/in"
    bronze, silver, gold, bad, meta = (f"{folder}/{n}" for n in ("bronze", "silver", "gold", "bad", "meta"))
    rows = [(f"onto_{i}", f"file_{i}.owl", str(i)) for i in range(3)]
    known = spark.createDataFrame(rows, "ontology string, filename string, size_in_kb string")
    for name in METADATA_GOLD.names[3:]:
        known = known.withColumn(name, F.lit(None).cast(METADATA_GOLD[name].dataType))
    known.write.parquet(meta)
    sent = []
    for part in range(3):
        texts = [event(id=f"np{part}{i}", ontology=f"onto_{i}", activity="Download" if i % 2 else "Login") for i in range(6)]
        texts += texts[:1]
        sent += texts
        write_messages(inbox, f"m{part}.json", [*texts, "nonsense"])
        for _ in range(2):
            finish(run_usage_bronze(stream_messages(spark, "text", inbox), bronze, "bus", quarantine=bad))
            finish([run_usage_silver(spark, bronze, silver, "t1", limits={"maxFilesPerTrigger": 1})])
    run_usage_gold(spark, silver, meta, gold)
    run_usage_gold(spark, silver, meta, gold)
    table = read_table(spark, gold)
    got = sorted((r.id, r.ontology, r.activity, r.filename) for r in table.collect())
    want = []
    for text in sent:
        e = json.loads(text)
        at = int(e["ontology"][5:])
        want.append((e["id"], e["ontology"], e["activity"], f"file_{at}.owl" if e["activity"] == "Download" and at < 3 else None))
    assert got == sorted(want, key=lambda r: r[:3])
    assert [r.body.decode() for r in spark.read.parquet(bad).collect()] == ["nonsense"] * 3
    assert shape(spark.read.parquet(silver).schema) == shape(USAGE_SILVER)


def test_gold_refuses_repeated_metadata(spark, folder):
    silver = silver_rows(bronze_rows(bodies(spark, [event(activity="Download")]), "b"), "t1")
    silver.write.parquet(f"{folder}/silver")
    rows = [("onto_1", "a", "1"), ("onto_1", "b", "2"), (None, "c", "3"), (None, "d", "4")]
    meta = rows_table(spark, rows, "ontology string, filename string, size_in_kb string")
    meta.write.parquet(f"{folder}/meta")
    paths = f"{folder}/silver", f"{folder}/meta", f"{folder}/gold"
    with pytest.raises(ValueError):
        run_usage_gold(spark, *paths)
    run_usage_gold(spark, *paths, unique=False)
    assert read_table(spark, f"{folder}/gold").count() == 2
    meta.where("filename <> 'b'").write.parquet(f"{folder}/meta2")
    run_usage_gold(spark, paths[0], f"{folder}/meta2", paths[2])
    assert read_table(spark, f"{folder}/gold").first().filename == "a"


def test_stream_checkpoint_may_not_be_the_table(spark, folder):
    write_messages(f"{folder}/in", "m.json", [event()])
    with pytest.raises(ValueError):
        stream_append(stream_messages(spark, "text", f"{folder}/in"), f"{folder}/t", checkpoint=f"{folder}/t/")


def metadata_event(at, size, **more):
    return json.dumps({"ontology": f"onto_{at}", "filename": f"file_{at}.owl", "size_in_kb": str(size)} | more)


@pytest.fixture
def capture(spark, folder):
    schema = "seq long, body string"
    inbox = f"{folder}/bus"
    job = MetadataJob(
        table=f"{folder}/meta", tenant="t1", label="bus-1", quarantine=f"{folder}/bad", order_by=["seq"]
    )

    def send(first, texts):
        rows = [(first + at, text) for at, text in enumerate(texts)]
        spark.createDataFrame(rows, schema).write.mode("append").parquet(inbox)
        run_metadata_upsert(stream_messages(spark, "parquet", inbox, schema), job)

    def sizes():
        return sorted((r.ontology, r.size_in_kb) for r in read_table(spark, job.table).collect())

    send.job, send.sizes, send.inbox, send.schema = job, sizes, inbox, schema
    return send


def test_metadata_capture_keeps_the_newest_per_key(spark, capture):
    capture(0, [metadata_event(1, 5), metadata_event(1, 9), metadata_event(1, 7), metadata_event(2, 1), "junk"])
    assert capture.sizes() == [("onto_1", "7"), ("onto_2", "1")]
    capture(10, [metadata_event(2, 4), metadata_event(3, 6)])
    assert capture.sizes() == [("onto_1", "7"), ("onto_2", "4"), ("onto_3", "6")]
    table = read_table(spark, capture.job.table)
    assert shape(table.schema) == shape(METADATA_GOLD)
    assert spark.read.parquet(capture.job.quarantine).count() == 1
    capture.sizes()
    run_metadata_upsert(stream_messages(spark, "parquet", capture.inbox, capture.schema), capture.job)
    assert capture.sizes() == [("onto_1", "7"), ("onto_2", "4"), ("onto_3", "6")]


def test_dense_ids_of_captures_do_not_repeat(spark, capture):
    from dataclasses import replace

    dense = replace(capture.job, guid="dense")
    for first in (0, 10):
        rows = [(first + at, metadata_event(first + at, 1)) for at in range(3)]
        spark.createDataFrame(rows, capture.schema).write.mode("append").parquet(capture.inbox)
        run_metadata_upsert(stream_messages(spark, "parquet", capture.inbox, capture.schema), dense)
    ids = [r[0] for r in read_table(spark, dense.table).select("MetadataLogGuid").collect()]
    assert len(ids) == len(set(ids)) == 6 and None not in ids


def test_metadata_without_key_is_inserted_once_even_on_replay(spark, capture, folder):
    from logweir.sinks.tables import upsert_table

    no_key = metadata_event(0, 1, ontology=None)
    capture(0, [no_key, no_key, metadata_event(1, 5)])
    assert read_table(spark, capture.job.table).where("ontology IS NULL").count() == 2
    batch = bodies(spark, [no_key]).withColumn("seq", F.lit(1))
    rows, _ = metadata_rows(batch, capture.job)
    for _ in range(2):
        upsert_table(rows, capture.job.table, ["ontology"], ["_order_seq"], METADATA_GOLD.names, token="b9")
    assert read_table(spark, capture.job.table).where("ontology IS NULL").count() == 3


def test_metadata_id_depends_on_payload_only_unless_asked(spark, capture):
    from dataclasses import replace

    def ids(job, when):
        now = F.lit(when).cast("timestamp")
        batch = bodies(spark, [metadata_event(1, 5)]).withColumn("seq", F.lit(1))
        return metadata_rows(batch, job, now)[0].first().MetadataLogId

    times = "2024-01-01 00:00:00", "2024-01-02 00:00:00"
    full = replace(capture.job, full_body=True)
    assert ids(capture.job, times[0]) == ids(capture.job, times[1])
    assert ids(full, times[0]) != ids(full, times[1])


def test_batch_that_fails_after_its_write_is_not_applied_twice(spark, capture, monkeypatch):
    import logweir.plans.metadata as plan

    write, calls = plan.upsert_table, []

    def failing(*args, **kwargs):
        write(*args, **kwargs)
        calls.append(kwargs["token"])
        if len(calls) == 1:
            raise RuntimeError("executor lost")

    monkeypatch.setattr(plan, "upsert_table", failing)
    texts = [metadata_event(0, 1, ontology=None), metadata_event(1, 5), "junk"]
    with pytest.raises(Exception, match="executor lost"):
        capture(0, texts)
    run_metadata_upsert(stream_messages(spark, "parquet", capture.inbox, capture.schema), capture.job)
    assert len(calls) == 2 and len(set(calls)) == 1
    assert sorted(r.size_in_kb for r in read_table(spark, capture.job.table).collect()) == ["1", "5"]
    assert spark.read.parquet(capture.job.quarantine).count() == 1


def test_stream_begun_anew_is_not_taken_for_a_replay(spark, capture, folder):
    """Without its checkpoint a capture reads everything again, as its own first batch."""
    from dataclasses import replace

    capture(0, [metadata_event(1, 5)])
    capture.sizes()
    rows = [(9, metadata_event(1, 8))]
    spark.createDataFrame(rows, capture.schema).write.mode("append").parquet(capture.inbox)
    anew = replace(capture.job, checkpoint=f"{folder}/other")
    run_metadata_upsert(stream_messages(spark, "parquet", capture.inbox, capture.schema), anew)
    assert capture.sizes() == [("onto_1", "8")]


def test_empty_capture_writes_nothing(spark, capture, folder):
    from logweir.sources.tables import table_exists

    capture(0, [])
    assert not table_exists(spark, capture.job.table)
