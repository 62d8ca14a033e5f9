"""Registered queries: each runs one operator or job over the given tables, next to the SQL that
gives the same rows."""

from __future__ import annotations

import sys
from collections.abc import Callable
from datetime import datetime, timedelta, timezone
from functools import partial
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logweir import functions as X
from logweir import operators as O
from logweir.fixed_values import (
    METADATA_FIELDS,
    QUERY_LOG_FIELDS,
    QUERY_LOG_TYPE,
    QUERY_TABLE_TYPE,
    USAGE_FIELDS,
)
from logweir.operators.envelope import SEQUENCE
from logweir.plans import (
    MetadataJob,
    QueryLogJob,
    correct_usage_gold,
    read_usage_gold,
    run_metadata_upsert,
    run_price_watch,
    run_query_log_etl,
    run_query_log_stream,
    run_usage_bronze,
    run_usage_bronze_split,
    run_usage_gold,
    run_usage_gold_stream,
    run_usage_silver,
    store_metadata,
)
from logweir.plans.query_log import read_query_log
from logweir.schemas import MESSAGE_QUARANTINE, METADATA_EVENT, METADATA_GOLD, USAGE_BRONZE, USAGE_EVENT
from logweir.session import pin_utc, work_folder
from logweir.sinks import append_table, replace_table, stream_append, upsert_buckets
from logweir.sources import (
    candidate_files,
    read_buckets,
    read_json_logs,
    read_table,
    read_watchlist,
    rows_table,
    stream_messages,
    stream_table,
)
from logweir.sources.messages import BODY
from logweir.streaming import bronze_rows, gold_rows, silver_rows
from logweir.streaming.outcomes import read_outcomes, watch_outcomes
from logweir.streaming.sequence import number_stream
from logweir_queries import bindings as B
from logweir_queries.sql import SQL

MARK = "2024-01-15 00:00:00"
TAGS = {"tenant": "tenant-1", "log_type": QUERY_LOG_TYPE, "table_type": QUERY_TABLE_TYPE}


def _local(name):
    """An instant as a zone-free UTC time."""
    return F.col(name).cast("timestamp_ntz").alias(name)


# ---- parsing -------------------------------------------------------------------------------


def usage_parse_json(spark, sf):
    messages = B.usage_messages(B.table(spark, sf, "events"))
    good, _ = O.split_malformed(O.parse_messages(messages, USAGE_EVENT, keep=["event_id"]))
    return good


def usage_props_json(spark, sf):
    events = B.table(spark, sf, "events")
    schema = T.StructType([T.StructField("k", T.LongType())])
    return O.parse_messages(events, schema, "props", keep=["event_id"]).select("event_id", "k")


def usage_other_fields(spark, sf):
    """What messages hold beside the usage fields: nested and repeated fields, a field that is not
    text, and nothing."""
    messages = B.extended_messages(B.table(spark, sf, "events"))
    parsed = O.parse_messages(messages, USAGE_EVENT, keep=["event_id"], rest="rest")
    return parsed.select("event_id", "id", "activity", F.to_json("rest").alias("rest"))


def malformed_split(spark, sf):
    messages = B.usage_messages(B.table(spark, sf, "events"), broken=True)
    parsed = O.parse_messages(messages, USAGE_EVENT, keep=["event_id"])
    return parsed.select("event_id", "malformed", "id", "activity")


def log_split_24(spark, sf):
    lines = B.order_log_lines(B.table(spark, sf, "orders"), B.table(spark, sf, "customer"))
    return O.parse_query_log(lines, keep=["o_orderkey"], count_as="n_fields")


def file_date_extract(spark, sf):
    path = B.log_path(F.col("o_orderkey"), F.col("o_orderdate"))
    orders = B.table(spark, sf, "orders").select("o_orderkey", path.alias("path"))
    return orders.select(
        "o_orderkey", X.source_dir("path").alias("source_dir"), X.file_day("path").alias("file_day")
    )


def page_title_extract(spark, sf):
    return B.table(spark, sf, "pages").select("page_id", X.page_title("html").alias("title"))


def page_nested_element(spark, sf):
    """Elements that nest their own kind, closed and left open, in the given pages."""
    pages = B.nested_pages(B.table(spark, sf, "pages"))
    return pages.select("page_id", X.element_text("html", "offer").alias("offer"))


def json_log_scan(spark, sf):
    rows = read_json_logs(spark, [B.stage_json_logs(spark, sf)])
    return rows.select(
        F.col("@timestamp").cast("timestamp_ntz").alias("event_time"),
        "log",
        F.col("_corrupt_record").alias("raw"),
        F.regexp_extract("input_file_path", "server=(AVDP[0-9])", 1).alias("server"),
        X.file_day("input_file_path", B.STAGED_DAY).alias("file_day"),
    )


# ---- envelope and ids ----------------------------------------------------------------------


def _event_source(spark, sf):
    columns = ["event_id", "user_id", "event_type", "ts", F.lit("bus-1").alias("source")]
    return B.table(spark, sf, "events").select(*columns)


def envelope_core(spark, sf):
    rows = O.envelope(
        _event_source(spark, sf), time="ts", source="source", now=B.fixed_now(), bits=256, **TAGS
    )
    return rows.drop("MetadataLogGuid").withColumn(
        "minute", X.minute_stamp(F.col("MetadataLogTimeGenerated"))
    )


def query_log_envelope(spark, sf):
    lines = B.order_log_lines(B.table(spark, sf, "orders"), B.table(spark, sf, "customer"))
    time, source = "TimeGenerated", "input_file_path"
    keep = [F.col("time").alias(time), F.col("path").alias(source)]
    rows = O.parse_query_log(lines, keep=keep).select(time, *QUERY_LOG_FIELDS, source)
    enveloped = O.envelope(rows, time=time, source=source, now=B.fixed_now(), bits=256, **TAGS)
    return enveloped.drop("MetadataLogGuid")


def content_id_256(spark, sf):
    events = B.table(spark, sf, "events")
    return events.select(
        "event_id", X.content_id(["event_type", "user_id", "props"], 256).alias("content_id")
    )


def log_guid_dense(spark, sf):
    """Of each event, the minute and the number within it."""
    rows = O.add_identity(_event_source(spark, sf), time="ts", bits=256, guid="dense")
    return rows.select(
        F.expr("MetadataLogGuid DIV 1000000000L").alias("minute"),
        (F.col("MetadataLogGuid") % 10**9).alias("place"),
    )


def log_guid_dense_stream(spark, sf):
    """As `log_guid_dense`, on a stream that is begun anew for the second half of the events."""
    folder = work_folder(spark, "numbers")
    inbox, table = f"{folder}/inbox", f"{folder}/rows"
    events = _event_source(spark, sf)
    early = F.col("event_id") <= F.lit(events.agg(F.avg("event_id")).first()[0])
    for part in (early, ~early):
        events.where(part).write.mode("append").parquet(inbox)
        rows = stream_table(spark, inbox, events.schema)
        numbered = number_stream(rows, SEQUENCE, X.minute_stamp(F.col("ts")))
        stream_append(O.add_identity(numbered, time="ts", bits=256, guid="numbered"), table).awaitTermination()
    return read_table(spark, table).select(
        F.expr("MetadataLogGuid DIV 1000000000L").alias("minute"),
        (F.col("MetadataLogGuid") % 10**9).alias("place"),
    )


def ingest_clock(spark, sf):
    """Whether the ingest time of each row lies within the run that wrote it."""
    path = f"{work_folder(spark, 'clock')}/rows"
    started = datetime.now(timezone.utc)
    append_table(O.envelope(_event_source(spark, sf), time="ts", source="source", **TAGS), path)
    ended = datetime.now(timezone.utc)
    at = F.col("TimeGenerated").cast("timestamp")
    return read_table(spark, path).select(
        "event_id", at.between(F.lit(started), F.lit(ended)).alias("within_run")
    )


def log_guid_stable(spark, sf):
    rows = O.add_identity(_event_source(spark, sf), time="ts", bits=256)
    return rows.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct("MetadataLogGuid").alias("n_ids"),
        F.countDistinct("MetadataLogId").alias("n_content_ids"),
    )


# ---- high-water marks ----------------------------------------------------------------------


def log_since_watermark(spark, sf):
    events = B.table(spark, sf, "events").select("event_id", "ts", "event_type")
    return O.since(events, "ts", F.lit(MARK).cast("timestamp_ntz"))


def _marked_rows(spark, sf):
    path = B.log_path(F.col("event_id"), F.col("ts"))
    return B.table(spark, sf, "events").select("ts", path.alias("path"))


def next_checkpoint(spark, sf):
    return O.next_checkpoint(_marked_rows(spark, sf), time="ts", source="path")


def latest_checkpoint(spark, sf):
    runs = _marked_rows(spark, sf).groupBy(F.date_format("ts", "yyyyMMdd").alias("file_date"))
    return O.latest_checkpoint(runs.agg(F.max("ts").alias("last_timegenerated")))


def candidate_file_grid(spark, sf):
    days = B.table(spark, sf, "orders").agg(
        F.min(F.to_date("o_orderdate")).alias("first_day"),
        F.max(F.to_date("o_orderdate")).alias("last_day"),
    )
    return candidate_files(days, "/logs")


def late_rows_unseen(spark, sf):
    rows = _event_source(spark, sf)
    mark = F.lit(MARK).cast("timestamp_ntz")
    window = (F.col("ts") > mark - F.expr("INTERVAL 3 DAYS")) & (F.col("ts") <= mark)
    ids = rows.where(window).withColumn("MetadataLogId", X.content_id(rows.columns, 256))
    stored = ids.where(F.col("event_type").isin("view", "click"))
    return O.unseen(ids, stored).select("event_id", "MetadataLogId")


# ---- upsert --------------------------------------------------------------------------------


def _part_updates(spark, sf):
    """Many versions of each key, half of the keys known and half new."""
    lineitem = B.table(spark, sf, "lineitem")
    return lineitem.select(
        F.concat(F.lit("onto_"), F.col("l_partkey") * 2).alias("ontology"),
        F.concat(F.lit("file_"), "l_orderkey", F.lit(".owl")).alias("filename"),
        F.col("l_linenumber").cast("string").alias("size_in_kb"),
        "l_shipdate",
        "l_orderkey",
        "l_linenumber",
    )


def metadata_upsert(spark, sf):
    return O.upsert(
        B.metadata(B.table(spark, sf, "part")),
        _part_updates(spark, sf),
        ["ontology"],
        ["l_shipdate", "l_orderkey", "l_linenumber"],
    )


def metadata_upsert_shuffled(spark, sf):
    return O.upsert(
        B.metadata(B.table(spark, sf, "part")),
        _part_updates(spark, sf),
        ["ontology"],
        ["l_shipdate", "l_orderkey", "l_linenumber"],
        max_broadcast_bytes=0,
    )


def metadata_upsert_bucketed(spark, sf):
    """The table is dealt into buckets; of each batch's keys only the buckets are rewritten."""
    path = f"{work_folder(spark, 'buckets')}/metadata"
    upsert_buckets(B.metadata(B.table(spark, sf, "part")), path, ["ontology"], n_buckets=16)
    order = ["l_shipdate", "l_orderkey", "l_linenumber"]
    updates = _part_updates(spark, sf)
    first, last = updates.agg(F.min("l_shipdate"), F.max("l_shipdate")).first()
    early = F.col("l_shipdate") <= F.lit(first + (last - first) / 2).cast("timestamp_ntz")
    for token, batch in (("early", updates.where(early)), ("late", updates.where(~early))):
        upsert_buckets(batch, path, ["ontology"], order, METADATA_FIELDS, token=token)
    return read_buckets(spark, path, METADATA_EVENT)


def metadata_capture(spark, sf, buckets=0):
    """Create the table from part, then drain the event stream into it, at each delivery."""
    folder = work_folder(spark, "metadata")
    known = B.metadata(B.table(spark, sf, "part"))
    first = O.envelope(
        known.withColumns({"t": B.fixed_now().cast("timestamp"), "s": F.lit("load")}),
        time="t",
        source="s",
        **TAGS,
    )
    job = MetadataJob(
        table=f"{folder}/table",
        tenant="tenant-1",
        label="bus-1",
        quarantine=f"{folder}/malformed",
        order_by=["event_id"],
        buckets=buckets,
    )
    store_metadata(first, job)
    for messages in _deliveries(spark, sf, folder, B.metadata_messages):
        run_metadata_upsert(messages, job)
    table = read_table(spark, job.table, schema=METADATA_GOLD)
    return table.select(*METADATA_FIELDS, "MetadataLogFileName", "Type")


def metadata_capture_bucketed(spark, sf):
    return metadata_capture(spark, sf, buckets=16)


def metadata_capture_timed(spark, sf):
    """The stream is drained by captures of at most a second and the batch that is in hand then."""
    folder = work_folder(spark, "metadata")
    job = MetadataJob(table=f"{folder}/table", tenant="t", label="bus-1", order_by=["event_id"], buckets=16)
    events = B.table(spark, sf, "events")
    first, last = events.agg(F.min("event_id"), F.max("event_id")).first()
    messages = B.metadata_messages(events)
    quarter = F.floor((F.col("event_id") - first) * 4 / (last - first + 1))
    for part in range(4):  # newer files hold newer events
        messages.where(quarter == part).coalesce(1).write.mode("append").parquet(f"{folder}/inbox")
    drained = False
    while not drained:
        one = stream_messages(spark, "parquet", f"{folder}/inbox", messages.schema, maxFilesPerTrigger=1)
        drained = run_metadata_upsert(one, job, seconds=1)
    return read_table(spark, job.table, schema=METADATA_GOLD).select(*METADATA_FIELDS)


def usage_stream_outcomes(spark, sf):
    """What three starts of the split stream did: two deliveries, and one start that finds nothing."""
    folder = work_folder(spark, "outcomes")
    table, bad, log = (f"{folder}/{name}" for name in ("bronze", "malformed", "outcomes"))
    broken = partial(B.usage_messages, broken=True)

    def run(messages):
        outcomes = watch_outcomes(spark, log)
        run_usage_bronze_split(messages, table, bad, "bus-1", outcomes=outcomes).awaitTermination()
        rows = read_outcomes(outcomes)
        spark.streams.removeListener(outcomes)
        return rows

    for messages in _deliveries(spark, sf, folder, broken, as_text=True):
        run(messages)
    rows = run(stream_messages(spark, "text", f"{folder}/inbox"))
    return rows.select("batch_id", "status", "n_good", "n_malformed")


def _deliveries(spark, sf, folder, bind, as_text=False):
    """The events' messages, delivered in two parts: after each, the stream over what is there."""
    events = B.table(spark, sf, "events")
    early = F.col("event_id") <= F.lit(events.agg(F.avg("event_id")).first()[0])
    inbox = f"{folder}/inbox"
    for part in (early, ~early):
        messages = bind(events.where(part))
        if as_text:
            lines = messages.select(F.col(BODY).cast("string").alias("value"))
            lines.write.mode("append").text(inbox)
            yield stream_messages(spark, "text", inbox)
        else:
            messages.write.mode("append").parquet(inbox)
            yield stream_messages(spark, "parquet", inbox, messages.schema)


# ---- usage layers --------------------------------------------------------------------------


def usage_enrich(spark, sf):
    usage = B.usage(B.table(spark, sf, "events"))
    return O.enrich_usage(usage, B.metadata(B.table(spark, sf, "part")))


def usage_enrich_shuffled(spark, sf):
    usage = B.usage(B.table(spark, sf, "events"))
    part = B.metadata(B.table(spark, sf, "part"))
    return O.enrich_usage(usage, part, max_broadcast_bytes=0)


def usage_enrich_concat(spark, sf):
    usage = B.usage(B.table(spark, sf, "events"))
    return O.enrich_usage(usage, B.metadata(B.table(spark, sf, "part")), key="concat")


def _bronze(spark, sf, **options):
    messages = B.usage_messages(B.table(spark, sf, "events"), broken=True)
    return bronze_rows(messages, "bus-1", now=B.fixed_now(), **options)


def _silver(spark, sf):
    return silver_rows(_bronze(spark, sf), "tenant-1", now=B.fixed_now())


def usage_bronze_rows(spark, sf):
    return _bronze(spark, sf)


def usage_bronze_null_rows(spark, sf):
    return _bronze(spark, sf, keep_malformed=True)


def usage_silver_rows(spark, sf):
    return _silver(spark, sf)


def usage_gold_rows(spark, sf):
    part = B.metadata(B.table(spark, sf, "part"))
    return gold_rows(_silver(spark, sf), part, bits=256).drop("MetadataLogGuid")


def usage_stream_gold(spark, sf):
    """Messages to bronze to silver as streams, each started at two deliveries, then gold."""
    folder = work_folder(spark, "usage")
    bronze, silver, gold = (f"{folder}/{name}" for name in ("bronze", "silver", "gold"))
    for messages in _deliveries(spark, sf, folder, B.usage_messages, as_text=True):
        for query in run_usage_bronze(messages, bronze, "bus-1"):
            query.awaitTermination()
        run_usage_silver(spark, bronze, silver, "tenant-1").awaitTermination()
    replace_table(_known(B.metadata(B.table(spark, sf, "part"))), f"{folder}/metadata")
    run_usage_gold(spark, silver, f"{folder}/metadata", gold)
    return read_table(spark, gold).select(*USAGE_FIELDS, "filename", "size_in_kb")


def _bronze_job(spark, sf):
    """Messages, some malformed, to bronze and quarantine."""
    folder = work_folder(spark, "bronze")
    table, bad = f"{folder}/bronze", f"{folder}/malformed"
    broken = partial(B.usage_messages, broken=True)
    for messages in _deliveries(spark, sf, folder, broken, as_text=True):
        started = datetime(2024, 2, 1, 12, 34, 56)
        for query in run_usage_bronze(messages, table, "bus-1", started_at=started, quarantine=bad):
            query.awaitTermination()
    return table, bad


def usage_bronze_stream(spark, sf):
    table, _ = _bronze_job(spark, sf)
    return read_table(spark, table).select(*USAGE_FIELDS, "input_file_path")


def usage_quarantine(spark, sf):
    _, bad = _bronze_job(spark, sf)
    return read_table(spark, bad).select(F.col(BODY).cast("string").alias(BODY))


def usage_split_bronze(spark, sf):
    table, _ = _split_job(spark, sf)
    return read_table(spark, table, schema=USAGE_BRONZE).select(*USAGE_FIELDS, "input_file_path")


def usage_split_quarantine(spark, sf):
    _, bad = _split_job(spark, sf)
    rows = read_table(spark, bad, schema=MESSAGE_QUARANTINE)
    return rows.select(F.col(BODY).cast("string").alias(BODY))


def _split_job(spark, sf):
    """Messages, some malformed, to bronze and quarantine with one read of each delivery."""
    folder = work_folder(spark, "split")
    table, bad = f"{folder}/bronze", f"{folder}/malformed"
    broken = partial(B.usage_messages, broken=True)
    for messages in _deliveries(spark, sf, folder, broken, as_text=True):
        run_usage_bronze_split(messages, table, bad, "bus-1").awaitTermination()
    return table, bad


def usage_stream_clock(spark, sf):
    """Micro-batches, rows and whether each row's stamp lies within the run of its micro-batch."""
    folder = work_folder(spark, "stamps")
    table, runs = f"{folder}/bronze", []
    for messages in _deliveries(spark, sf, folder, B.usage_messages, as_text=True):
        started = datetime.now(timezone.utc)
        for query in run_usage_bronze(messages, table, "bus-1"):
            query.awaitTermination()
        runs.append((started, datetime.now(timezone.utc)))
    stamp = F.col("TimeGenerated")
    within = [stamp.between(F.lit(first), F.lit(last)) for first, last in runs]
    return read_table(spark, table, schema=USAGE_BRONZE).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct(stamp).alias("n_stamps"),
        F.count_if(within[0] | within[1]).alias("n_within"),
    )


def usage_stream_once(spark, sf):
    """The second delivery holds every event of the first again, in a stream begun anew."""
    folder = work_folder(spark, "once")
    inbox, table = f"{folder}/inbox", f"{folder}/bronze"
    events = B.table(spark, sf, "events")
    early = F.col("event_id") <= F.lit(events.agg(F.avg("event_id")).first()[0])
    for hour, part in enumerate((events.where(early), events)):
        arrived = F.timestamp_add("HOUR", F.lit(hour), B.fixed_now().cast("timestamp"))
        messages = B.usage_messages(part).withColumn("arrived", arrived)
        messages.write.mode("append").parquet(inbox)
        stream = stream_messages(spark, "parquet", inbox, messages.schema)
        for query in run_usage_bronze(stream, table, "bus-1", once_within="6 hours", arrived="arrived"):
            query.awaitTermination()
    return read_table(spark, table, schema=USAGE_BRONZE).select(*USAGE_FIELDS)


def _known(metadata):
    """Metadata as a gold table has it, without an envelope."""
    for name in METADATA_GOLD.names[len(METADATA_FIELDS) :]:
        metadata = metadata.withColumn(name, F.lit(None).cast(METADATA_GOLD[name].dataType))
    return metadata


def _streamed_gold(spark, sf, folder):
    """Silver to gold as a stream in two deliveries; the metadata is replaced between them, by one
    with another size for every third file."""
    part = B.metadata(B.table(spark, sf, "part"))
    silver, gold, known = f"{folder}/silver", f"{folder}/gold", f"{folder}/metadata"
    grown = F.concat("size_in_kb", F.lit("0"))
    number = F.regexp_extract("ontology", "([0-9]+)", 1).cast("long")
    later = part.withColumn("size_in_kb", F.when(number % 3 == 0, grown).otherwise(F.col("size_in_kb")))
    for messages, metadata in zip(_deliveries(spark, sf, folder, B.usage_messages, as_text=True), (part, later)):
        replace_table(_known(metadata), known)
        for query in run_usage_bronze(messages, f"{folder}/bronze", "bus-1"):
            query.awaitTermination()
        run_usage_silver(spark, f"{folder}/bronze", silver, "tenant-1").awaitTermination()
        run_usage_gold_stream(spark, silver, known, gold, bits=256).awaitTermination()
    return gold, _known(part), _known(later)


def usage_gold_stream(spark, sf):
    gold, _, _ = _streamed_gold(spark, sf, work_folder(spark, "gold"))
    return read_usage_gold(spark, gold).select(*USAGE_FIELDS, "filename", "size_in_kb")


def usage_gold_corrected(spark, sf):
    gold, old, new = _streamed_gold(spark, sf, work_folder(spark, "gold"))
    correct_usage_gold(spark, gold, old, new, "later")
    return read_usage_gold(spark, gold).select(*USAGE_FIELDS, "filename", "size_in_kb")


def metadata_changes(spark, sf):
    """What the updates of the line items change in the metadata."""
    part = B.metadata(B.table(spark, sf, "part"))
    order = ["l_shipdate", "l_orderkey", "l_linenumber"]
    updated = O.upsert(part, _part_updates(spark, sf), ["ontology"], order)
    return O.changed_keys(part, updated, ["ontology"], ["filename", "size_in_kb"])


def captured_rows(spark, sf):
    """Events by an activity that the driver has as rows."""
    known = rows_table(spark, B.CAPTURED_ACTIVITIES, "event_type string, activity string")
    events = B.table(spark, sf, "events").join(F.broadcast(known), "event_type", "left")
    return events.groupBy("activity").agg(F.count(F.lit(1)).alias("n_events"))


def layer_validation(spark, sf):
    """Against the declared schemas; silver is held against bronze's, which it must not match."""
    bronze = _bronze(spark, sf, keep_malformed=True)
    bronze = bronze.withColumn("TimeGenerated", F.col("TimeGenerated").cast("timestamp"))
    silver = _silver(spark, sf)
    part = B.metadata(B.table(spark, sf, "part"))
    gold = O.enrich_usage(silver, part)
    return O.validate_layers(
        {"bronze": bronze, "silver": silver, "metadata": part, "gold": gold},
        keys={"bronze": ["id"], "silver": ["id"], "metadata": ["ontology"], "gold": ["filename"]},
        schemas={"bronze": USAGE_BRONZE, "silver": USAGE_BRONZE},
        follows={"silver": "bronze", "gold": "silver"},
    )


def _kept_layers(spark, sf):
    """The events as a layer, and a layer after it that lost every 997th event and repeated the one
    that is 500 ahead, on days that both have."""
    events = B.table(spark, sf, "events").select("event_id", "ts", "event_type", "value")
    lost = F.pmod("event_id", F.lit(997)) == 5
    again = events.where(F.pmod("event_id", F.lit(997)) == 505)
    return events, events.where(~lost).unionByName(again)


def layer_checksums(spark, sf):
    """Days whose rows differ between the layers, with their numbers of rows."""
    day, content = F.to_date("ts"), X.content_id(["event_id", "event_type"], 256)
    upper, lower = (O.day_checksums(layer, day, content) for layer in _kept_layers(spark, sf))
    return O.differing_days(upper, lower)


def layer_reconcile(spark, sf):
    upper, lower = _kept_layers(spark, sf)
    content = X.content_id(["event_id", "event_type"], 256)
    return O.reconcile(upper, lower, F.to_date("ts"), content)


def layer_preview(spark, sf):
    events = B.table(spark, sf, "events").select("event_id", "ts", "event_type")
    return O.preview_layers({"bronze": events}, 20, {"bronze": [F.desc("ts")]})["bronze"]


# ---- query-log job and tables --------------------------------------------------------------


def _query_log_job(spark, sf, source, lateness=False):
    """(job, first day, last day); with lateness, all days may still get lines."""
    folder = work_folder(spark, "etl")
    first, last = (
        B.table(spark, sf, "events")
        .agg(F.min(F.to_date("ts")), F.max(F.to_date("ts")))
        .first()
    )
    job = QueryLogJob(
        source=source,
        table=f"{folder}/queries",
        checkpoint=f"{folder}/mark",
        quarantine=f"{folder}/unusable",
        tenant="tenant-1",
        first_day=first,
        layout=B.STAGED_LAYOUT,
        day_pattern=B.STAGED_DAY,
        allowed_lateness=(last - first + timedelta(days=1)) if lateness else timedelta(0),
    )
    return job, first, last


def _query_log_runs(spark, sf):
    """The job over the staged logs in two runs, split at the middle day."""
    job, first, last = _query_log_job(spark, sf, B.stage_json_logs(spark, sf))
    for day in (first + timedelta(days=(last - first).days // 2), last):
        run_query_log_etl(spark, job, day)
    return job


def _stored_lines(spark, job):
    return read_query_log(spark, job).select(
        *QUERY_LOG_FIELDS, _local("MetadataLogTimeGenerated"), "MetadataLogDate", "TenantId"
    )


def incremental_two_runs(spark, sf):
    return _stored_lines(spark, _query_log_runs(spark, sf))


def incremental_late_runs(spark, sf):
    """A part of the lines comes after the first run, into days that it has read; the third run
    finds nothing new."""
    late = F.col("event_id") % 11 == 0
    source = B.stage_json_logs(spark, sf, ~late)
    job, _, last = _query_log_job(spark, sf, source, lateness=True)
    run_query_log_etl(spark, job, last)
    B.stage_json_logs(spark, sf, late, source)
    for _ in range(2):
        run_query_log_etl(spark, job, last)
    return _stored_lines(spark, job)


def _query_log_stream(spark, sf):
    """The files as a stream, begun anew after more of them have come, for days that it has read."""
    later = F.col("event_id") % 11 == 0
    source = B.stage_json_logs(spark, sf, ~later)
    job, _, _ = _query_log_job(spark, sf, source)
    run_query_log_stream(spark, job).awaitTermination()
    B.stage_json_logs(spark, sf, later, source)
    run_query_log_stream(spark, job).awaitTermination()
    return job


def query_log_stream(spark, sf):
    return _stored_lines(spark, _query_log_stream(spark, sf))


def query_log_stream_quarantine(spark, sf):
    job = _query_log_stream(spark, sf)
    return spark.read.parquet(job.quarantine).select("raw", "reason")


def query_log_status(spark, sf):
    """Outcomes of a run without files, one with lines and one without new lines."""
    job, first, last = _query_log_job(spark, sf, B.stage_json_logs(spark, sf))
    days = (first - timedelta(days=1), last, last)
    results = [run_query_log_etl(spark, job, day) for day in days]
    rows = [(at, result.status, result.n_rows) for at, result in enumerate(results)]
    return rows_table(spark, rows, "run int, status string, n_rows long")


def query_log_quarantine(spark, sf):
    job = _query_log_runs(spark, sf)
    return spark.read.parquet(job.quarantine).select("raw", "reason")


def query_log_checkpoint(spark, sf):
    job = _query_log_runs(spark, sf)
    return read_table(spark, job.checkpoint).select("file_date", _local("last_timegenerated"))


def table_append(spark, sf):
    path = f"{work_folder(spark, 'append')}/events"
    events = B.table(spark, sf, "events")
    early = F.col("ts") <= F.lit(MARK).cast("timestamp_ntz")
    for half in (events.where(early), events.where(~early)):
        append_table(half, path, partition_by=["event_type"])
    return read_table(spark, path).select("event_id", "ts", "event_type", "value")


def table_replace(spark, sf):
    """The second version is made from the first."""
    path = f"{work_folder(spark, 'replace')}/orders"
    replace_table(B.table(spark, sf, "orders"), path)
    raised = read_table(spark, path).withColumn("o_totalprice", F.col("o_totalprice") * 2)
    replace_table(raised, path)
    return read_table(spark, path).select("o_orderkey", "o_orderstatus", "o_totalprice")


# ---- prices --------------------------------------------------------------------------------


def price_status(spark, sf):
    part = B.table(spark, sf, "part")
    return O.price_status(B.watchlist(part), B.product_pages(part))


def price_status_shuffled(spark, sf):
    part = B.table(spark, sf, "part")
    return O.price_status(B.watchlist(part), B.product_pages(part), max_broadcast_bytes=0)


def price_top_n(spark, sf):
    part = B.table(spark, sf, "part")
    first = O.first_rows(B.watchlist(part), ["Model"], 5)
    return O.price_status(first, B.product_pages(part)).select("Model", "status", "line")


def page_prices(spark, sf):
    """Several products of each of the given pages."""
    pages = B.table(spark, sf, "pages")
    return O.price_status(B.page_watchlist(pages), B.priced_pages(pages))


def watchlist_csv(spark, sf):
    path = f"{work_folder(spark, 'watchlist')}/products"
    B.watchlist(B.table(spark, sf, "part")).write.option("header", True).csv(path)
    return read_watchlist(spark, path)


def price_report_lines(spark, sf):
    part = B.table(spark, sf, "part")
    report = f"{work_folder(spark, 'prices')}/report"
    run_price_watch(B.watchlist(part), B.product_pages(part), report)
    return spark.read.text(report).withColumnRenamed("value", "line")


QUERIES = {
    "usage_parse_json": usage_parse_json,
    "usage_props_json": usage_props_json,
    "usage_other_fields": usage_other_fields,
    "malformed_split": malformed_split,
    "log_split_24": log_split_24,
    "file_date_extract": file_date_extract,
    "page_title_extract": page_title_extract,
    "page_nested_element": page_nested_element,
    "json_log_scan": json_log_scan,
    "envelope_core": envelope_core,
    "query_log_envelope": query_log_envelope,
    "content_id_256": content_id_256,
    "log_guid_dense": log_guid_dense,
    "log_guid_dense_stream": log_guid_dense_stream,
    "ingest_clock": ingest_clock,
    "log_guid_stable": log_guid_stable,
    "log_since_watermark": log_since_watermark,
    "next_checkpoint": next_checkpoint,
    "latest_checkpoint": latest_checkpoint,
    "candidate_files": candidate_file_grid,
    "late_rows_unseen": late_rows_unseen,
    "metadata_upsert": metadata_upsert,
    "metadata_upsert_shuffled": metadata_upsert_shuffled,
    "metadata_upsert_bucketed": metadata_upsert_bucketed,
    "metadata_capture": metadata_capture,
    "metadata_capture_bucketed": metadata_capture_bucketed,
    "metadata_capture_timed": metadata_capture_timed,
    "usage_stream_outcomes": usage_stream_outcomes,
    "usage_enrich": usage_enrich,
    "usage_enrich_shuffled": usage_enrich_shuffled,
    "usage_enrich_concat": usage_enrich_concat,
    "usage_bronze_rows": usage_bronze_rows,
    "usage_bronze_null_rows": usage_bronze_null_rows,
    "usage_silver_rows": usage_silver_rows,
    "usage_gold_rows": usage_gold_rows,
    "usage_stream_gold": usage_stream_gold,
    "usage_bronze_stream": usage_bronze_stream,
    "usage_quarantine": usage_quarantine,
    "usage_split_bronze": usage_split_bronze,
    "usage_split_quarantine": usage_split_quarantine,
    "usage_stream_clock": usage_stream_clock,
    "usage_stream_once": usage_stream_once,
    "usage_gold_stream": usage_gold_stream,
    "usage_gold_corrected": usage_gold_corrected,
    "metadata_changes": metadata_changes,
    "captured_rows": captured_rows,
    "layer_validation": layer_validation,
    "layer_checksums": layer_checksums,
    "layer_reconcile": layer_reconcile,
    "layer_preview": layer_preview,
    "incremental_two_runs": incremental_two_runs,
    "incremental_late_runs": incremental_late_runs,
    "query_log_stream": query_log_stream,
    "query_log_stream_quarantine": query_log_stream_quarantine,
    "query_log_quarantine": query_log_quarantine,
    "query_log_checkpoint": query_log_checkpoint,
    "query_log_status": query_log_status,
    "table_append": table_append,
    "table_replace": table_replace,
    "price_status": price_status,
    "price_status_shuffled": price_status_shuffled,
    "price_top_n": price_top_n,
    "page_prices": page_prices,
    "watchlist_csv": watchlist_csv,
    "price_report_lines": price_report_lines,
}


def _llm():
    """Queries of the training-data operators and their SQL; none where that subpackage or
    something it needs can't be imported, which is said on standard error."""
    try:
        from logweir.llm import queries as llm
    except ImportError as error:
        print(f"without the training-data queries: {error}", file=sys.stderr)
        return {}, {}
    try:
        import corpus_pipeline
    except ImportError as error:
        print(f"without the corpus pipeline: {error}", file=sys.stderr)
        return dict(llm.QUERIES), dict(llm.SQL)
    sql = dict(llm.SQL)
    if corpus_pipeline.ORACLE_SQL:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return {**llm.QUERIES, "pipeline": corpus_pipeline.run}, sql


LLM_QUERIES, LLM_SQL = _llm()


def _pinned(query):
    def run(spark, sf_dir):
        return query(pin_utc(spark), sf_dir)

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """One entry per operator or job; each takes (spark, sf_dir)."""
    return {name: _pinned(query) for name, query in {**QUERIES, **LLM_QUERIES}.items()}


def entry(spark: SparkSession) -> DataFrame:
    """Usage events with the metadata of the file they fetched."""
    return queries()["usage_enrich"](spark, "/root/testdata/sf0.001")


def oracle_sql() -> dict[str, str]:
    """The same rows in SQL over the same tables."""
    return {**SQL, **LLM_SQL}
