"""The usage pipeline: messages to bronze to silver as streams, silver and metadata to gold."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from logweir.fixed_values import FILE_ACTIVITY
from logweir.functions import minute_stamp, source_label
from logweir.operators.changes import changed_keys
from logweir.operators.enrich import enrich_usage, repeated_keys
from logweir.operators.envelope import SEQUENCE
from logweir.operators.joins import bounded_join
from logweir.schemas import METADATA_GOLD, USAGE_BRONZE, USAGE_GOLD, USAGE_SILVER
from logweir.session import pin_utc
from logweir.sinks.streams import default_checkpoint, stream_append, stream_tables
from logweir.sinks.tables import replace_partitions, replace_table
from logweir.sources.tables import read_table, stream_table
from logweir.streaming.layers import (
    bronze_columns,
    bronze_rows,
    gold_rows,
    malformed_columns,
    malformed_rows,
    parsed_messages,
    silver_rows,
)
from logweir.streaming.outcomes import OUTCOME
from logweir.streaming.sequence import number_stream

#: Partitions of streamed gold: the micro-batch, and a part of the ontologies.
GOLD_RUN, GOLD_PART = "ingest_run", "ontology_part"
GOLD_PARTS = 16
#: What gold takes from the metadata.
ATTRIBUTES = ("filename", "size_in_kb")


def run_usage_bronze(
    messages, table, label, *, started_at=None, quarantine=None, fmt="parquet", keep_malformed=False,
    once_within=None, arrived=None, rest=None, **trigger,
):
    """Start the message stream into bronze; returns the running queries.

    With `started_at`, the run's start time, rows carry it next to the name of their source.

    With a quarantine table, malformed messages go there through a second query. Each query has
    its own checkpoint, so either can stop and resume without the other. `run_usage_bronze_split`
    does both with one read.

    With `once_within`, such as "1 hour", a message that is delivered again within that time is left
    out; `arrived` names the source's column of arrival, such as Kafka's `timestamp`. `rest` names a
    VARIANT column for fields that the schema does not know.
    """
    pin_utc(messages.sparkSession)
    if started_at:
        label = source_label(label, started_at)
    again = {"once_within": once_within, "arrived": arrived}
    rows = bronze_rows(messages, label, keep_malformed=keep_malformed, rest=rest, **again)
    queries = [stream_append(rows, table, fmt, **trigger)]
    if quarantine:
        queries.append(stream_append(malformed_rows(messages, **again), quarantine, fmt, **trigger))
    return queries


def run_usage_bronze_split(
    messages, table, quarantine, label, *, started_at=None, checkpoint=None, once_within=None,
    arrived=None, rest=None, outcomes=None, **trigger,
):
    """Start the message stream into bronze and quarantine at once; returns the running query.

    Each message is read and parsed once. Both tables are parquet and get the rows of a micro-batch
    as one run; a batch that died between them is completed when it comes again. `outcomes`, made by
    `watch_outcomes`, gets one row for each micro-batch."""
    pin_utc(messages.sparkSession)
    if started_at:
        label = source_label(label, started_at)
    parsed = parsed_messages(messages, once_within=once_within, arrived=arrived, rest=rest)

    def tables(batch):
        return {
            table: batch.where(~F.col("malformed")).select(*bronze_columns(label, rest=rest)),
            quarantine: batch.where("malformed").select(*malformed_columns()),
        }

    name = None
    if outcomes:
        name = outcomes.query_name
        parsed = parsed.observe(
            OUTCOME,
            F.count_if(~F.col("malformed")).alias("n_good"),
            F.count_if("malformed").alias("n_malformed"),
        )
    return stream_tables(parsed, tables, checkpoint or default_checkpoint(table), name=name, **trigger)


def run_usage_silver(spark, bronze, table, tenant, *, fmt="parquet", limits=None, **trigger):
    """Start the bronze to silver stream; returns the running query. `limits` bounds one
    micro-batch, such as {"maxFilesPerTrigger": 1000}."""
    pin_utc(spark)
    rows = stream_table(spark, bronze, USAGE_BRONZE, fmt, **(limits or {})).select(*USAGE_BRONZE.names)
    return stream_append(silver_rows(rows, tenant), table, fmt, **trigger)


def run_usage_gold(spark, silver, metadata, table, *, fmt="parquet", unique=True, **gold):
    """Rebuild gold from silver and the current metadata.

    Metadata with two rows for one ontology would repeat usage rows, so it is refused; with
    `unique=False` the rows are repeated.
    """
    pin_utc(spark)
    rows = read_table(spark, silver, fmt, USAGE_SILVER)
    known = read_table(spark, metadata, fmt, METADATA_GOLD)
    if unique and not repeated_keys(known).isEmpty():
        raise ValueError("the metadata has more than one row for an ontology")
    replace_table(gold_rows(rows, known, **gold), table, fmt)


def _current_metadata(spark, metadata):
    known = read_table(spark, metadata, schema=METADATA_GOLD)
    if not repeated_keys(known).isEmpty():
        raise ValueError("the metadata has more than one row for an ontology")
    return known


def run_usage_gold_stream(
    spark, silver, metadata, table, *, parts=GOLD_PARTS, checkpoint=None, limits=None, guid="stable",
    bits=512, **trigger,
):
    """Start the silver to gold stream; returns the running query.

    Each micro-batch is joined with the metadata that is current when it is taken, so a replaced or
    upserted metadata table counts from the next batch on; `correct_usage_gold` brings what is stored
    up to it. The rows of a batch are one run of the table, parted by ontology. With `guid="dense"`
    the row ids number each minute's rows on over all batches."""
    pin_utc(spark)
    rows = stream_table(spark, silver, USAGE_SILVER, **(limits or {})).select(*USAGE_SILVER.names)
    if guid == "dense":
        rows = number_stream(rows, SEQUENCE, minute_stamp(F.col("MetadataLogTimeGenerated")))
        guid = "numbered"

    def tables(batch):
        gold = gold_rows(batch, _current_metadata(spark, metadata), bits=bits, guid=guid)
        return {table: gold.withColumn(GOLD_PART, _gold_part(parts))}

    checkpoint = checkpoint or default_checkpoint(table)
    return stream_tables(rows, tables, checkpoint, partition_by={table: [GOLD_PART]}, **trigger)


def _gold_part(parts):
    return F.pmod(F.xxhash64("ontology"), F.lit(parts)).cast("int")


def read_usage_gold(spark, table, partitions=False):
    """Streamed gold, with the columns it is parted by if asked for."""
    parted = [T.StructField(GOLD_RUN, T.StringType()), T.StructField(GOLD_PART, T.IntegerType())]
    rows = spark.read.schema(T.StructType([*USAGE_GOLD.fields, *parted])).parquet(table)
    return rows if partitions else rows.select(*USAGE_GOLD.names)


def correct_usage_gold(spark, table, old, new, token, *, parts=GOLD_PARTS):
    """Bring streamed gold, made with the metadata `old`, up to `new`; returns the number of changed
    ontologies.

    Only partitions with file events of a changed ontology are read whole and replaced; the others
    keep their files. `token` names the change, such as the new version: a correction that died
    half-way is completed by one with the same token, and one that is repeated leaves the same rows.
    `parts` must be that of the stream."""
    pin_utc(spark)
    if not repeated_keys(new).isEmpty():
        raise ValueError("the metadata has more than one row for an ontology")
    changed = changed_keys(old, new, ["ontology"], list(ATTRIBUTES)).persist()
    try:
        n_changed = changed.count()
        # one small number for each part
        touched = [r[0] for r in changed.select(_gold_part(parts)).distinct().collect()]
        gold = read_usage_gold(spark, table, partitions=True).where(F.col(GOLD_PART).isin(touched))
        files = gold.where(F.col("activity") == FILE_ACTIVITY)
        partition = [GOLD_RUN, GOLD_PART]
        hit = bounded_join(files, changed.select("ontology"), ["ontology"], "left_semi").select(*partition).distinct()
        stale = bounded_join(gold, hit, partition, "left_semi").drop(*ATTRIBUTES)
        right = enrich_usage(stale, new, attributes=ATTRIBUTES)
        if n_changed:
            replace_partitions(right.select(*USAGE_GOLD.names, *partition), table, partition, token)
        return n_changed
    finally:
        changed.unpersist()
