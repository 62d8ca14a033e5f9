"""Dense row ids on streams."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from logweir.functions import minute_stamp
from logweir.operators.envelope import SEQUENCE, add_identity
from logweir.plans import read_usage_gold, run_usage_gold_stream
from logweir.schemas import METADATA_GOLD, USAGE_SILVER
from logweir.sinks import replace_table, stream_append
from logweir.sources import read_table, stream_table
from logweir.streaming.sequence import number_stream

SCHEMA = "t timestamp, k string, n long, ok boolean"


def batch(spark, name, minutes):
    rows = [(m, f"{name}-{i}", None if i % 3 else 2**62 + i, None if i % 2 else True) for i, m in enumerate(minutes)]
    frame = spark.createDataFrame(rows, "t string, k string, n long, ok boolean")
    return frame.withColumn("t", F.col("t").cast("timestamp")).repartition(3)


def test_no_repeat_and_no_gap_over_three_restarts(spark, folder):
    inbox, table = f"{folder}/in", f"{folder}/out"
    hot = ["2024-01-01 10:00:00.123456"] * 40 + ["2024-01-01 10:01:30"] * 5 + [None] * 3
    sent = {}
    for run in range(4):
        rows = batch(spark, f"r{run}", hot + [f"2024-01-01 11:{run:02d}:00"] * 2)
        sent.update({r.k: (r.n, r.ok, r.t) for r in rows.collect()})
        rows.write.mode("append").parquet(inbox)
        stream = stream_table(spark, inbox, rows.schema, maxFilesPerTrigger=1)
        numbered = number_stream(stream, SEQUENCE, minute_stamp(F.col("t")))
        stream_append(add_identity(numbered, time="t", guid="numbered"), table).awaitTermination()
    stored = read_table(spark, table).collect()
    assert {r.k: (r.n, r.ok, r.t) for r in stored} == sent and len(stored) == len(sent)
    ids = defaultdict(list)
    for r in stored:
        ids[r.MetadataLogGuid // 10**9 if r.MetadataLogGuid is not None else None].append(r.MetadataLogGuid)
    assert len(ids.pop(None)) == 12
    assert sorted(map(len, ids.values())) == [2, 2, 2, 2, 20, 160]
    for minute, given in ids.items():
        assert sorted(given) == [minute * 10**9 + at for at in range(len(given))]


def test_gold_stream_numbers_on(spark, folder):
    silver, known, table = f"{folder}/silver", f"{folder}/metadata", f"{folder}/gold"
    replace_table(spark.createDataFrame([], METADATA_GOLD), known)
    for run in range(2):
        rows = spark.range(30).select(F.concat(F.lit(f"{run}-"), "id").alias("id"))
        for field in USAGE_SILVER.fields:
            if field.name != "id":
                rows = rows.withColumn(field.name, F.lit(None).cast(field.dataType))
        rows = rows.withColumn("MetadataLogTimeGenerated", F.lit("2024-01-01 10:00:00").cast("timestamp"))
        rows.select(*USAGE_SILVER.names).write.mode("append").parquet(silver)
        run_usage_gold_stream(spark, silver, known, table, guid="dense").awaitTermination()
    gold = read_usage_gold(spark, table)
    assert sorted(r.MetadataLogGuid for r in gold.collect()) == [2401011000 * 10**9 + at for at in range(60)]


def test_a_full_group_and_other_columns_are_refused(spark, folder):
    rows = batch(spark, "a", ["2024-01-01 10:00:00"] * 9)
    rows.write.parquet(f"{folder}/in")
    stream = stream_table(spark, f"{folder}/in", rows.schema)
    full = number_stream(stream, SEQUENCE, minute_stamp(F.col("t")), limit=8)
    with pytest.raises(Exception, match="more rows than 8"):
        stream_append(full, f"{folder}/out").awaitTermination()
    with pytest.raises(ValueError, match="can't be numbered"):
        number_stream(stream.withColumn("x", F.array("k")), SEQUENCE, F.col("k"))
