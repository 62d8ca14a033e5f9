"""Operators against brute force on small frames."""

import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from logweir.functions import (
    dense_guid,
    element_text,
    file_day,
    page_title,
    parse_price,
    price_text,
    source_dir,
)
from logweir.operators.enrich import enrich_usage, repeated_keys
from logweir.operators.envelope import add_identity
from logweir.operators.joins import fits_broadcast, skew_safe_join
from logweir.operators.parse import parse_query_log
from logweir.operators.pricing import first_rows, price_status
from logweir.operators.sequence import dense_sequence, nine_digit_sequence
from logweir.operators.upsert import latest_per_key, upsert
from logweir.operators.validate import preview_layers, validate_layers
from logweir.operators.watermark import latest_checkpoint, next_checkpoint, since, unseen
from logweir.plans.price_watch import run_price_watch
from logweir.sinks.tables import append_table, replace_table, upsert_table
from logweir.sources.files import candidate_files, existing_paths
from logweir.schemas import WATCHLIST
from logweir.sources.tables import read_table, read_watchlist, rows_table, table_exists, versions


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def one(df, column):
    return [r[0] for r in df.select(column).collect()]


@pytest.mark.parametrize("how", ["left", "left_anti", "left_semi", "inner"])
def test_skew_safe_join_equals_the_plain_join(spark, how):
    pick = random.Random(1)
    keys = ["hot"] * 40 + [None] * 20 + [f"k{i}" for i in range(20)]
    left = [(pick.choice(keys), i % 7) for i in range(600)]
    right = [("hot", 1), ("hot", 2)] + [(f"k{i}", i) for i in range(0, 20, 2)] + [(None, 5)]
    lf = spark.createDataFrame(left, "k string, v int").repartition(6)
    rf = spark.createDataFrame(right, "k string, w int")
    got = skew_safe_join(lf, rf, ["k"], how, rows_per_task=50)
    assert rows(got) == rows(lf.join(rf, "k", how))


def test_skew_safe_join_splits_the_hot_key(spark):
    largest(spark, spark.range(0, 4000, 1, 8).select(F.lit("hot").alias("k"), "id"), 500)


def test_skew_safe_join_splits_rows_of_one_map_task(spark):
    largest(spark, spark.range(0, 10_000, 1, 1).select(F.lit("hot").alias("k"), "id"), 1000)


def test_skew_safe_join_splits_thousands_of_hot_keys(spark):
    key = F.concat(F.lit("k"), F.col("id") % 2000).alias("k")
    left = spark.range(0, 100_000, 1, 4).select(key, "id")
    right = left.select("k").distinct().withColumn("w", F.lit(1))
    joined = skew_safe_join(left, right, ["k"], "left", rows_per_task=10)
    assert joined.count() == joined.where("w = 1").count() == 100_000


def largest(spark, left, limit):
    right = spark.createDataFrame([("hot", 1)], "k string, w int")
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = skew_safe_join(left, right, ["k"], "left", rows_per_task=limit)
        sizes = joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", parts)
    assert sum(r["count"] for r in sizes) == left.count()
    assert max(r["count"] for r in sizes) <= 2.5 * limit  # parts share tasks by their hashes


def test_fits_broadcast(spark):
    df = spark.createDataFrame([("a" * 100,)] * 10, "s string")
    assert fits_broadcast(df, 2000) and not fits_broadcast(df, 1000) and not fits_broadcast(df, 0)
    assert fits_broadcast(df.limit(0), 1)


USAGE = "id int, ontology string, activity string"
META = "ontology string, filename string, size_in_kb string"


@pytest.mark.parametrize("limit", [0, 1 << 20])
@pytest.mark.parametrize("key", ["ontology", "concat"])
def test_enrich(spark, limit, key):
    usage = spark.createDataFrame(
        [(1, "a", "Download"), (2, "a", "Login"), (3, "z", "Download"), (4, None, "Download"), (5, "a", None),
         (6, "b", "Download"), (6, "b", "Download")],
        USAGE,
    )
    meta = spark.createDataFrame([("a", "fa", "1"), ("b", "fb", "2"), (None, "fn", "3")], META)
    got = enrich_usage(usage, meta, max_broadcast_bytes=limit, key=key, rows_per_task=1)
    assert got.columns == ["id", "ontology", "activity", "filename", "size_in_kb"]
    assert sorted((r.id, r.filename) for r in got.collect()) == sorted(
        [(1, "fa"), (2, None), (3, None), (4, None), (5, None), (6, "fb"), (6, "fb")], key=str
    )


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_concat_key_is_ambiguous_and_the_pair_is_not(spark, limit):
    usage = spark.createDataFrame([(1, "ab", "cDownload")], USAGE)
    meta = spark.createDataFrame([("abc", "f", "1")], META)
    assert enrich_usage(usage, meta, key="concat", max_broadcast_bytes=limit).first().filename == "f"
    assert enrich_usage(usage, meta, max_broadcast_bytes=limit).first().filename is None


def test_repeated_metadata_keys_multiply_and_are_found(spark):
    usage = spark.createDataFrame([(1, "a", "Download")], USAGE)
    meta = spark.createDataFrame([("a", "f1", "1"), ("a", "f2", "2")], META)
    assert enrich_usage(usage, meta).count() == 2
    assert rows(repeated_keys(meta)) == [("a", 2)]


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_upsert_against_brute_force(spark, limit):
    pick = random.Random(2)
    target = [(f"k{i}", i, 0) for i in range(20)] + [(None, 1, 0), (None, 1, 0)]
    source = [(pick.choice(["hot", "hot", None, f"k{pick.randrange(40)}"]), i, i) for i in range(100)]
    schema = "k string, v int, at int"
    got = upsert(
        spark.createDataFrame(target, schema),
        spark.createDataFrame(source, schema).repartition(5),
        ["k"],
        ["at"],
        max_broadcast_bytes=limit,
    )
    want = {r[0]: r for r in target if r[0]} | {r[0]: r for r in source if r[0]}
    nulls = [r for r in target + source if r[0] is None]
    assert rows(got) == sorted([*want.values(), *nulls], key=str)


def test_latest_per_key_breaks_ties_one_way(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 1, "y"), ("a", None, "z")], "k string, at int, v string")
    assert rows(latest_per_key(df, ["k"], ["at"])) == [("a", 1, "y")]
    assert rows(latest_per_key(df, ["k"], ["at"], ["k", "v"])) == [("a", "y")]


def test_upsert_table_creates_then_merges_and_keeps_two_versions(spark, folder):
    path = f"{folder}/t"
    schema = "k string, v int"
    assert not table_exists(spark, path)
    for batch in ([("a", 1), ("a", 2)], [("b", 1)], [("a", 3), ("c", 1)]):
        upsert_table(spark.createDataFrame(batch, schema), path, ["k"], ["v"])
    assert rows(read_table(spark, path)) == [("a", 3), ("b", 1), ("c", 1)]
    assert len(versions(spark, path)) == 2


def test_replace_table_may_read_itself_and_skips_unfinished_versions(spark, folder):
    from pathlib import Path

    path = f"{folder}/t"
    replace_table(spark.range(3), path)
    replace_table(read_table(spark, path).union(spark.range(1)), path)
    half = Path(path) / "version-0000000002"
    half.mkdir()
    (half / "part-0.parquet").write_text("half a file")
    assert read_table(spark, path).count() == 4
    replace_table(spark.range(9), path)
    assert read_table(spark, path).count() == 9 and not half.exists()


def test_append_table(spark, folder):
    path = f"{folder}/t"
    for _ in range(2):
        append_table(spark.range(4).withColumn("p", F.col("id") % 2), path, partition_by=["p"])
    assert table_exists(spark, path) and read_table(spark, path).count() == 8


def test_dense_sequence_over_many_partitions(spark):
    df = spark.range(0, 101, 1, 7).where("id % 3 != 0")
    got = dense_sequence(df, "n")
    assert sorted(one(got, "n")) == list(range(67)) and got.columns == ["id", "n"]


def test_nine_digit_sequence_is_gapless_in_every_minute(spark):
    df = spark.range(0, 1000, 1, 7).withColumn("minute", F.when(F.col("id") > 600, 7).otherwise(F.col("id") % 5))
    df = df.withColumn("minute", F.when(F.col("id") > 990, None).otherwise(F.col("minute")))
    numbers = lambda rows: {
        r.minute: sorted(r.n) for r in rows.groupBy("minute").agg(F.collect_list("n").alias("n")).collect()
    }
    got = numbers(nine_digit_sequence(df, "n", F.col("minute")))
    assert {m: len(n) for m, n in got.items()} == {0: 121, 1: 120, 2: 120, 3: 120, 4: 120, 7: 390, None: 9}
    assert all(n == list(range(len(n))) for n in got.values())
    taken = spark.createDataFrame([(7, 50), (99, 3), (None, 2)], "group long, next long")
    after = numbers(nine_digit_sequence(df, "n", F.col("minute"), taken))
    assert after[7] == list(range(50, 440)) and after[0] == got[0] and after[None] == list(range(2, 11))


def test_equal_rows_have_numbers_of_their_own(spark):
    df = spark.range(0, 50, 1, 5).select(F.lit("a").alias("a"), F.lit(1).alias("minute"))
    assert sorted(one(nine_digit_sequence(df, "n", F.col("minute")), "n")) == list(range(50))


def test_a_full_minute_fails(spark):
    df = spark.range(0, 100, 1, 7).withColumn("minute", F.col("id") % 5)
    assert nine_digit_sequence(df, "n", F.col("minute"), limit=20).count() == 100
    with pytest.raises(Exception, match="more rows than 19 numbers"):
        nine_digit_sequence(df, "n", F.col("minute"), limit=19).collect()


def test_dense_guid_overflow_is_null(spark):
    df = spark.createDataFrame([(9412312359, 1), (2401010000, 12)], "m long, n long")
    assert one(df, dense_guid(F.col("m"), F.col("n"))) == [None, 2401010000000000012]


def test_stable_ids_are_the_same_in_every_layout(spark):
    df = spark.range(50).select(F.col("id").cast("string").alias("a"), F.timestamp_seconds("id").alias("t"))
    a = add_identity(df.repartition(3), time="t")
    b = add_identity(df.repartition(7), time="t")
    assert rows(a) == rows(b) and a.select("MetadataLogGuid").distinct().count() == 50


def test_null_fields_do_not_enter_the_content_id(spark):
    df = spark.createDataFrame([(None, "1")], "a string, b string").withColumn("t", F.lit(None).cast("timestamp"))
    narrow = df.select("b", "t")
    assert add_identity(df, time="t").first().MetadataLogId == add_identity(narrow, time="t").first().MetadataLogId


def test_split_takes_the_separator_literally(spark):
    df = spark.createDataFrame([("a|b|c",), (None,)], "log string")
    got = parse_query_log(df, ["x", "y"], sep="|", count_as="n")
    assert rows(got) == [("a", "b", 3), (None, None, 0)]


def test_path_parts(spark):
    paths = ["/x/AVDP1/q.log.01312024", "/x/AVDP4/q.log.01312024", "/x/AVDP3/q.log.13312024", "/x/q.log.2024", ""]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    assert one(df, source_dir("p")) == ["AVDP1", "", "AVDP3", "", ""]
    assert one(df, file_day("p")) == [date(2024, 1, 31), date(2024, 1, 31), None, None, None]


def test_candidate_files(spark):
    ranges = spark.createDataFrame(
        [(date(2024, 2, 28), date(2024, 3, 1)), (date(2024, 5, 2), date(2024, 5, 1))], "first_day date, last_day date"
    )
    got = candidate_files(ranges, "base").orderBy("day", "directory")
    assert one(got, "path") == [
        f"base/AVDP{d}/dev_azure_vdp{d}-queries.log.{day}" for day in ("02282024", "02292024", "03012024") for d in (1, 2)
    ]


def test_existing_paths(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "f1").write_text("x")
    wanted = [f"{tmp_path}/a/f2", f"{tmp_path}/a/f1", f"{tmp_path}/none/f1"]
    assert existing_paths(spark, wanted) == [f"{tmp_path}/a/f1"]


def test_since_is_strict(spark):
    df = spark.createDataFrame([(datetime(2024, 1, d),) for d in (1, 2, 3)] + [(None,)], "t timestamp")
    assert since(df, "t", datetime(2024, 1, 2)).count() == 1
    assert since(df, "t", None).count() == 4


def test_checkpoints(spark):
    df = spark.createDataFrame(
        [(datetime(2024, 1, 5), "/x.01022024"), (datetime(2024, 1, 4), "/x.12312023"), (None, "/x")], "t timestamp, p string"
    )
    got = next_checkpoint(df, time="t", source="p")
    assert rows(got) == [("20240102", datetime(2024, 1, 5))]
    newest = latest_checkpoint(got.union(spark.createDataFrame([("20231231", datetime(2023, 1, 1))], got.schema)))
    assert newest.first().file_day == "01022024"
    assert latest_checkpoint(got.limit(0)).count() == 0


def test_unseen_keeps_repeats_within_the_batch(spark):
    batch = spark.createDataFrame([("a",), ("b",), ("b",), ("c",)], "MetadataLogId string")
    known = spark.createDataFrame([("a",), ("a",), ("z",)], "MetadataLogId string")
    for limit in (0, 1 << 20):
        assert rows(unseen(batch, known, max_broadcast_bytes=limit)) == [("b",), ("b",), ("c",)]


def test_validate_layers(spark):
    bronze = spark.createDataFrame([("a",), (None,), ("b",)], "k string")
    silver = bronze.where("k IS NOT NULL")
    got = validate_layers(
        {"bronze": bronze, "silver": silver, "extra": spark.range(0)},
        keys={"bronze": ["k"], "silver": ["k"]},
        schemas={"bronze": bronze.schema, "silver": spark.range(1).schema},
        follows={"silver": "bronze"},
    )
    assert rows(got) == [
        (0, "bronze", 3, 1, True, None, None),
        (1, "silver", 2, 0, False, "bronze", -1),
        (2, "extra", 0, 0, None, None, None),
    ]
    assert preview_layers({"bronze": bronze}, 2, {"bronze": ["k"]})["bronze"].count() == 2


PAGES = [
    (1, "u1", '<html><span id="priceblock_dealprice" class="a">₹ 12,999.00</span></html>'),
    (2, "u2", "<div class=x id='priceblock_ourprice'>&#8377;&nbsp;1,000.50\n</div>"),
    (3, "u3", '<b id="priceblock_ourprice">₹ 5.00</b><b id="priceblock_dealprice">₹ 4.25</b>'),
    (4, "u4", '<b data-id="priceblock_ourprice">₹ 5.00</b><p id="other">₹ 1.00</p>'),
    (5, "u5", '<b id="priceblock_ourprice"> see <i>offer</i></b>'),
    (6, "u6", '<SPAN ID=priceblock_ourprice><i>₹</i> 12,345,678.00</SPAN>'),
    (7, "u1b", '<b id="priceblock_ourprice">₹ 9.00 - ₹ 12.00</b>'),
    (0, "u2", '<b id="priceblock_ourprice">₹ 1.00</b>'),
]


@pytest.fixture
def watch(spark):
    pages = spark.createDataFrame(PAGES, "page_id int, url string, html string")
    wanted = [("M1", "u1", 13000), ("M2", "u2", 1000), ("M3", "u3", 4), ("M3b", "u3", 5), ("M4", "u4", 9),
              ("M5", "u5", 9), ("M6", "u6", 99999999), ("M7", "u1b", 99), ("M8", "nowhere", 9)]
    return spark.createDataFrame(wanted, "Model string, URL string, `Target Price` int"), pages


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_price_status(watch, limit):
    lines = one(price_status(*watch, max_broadcast_bytes=limit), "line")
    assert sorted(lines) == sorted([
        "M1 Present Price: Rs.12999.0 Status:Available at your price",
        "M2 Present Price: Rs.1000.5 Status:Still at same price",
        "M3 Present Price: Rs.4.25 Status:Still at same price",
        "M3b Present Price: Rs.4.25 Status:Available at your price",
        "M4 Present Price: Rs.unknown Status:Price not found",
        "M5 Present Price: Rs.unknown Status:Price not found",
        "M6 Present Price: Rs.12345678.0 Status:Available at your price",
        "M7 Present Price: Rs.unknown Status:Price not found",
        "M8 Present Price: Rs.unknown Status:Price not found",
    ])


def test_price_equal_to_the_target_is_not_below(spark):
    pages = spark.createDataFrame([(1, "u", '<b id="priceblock_ourprice">₹ 10.00</b>')], "page_id int, url string, html string")
    watch = spark.createDataFrame([("M", "u", 10.9)], "Model string, URL string, `Target Price` double")
    row = price_status(watch, pages).first()
    assert (row.target, row.status) == (10, "Still at same price")


def test_price_report(spark, watch, folder):
    run_price_watch(*watch, f"{folder}/report", limit=5)
    lines = one(spark.read.text(f"{folder}/report"), "value")
    assert sorted(line.split()[0] for line in lines) == ["M1", "M2", "M3", "M3b", "M4"]
    assert first_rows(watch[0], ["Model"], 99).count() == 9


def test_watchlist_from_a_file(spark, tmp_path):
    (tmp_path / "w.csv").write_text('Model,URL,Target Price\n"Phone, red",u1,13000\n')
    row = read_watchlist(spark, str(tmp_path / "w.csv")).first()
    assert tuple(row) == ("Phone, red", "u1", 13000)
    assert rows_table(spark, [], WATCHLIST).count() == 0


def test_price_text_has_at_least_one_decimal(spark):
    df = spark.createDataFrame([("Rs. 7",), ("7.50\u00a0",), ("7.123",), ("",), (None,), ("x",)], "t string")
    assert one(df, price_text(parse_price("t"))) == ["7.0", "7.5", "7.123", None, None, None]


def test_page_text(spark):
    html = "<head><TITLE lang='en'> A &amp; B\n</TITLE></head><p id='a.c'>x <b>y</b></p><p id='abc'>z</p>"
    df = spark.createDataFrame([(html,), ("<p>none</p>",)], "h string")
    assert one(df, element_text("h", "a.c")) == ["x y", None]
    assert one(df, page_title("h")) == ["A &amp; B\n", None]
