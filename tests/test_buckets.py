"""Keyed tables dealt into hash buckets."""

import os

import pytest
from pyspark.sql import functions as F

from logweir.sinks import upsert_buckets, write_buckets
from logweir.sources import read_table, table_exists
from logweir.sources.buckets import BUCKET, KEYLESS, bucket_of, holders

SCHEMA = "k string, v int, w string"
N = 8


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def stored(spark, path):
    return sorted((tuple(r) for r in read_table(spark, path, schema=SCHEMA).collect()), key=repr)


def bucket_by_key(spark, keys):
    rows = frame(spark, [(k, 0, "") for k in keys]).select("k", bucket_of(["k"], N).alias("b"))
    return {r.k: r.b for r in rows.collect()}


@pytest.fixture
def table(spark, folder):
    path = f"{folder}/t"
    upsert_buckets(frame(spark, [(f"k{i}", i, "old") for i in range(200)]), path, ["k"], n_buckets=N, token="a")
    return path


def test_only_buckets_with_keys_of_the_batch_are_read_and_rewritten(spark, table):
    place = bucket_by_key(spark, [f"k{i}" for i in range(200)] + ["new"])
    mine = [k for k in place if place[k] == place["new"]]
    before = files(table)
    upsert_buckets(frame(spark, [(k, 1000, "late") for k in mine] + [(mine[0], 1001, "later")]), table, ["k"], ["v"], token="b")
    after = files(table)
    added = set(after) - set(before)
    assert {f for f in before if after.get(f) == before[f]} == set(before)
    assert added and all(f"{BUCKET}={place['new']}/" in f for f in added)
    want = {(k, int(k[1:]), "old") for k in place if place[k] != place["new"]} | {(k, 1000, "late") for k in mine}
    want = want - {(mine[0], 1000, "late")} | {(mine[0], 1001, "later")}
    assert stored(spark, table) == sorted(want, key=repr)
    # the read of the target names the batch's bucket alone
    read = read_table(spark, table, schema=SCHEMA)
    assert len(holders(spark, table)[place["new"]]) == 2 and len(read.inputFiles()) >= N


def test_a_batch_that_dies_between_two_buckets_is_completed_by_its_replay(spark, table):
    before = stored(spark, table)
    place = bucket_by_key(spark, ["k1", "k2", "k3", "k4", "k5"])
    batch = frame(spark, [(k, 7, "new") for k in place])
    broken = read_table(spark, table, schema=SCHEMA).withColumn(
        "w", F.when(F.col("k") == "k3", F.raise_error(F.lit("lost"))).otherwise(F.col("w"))
    )
    with pytest.raises(Exception, match="lost"):
        write_buckets(broken, table, ["k"], N, "b")
    assert stored(spark, table) == before
    # dead after some buckets were in place: files without the marker
    upsert_buckets(batch, table, ["k"], token="b")
    root = f"{table}/of={N}"
    newest = sorted(os.listdir(root))[-1]
    whole = stored(spark, table)
    os.remove(f"{root}/{newest}/_SUCCESS")
    os.remove(f"{root}/{newest}/._SUCCESS.crc")
    assert stored(spark, table) == before
    upsert_buckets(batch, table, ["k"], token="b")
    assert stored(spark, table) == whole != before
    assert newest not in os.listdir(root)
    once = files(table)
    upsert_buckets(batch, table, ["k"], token="b")
    assert files(table) == once


def test_old_versions_go_and_rows_without_a_key_stay(spark, table):
    for at in range(5):
        batch = frame(spark, [("k1", 100 + at, "x"), (None, at, "no key"), (None, at, "no key")])
        upsert_buckets(batch, table, ["k"], token=f"t{at}")
    rows = stored(spark, table)
    assert [r for r in rows if r[0] == "k1"] == [("k1", 104, "x")]
    assert sorted(r[1] for r in rows if r[0] is None) == sorted([0, 1, 2, 3, 4] * 2)
    held = holders(spark, table)
    place = bucket_by_key(spark, ["k1"])["k1"]
    assert len(held[place]) == 2 and len(held[KEYLESS]) == 5
    assert all(len(held[b]) == 1 for b in held if b not in (place, KEYLESS))


@pytest.mark.parametrize("settings", [{}, {"max_broadcast_bytes": 0}, {"files_per_bucket": 3}])
def test_upserts_equal_one_dictionary(spark, folder, settings):
    path, want = f"{folder}/t", {}
    assert not table_exists(spark, path)
    for at in range(4):
        batch = [(f"k{(i * 7 + at) % 50}", at * 1000 + i, str(i)) for i in range(60)]
        upsert_buckets(frame(spark, batch), path, ["k"], ["v"], n_buckets=5 + at, **settings)
        for k, v, w in batch:
            want[k] = max(want.get(k, (-1, "")), (v, w)) if want.get(k, (-1, ""))[0] >= at * 1000 else (v, w)
    assert stored(spark, path) == sorted(((k, *v) for k, v in want.items()), key=repr)
    upsert_buckets(frame(spark, []), path, ["k"], ["v"])
    assert len(stored(spark, path)) == len(want) and table_exists(spark, path)
    assert os.listdir(path) == ["of=5"]
