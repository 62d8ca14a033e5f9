"""Keyed tables dealt into hash buckets, of which an upsert reads and rewrites only those that its
batch has keys for.

A write puts the buckets that it replaces, whole, below `of=<buckets>/version-<number>-<token>/`.
Spark's success marker makes all of them visible at once, so a batch that dies between two buckets
leaves the table as it was and its replay writes them all. The rows of a bucket are those of its
newest version; buckets that no later write touched stay where they are. Rows without a key have
nothing to replace: they are in a bucket of their own, to which writes only add.
"""

from pyspark.sql import functions as F

from logweir.operators.joins import BROADCAST_BYTES
from logweir.operators.upsert import merged, staged_newest
from logweir.sources.buckets import (
    BUCKET,
    KEYLESS,
    bucket_count,
    bucket_of,
    holders,
    read_buckets,
    root_of,
)
from logweir.sources.folders import names_in, remove
from logweir.sources.versions import VERSION, versions

#: Buckets of a new table. A bucket is read and rewritten whole, so it should hold some hundred MB.
BUCKETS = 64


def _version_number(name):
    return int(name[len(VERSION) :].partition("-")[0])


def write_buckets(rows, path, keys, n_buckets, token=None, files_per_bucket=1, keep=2):
    """Replace the buckets that `rows` fall into, in one step. The frame may read the table.

    Rows move once, to the task of their bucket, or of one of `files_per_bucket` parts of it. The
    `keep` newest versions of a replaced bucket stay, so that a reader can finish."""
    spark, root = rows.sparkSession, root_of(path, n_buckets)
    taken = [name for name in names_in(spark, root) if name.startswith(VERSION)]
    number = max(map(_version_number, taken), default=-1) + 1
    version = f"{VERSION}{number:010d}" + (f"-{token}" if token else "")
    part = F.pmod(F.xxhash64(F.lit(number), *[F.col(f"`{name}`") for name in rows.columns]), F.lit(files_per_bucket))
    (
        rows.withColumns({BUCKET: bucket_of(keys, n_buckets), "_part": part})
        .repartition(BUCKET, "_part")
        .drop("_part")
        .write.mode("errorifexists")
        .partitionBy(BUCKET)
        .parquet(f"{root}/{version}")
    )
    replaced = set(_buckets_in(spark, root, version))
    held = holders(spark, path)
    for bucket in replaced - {KEYLESS}:
        for old in held[bucket][:-keep]:
            remove(spark, f"{root}/{old}/{BUCKET}={bucket}")
    complete = versions(spark, root)
    for name in taken:
        if name not in complete or (not _buckets_in(spark, root, name) and name not in complete[-keep:]):
            remove(spark, f"{root}/{name}")


def _buckets_in(spark, root, version):
    return [int(name.partition("=")[2]) for name in names_in(spark, f"{root}/{version}") if name.startswith(f"{BUCKET}=")]


def published_batch(spark, path):
    """Token of the newest write, None when there is none."""
    n_buckets = bucket_count(spark, path)
    done = versions(spark, root_of(path, n_buckets)) if n_buckets else []
    return done[-1][len(VERSION) :].partition("-")[2] or None if done else None


def upsert_buckets(
    df, path, keys, order_by=(), columns=None, n_buckets=BUCKETS, token=None, files_per_bucket=1,
    max_broadcast_bytes=BROADCAST_BYTES,
):
    """Insert new keys and update known ones, as `upsert_table`, reading and rewriting only the
    buckets of the batch's keys.

    The first call deals the table into `n_buckets`; later ones go by what is there. When the newest
    write carries the token, the batch is already in and nothing is done. An empty batch writes
    nothing."""
    spark = df.sparkSession
    if token is not None and token == published_batch(spark, path):
        return
    n_buckets = bucket_count(spark, path) or n_buckets
    newest, folder = staged_newest(df, keys, order_by, columns)
    # one small number for each bucket
    touched = [row[0] for row in newest.select(bucket_of(keys, n_buckets)).distinct().collect()]
    if touched:
        known = [bucket for bucket in touched if bucket != KEYLESS]
        target = read_buckets(spark, path, newest.schema, only=known)
        rows = merged(target, newest, keys, newest.columns, max_broadcast_bytes)
        write_buckets(rows, path, keys, n_buckets, token, files_per_bucket)
    remove(spark, folder)
