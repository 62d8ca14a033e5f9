"""Equi-joins that neither broadcast a side of unknown size nor let a hot key sit in one task."""

from functools import reduce

from pyspark.sql import functions as F

from logweir.session import ensure_checkpoint_dir

BROADCAST_BYTES = 64 * 1024 * 1024
ROWS_PER_TASK = 2_000_000


def _row_bytes(df):
    """Bytes of a row's text and binary values plus a fixed share per column."""
    sizes = [F.lit(16 * len(df.columns)).cast("long")]
    for field in df.schema:
        value = F.col(f"`{field.name}`")
        if field.dataType.typeName() not in ("string", "binary"):
            value = value.cast("string")
        sizes.append(F.coalesce(F.octet_length(value).cast("long"), F.lit(0)))
    return reduce(lambda a, b: a + b, sizes)


def fits_broadcast(df, max_bytes=BROADCAST_BYTES):
    """True when the rows, measured by one aggregate over them, are at most `max_bytes`."""
    if max_bytes <= 0:
        return False
    size = df.select(_row_bytes(df).alias("size")).agg(F.sum("size")).first()[0]
    return (size or 0) <= max_bytes


def _no_null(keys):
    return reduce(lambda a, b: a & b, [F.col(key).isNotNull() for key in keys])


def _hot_keys(left, keys, rows_per_task):
    """Keys of `left` with more than `rows_per_task` rows, each with the number of parts to split
    it into. There are at most rows / rows_per_task of them; they stay a frame, worked out once."""
    ensure_checkpoint_dir(left.sparkSession)
    counts = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    parts = F.ceil(F.col("_n") / rows_per_task).cast("int").alias("_parts")
    return counts.where(F.col("_n") > rows_per_task).select(*keys, parts).checkpoint()


def skew_safe_join(left, right, keys, how="left", rows_per_task=ROWS_PER_TASK):
    """Left outer, left anti, left semi or inner equi-join with hot left keys split over tasks.

    A hot key's left rows are spread over as many parts as its size asks for and its right rows
    are repeated once per part, so every left row still meets every right row of its key exactly
    once. Rows with a NULL key match nothing and do not enter the shuffle. The part comes from the
    row's content and the map task's number, which a retried task has again: rows that differ are
    spread even if one map task holds them all, and equal rows as far as tasks do.
    """
    if how not in ("left", "left_anti", "left_semi", "inner"):
        raise ValueError(f"unsupported join: {how}")
    keyed = left.where(_no_null(keys))
    parts = _hot_keys(keyed, keys, rows_per_task)
    if not parts.isEmpty():
        if fits_broadcast(parts):
            parts = F.broadcast(parts)
        content = [f.name for f in left.schema.fields if f.dataType.typeName() not in ("map", "variant")]
        place = F.xxhash64(F.spark_partition_id(), *[F.col(f"`{name}`") for name in content])
        n_parts = F.coalesce(F.col("_parts"), F.lit(1))
        keyed = (
            keyed.join(parts, list(keys), "left")
            .withColumn("_part", F.pmod(place, n_parts).cast("int"))
            .drop("_parts")
        )
        right = (
            right.join(parts, list(keys), "left")
            .withColumn("_part", F.explode(F.sequence(F.lit(0), n_parts - 1)))
            .drop("_parts")
        )
        joined = keyed.join(right, [*keys, "_part"], how).drop("_part")
    else:
        joined = keyed.join(right, list(keys), how)
    if how in ("left", "left_anti"):
        unkeyed = left.where(~_no_null(keys))
        joined = joined.unionByName(unkeyed, allowMissingColumns=True)
    return joined


def bounded_join(left, right, keys, how="left", max_broadcast_bytes=BROADCAST_BYTES, **skew):
    """Broadcast `right` when its measured size allows, else join by shuffle with hot keys split."""
    if fits_broadcast(right, max_broadcast_bytes):
        return left.join(F.broadcast(right), list(keys), how)
    return skew_safe_join(left, right, keys, how, **skew)
