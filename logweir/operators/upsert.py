"""Newest row per key and upsert by key."""

from functools import reduce

from pyspark.sql import functions as F

from logweir.operators.joins import BROADCAST_BYTES, fits_broadcast
from logweir.session import work_folder


def _keyed(keys):
    return reduce(lambda a, b: a & b, [F.col(key).isNotNull() for key in keys])


def latest_per_key(df, keys, order_by=(), columns=None):
    """One row per key: the one with the greatest `order_by` values, then the greatest other
    columns, so ties have one outcome.

    An aggregate, not a window: each task sends at most one row per key, so a key that holds a
    third of all rows costs no more than any other. Rows with a NULL key have no identity and
    all stay.
    """
    columns = list(columns or df.columns)
    rest = [name for name in columns if name not in keys]
    order = [F.col(name).alias(f"_o{at}") for at, name in enumerate(order_by)]
    newest = (
        df.where(_keyed(keys))
        .groupBy(*keys)
        .agg(F.max(F.struct(F.lit(0).alias("_first"), *order, *rest)).alias("_newest"))
        .select(*[name if name in keys else f"_newest.`{name}`" for name in columns])
    )
    return newest.unionByName(df.where(~_keyed(keys)).select(*columns))


def staged_newest(source, keys, order_by=(), columns=None):
    """(newest rows per key, the work folder that holds them). The source is read and aggregated
    once, whatever is done with its newest rows."""
    spark = source.sparkSession
    folder = work_folder(spark, "newest")
    newest = latest_per_key(source, keys, order_by, columns)
    newest.write.parquet(folder)
    return spark.read.schema(newest.schema).parquet(folder), folder


def merged(target, newest, keys, columns, max_broadcast_bytes=BROADCAST_BYTES):
    """The target without the rows whose key is among the newest, and the newest.

    The keys are broadcast when they are measured to be small, so a small batch does not shuffle a
    large target; otherwise both sides shuffle on the key, which holds at most one target row per
    key."""
    changed = newest.where(_keyed(keys)).select(*keys)
    if fits_broadcast(changed, max_broadcast_bytes):
        kept = target.join(F.broadcast(changed), list(keys), "left_anti")
    else:
        kept = (
            target.where(_keyed(keys))
            .join(changed, list(keys), "left_anti")
            .unionByName(target.where(~_keyed(keys)))
        )
    return kept.select(*columns).unionByName(newest)


def upsert(
    target, source, keys, order_by=(), columns=None, max_broadcast_bytes=BROADCAST_BYTES
):
    """The target after every source row is inserted or has updated the target row of its key.

    Target rows whose key the source has are dropped and the source's newest rows added. The newest
    rows go to a work folder; measuring, dropping and adding read them there.
    """
    columns = list(columns or target.columns)
    newest, _ = staged_newest(source, keys, order_by, columns)
    return merged(target, newest, keys, columns, max_broadcast_bytes)
