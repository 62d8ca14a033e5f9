"""Usage events with the metadata of the file they fetched."""

from pyspark.sql import functions as F

from logweir.fixed_values import FILE_ACTIVITY
from logweir.operators.joins import BROADCAST_BYTES, fits_broadcast, skew_safe_join

JOIN_KEY = "_join_key"


def _keys(key, activity):
    """(usage side, metadata side) of the join key; NULL on the usage side where nothing can
    match."""
    if key == "ontology":
        usage = F.when(F.col("activity") == activity, F.col("ontology"))
        return usage, F.col("ontology")
    if key == "concat":
        usage = F.concat("ontology", "activity")
        return usage, F.concat(F.col("ontology"), F.lit(activity))
    raise ValueError(f"unknown join key: {key}")


def enrich_usage(
    usage,
    metadata,
    *,
    activity=FILE_ACTIVITY,
    attributes=("filename", "size_in_kb"),
    key="ontology",
    max_broadcast_bytes=BROADCAST_BYTES,
    **skew,
):
    """All usage rows, with the metadata attributes where the activity is the given one.

    The metadata is broadcast when its needed columns are measured to be small. Beyond that the
    rows that can match are shuffled with hot keys split, and the rest, whose key is NULL, are
    passed through without a shuffle. `key="concat"` joins on the two values run together, which
    also matches other pairs with the same text.
    """
    usage_key, metadata_key = _keys(key, activity)
    columns = usage.columns
    left = usage.withColumn(JOIN_KEY, usage_key)
    right = metadata.select(metadata_key.alias(JOIN_KEY), *attributes)
    if fits_broadcast(right, max_broadcast_bytes):
        joined = left.join(F.broadcast(right), JOIN_KEY, "left")
    else:
        joined = skew_safe_join(left, right, [JOIN_KEY], "left", **skew)
    return joined.select(*columns, *attributes)


def repeated_keys(metadata, key="ontology"):
    """Keys with more than one row. Empty when a join on them cannot multiply rows; a NULL key
    matches nothing and does not count."""
    rows = metadata.where(F.col(key).isNotNull()).groupBy(key)
    return rows.agg(F.count(F.lit(1)).alias("n")).where("n > 1")
