"""Checks over the layers of a pipeline."""

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F


def validate_layers(layers, keys=None, schemas=None, follows=None):
    """One row per layer: rows, rows with a NULL key, schema check, and rows lost or gained
    against the layer it follows.

    `layers` maps names to frames, in order. `keys` maps a name to its key columns, `schemas` to
    the expected schema, `follows` to the layer before it. Every layer is scanned once, for its
    key columns only.
    """
    keys, schemas, follows = keys or {}, schemas or {}, follows or {}

    def checks(at, name, df):
        no_key = [F.col(key).isNull() for key in keys.get(name, [])]
        missing = reduce(lambda a, b: a | b, no_key) if no_key else F.lit(False)
        expected = schemas.get(name)
        matches = None if expected is None else _shape(expected) == _shape(df.schema)
        return df.agg(
            F.count(F.lit(1)).alias("n_rows"), F.count_if(missing).alias("n_null_keys")
        ).select(
            F.lit(at).alias("position"),
            F.lit(name).alias("layer"),
            "n_rows",
            "n_null_keys",
            F.lit(matches).cast("boolean").alias("schema_matches"),
            F.lit(follows.get(name)).cast("string").alias("follows"),
        )

    rows = reduce(
        lambda a, b: a.unionByName(b),
        [checks(at, name, df) for at, (name, df) in enumerate(layers.items())],
    )
    # One row per layer from here on, so one window over all of them is small whatever the data.
    everything = Window.partitionBy(F.lit(0))
    counts = F.map_from_entries(F.collect_list(F.struct("layer", "n_rows")).over(everything))
    return (
        rows.withColumn("counts", counts)
        .withColumn("row_delta", F.col("n_rows") - F.try_element_at("counts", F.col("follows")))
        .drop("counts")
    )


def _shape(schema):
    return [(field.name, field.dataType.simpleString()) for field in schema]


def preview_layers(layers, n=20, order_by=None):
    """{name: its first n rows}, in `order_by` order where one is given for the layer."""
    order_by = order_by or {}
    return {
        name: (df.orderBy(*order_by[name]) if name in order_by else df).limit(n)
        for name, df in layers.items()
    }
