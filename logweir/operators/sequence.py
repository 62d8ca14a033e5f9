"""Gapless row numbers without a global sort."""

from pyspark.sql import Window
from pyspark.sql import functions as F

NINE_DIGITS = 10**9
#: A group holds at most a billion rows, so a part of it holds about two million.
PARTS = 512


def _content(df):
    return F.xxhash64(*[F.col(f"`{name}`") for name in df.columns])


def grouped_sequence(df, name, group, taken=None, limit=NINE_DIGITS):
    """Number the rows of each group 0, 1, 2, ..., or from `taken` on.

    `group` is a column; `taken` has one row (group, next) for a group whose first numbers are
    given away. A group is cut into parts by the content of its rows. Counts per part give each
    part its first number, and rows are ranked within their part, so a group that holds most rows
    is spread over many tasks and the rows move once. Numbers follow from content alone: rows that
    are evaluated again, on a lost executor or for another output, have the same ones, but for
    equal rows among themselves, which share a part. A group that reaches `limit` fails the query.
    """
    columns = df.columns
    parted = df.withColumns({"_group": group, "_content": _content(df)})
    parted = parted.withColumn("_part", F.pmod(F.col("_content"), F.lit(PARTS)).cast("int"))
    sizes = parted.groupBy("_group", "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_group").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("_n").over(before), F.lit(0))
    starts = sizes.select(F.col("_group").alias("_of"), F.col("_part").alias("_at"), start.alias("_start"))
    if taken is not None:
        given = taken.select(F.col("group").alias("_given"), F.col("next").alias("_next"))
        starts = starts.join(given, F.col("_of").eqNullSafe(F.col("_given")), "left")
        starts = starts.withColumn("_start", F.col("_start") + F.coalesce("_next", F.lit(0)))
    order = Window.partitionBy("_group", "_part").orderBy("_content")
    rows = parted.withColumn("_rank", F.row_number().over(order) - 1)
    same = F.col("_group").eqNullSafe(F.col("_of")) & (F.col("_part") == F.col("_at"))
    number = F.col("_start") + F.col("_rank")
    full = F.raise_error(F.lit(f"a group has more rows than {limit} numbers; use the stable row id"))
    checked = F.when(number < limit, number).otherwise(full.cast("long"))
    return rows.join(starts, same).select(*[f"`{c}`" for c in columns], checked.alias(name))


def dense_sequence(df, name):
    """Number all rows 0, 1, 2, ... whatever there are of them."""
    return grouped_sequence(df, name, F.lit(0), limit=2**63 - 1)


def nine_digit_sequence(df, name, minute, taken=None, limit=NINE_DIGITS):
    """Row numbers below `limit` that are gapless within every minute, from `taken` on."""
    return grouped_sequence(df, name, minute, taken, limit)
