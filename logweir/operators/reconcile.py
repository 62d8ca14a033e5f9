"""Whether one layer holds exactly the rows of another, row by row and not only in number."""

from pyspark.sql import functions as F

from logweir.operators.joins import bounded_join

#: Sums of 64-bit hashes: exact for 10^19 rows of a day.
_SUM = "decimal(38,0)"


def day_checksums(layer, day, content):
    """day, n_rows, sum_1, sum_2: checksums of the multiset of contents of each day, whatever the
    order of its rows. A null day is a day of its own.

    Two sums of independent hashes see a lost row and another that is repeated, which a count does
    not. They are added up on each task first; one row for a day is all that moves."""
    one, two = F.xxhash64(content), F.xxhash64(F.lit("2"), content)
    return layer.groupBy(day.alias("day")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(one.cast(_SUM)).alias("sum_1"),
        F.sum(two.cast(_SUM)).alias("sum_2"),
    )


def differing_days(upper, lower):
    """day, n_upper, n_lower of the days whose checksums differ, days that one side lacks included."""
    a, b = upper.alias("a"), lower.alias("b")
    differ = F.lit(False)
    for name in ("n_rows", "sum_1", "sum_2"):
        differ = differ | ~F.col(f"a.{name}").eqNullSafe(F.col(f"b.{name}"))
    joined = a.join(b, F.col("a.day").eqNullSafe(F.col("b.day")), "full_outer").where(differ)
    return joined.select(
        F.coalesce("a.day", "b.day").alias("day"),
        F.coalesce("a.n_rows", F.lit(0)).cast("long").alias("n_upper"),
        F.coalesce("b.n_rows", F.lit(0)).cast("long").alias("n_lower"),
    )


def reconcile(upper, lower, day, content):
    """day, content, n_upper, n_lower of every content that the two layers do not hold equally often
    on a day. Nothing where the layers agree.

    `day` and `content` are columns that both layers have. Each layer is scanned once for its
    checksums; only days that differ are read again and compared content by content: counts of each
    side's contents, partly on each task, then one full outer join on day and content. A content
    that fills a third of a layer is one row of it. A null content is a content like any other."""

    def counted(layer, name):
        # of the days that differ, one small row each
        rows = layer.select(day.alias("day"), content.alias("content"))
        some = bounded_join(rows.withColumn("_day", _known(F.col("day"))), days, ["_day"], "left_semi")
        return some.groupBy("day", "content").agg(F.count(F.lit(1)).alias(name))

    found = differing_days(day_checksums(upper, day, content), day_checksums(lower, day, content))
    days = found.select(_known(F.col("day")).alias("_day"))
    a, b = counted(upper, "n_upper").alias("a"), counted(lower, "n_lower").alias("b")
    same = F.col("a.day").eqNullSafe(F.col("b.day")) & F.col("a.content").eqNullSafe(F.col("b.content"))
    both = a.join(b, same, "full_outer")
    at_upper, at_lower = F.coalesce("n_upper", F.lit(0)), F.coalesce("n_lower", F.lit(0))
    has_upper = F.col("n_upper").isNotNull()
    return both.where(at_upper != at_lower).select(
        F.when(has_upper, F.col("a.day")).otherwise(F.col("b.day")).alias("day"),
        F.when(has_upper, F.col("a.content")).otherwise(F.col("b.content")).alias("content"),
        at_upper.cast("long").alias("n_upper"),
        at_lower.cast("long").alias("n_lower"),
    )


def _known(day):
    """A day as a key that is never null."""
    return F.coalesce(day.cast("string"), F.lit(""))
