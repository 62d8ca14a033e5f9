"""High-water marks: take only rows above the mark, and work out the next mark."""

from pyspark.sql import functions as F

from logweir.fixed_values import CHECKPOINT_DAY_FORMAT, FILE_DAY_FORMAT
from logweir.functions import file_day
from logweir.operators.joins import bounded_join


def since(df, time, mark):
    """Rows strictly above the mark; all rows when there is no mark yet."""
    return df if mark is None else df.where(F.col(time) > F.lit(mark))


def next_checkpoint_columns(
    time="MetadataLogTimeGenerated", source="MetadataLogFileName", day=None
):
    """Newest file day and newest event time as two aggregates, to be taken in one pass."""
    day = file_day(F.col(source)) if day is None else day
    return [
        F.date_format(F.max(day), CHECKPOINT_DAY_FORMAT).alias("file_date"),
        F.max(time).alias("last_timegenerated"),
    ]


def next_checkpoint(df, **columns):
    """One row: the checkpoint after these rows are stored."""
    return df.agg(*next_checkpoint_columns(**columns))


def latest_checkpoint(checkpoints):
    """The newest checkpoint row, with its day also as a date and in the format file names use.
    No row for an empty table."""
    day = F.try_to_date("file_date", CHECKPOINT_DAY_FORMAT)
    return (
        checkpoints.orderBy(F.desc("file_date"))
        .limit(1)
        .select(
            "file_date",
            day.alias("day"),
            F.date_format(day, FILE_DAY_FORMAT).alias("file_day"),
            "last_timegenerated",
        )
    )


def unseen(rows, known, on="MetadataLogId", **join):
    """Rows whose content id is not among the known rows. Rows that repeat within the frame all
    stay: two equal log lines are two log lines."""
    return bounded_join(rows, known.select(on).distinct(), [on], "left_anti", **join)
