"""Times as numbers and labels. The session clock is UTC, so no zone shift is needed."""

from pyspark.sql import functions as F

from logweir.fixed_values import MINUTE_FORMAT, NUMERIC_TIME_FORMAT


def numeric_stamp(ts):
    """Event time as a 17-digit number, cut to milliseconds."""
    return F.date_format(ts, NUMERIC_TIME_FORMAT).cast("long")


def minute_stamp(ts):
    """Event minute as a 10-digit number."""
    return F.date_format(ts, MINUTE_FORMAT).cast("long")


def source_label(name, started_at):
    """Label of a message source: its name and the start time of the run that read it."""
    return f"{name}-{started_at:%Y-%m-%d %H:%M:%S}"
