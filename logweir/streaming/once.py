"""Redelivered events, taken once."""

from pyspark.sql import functions as F


def once(rows, content, arrived, within):
    """The rows of a stream without those whose `content` was seen before, within the time that a
    redelivery may take.

    `arrived` is the source's own time of arrival, or null for the time of the micro-batch; a row
    without one counts as arriving now. The state store keeps each content until the watermark is
    `within` past its arrival, so its size follows the rate of arrival and not the length of the
    stream. A content that comes again later than that counts as new, and a row that arrives out of
    order by more than that is dropped, so `within` must cover both.
    """
    now = F.current_timestamp()
    time = now if arrived is None else F.coalesce(F.col(arrived).cast("timestamp"), now)
    marked = rows.withColumns({"_content": content, "_arrived": time}).withWatermark("_arrived", within)
    return marked.dropDuplicatesWithinWatermark(["_content"]).drop("_content", "_arrived")
