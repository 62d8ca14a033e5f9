"""Message streams: any streaming source that yields one binary body per message."""

import time
from concurrent.futures import Future
from threading import Event, Lock

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

BODY = "body"

# The column in which each source format delivers the message.
BODY_COLUMN = {"eventhubs": "body", "kafka": "value", "text": "value"}


def stream_messages(spark, fmt, path=None, schema=None, body=None, **options):
    """Messages with a binary `body`, next to whatever columns the source adds.

    Kafka and text deliver the message as `value`, an event hub as `body`.
    """
    reader = spark.readStream.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    rows = reader.load(path) if path else reader.load()
    name = body or BODY_COLUMN.get(fmt, BODY)
    return rows.withColumnRenamed(name, BODY).withColumn(BODY, F.col(BODY).cast("binary"))


def capture_available(stream, each_batch, checkpoint):
    """Run `each_batch(rows, name)` over everything the stream holds now, then stop.

    Offsets live in the checkpoint: a later capture starts where this one ended, and a batch
    that failed midway comes again under the same name. The name holds the query's own id, which
    lasts as long as its checkpoint, so a stream begun anew never takes an old batch's name.
    """
    query_id = Future()

    def named(rows, batch_id):
        each_batch(rows, f"{query_id.result()}-{batch_id}")

    query = (
        stream.writeStream.foreachBatch(named)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query_id.set_result(query.id)
    query.awaitTermination()
    return query


class _TimeIsUp(Exception):
    pass


#: Seconds in which Spark writes down that a batch is done, once it is.
_COMMIT_SECONDS = 10.0


def capture_for(stream, each_batch, checkpoint, seconds):
    """As `capture_available`, for at most so many seconds and the batch that is in hand then; True
    when nothing of what the stream held is left.

    Batches follow the source's limits, such as maxFilesPerTrigger, and the bound is kept between
    them: no batch is broken off. One that has not begun when the time is up keeps its name and its
    offsets, and the next capture begins with it."""
    in_hand, closed, done, query_id = Lock(), Event(), [], Future()

    def named(rows, batch_id):
        with in_hand:
            if closed.is_set():
                raise _TimeIsUp(f"batch {batch_id} is left to the next capture")
            each_batch(rows, f"{query_id.result()}-{batch_id}")
            done.append(batch_id)

    query = (
        stream.writeStream.foreachBatch(named)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query_id.set_result(query.id)
    if query.awaitTermination(seconds):
        return True
    closed.set()
    with in_hand:
        last = done[-1] if done else None
    until = time.monotonic() + _COMMIT_SECONDS
    while query.isActive and last is not None and time.monotonic() < until:
        progress = query.lastProgress
        if progress is not None and progress.batchId >= last:
            break
        time.sleep(0.05)
    query.stop()
    failed = query.exception()
    if failed is None:
        # the last batch may have been the end of what there was, which the next capture will find
        return False
    if _TimeIsUp.__name__ in str(failed):
        return False
    raise StreamingQueryException(str(failed))
