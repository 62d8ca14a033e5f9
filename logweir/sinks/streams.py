"""Streaming append with exactly-once files."""

from concurrent.futures import Future

from logweir.sinks.tables import run_is_written, write_run


def default_checkpoint(path):
    """Checkpoints sit next to the table, never inside it."""
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/_checkpoints/{name}"


def stream_append(df, path, fmt="parquet", checkpoint=None, available_now=True, interval=None):
    """Start appending a stream to a table and return the running query.

    With `available_now` the query ends once it has taken what is there; otherwise it runs until
    stopped, at the given interval if there is one. The sink's own log makes a replayed batch
    leave no second copy.
    """
    checkpoint = checkpoint or default_checkpoint(path)
    if checkpoint.rstrip("/") == path.rstrip("/"):
        raise ValueError("the streaming checkpoint must not be the table path")
    writer = df.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    return triggered(writer, available_now, interval).start(path)


def triggered(writer, available_now=True, interval=None):
    if available_now:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=interval) if interval else writer


def stream_tables(
    df, tables, checkpoint, *, partition_by=None, name=None, available_now=True, interval=None
):
    """Start a stream into several parquet tables with one read of its source; returns the query.

    `tables(batch)` gives {path: rows} for a micro-batch, which is kept while they are written. The
    rows of a batch are a run of their table, under the batch's name, parted by what `partition_by`
    has for its path. A batch that died between two
    tables comes again with the same name, and the tables that it is in already are left alone."""
    query_id = Future()

    def take(batch, batch_id):
        run = f"{query_id.result()}-{batch_id}"
        spark, kept = batch.sparkSession, batch.persist()
        try:
            for path, rows in tables(kept).items():
                if not run_is_written(spark, path, run):
                    write_run(rows, path, run, partition_by=(partition_by or {}).get(path, ()))
        finally:
            kept.unpersist()

    writer = df.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    query = triggered(writer, available_now, interval).start()
    query_id.set_result(query.id)
    return query
