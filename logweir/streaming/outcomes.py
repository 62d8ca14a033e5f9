"""What each micro-batch of a stream did, as rows of a table."""

import uuid
from threading import Event

from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from logweir.sinks.tables import write_run
from logweir.sources.tables import read_table, table_exists

#: Name of the observed counts on the stream.
OUTCOME = "outcome"

OUTCOMES = T.StructType(
    [
        T.StructField("query_id", T.StringType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("n_good", T.LongType()),
        T.StructField("n_malformed", T.LongType()),
        T.StructField("ended_at", T.TimestampType()),
    ]
)


class Outcomes(StreamingQueryListener):
    """Appends one row for each micro-batch of the query of its name: OK with the counts observed on
    the stream, or EMPTY when it had no rows. A start of the query without a micro-batch gives one
    row without a batch: EMPTY, or FAILED when it ended with an error, as does a batch that fails.

    A row is written under the name of its batch, so one that is reported again is there once."""

    def __init__(self, spark, table):
        self.spark, self.table = spark, table
        self.query_name = f"outcomes-{uuid.uuid4().hex}"
        self.ended, self.runs = Event(), {}

    def onQueryStarted(self, event):
        if event.name == self.query_name:
            self.ended.clear()
            self.runs[str(event.runId)] = 0

    def onQueryProgress(self, event):
        progress = event.progress
        run = str(progress.runId)
        if run not in self.runs or OUTCOME not in progress.observedMetrics:
            return
        self.runs[run] += 1
        counts = progress.observedMetrics[OUTCOME]
        good, malformed = counts["n_good"] or 0, counts["n_malformed"] or 0
        status = "OK" if good + malformed else "EMPTY"
        self._add(progress.id, progress.batchId, status, good, malformed, f"{progress.id}-{progress.batchId}")

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        batches = self.runs.pop(str(event.runId), None)
        if batches is None:
            return
        if event.exception or not batches:
            status = "FAILED" if event.exception else "EMPTY"
            self._add(event.id, None, status, 0, 0, f"{event.id}-run-{event.runId}")
        self.ended.set()

    def _add(self, query_id, batch_id, status, good, malformed, name):
        values = (str(query_id), batch_id, status, good, malformed)
        row = self.spark.range(0, 1, 1, 1).select(
            *[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(values, OUTCOMES)],
            F.current_timestamp().alias("ended_at"),
        )
        write_run(row, self.table, name)


def watch_outcomes(spark, table):
    """A listener that writes to `table` what the query that is started with it does."""
    outcomes = Outcomes(spark, table)
    spark.streams.addListener(outcomes)
    return outcomes


def read_outcomes(outcomes, seconds=60):
    """The rows so far. Spark reports after the fact, so this waits for the end of a query that has
    ended; of one that runs on, the newest batches may be missing."""
    outcomes.ended.wait(seconds)
    spark, table = outcomes.spark, outcomes.table
    rows = read_table(spark, table, schema=OUTCOMES) if table_exists(spark, table) else spark.createDataFrame([], OUTCOMES)
    return rows.select(*OUTCOMES.names)
