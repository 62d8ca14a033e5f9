"""Gapless row numbers on a stream."""

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from logweir.operators.sequence import NINE_DIGITS

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PLAIN = (T.StringType, T.LongType, T.IntegerType, T.TimestampType, T.TimestampNTZType, T.DateType, T.BooleanType)


class _Counter(StatefulProcessor):
    """Numbers a group's rows on from where its last micro-batch ended. The state is one number for
    a group; rows pass in Arrow batches and are not collected."""

    def __init__(self, columns, name, limit):
        self.columns, self.name, self.limit = columns, name, limit

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.next = handle.getValueState("next", "next long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        at = self.next.get()[0] if self.next.exists() else 0
        for some in rows:
            if at + len(some) > self.limit:
                raise ValueError(f"a group has more rows than {self.limit} numbers; use the stable row id")
            yield some[self.columns].assign(**{self.name: range(at, at + len(some))})
            at += len(some)
        self.next.update((at,))

    def close(self) -> None:
        pass


def number_stream(rows, name, group, limit=NINE_DIGITS):
    """The rows of a stream with `name`: 0, 1, 2, ... within each group, over all its micro-batches
    and restarts.

    The counters are state of the query, so a batch that comes again gives its rows the numbers of
    its first try, if in another order, and the sink keeps one of them. Groups are never forgotten:
    one number for each is kept. A group's rows of one micro-batch pass through one task. Columns
    pass as text, which gives back strings, whole numbers, times, dates and booleans as they were;
    others are refused. Needs the RocksDB state store, which is set for the session."""
    rows.sparkSession.conf.set(STATE_STORE, ROCKS_DB)
    for field in rows.schema:
        if not isinstance(field.dataType, _PLAIN):
            raise ValueError(f"{field.name}: {field.dataType.simpleString()} can't be numbered on a stream")
    text = rows.select(group.cast("string").alias("_group"), *[F.col(f"`{c}`").cast("string") for c in rows.columns])
    schema = T.StructType([*text.schema.fields[1:], T.StructField(name, T.LongType())])
    numbered = text.groupBy("_group").transformWithStateInPandas(_Counter(rows.columns, name, limit), schema, "append", "none")
    return numbered.select(
        *[F.col(f"`{field.name}`").cast(field.dataType).alias(field.name) for field in rows.schema], name
    )
