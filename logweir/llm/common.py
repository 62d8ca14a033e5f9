"""What several operators share."""

from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import functions as F

from logweir.session import work_folder
from logweir.sources.folders import remove

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: White space between words: blank, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"
#: Rows that Spark hands to a Python worker at a time: texts are long, and both sides hold a batch.
ARROW_ROWS = 500


def written(df, name):
    """The rows as a table in the cluster's shared folder: computed once, readable after any loss
    of executors, and without the lineage of what made it."""
    path = work_folder(df.sparkSession, name)
    if _SCRATCH:
        _SCRATCH[-1][path] = df.sparkSession
    df.write.option("compression", "zstd").parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.work_path = path
    return table


#: Work tables of the scratches that are open, the innermost last.
_SCRATCH = []


@contextmanager
def scratch():
    """Work tables that are written inside go at its end, but for those that `kept` is told of."""
    tables = {}
    _SCRATCH.append(tables)
    try:
        yield tables
    finally:
        _SCRATCH.remove(tables)
        for path, spark in tables.items():
            remove(spark, path)


def kept(tables, df):
    """A work table of a scratch that outlives it; one that is around it takes it over."""
    spark = tables.pop(df.work_path)
    around = [other for other in _SCRATCH if other is not tables]
    if around:
        around[-1][df.work_path] = spark
    return df


def discard(*tables):
    """Remove work tables that nothing reads any more."""
    for df in tables:
        for open_ in _SCRATCH:
            open_.pop(df.work_path, None)
        remove(df.sparkSession, df.work_path)


def ascii_lower(text):
    """Lower-case A-Z and nothing else; the built-in lower() agrees where all is ASCII."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def workers_can_import(spark):
    """Python workers look for this package where the driver found it, too."""
    root = str(Path(__file__).resolve().parents[2])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(":")
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = ":".join(filter(None, [*paths, root]))


def bounded_batches(spark):
    """Batches for Python workers of at most ARROW_ROWS rows."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(setting)) <= ARROW_ROWS:
        spark.conf.set(setting, ARROW_ROWS)


def table(spark, sf_dir, name):
    workers_can_import(spark)
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_struct(df):
    """The whole row as one value, so that columns of an operator can't clash with its names."""
    return F.struct(*[F.col(f"`{name}`") for name in df.columns])
