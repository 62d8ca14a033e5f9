"""Table scans, batch and streaming."""

from logweir.schemas import WATCHLIST
from logweir.sources.buckets import OF, bucket_count, read_buckets
from logweir.sources.folders import names_in
from logweir.sources.versions import VERSION, versions


def current_path(spark, path, fmt="parquet"):
    """Folder that holds the table's rows now."""
    if fmt != "delta":
        done = versions(spark, path)
        if done:
            return f"{path}/{done[-1]}"
    return path


def table_exists(spark, path, fmt="parquet"):
    """True when the table has been written at least once."""
    names = names_in(spark, path)
    if fmt == "delta":
        return "_delta_log" in names
    if any(name.startswith(OF) for name in names):
        return bool(versions(spark, f"{path}/{names[0]}"))
    if any(name.startswith(VERSION) for name in names):
        return bool(versions(spark, path))
    return any(not name.startswith(("_", ".")) or name == "_SUCCESS" for name in names)


def read_table(spark, path, fmt="parquet", schema=None):
    """A table by path. With a schema there is no inference, and a table without rows reads too. A
    table dealt into buckets needs the schema."""
    if fmt == "parquet" and schema is not None:
        if bucket_count(spark, path):
            return read_buckets(spark, path, schema)
    reader = spark.read.format(fmt)
    if schema is not None and fmt != "delta":
        reader = reader.schema(schema)
    return reader.load(current_path(spark, path, fmt))


def stream_table(spark, path, schema=None, fmt="parquet", **options):
    """New rows of an append-only table as a stream. Options bound a micro-batch, such as
    maxFilesPerTrigger."""
    reader = spark.readStream.format(fmt).options(**options)
    if schema is not None and fmt != "delta":
        reader = reader.schema(schema)
    return reader.load(path)


def rows_table(spark, rows, schema):
    """A small table from rows the driver has, such as captured dicts or tuples. The schema is
    required, so no rows is a table too."""
    return spark.createDataFrame(rows, schema)


def read_watchlist(spark, path, fmt="csv"):
    """Watched products from a delimited file with a header, or from any table format."""
    reader = spark.read.format(fmt).schema(WATCHLIST)
    return (reader.option("header", True) if fmt == "csv" else reader).load(path)
