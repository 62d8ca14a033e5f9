"""Query-log files: which ones a date range needs, and the JSON-lines scan over them."""

from pyspark.sql import functions as F

from logweir.fixed_values import FILE_DAY_FORMAT, QUERY_LOG_DIRECTORIES, QUERY_LOG_LAYOUT
from logweir.schemas import CORRUPT, QUERY_LOG_IN
from logweir.sources.folders import names_in


def candidate_files(
    ranges, base, directories=None, layout=QUERY_LOG_LAYOUT, day_format=FILE_DAY_FORMAT
):
    """One row per day and directory of each (first_day, last_day) range, both ends included.

    An empty range gives no row: a backward range must not count down.
    """
    directories = QUERY_LOG_DIRECTORIES if directories is None else directories
    places = F.array(
        *[
            F.struct(F.lit(name).alias("directory"), F.lit(prefix).alias("prefix"))
            for name, prefix in directories.items()
        ]
    )
    days = ranges.where(F.col("first_day") <= F.col("last_day")).select(
        F.explode(F.sequence("first_day", "last_day")).alias("day")
    )
    grid = days.select("day", F.explode(places).alias("place")).select("day", "place.*")
    path = F.lit(f"{base}/{layout}")
    for part, value in (
        ("{directory}", F.col("directory")),
        ("{prefix}", F.col("prefix")),
        ("{day}", F.date_format("day", day_format)),
    ):
        path = F.replace(path, F.lit(part), value)
    return grid.select("day", "directory", path.alias("path"))


def existing_paths(spark, paths):
    """The paths that exist, in the given order. Lists each parent folder once."""
    listed = {}
    found = []
    for path in paths:
        parent, _, name = path.rpartition("/")
        if parent not in listed:
            listed[parent] = set(names_in(spark, parent))
        if name in listed[parent]:
            found.append(path)
    return found


def _json_lines(reader, schema):
    return (
        reader.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    )


def _with_path(rows):
    return rows.withColumn("input_file_path", F.col("_metadata.file_path"))


def read_json_logs(spark, paths, schema=QUERY_LOG_IN):
    """JSON lines with a fixed schema, so there is no inference pass over the files.

    Lines that do not fit go to the corrupt-record column whole. `input_file_path` is the file
    each row came from.
    """
    return _with_path(_json_lines(spark.read, schema).json(paths))


def stream_json_logs(spark, pattern, schema=QUERY_LOG_IN, **options):
    """As `read_json_logs`, the files and folders that a path pattern finds as a stream: each file
    once, in the order of its appearance. Options bound a micro-batch, such as maxFilesPerTrigger."""
    return _with_path(_json_lines(spark.readStream, schema).options(**options).json(pattern))
