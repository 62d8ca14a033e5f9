"""Reading tables that are dealt into hash buckets (see `sinks.buckets`)."""

from functools import reduce

from pyspark.sql import functions as F

from logweir.sources.folders import names_in
from logweir.sources.versions import versions

BUCKET = "hash_bucket"
#: Bucket of the rows without a key.
KEYLESS = -1
OF = "of="


def bucket_of(keys, n_buckets):
    """The bucket of a row by its key columns."""
    keyed = reduce(lambda a, b: a & b, [F.col(key).isNotNull() for key in keys])
    return F.when(keyed, F.pmod(F.xxhash64(*keys), F.lit(n_buckets))).otherwise(KEYLESS).cast("int")


def bucket_count(spark, path):
    """How many buckets the table is dealt into, None when it is no such table."""
    found = [name for name in names_in(spark, path) if name.startswith(OF)]
    return int(found[0][len(OF) :]) if found else None


def root_of(path, n_buckets):
    return f"{path}/{OF}{n_buckets}"


def holders(spark, path):
    """{bucket: complete versions that hold it, oldest first}."""
    n_buckets = bucket_count(spark, path)
    found = {}
    for version in versions(spark, root_of(path, n_buckets)) if n_buckets else []:
        for name in names_in(spark, f"{root_of(path, n_buckets)}/{version}"):
            if name.startswith(f"{BUCKET}="):
                found.setdefault(int(name.partition("=")[2]), []).append(version)
    return found


def read_buckets(spark, path, schema, only=None):
    """The table's rows, or those of the buckets `only`: of each bucket its newest version, of the
    rows without a key all that were added."""
    n_buckets = bucket_count(spark, path)
    paths = [
        f"{root_of(path, n_buckets)}/{version}/{BUCKET}={bucket}"
        for bucket, held in sorted(holders(spark, path).items())
        if only is None or bucket in only
        for version in (held if bucket == KEYLESS else held[-1:])
    ]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*paths)
