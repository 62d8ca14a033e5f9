"""Batch writes: append, replace, one run's rows, and upsert by key.

Parquet has no transactions, so a replaced table is a folder of numbered versions. Each version
is written whole, becomes visible with Spark's success marker, and is what readers of the table
path get from then on. One writer per table is assumed. With Delta the format's own
transactions are used instead.
"""

from pyspark.sql import functions as F

from logweir.operators.upsert import latest_per_key, merged, staged_newest
from logweir.sources.folders import names_in, remove
from logweir.sources.tables import read_table, table_exists
from logweir.sources.versions import VERSION, versions


def append_table(df, path, fmt="parquet", partition_by=()):
    df.write.format(fmt).mode("append").partitionBy(*partition_by).save(path)


def write_run(df, path, run_id, fmt="parquet", partition_by=()):
    """Write the rows of one run, replacing what an earlier try of the same run left.

    Rows of a run live under their own `ingest_run` value. A run that died before its checkpoint
    was saved comes again with the same id, so the table never holds its rows twice and no
    look-up of existing rows is needed.
    """
    if fmt == "delta":
        (
            df.withColumn("ingest_run", F.lit(run_id))
            .write.format(fmt)
            .mode("overwrite")
            .option("replaceWhere", f"ingest_run = '{run_id}'")
            .partitionBy("ingest_run", *partition_by)
            .save(path)
        )
    else:
        (
            df.write.format(fmt)
            .mode("overwrite")
            .option("partitionOverwriteMode", "static")
            .partitionBy(*partition_by)
            .save(f"{path}/ingest_run={run_id}")
        )


def run_is_written(spark, path, run_id):
    """True when the rows of the run are in the parquet table, whole."""
    return "_SUCCESS" in names_in(spark, f"{path}/ingest_run={run_id}")


def replace_partitions(df, path, partition_by, token):
    """Replace the partitions of a parquet table that `df` has rows of, and no other. The frame may
    read the table.

    The new rows are written next to the table first, under the token. A call that died while
    partitions were being exchanged is completed by one with the same token, which takes those rows
    and does not work them out again."""
    spark = df.sparkSession
    parent, _, name = path.rstrip("/").rpartition("/")
    staged = f"{parent}/_replaced/{name}/{token}"
    if "_SUCCESS" not in names_in(spark, staged):
        df.write.mode("overwrite").partitionBy(*partition_by).parquet(staged)
    rows = spark.read.schema(df.schema).parquet(staged)
    (
        rows.select(*df.columns)
        .hint("rebalance", *partition_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )
    remove(spark, staged)


def published_number(spark, path, fmt="parquet"):
    """The number that the newest version carries as its token, 0 when it has none. Delta numbers
    its versions itself."""
    if not table_exists(spark, path, fmt):
        return 0
    if fmt == "delta":
        return spark.sql(f"DESCRIBE HISTORY delta.`{path}` LIMIT 1").first()["version"]
    return int(published_token(spark, path) or 0)


def published_token(spark, path):
    """Token of the newest version, None when it has none."""
    done = versions(spark, path)
    return done[-1][len(VERSION) :].partition("-")[2] or None if done else None


def replace_table(df, path, fmt="parquet", token=None, keep=2):
    """Replace the whole table. The frame may read the table it replaces.

    `keep` complete versions stay, so that a reader of the previous one can finish.
    """
    spark = df.sparkSession
    if fmt == "delta":
        df.write.format(fmt).mode("overwrite").option("overwriteSchema", "true").save(path)
        return
    taken = [name for name in names_in(spark, path) if name.startswith(VERSION)]
    number = max((int(name[len(VERSION) :].partition("-")[0]) for name in taken), default=-1) + 1
    name = f"{VERSION}{number:010d}" + (f"-{token}" if token else "")
    df.write.format(fmt).mode("errorifexists").save(f"{path}/{name}")
    old = [other for other in taken if other not in versions(spark, path)[-keep:]]
    for other in old:
        remove(spark, f"{path}/{other}")


def _merge_delta(newest, path, keys):
    from delta.tables import DeltaTable

    same_key = " AND ".join(f"target.`{key}` = source.`{key}`" for key in keys)
    (
        DeltaTable.forPath(newest.sparkSession, path)
        .alias("target")
        .merge(newest.alias("source"), same_key)
        .whenMatchedUpdateAll()
        .whenNotMatchedInsertAll()
        .execute()
    )


def upsert_table(df, path, keys, order_by=(), columns=None, fmt="parquet", token=None):
    """Insert new keys and update known ones; the newest row of the batch wins for a key.

    `order_by` says which row is newest and may use columns that are not among the `columns`
    kept. The first call creates the table, with the same one-row-per-key rule. A token names
    the batch: when the newest version carries it, the batch is already in and nothing is done,
    so a replay is harmless.
    """
    spark = df.sparkSession
    if token is not None and fmt != "delta" and token == published_token(spark, path):
        return
    if not table_exists(spark, path, fmt):
        replace_table(latest_per_key(df, keys, order_by, columns), path, fmt, token)
    elif fmt == "delta":
        _merge_delta(latest_per_key(df, keys, order_by, columns), path, keys)
    else:
        target = read_table(spark, path, fmt)
        newest, folder = staged_newest(df, keys, order_by, columns or target.columns)
        replace_table(merged(target, newest, keys, newest.columns), path, fmt, token)
        remove(spark, folder)
