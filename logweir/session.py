"""Session settings and the shared work folder."""

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app_name="logweir", master=None, **conf):
    """A session with the settings the jobs rely on: UTC clock, ANSI errors, adaptive plans."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.parquet.compression.codec": "zstd",
        "spark.ui.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_utc(spark):
    """Event times are read and rendered in UTC whatever the host's zone."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_folder(spark):
    """The folder every executor can reach, named by the cluster in spark.checkpoint.dir."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    return tempfile.mkdtemp(prefix="logweir-")


def work_folder(spark, name):
    """A fresh folder for one run, below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark):
    """DataFrame.checkpoint() needs a folder; Spark takes it from the setting when there is one."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
