"""Folder listing on whatever file system a path names."""


def _open(spark, path):
    handle = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return handle.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), handle


def names_in(spark, path):
    """Names directly below a folder; none when the folder is missing."""
    fs, handle = _open(spark, path)
    if not fs.exists(handle):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(handle))


def exists(spark, path):
    fs, handle = _open(spark, path)
    return fs.exists(handle)


def remove(spark, path):
    fs, handle = _open(spark, path)
    fs.delete(handle, True)
