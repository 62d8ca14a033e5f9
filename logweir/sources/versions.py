"""Numbered versions of a replaced table."""

from logweir.sources.folders import names_in

VERSION = "version-"


def versions(spark, path):
    """Complete versions of a replaced table, oldest first. A version is complete once Spark's
    committer has put its success marker there."""
    return [
        name
        for name in names_in(spark, path)
        if name.startswith(VERSION) and "_SUCCESS" in names_in(spark, f"{path}/{name}")
    ]
