"""Text reports."""


def write_lines(df, path, column="line"):
    """One text line per row, in as many files as the frame has partitions."""
    df.select(column).write.mode("overwrite").text(path)
