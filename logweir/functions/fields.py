"""Fields cut out of delimited lines and source paths."""

from pyspark.sql import functions as F

from logweir.fixed_values import FILE_DAY_FORMAT, FILE_DAY_PATTERN, SOURCE_DIR_PATTERN


def pieces(line, sep):
    """The line cut at a literal separator. Splitting at one plain or escaped character needs no
    regular expression, which would be compiled again for every row."""
    if len(sep) == 1:
        pattern = f"\\{sep}" if sep in ".$|()[{^?*+\\" else sep
    else:
        pattern = rf"\Q{sep}\E"
    return F.split(line, pattern)


def split_fields(line, names, sep="\t"):
    """One string column per name; missing fields are NULL and extra ones are left out."""
    cut = pieces(line, sep)
    return [F.get(cut, F.lit(at)).alias(name) for at, name in enumerate(names)]


def field_count(line, sep="\t"):
    """Number of fields on a line, 0 for no line."""
    return F.coalesce(F.size(pieces(line, sep)), F.lit(0))


def source_dir(path, pattern=SOURCE_DIR_PATTERN):
    """Name of the log directory in a path, empty when there is none."""
    return F.regexp_extract(path, pattern, 1)


def file_day(path, pattern=FILE_DAY_PATTERN, day_format=FILE_DAY_FORMAT):
    """Day in a file name, NULL when the name has none."""
    return F.try_to_date(F.regexp_extract(path, pattern, 1), day_format)
