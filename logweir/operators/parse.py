"""Lines and messages into typed columns."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from logweir.fixed_values import QUERY_LOG_FIELDS
from logweir.functions.fields import pieces
from logweir.schemas import CORRUPT
from logweir.sources.messages import BODY

PIECES = "_pieces"


def parse_query_log(df, names=QUERY_LOG_FIELDS, log="log", sep="\t", keep=(), count_as=None):
    """The `keep` columns, then one string column per delimited field of the line.

    `count_as` adds the number of fields under that name, to tell apart lines that a separator
    inside a value has shifted.
    """
    # A generated column is computed once. A plain one is cut again for every field where the fields
    # are only used under a condition.
    cut = df.select(*keep, F.explode(F.array(pieces(F.col(log), sep))).alias(PIECES))
    columns = [F.col(f"`{name}`") for name in cut.columns[:-1]]
    columns += [F.get(PIECES, F.lit(at)).alias(name) for at, name in enumerate(names)]
    if count_as:
        columns.append(F.coalesce(F.size(PIECES), F.lit(0)).alias(count_as))
    return cut.select(*columns)


def other_fields(text, schema):
    """What a JSON object holds beside the schema's columns, as a VARIANT; NULL when there is
    nothing, or no object.

    That is each field that the schema does not name, each text column's field that is not text (the
    column has its JSON text), and each field that comes more than once, with all its values in
    order, as the column can have only one of them. Nested values stay as they are.
    """
    fields = F.map_entries(F.from_json(text, "map<string,variant>"))
    texts = [field.name for field in schema if isinstance(field.dataType, T.StringType)]

    def is_other(field):
        unnamed = ~field["key"].isin(schema.names)
        no_text = field["key"].isin(texts) & ~F.schema_of_variant(field["value"]).isin("STRING", "VOID")
        times = F.size(F.filter(fields, lambda other: other["key"] == field["key"]))
        return unnamed | no_text | (times > 1)

    others = F.filter(fields, is_other)

    def entry(name):
        values = F.transform(
            F.filter(others, lambda field: field["key"] == name), lambda field: field["value"]
        )
        several = F.to_variant_object(values)
        return F.struct(name, F.when(F.size(values) == 1, F.get(values, F.lit(0))).otherwise(several))

    names = F.array_distinct(F.transform(others, lambda field: field["key"]))
    whole = F.to_variant_object(F.map_from_entries(F.transform(names, entry)))
    return F.when(F.size(names) > 0, whole)


def parse_messages(df, schema, body=BODY, keep=(), rest=None):
    """The `keep` columns, the fields of the JSON body, the body, and `malformed`.

    A message is malformed when it has no body or its body is not one JSON object of the schema's
    shape. Absent fields are NULL. Unknown ones are left out, or are in the VARIANT column `rest`,
    as `other_fields` says, when it is named.
    """
    checked = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    data = F.from_json(
        F.col(body).cast("string"), checked, {"columnNameOfCorruptRecord": CORRUPT}
    )
    # A generated column is computed once. A plain one would be repeated in every filter that is
    # pushed below this projection, and parsing is the costly part.
    read = df.select(*keep, body, F.explode(F.array(data)).alias("data"))
    malformed = F.col("data").isNull() | F.col(f"data.{CORRUPT}").isNotNull()
    others = F.when(~malformed, other_fields(F.col(body).cast("string"), schema))
    return read.select(
        *read.columns[:-2],
        *[F.col(f"data.`{name}`") for name in schema.names],
        *([others.alias(rest)] if rest else []),
        body,
        malformed.alias("malformed"),
    )


def split_malformed(parsed, body=BODY):
    """(good, bad): good rows without the helper columns, bad rows as they came."""
    good = parsed.where(~F.col("malformed")).drop("malformed", body)
    bad = parsed.where(F.col("malformed")).select(body)
    return good, bad
