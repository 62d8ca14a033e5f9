"""What changed between two versions of a keyed table."""

from functools import reduce

from pyspark.sql import functions as F


def changed_keys(old, new, keys, content):
    """keys, change: `added`, `removed` or `updated` for every key whose row differs.

    `content` names the columns that are compared, nulls equal to nulls. Both versions have one row
    for a key; rows without a key have no identity and are left out. One full outer join on the key
    that moves the keys and a hash of 256 bits for each row.
    """
    keyed = reduce(lambda a, b: a & b, [F.col(key).isNotNull() for key in keys])

    def hashed(df, name):
        body = F.to_json(F.struct(*[F.col(f"`{column}`") for column in content]))
        return df.where(keyed).select(*keys, F.sha2(body, 256).alias(name))

    both = hashed(old, "_old").join(hashed(new, "_new"), list(keys), "full_outer")
    change = (
        F.when(F.col("_old").isNull(), "added")
        .when(F.col("_new").isNull(), "removed")
        .when(F.col("_old") != F.col("_new"), "updated")
    )
    return both.select(*keys, change.alias("change")).where(F.col("change").isNotNull())
