"""Exact duplicates by an extendible-hash index kept as files in the shared folder.

A text's key is the 64-bit hash of its bytes. The directory starts at the smallest depth that
could hold the distinct texts and doubles while some bucket with more than one key is overfull; a
bucket that fits at fewer bits keeps its smaller local depth. A bucket whose rows still exceed its
size, because a text repeats or the doublings are used up, gets overflow pages, and its rows are
spread over them by document id and number of the row. Each (bucket, page) has one owner task, which
chains the rows of a key and compares their bytes. Chains of one bucket's pages are then put together
by an aggregate over their texts, of which each task sends one row on.
"""

from math import ceil, floor, log2

from pyspark.sql import Window
from pyspark.sql import functions as F

from logweir.llm.common import as_struct, ascii_lower, discard, written

#: Bytes of distinct text for a bucket; grows only where the directory would pass MAX_BUCKETS.
BUCKET_BYTES = 128 * 1024
#: Bounds the directory: 2 * MAX_BUCKETS * 2**DOUBLINGS slots of about 20 bytes.
MAX_BUCKETS = 2**18
DOUBLINGS = 3


def _slot(depth):
    """The first `depth` bits of the key."""
    return F.shiftrightunsigned("key", 64 - depth) if depth else F.lit(0).cast("long")


def _overfull(keys, depth, bucket_bytes):
    load = keys.groupBy(_slot(depth).alias("slot")).agg(
        F.sum("one_bytes").alias("bytes"), F.count(F.lit(1)).alias("n_keys")
    )
    return bool(load.where((F.col("bytes") > bucket_bytes) & (F.col("n_keys") > 1)).head(1))


def build_directory(keys, bucket_bytes=BUCKET_BYTES, max_buckets=MAX_BUCKETS, doublings=DOUBLINGS):
    """(global depth, directory): slot -> bucket and its number of pages.

    `keys` has one row for each key: one_bytes of its text, all_bytes of all its copies."""
    total = keys.agg(F.sum("one_bytes")).first()[0] or 0
    bucket_bytes = max(bucket_bytes, ceil(total / max_buckets))
    least = max(0, floor(log2(max(1, total / bucket_bytes))))
    depth = least
    while depth < least + doublings and _overfull(keys, depth, bucket_bytes):
        depth += 1
    slots = keys.groupBy(_slot(depth).alias("slot")).agg(
        F.sum("one_bytes").alias("one"),
        F.sum("all_bytes").alias("all"),
        F.count(F.lit(1)).alias("n_keys"),
    )
    local = F.lit(depth)
    for bits in range(depth - 1, least - 1, -1):
        buddies = Window.partitionBy(F.shiftright("slot", depth - bits))
        slots = slots.withColumns(
            {f"one_{bits}": F.sum("one").over(buddies), f"n_{bits}": F.sum("n_keys").over(buddies)}
        )
        fits = (F.col(f"one_{bits}") <= bucket_bytes) | (F.col(f"n_{bits}") <= 1)
        local = F.when(fits, F.lit(bits)).otherwise(local)
    prefix = F.expr("shiftright(slot, CAST(depth - local AS INT))")
    bucket = Window.partitionBy("bucket")
    slots = (
        slots.withColumns({"local": local, "depth": F.lit(depth)})
        .withColumn("bucket", prefix * 64 + F.col("local"))
        .withColumn("pages", F.ceil(F.sum("all").over(bucket) / (2 * bucket_bytes)))
        .select("slot", "bucket", F.greatest("pages", F.lit(1)).alias("pages"))
    )
    return depth, written(slots, "dedup-directory")


def exact_duplicates(docs, id_col="doc_id", text_col="text", whole_rows=False, **limits):
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256; `row` as well, the
    input row, if `whole_rows`.

    Texts are equal when identical after lower-casing A-Z; null counts as empty. The row with the
    largest id stays, a null id being the smallest. Repeated rows with one id are copies of each
    other, of which one stays. An empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        ascii_lower(text).alias("norm"),
        (as_struct(docs) if whole_rows else F.lit(True)).alias("row"),
        F.monotonically_increasing_id().alias("number"),
    ).withColumn("key", F.xxhash64("norm"))
    sizes = rows.select("key", F.octet_length("norm").cast("long").alias("n"))
    keys = written(
        sizes.groupBy("key").agg(F.max("n").alias("one_bytes"), F.sum("n").alias("all_bytes")),
        "dedup-keys",
    )
    depth, directory = build_directory(keys, **limits)
    discard(keys)
    owned = (
        rows.withColumn("slot", _slot(depth))
        .join(F.broadcast(directory), "slot")  # bounded by MAX_BUCKETS and DOUBLINGS
        .withColumn("page", F.pmod(F.xxhash64("doc_id", "number"), F.col("pages")))
        .repartition("bucket", "page")
    )
    chain = Window.partitionBy("bucket", "page", "key", "norm").orderBy(F.desc_nulls_last("doc_id"))
    whole = chain.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    index = written(
        owned.withColumns(
            {
                "place": F.row_number().over(chain),
                "page_keep": F.first("doc_id").over(whole),
                "page_size": F.count(F.lit(1)).over(whole),
            }
        ).select(
            "doc_id", "row", "bucket", "page", "pages", "key", "place", "page_keep", "page_size",
            F.sha2("norm", 256).alias("text_sha256"),
            F.when((F.col("pages") > 1) & (F.col("place") == 1), F.col("norm")).alias("norm"),
        ),
        "dedup-index",
    )
    single = index.where("pages = 1").withColumns(
        {"keep_id": F.col("page_keep"), "group_size": F.col("page_size"), "kept": F.col("place") == 1}
    )
    paged = index.where("pages > 1")
    heads = paged.where("place = 1")
    best = F.struct(F.col("page_keep").isNotNull(), "page_keep", (-F.col("page")).alias("page"))
    whole = heads.groupBy("bucket", "key", "norm").agg(
        F.max(best).alias("best"), F.sum("page_size").alias("group_size")
    )
    whole = whole.select(
        "bucket", "key", F.sha2("norm", 256).alias("text_sha256"), "group_size",
        F.col("best.page_keep").alias("keep_id"), (-F.col("best.page")).alias("keep_page"),
    )
    # each page looks its own texts up, so the rows of a hot text are joined where they are
    of_page = heads.select("bucket", "page", "key", "text_sha256").join(whole, ["bucket", "key", "text_sha256"])
    found = paged.join(of_page, ["bucket", "page", "key", "text_sha256"]).withColumn(
        "kept", (F.col("place") == 1) & (F.col("page") == F.col("keep_page"))
    )
    columns = ["doc_id", "keep_id", "group_size", "kept", "text_sha256", *["row"] * whole_rows]
    return single.select(*columns).unionByName(found.select(*columns))


def drop_exact_duplicates(docs, id_col="doc_id", text_col="text", **limits):
    """The rows that stay, with the columns they came with: of equal texts the row with the largest
    id, a null id being the smallest, and one row of those that share it. Null text equals empty
    text. An empty table gives no rows."""
    found = exact_duplicates(docs, id_col, text_col, whole_rows=True, **limits)
    return found.where("kept").select("row.*")
