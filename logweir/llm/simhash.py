"""Near duplicates by SimHash, found through deletion-variant signatures.

A fingerprint is cut into so few segments that of two fingerprints within the distance, at least
one segment differs in one bit or none. Each segment is indexed with each of its bits left out in
turn; equal variants meet in an equality join, which verifies the distance. A pair that meets under
several variants counts at the first that it must share. Equal fingerprints are one class, so
copies make no pairs, and groups of near copies that a cheap first look ties together make none
within them. Components are the classes' smallest labels, spread by alternating star steps.
"""

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logweir.llm.common import as_struct, discard, kept, scratch, written
from logweir.operators.joins import bounded_join

BITS = 64
#: Shingles hashed at a time; bounds memory for very long texts.
SHINGLES_AT_ONCE = 1 << 16


def fingerprint(text, shingle, seed):
    """64 bits as a signed number: a bit is 1 if set in over half of the shingles' hashes."""
    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    counts = np.zeros(BITS, np.int64)
    for start in range(0, n, SHINGLES_AT_ONCE):
        end = min(n, start + SHINGLES_AT_ONCE)
        digests = b"".join(
            [xxhash.xxh64_digest(b" ".join(words[at : at + shingle]), seed) for at in range(start, end)]
        )
        bits = np.unpackbits(np.frombuffer(digests, np.uint8)).reshape(-1, BITS)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n).view(">i8")[0])


def fingerprints(text, shingle, seed):
    """Column of signed 64-bit fingerprints; null text is empty."""

    @F.pandas_udf(T.LongType())
    def udf(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(text, shingle, seed) for text in texts], dtype="int64")

    return udf(F.coalesce(text, F.lit("")))


def _segments(max_bits):
    """(shift, width) of the fewest segments of which one differs in at most one bit."""
    n = max_bits // 2 + 1
    edges = [BITS * i // n for i in range(n + 1)]
    return list(zip(edges, [b - a for a, b in zip(edges, edges[1:])]))


def _mask(width, shift=0):
    value = ((1 << width) - 1) << shift
    return F.lit(value - (1 << 64) if value >> 63 else value)


def _differs():
    return F.expr("a.word ^ b.word")


def _first_shared(max_bits):
    """The variant under which a close pair counts: of the first segment that differs in at most
    one bit, the one with the differing bit left out (the lowest where none differs)."""
    found = F.lit(None).cast("int")
    for shift, width in reversed(_segments(max_bits)):
        part = _differs().bitwiseAND(_mask(width, shift))
        # the place of a single bit: the number of bits below it
        bit = F.when(part == 0, shift).when(part < 0, BITS - 1).otherwise(F.bit_count(part - 1))
        found = F.when(F.bit_count(part) <= 1, bit).otherwise(found)
    return found


def _variants(classes, max_bits):
    """Each class under each of its variants: number of the bit left out, and what is left."""
    variants = []
    for shift, width in _segments(max_bits):
        segment = F.col("word").bitwiseAND(_mask(width, shift))
        for bit in range(shift, shift + width):
            kept = segment.bitwiseAND(F.bitwise_not(_mask(1, bit)))
            variants.append(F.struct(F.lit(bit).cast("int").alias("variant"), kept.alias("rest")))
    exploded = classes.select("word", "crowd", F.explode(F.array(*variants)).alias("v"))
    return exploded.select("word", "crowd", "v.variant", "v.rest")


def crowd_links(classes, max_bits):
    """Some of the close pairs, few for each class: of the classes that agree in half a word, the
    smallest with each other one that is close to it. They tie large groups of near copies."""
    halves = [
        F.struct(F.lit(half).alias("half"), F.col("word").bitwiseAND(_mask(32, 32 * half)).alias("value"))
        for half in range(2)
    ]
    agreeing = classes.select("word", F.explode(F.array(*halves)).alias("h")).select("word", "h.half", "h.value")
    smallest = agreeing.groupBy("half", "value").agg(F.min("word").alias("word"), F.count(F.lit(1)).alias("n"))
    a = smallest.where("n > 1").alias("a")
    b = agreeing.alias("b")
    same = (F.col("a.half") == F.col("b.half")) & (F.col("a.value") == F.col("b.value"))
    close = (F.bit_count(_differs()) <= max_bits) & (F.col("a.word") < F.col("b.word"))
    return a.join(b, same & close).select(F.col("a.word").alias("one"), F.col("b.word").alias("two"))


def met_crowds(variants):
    """The variants of crowded classes that classes of several crowds share. Most crowds fill their
    variants alone; those rows go here, by an aggregate that each task begins by itself, and never
    meet each other."""
    here = variants.where("crowd IS NOT NULL")
    shared = here.groupBy("variant", "rest").agg(F.min("crowd").alias("low"), F.max("crowd").alias("high"))
    several = shared.where("low < high").select("variant", "rest")
    return here.join(several.hint("merge"), ["variant", "rest"], "left_semi")


def close_pairs(classes, max_bits):
    """Pairs of classes of which the word differs in at most `max_bits` bits: one row a pair.
    Classes of one `crowd`, where they have one, are linked already and make no pairs."""
    if "crowd" not in classes.columns:
        classes = classes.withColumn("crowd", F.lit(None).cast("long"))
    # a class has many variants, so even a small table of classes is work for all tasks
    tasks = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    indexed = _variants(classes.repartition(tasks, "word"), max_bits)
    verified = (
        (F.col("a.variant") == F.col("b.variant"))
        & (F.col("a.rest") == F.col("b.rest"))
        & (F.bit_count(_differs()) <= max_bits)
        & (_first_shared(max_bits) == F.col("a.variant"))
    )
    ordered = F.col("a.word") < F.col("b.word")
    pair = [F.least("a.word", "b.word").alias("one"), F.greatest("a.word", "b.word").alias("two")]
    # a class without a crowd against every class; then crowds among themselves. Spark takes the
    # variants for as small as their classes and would broadcast them
    single = indexed.where("crowd IS NULL").alias("a")
    every = indexed.alias("b").hint("merge")
    of_single = single.join(every, verified & (F.col("b.crowd").isNotNull() | ordered))
    crowded = met_crowds(indexed)
    apart = F.col("a.crowd") != F.col("b.crowd")
    of_crowds = crowded.alias("a").join(crowded.alias("b").hint("merge"), verified & ordered & apart)
    return of_single.select(*pair).unionByName(of_crowds.select(*pair))


def _checksum(edges):
    """Number and sums of two hashes of different edges, whatever their order."""
    hashes = [F.xxhash64("u", "v"), F.xxhash64(F.lit(1), "v", "u")]
    sums = [F.sum(h.cast("decimal(38,0)")) for h in hashes]
    return tuple(edges.agg(F.count(F.lit(1)), *sums).first())


def components(nodes, edges):
    """`nodes` (node) with `root`: the smallest node reachable over `edges` (one, two).

    Alternating star steps: each node's larger neighbours, then its smaller ones, are tied to the
    smallest node around it, until nothing moves, which a checksum of the edges tells. Each step is
    written to the shared folder. Only minima are taken per node, partly before the shuffle; no
    node's neighbours meet in one task."""
    edges = written(
        edges.select(F.greatest("one", "two").alias("u"), F.least("one", "two").alias("v")).distinct(),
        "component-edges",
    )
    before = _checksum(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(large.where("u <> v").distinct(), "component-large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
        moved = written(small.where("u <> v").distinct(), "component-small")
        discard(edges, large)
        edges = moved
        after = _checksum(edges)
        if after == before:
            break
        before = after
    roots = edges.groupBy("u").agg(F.min("v").alias("root"))
    linked = nodes.join(roots, nodes["node"] == roots["u"], "left")
    return linked.select("node", F.coalesce("root", "node").alias("root"))


def _labels(marked, max_bits):
    """word, root, component_id of each class of equal fingerprints."""
    with scratch() as tables:
        rooted = kept(tables, _rooted(marked, max_bits))
    # only components of several classes are looked up, so that a root with many classes, which
    # the join splits, is the one case of a key with many rows
    alone = F.col("root") == F.col("word")
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("n"))
    several = smallest.where("n > 1").select("root", "component_id")
    joined = bounded_join(rooted, several.withColumn("found", F.lit(True)), ["root"], "left")
    own = F.when(F.col("found"), F.col("component_id")).when(alone, F.col("least"))
    return joined.select("word", "root", own.alias("component_id"))


def _rooted(marked, max_bits):
    """word, root, least: each class with the smallest word of its component and its smallest id."""
    classes = written(marked.groupBy("word").agg(F.min("doc_id").alias("least")), "simhash-classes")
    nodes = classes.select(F.col("word").alias("node"))
    links = written(crowd_links(classes.select("word"), max_bits), "simhash-crowds")
    tied = links.select(F.explode(F.array("one", "two")).alias("node")).distinct()
    crowds = components(tied, links).select(F.col("node").alias("word"), F.col("root").alias("crowd"))
    crowded = written(classes.select("word").join(crowds, "word", "left"), "simhash-crowded")
    pairs = close_pairs(crowded, max_bits)
    rooted = components(nodes, links.unionByName(pairs)).withColumnRenamed("node", "word")
    return written(rooted.join(classes, "word"), "simhash-rooted")


def _marked(docs, id_col, text_col, shingle, seed, *more):
    return docs.select(
        F.col(id_col).alias("doc_id"), fingerprints(F.col(text_col), shingle, seed).alias("word"), *more
    )


def simhash_components(docs, id_col="doc_id", text_col="text", shingle=4, seed=42, max_bits=4):
    """One row per input row: doc_id, word (its fingerprint), component_id.

    Fingerprints link at `max_bits` or fewer differing bits. component_id is the smallest id
    reachable over links, a document's own included, null ids being larger than all others. Null
    and empty texts have the fingerprint zero and link like any other; shorter texts are one
    shingle. Repeated rows share a class. An empty table gives no rows.
    """
    marked = written(_marked(docs, id_col, text_col, shingle, seed), "simhash-words")
    labels = _labels(marked, max_bits).select("word", "component_id")
    return marked.join(labels, "word").select("doc_id", "word", "component_id")


def hex_fingerprint(word):
    return F.lower(F.lpad(F.hex(word), 16, "0"))


def drop_near_duplicates(docs, id_col="doc_id", text_col="text", shingle=4, seed=42, max_bits=4):
    """One row of each component, with the columns it came with: that of the smallest id, null ids
    being larger than all others; of rows that share the id, the one whose text has the smallest
    hash.

    Which rows stay is worked out on ids and fingerprints; the rows themselves are written once
    and moved at most once, and not at all where the dropped ones are few enough to broadcast.
    Nulls, empty texts and repeated rows as in `simhash_components`. An empty table gives no rows."""
    marked = written(
        _marked(
            docs, id_col, text_col, shingle, seed,
            F.xxhash64(F.col(text_col)).alias("text_no"),
            F.monotonically_increasing_id().alias("row_no"),
            as_struct(docs).alias("row"),
        ),
        "simhash-rows",
    )
    narrow = marked.select("row_no", "doc_id", "text_no", "word")
    labelled = narrow.join(_labels(marked, max_bits).select("word", "root"), "word")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "text_no", "row_no")
    kept = labelled.groupBy("root").agg(F.min(order).alias("first")).select("first.row_no")
    dropped = written(narrow.select("row_no").join(kept, "row_no", "left_anti"), "simhash-dropped")
    return bounded_join(marked.select("row_no", "row"), dropped, ["row_no"], "left_anti").select("row.*")
