"""Mixing sources to target weights by pivotal dependent rounding.

A source's documents are to be taken target / size times each: once or not at all for certain, and
once more with a probability. Pairs of documents exchange words at random, in keeping with those
probabilities, until one of the two is taken a whole number of times; the sum of words stays as it
was. Blocks of a source do so by themselves, octave by octave of document size, and leave one open
document for each octave; those go up a tree whose nodes do the same with what their children left.
At the root, one document an octave is open, and rounding them from the longest to the shortest,
each with the words that the longer ones missed, leaves a source off by about half a short document.
"""

from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from logweir.llm.common import WORD, as_struct, discard, written
from logweir.operators.joins import fits_broadcast

#: Relative weights of the sources in order, repeating.
WEIGHTS = (5, 2, 1)
TOTAL_SHARE = 1.5
MOST_COPIES = 2.0
#: Documents of a block and nodes under a node of the tree; bounds what a task holds.
BLOCK_ROWS = 4096
SEED = 42

#: What makes a row's place in the draw: nothing here depends on how the table is laid out.
DRAW = ["doc_id", "text_no", "copy_no"]
OPEN_SCHEMA = (
    "row_no long, doc_id long, text_no long, copy_no long, source string, node long, size long, "
    "base long, p double, open boolean"
)


def n_words(text):
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes, weights=WEIGHTS, share=TOTAL_SHARE, most=MOST_COPIES):
    """source, source_size, target: `share` of all words dealt by weight, where a source that
    would get more than `most` times its size stops there and the rest is dealt again by weight.

    Sources are ordered by code point, null last. In order of capacity per weight the sources that
    stop come first, so the level at which the others stand follows from running sums. One row a
    source is all that this looks at.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(place, len(weights)) + 1)
    cap = F.col("source_size") * F.lit(most)
    order = Window.orderBy("full_at", F.asc_nulls_last("source"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    ranked = by_source.withColumn("weight", weight).withColumns({"cap": cap, "full_at": cap / F.col("weight")})
    ranked = ranked.withColumn("all_words", F.sum("source_size").over(everything) * F.lit(share))
    left = F.col("all_words") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    ranked = ranked.withColumn("level", left / F.sum("weight").over(rest))
    # the first source that does not reach its cap sets the level for all that follow
    ranked = ranked.withColumn("fits", F.when(F.col("level") <= F.col("full_at"), F.col("level")))
    level = F.first("fits", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    return ranked.withColumn("level", level).select(
        "source", "source_size", F.coalesce(F.col("level") * F.col("weight"), F.col("cap")).alias("target")
    )


def exchange(sizes, p, random):
    """Whole-number outcomes for all but one of the probabilities, sum(size * p) unchanged.

    Returns the probabilities and the place of the one left open, or None."""
    p = p.copy()
    held = None
    for at in range(len(p)):
        if not 0.0 < p[at] < 1.0:
            continue
        if held is None:
            held = at
            continue
        i, j, si, sj = held, at, float(sizes[held]), float(sizes[at])
        up = min(si * (1 - p[i]), sj * p[j])
        down = min(si * p[i], sj * (1 - p[j]))
        move = up if random.random() * (up + down) < down else -down
        first_full = move == (si * (1 - p[i]) if move > 0 else -si * p[i])
        pi, pj = p[i] + move / si, p[j] - move / sj
        if first_full:
            p[i], p[j] = round(pi), min(1.0, max(0.0, pj))
            held = j if 0.0 < p[j] < 1.0 else None
        else:
            p[j], p[i] = round(pj), min(1.0, max(0.0, pi))
            held = i if 0.0 < p[i] < 1.0 else None
    return p, held


def _octave(size):
    return np.floor(np.log2(np.maximum(size, 1))).astype(int)


def _with(rows, **columns):
    for name, values in columns.items():
        rows = rows.set_column(rows.column_names.index(name), name, pa.array(values))
    return rows


def _settle(seed):
    """One node of the tree. Rows stay Arrow columns, so ids are never turned into other numbers."""

    def settle(key, rows):
        rows = rows.sort_by([(name, "ascending") for name in ["size", *DRAW]])
        name = repr(tuple(part.as_py() for part in key)).encode()
        random = np.random.default_rng([seed, *np.frombuffer(name, np.uint8)])
        size, p = rows["size"].to_numpy(), rows["p"].to_numpy()
        octave = _octave(size)
        result, is_open = p.copy(), np.zeros(len(p), bool)
        for one in np.unique(octave):
            of = np.flatnonzero(octave == one)
            order = of[random.permutation(len(of))]
            result[order], held = exchange(size[order], p[order], random)
            if held is not None:
                is_open[order[held]] = True
        return _with(rows, p=result, open=is_open)

    return settle


def _close(key, rows):
    """The root of a source: the open documents from the longest to the shortest."""
    rows = rows.sort_by([(name, "descending") for name in ["size", *DRAW]])
    missed, base, p = 0.0, rows["base"].to_numpy(), []
    for at, (size, share) in enumerate(zip(rows["size"].to_numpy(), rows["p"].to_numpy())):
        wanted = missed + size * (base[at] + share)
        copies = min(MOST_COPIES, max(0.0, np.floor(wanted / size + 0.5)))
        missed = wanted - copies * size
        p.append(float(copies - base[at]))
    return _with(rows, p=p, open=[False] * len(p))


def _numbered(sized):
    """The rows with copy_no, 0, 1, ... among rows of one id, text and source. Only rows that have
    such copies are numbered, each task's by itself after those of the tasks before it, so a third
    of all rows may be alike."""
    key = ["doc_id", "text_no", "source"]
    copied = sized.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*key)
    copied = written(copied.toDF("_id", "_text", "_from"), "mix-copied")
    same = (
        F.col("doc_id").eqNullSafe(F.col("_id"))
        & F.col("text_no").eqNullSafe(F.col("_text"))
        & F.col("source").eqNullSafe(F.col("_from"))
    )
    side = F.broadcast(copied) if fits_broadcast(copied) else copied
    single = sized.join(side, same, "left_anti").withColumn("copy_no", F.lit(0).cast("long"))
    several = sized.join(side, same, "left_semi").withColumn("_task", F.shiftright("row_no", 33))
    task = [*key, "_task"]
    counts = several.groupBy(*task).agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy(*key).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        *[F.col(name).alias(f"_{name}") for name in key],
        F.col("_task").alias("_at"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_start"),
    )
    place = F.row_number().over(Window.partitionBy(*task).orderBy("row_no")) - 1
    at = F.col("_task") == F.col("_at")
    for name in key:
        at = at & F.col(name).eqNullSafe(F.col(f"_{name}"))
    several = several.withColumn("_place", place).join(starts, at)
    several = several.withColumn("copy_no", (F.col("_start") + F.col("_place")).cast("long"))
    numbered = written(single.unionByName(several.select(*single.columns)), "mix-numbered")
    discard(copied)
    return numbered


def _sized(docs, id_col, text_col, source_col, *more):
    """The rows in the shared folder, each with a number of its own that stays as written."""
    return written(
        docs.select(
            F.monotonically_increasing_id().alias("row_no"),
            F.col(id_col).cast("long").alias("doc_id"),
            F.col(source_col).alias("source"),
            n_words(F.col(text_col)).alias("size"),
            F.xxhash64(F.col(text_col)).alias("text_no"),
            *more,
        ),
        "mix-sizes",
    )


def mix(docs, id_col="doc_id", text_col="text", source_col="source", seed=SEED, block_rows=BLOCK_ROWS):
    """One row per input row: doc_id, size, source_size, target, taken, copies, source, row_no.

    Null text and text without words have size 0 and are taken with 0 words. Null is a source like
    any other, and null an id like any other. Repeated rows are rounded each by itself and dealt
    over blocks like others. Equal input gives equal results, however the table is laid out: rows
    are drawn by id and text, and by their number among equal rows. An empty table gives no rows.
    """
    return _rounded(_sized(docs, id_col, text_col, source_col), seed, block_rows)


def _rounded(sized, seed, block_rows):
    sized = _numbered(sized)
    targets = source_targets(sized)
    counts = sized.groupBy("source").agg(F.count(F.lit(1)).alias("n_rows"))
    counts = counts.withColumnRenamed("source", "of")
    facts = written(
        targets.join(counts, F.col("source").eqNullSafe(F.col("of")))
        .drop("of")
        .withColumn("n_blocks", F.ceil(F.col("n_rows") / block_rows)),
        "mix-targets",
    ).withColumnRenamed("source", "of")
    copies = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    copies = F.least(copies, F.lit(MOST_COPIES))
    open_ = (F.col("p") > 0) & (F.col("size") > 0)
    rows = (
        sized.join(facts, F.col("source").eqNullSafe(F.col("of")))
        .withColumn("base", F.floor(copies).cast("long"))
        .withColumn("p", copies - F.col("base"))
        .withColumn("node", F.pmod(F.xxhash64(*DRAW, F.lit(seed)), F.col("n_blocks")))
    )
    names = ["row_no", *DRAW, "source", "node", "size", "base", "p"]
    result = ["doc_id", "size", "source_size", "target", "source", "copies", "row_no"]
    whole = rows.where(~open_).withColumn("copies", F.col("base")).select(*result)
    level = rows.where(open_).select(*names, open_.alias("open"))
    most_blocks = facts.agg(F.max("n_blocks")).first()[0] or 1
    settled = []
    while True:
        done = written(
            level.groupBy("source", "node").applyInArrow(_settle(seed), OPEN_SCHEMA), "mix-level"
        )
        settled.append(done.where("NOT open"))
        level = done.where("open")
        if most_blocks <= 1:
            break
        most_blocks = ceil(most_blocks / block_rows)
        level = level.withColumn("node", F.floor(F.col("node") / block_rows))
    root = level.groupBy("source").applyInArrow(_close, OPEN_SCHEMA)
    rounded = root
    for part in settled:
        rounded = rounded.unionByName(part)
    rounded = rounded.withColumn("copies", (F.col("base") + F.round("p")).cast("long")).join(
        facts, F.col("source").eqNullSafe(F.col("of"))
    )
    rounded = whole.unionByName(rounded.select(*result))
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return rounded.select("doc_id", "size", "source_size", "target", taken, "copies", "source", "row_no")


def mixed_documents(
    docs, id_col="doc_id", text_col="text", source_col="source", seed=SEED, block_rows=BLOCK_ROWS
):
    """The documents of the mix, each as often as it is taken, with the columns they came with.

    Rows are told apart by their numbers, so repeated rows and null ids are each taken as `mix`
    says. Documents without words come as often as the whole part of their source's share. An empty
    table gives no rows."""
    rows = _sized(docs, id_col, text_col, source_col, as_struct(docs).alias("row"))
    decisions = _rounded(rows.drop("row"), seed, block_rows).where("copies > 0")
    taken = rows.select("row_no", "row").join(decisions.select("row_no", "copies"), "row_no")
    repeated = taken.select("row", F.explode(F.array_repeat(F.lit(True), F.col("copies").cast("int"))))
    return repeated.select("row.*")
