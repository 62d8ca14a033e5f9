"""Hard negatives by exact threshold joins over an inverted index with norm bounds.

For each anchor, the best rows of its own label are its positives, and the rows of other labels that
score up to a positive, and not too far below it, are that positive's hard negatives. Both searches
are joins that find every pair of at least a threshold:

* a candidate block's index leaves out a vector's first dimensions as long as their norm, times the
  longest query, stays below the threshold: they can't lift any pair to it by themselves;
* scores are accumulated dimension by dimension from the last one back, and pairs whose score so
  far, plus the product of the norms of what remains, stays below their threshold are given up;
* pairs that are left get the rest of their score exactly.

The threshold of the positives is the score that an anchor reaches within one block of candidates.
That of the negatives begins near the positive and is lowered, for anchors whose windows are not
full yet, down to the end of the window.
"""

from functools import reduce
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from logweir.llm.common import kept, scratch, written

POSITIVES = 5
NEGATIVES = 5
#: Percent of the positive's score at which the search for its negatives begins and goes on; the
#: last is the end of the window.
STEPS = (95, 88, 80)
#: Rows of a block of anchors and of a block of candidates; bounds what a task holds.
ANCHOR_ROWS = 1024
CANDIDATE_ROWS = 8192
#: Anchors whose scores are accumulated together, and dimensions between two rounds of pruning.
ANCHORS_AT_ONCE = 64
DIMENSIONS_AT_ONCE = 16
#: Bounds are compared with this much to spare, as they are not whole numbers.
SPARE = 1e-9
#: Below this, sums of whole numbers in doubles are exact.
EXACT = 2.0**53

LARGEST = 2**62


def quantised(values, scale=256):
    """floor(scale * x) in double arithmetic as whole numbers, standing at 2^62; null for a null
    vector and for one with a null or non-finite component."""
    usable = values.isNotNull() & ~F.exists(
        values, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == F.lit(float("inf")))
    )
    big = F.lit(float(LARGEST))
    terms = F.transform(
        values,
        lambda x: F.floor(F.greatest(F.least(x.cast("double") * F.lit(float(scale)), big), -big)).cast("long"),
    )
    return F.when(usable, terms)


def _matrix(lists):
    """Rows of terms as one array; shorter rows lack the later terms."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    lengths = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lengths), int(lengths.max(initial=0))), np.int64)
    rows = np.repeat(np.arange(len(lengths)), lengths)
    out[rows, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def _widened(rows, width):
    return np.pad(rows, ((0, 0), (0, width - rows.shape[1])))


class Index:
    """Candidates under their dimensions, without the first dimensions of each that its norm covers.

    Dimensions go from the one with the least energy in the block to the one with the most, so that
    much can be left out. `reach` is the least threshold of a query of length one."""

    def __init__(self, rows, reach):
        energy = (rows.astype(np.float64) ** 2).sum(0)
        self.order = np.argsort(energy, kind="stable")
        self.rows = np.ascontiguousarray(rows[:, self.order], dtype=np.float64)
        self.norms = np.sqrt(np.cumsum(self.rows**2, axis=1))
        covered = self.norms * (1 + SPARE) < reach
        # dimensions before `first` are not in the index of the row
        self.first = covered.sum(1)
        places = np.arange(self.rows.shape[1])
        self.indexed = np.where(places[None, :] >= self.first[:, None], self.rows, 0.0)

    def left_of(self, place):
        """Norm of what is not accumulated yet when all indexed dimensions from `place` on are."""
        until = np.maximum(self.first, place)
        return np.where(until > 0, self.norms[np.arange(len(until)), until - 1], 0.0)


def threshold_join(queries, thresholds, candidates):
    """(query, candidate, score) of all pairs whose inner product is at least the query's threshold.

    Scores are exact whole numbers: where doubles could round, sums are taken over Python's own
    whole numbers without an index, and a score beyond 64 bits stands at the limit."""
    none = (np.zeros(0, np.int64),) * 3
    width = max(queries.shape[1], candidates.shape[1])
    if not len(queries) or not len(candidates):
        return none
    queries, candidates = _widened(queries, width), _widened(candidates, width)
    biggest = float(np.abs(queries.astype(np.float64)).max(initial=0)) * float(np.abs(candidates.astype(np.float64)).max(initial=0))
    if biggest * max(1, width) >= EXACT:
        return _wide_join(queries, thresholds, candidates)
    if width == 0:
        found = np.flatnonzero(thresholds <= 0)
        return np.repeat(found, len(candidates)), np.tile(np.arange(len(candidates)), len(found)), np.zeros(len(found) * len(candidates), np.int64)
    lengths = np.sqrt((queries.astype(np.float64) ** 2).sum(1))
    with np.errstate(over="ignore"):
        reaches = np.where(lengths > 0, thresholds / np.maximum(lengths, 1e-300), np.where(thresholds <= 0, -np.inf, np.inf))
    order = np.argsort(-reaches, kind="stable")
    parts = []
    for start in range(0, len(order), ANCHORS_AT_ONCE):
        some = order[start : start + ANCHORS_AT_ONCE]
        index = Index(candidates, reaches[some].min())
        q, c, score = _accumulate(queries[some].astype(np.float64), thresholds[some], index)
        parts.append((some[q], c, score))
    return tuple(np.concatenate(column) for column in zip(*parts))


def _accumulate(queries, thresholds, index):
    queries = queries[:, index.order]
    q_norms = np.sqrt(np.cumsum(queries**2, axis=1))
    width = queries.shape[1]
    use = np.flatnonzero(index.first < width)
    scores = np.zeros((len(queries), len(use)))
    least = thresholds[:, None]
    place, pairs = width, None
    while place > 0:
        begin = max(0, place - DIMENSIONS_AT_ONCE)
        if pairs is None:
            posted = np.flatnonzero(index.first[use] < place)
            added = queries[:, begin:place] @ index.indexed[use[posted], begin:place].T
            if len(posted) == len(use):
                scores += added
            else:
                scores[:, posted] += added
        else:
            q, c = pairs
            scores += (queries[q, begin:place] * index.indexed[use[c], begin:place]).sum(1)
        place = begin
        remaining = index.left_of(place)[use]
        q_left = q_norms[:, place - 1] if place else np.zeros(len(queries))
        # a row's dimensions before its first may go on beyond `place`; the query's norm over them
        # is at most its whole norm
        q_left = np.where(index.first[use][None, :] > place, q_norms[:, np.maximum(index.first[use], 1) - 1], q_left[:, None])
        if pairs is None:
            alive = scores + q_left * remaining[None, :] * (1 + SPARE) + SPARE >= least
            if place == 0 or alive.mean() < 0.1:
                pairs = np.nonzero(alive)
                scores = scores[pairs]
        else:
            q, c = pairs
            alive = scores + q_left[q, c] * remaining[c] * (1 + SPARE) + SPARE >= thresholds[q]
            pairs, scores = (q[alive], c[alive]), scores[alive]
    q, c = pairs if pairs is not None else np.nonzero(scores >= least)
    # what the index left out
    before = np.arange(width)[None, :] < index.first[use[c]][:, None]
    for start in range(0, len(q), 1 << 16):
        part = slice(start, start + (1 << 16))
        rest = np.where(before[part], index.rows[use[c[part]]], 0.0)
        scores[part] += (queries[q[part]] * rest).sum(1)
    enough = scores >= thresholds[q]
    return q[enough], use[c[enough]], scores[enough].astype(np.int64)


def _wide_join(queries, thresholds, candidates):
    parts = []
    held = candidates.astype(object)
    for at, query in enumerate(queries.astype(object)):
        scores = np.clip(held @ query, -(2**63), 2**63 - 1).astype(np.int64) if held.shape[1] else np.zeros(len(held), np.int64)
        found = np.flatnonzero([score >= thresholds[at] for score in scores.tolist()])
        parts.append((np.full(len(found), at), found, scores[found]))
    return tuple(np.concatenate(column) for column in zip(*parts))


def _first(scores, ids, n):
    """Places of the n first: score down, id up, null ids (the largest stand-in) last."""
    if len(scores) > 4 * n:
        least = np.partition(scores, len(scores) - n)[len(scores) - n]
        some = np.flatnonzero(scores >= least)
    else:
        some = np.arange(len(scores))
    # whole numbers, so no negative of the least one
    order = sorted(some.tolist(), key=lambda at: (-int(scores[at]), int(ids[at])))
    return np.array(order[:n], np.int64)


NO_ID = np.iinfo(np.int64).max
HIT_SCHEMA = "anchor_id long, anchor_no long, edge long, vec_id long, score long"


def _hits(rows):
    columns = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in (zip(*rows) if rows else [[]] * 5)]
    ids = pa.array(columns[3].astype(np.int64), pa.int64(), mask=columns[3] == NO_ID)
    arrays = [pa.array(c.astype(np.int64)) for c in columns]
    arrays[3] = ids
    return pa.table(arrays, names=["anchor_id", "anchor_no", "edge", "vec_id", "score"])


def _codes(*columns):
    """Labels as whole numbers, equal for equal labels."""
    number = {}
    return [np.array([number.setdefault(x, len(number)) for x in c.to_pylist()], np.int64) for c in columns]


def _cell_positives(n):
    def cell(anchors, rows):
        out = []
        if anchors.num_rows and rows.num_rows:
            a_label, r_label = _codes(anchors["label"], rows["label"])
            a, r = _matrix(anchors["terms"]), _matrix(rows["terms"])
            a_ids, numbers = anchors["vec_id"].to_numpy(), anchors["anchor_no"].to_numpy()
            r_ids = rows["vec_id"].fill_null(NO_ID).to_numpy()
            least = anchors["least"].to_numpy()
            for label in np.unique(a_label):
                mine, theirs = np.flatnonzero(a_label == label), np.flatnonzero(r_label == label)
                q, c, score = threshold_join(a[mine], least[mine], r[theirs])
                q, c = mine[q], theirs[c]
                other = r_ids[c] != a_ids[q]
                q, c, score = q[other], c[other], score[other]
                for at in np.unique(q):
                    own = np.flatnonzero(q == at)
                    best = own[_first(score[own], r_ids[c[own]], n)]
                    k = len(best)
                    out.append((np.full(k, a_ids[at]), np.full(k, numbers[at]), np.zeros(k, np.int64), r_ids[c[best]], score[best]))
        return _hits(out)

    return cell


def _cell_negatives(n):
    def cell(anchors, rows):
        out = []
        if anchors.num_rows and rows.num_rows:
            a_label, r_label = _codes(anchors["label"], rows["label"])
            a, r = _matrix(anchors["terms"]), _matrix(rows["terms"])
            a_ids, numbers = anchors["vec_id"].to_numpy(), anchors["anchor_no"].to_numpy()
            r_ids = rows["vec_id"].fill_null(NO_ID).to_numpy()
            windows = anchors["windows"].to_pylist()
            least = np.array([min(w["least"] for w in some) for some in windows], np.int64)
            q, c, score = threshold_join(a, least, r)
            other = a_label[q] != r_label[c]
            q, c, score = q[other], c[other], score[other]
            for at in np.unique(q):
                own = np.flatnonzero(q == at)
                for window in windows[at]:
                    inside = own[(score[own] <= window["edge"]) & (score[own] >= window["least"])]
                    best = inside[_first(score[inside], r_ids[c[inside]], n)]
                    k = len(best)
                    out.append((np.full(k, a_ids[at]), np.full(k, numbers[at]), np.full(k, window["edge"]), r_ids[c[best]], score[best]))
        return _hits(out)

    return cell


def _grid(anchors, rows, n_anchors, n_blocks, cell, anchor_rows, blocks=None):
    """The cell's hits for every block of anchors against every block of rows (or the first few)."""
    a_blocks, few = max(1, ceil(n_anchors / anchor_rows)), blocks or n_blocks

    def each(n):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = anchors.withColumn("q", F.pmod(F.xxhash64("vec_id", "anchor_no"), F.lit(a_blocks)).cast("int"))
    left = left.withColumn("c", each(few))
    right = rows.where(F.col("c") < few).withColumn("q", each(a_blocks))
    return left.groupBy("q", "c").cogroup(right.groupBy("q", "c")).applyInArrow(cell, HIT_SCHEMA)


def _ranked(hits, n, edge=()):
    order = Window.partitionBy("anchor_id", "anchor_no", *edge).orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def usable_rows(vectors, id_col="vec_id", vector_col="embedding", label_col="label"):
    """vec_id, label, terms of the rows that take part."""
    rows = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), quantised(F.col(vector_col)).alias("terms")
    )
    return rows.where(F.col("label").isNotNull() & F.col("terms").isNotNull())


def mine_negatives(
    rows, anchors, n_positives=POSITIVES, n_negatives=NEGATIVES, steps=STEPS,
    anchor_rows=ANCHOR_ROWS, candidate_rows=CANDIDATE_ROWS,
):
    """anchor_id, positive_id, rank from 1, negative_id, positive_score, negative_score.

    `rows` and `anchors` have vec_id, label and terms, as `usable_rows` makes them. A positive is one
    of the first `n_positives` rows of the anchor's label with another id; its negatives are the
    first `n_negatives` rows of other labels with steps[-1] percent of its score at least and its
    score at most, so a positive below 0 has none. First is the higher score, then the smaller id, a
    null id last; a score beyond 64 bits stands at the limit. Repeated rows are candidates each by
    itself; an anchor that is repeated in every column is asked once, and one id with other terms or
    labels for each. Without rows or anchors there are no rows.
    """
    with scratch() as tables:
        positives, found = _searched(rows, anchors, n_positives, n_negatives, steps, anchor_rows, candidate_rows)
        kept(tables, positives)
        for some in found:
            kept(tables, some)
    hits = reduce(lambda a, b: a.unionByName(b), found)
    key = ["anchor_id", "anchor_no", "edge"]
    positives = positives.select(*key[:2], F.col("vec_id").alias("positive_id"), F.col("score").alias("edge"))
    return positives.join(hits, key).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
        F.col("edge").alias("positive_score"), F.col("score").alias("negative_score"),
    )


def _searched(rows, anchors, n_positives, n_negatives, steps, anchor_rows, candidate_rows):
    """The positives, and tables of the hits of each full window by step, as work tables."""
    anchors = anchors.where(F.col("vec_id").isNotNull()).dropDuplicates(["vec_id", "label", "terms"])
    anchors = written(anchors.withColumn("anchor_no", F.xxhash64("label", "terms")), "negatives-anchors")
    # dealt by content and by number, so equal rows are spread as well
    place = F.xxhash64("vec_id", "terms", F.monotonically_increasing_id())
    rows = written(rows.select("vec_id", "label", "terms", place.alias("place")), "negatives-rows")
    n_anchors, n_blocks = anchors.count(), max(1, ceil(rows.count() / candidate_rows))
    rows = rows.select("vec_id", "label", "terms", F.pmod("place", F.lit(n_blocks)).cast("int").alias("c"))
    key = ["anchor_id", "anchor_no"]
    named = anchors.withColumnRenamed("vec_id", "anchor_id")

    def search(asked, cell, blocks=None):
        return _grid(asked.withColumnRenamed("anchor_id", "vec_id"), rows, n_anchors, n_blocks, cell, anchor_rows, blocks)

    # what an anchor reaches within the first block is a threshold that its positives can't miss
    anything = -(2**63)
    known = _ranked(search(named.withColumn("least", F.lit(anything)), _cell_positives(n_positives), 1), n_positives)
    reached = known.where(F.col("rank") == n_positives).select(*key, F.col("score").alias("least"))
    asked = named.join(reached, key, "left").withColumn("least", F.coalesce("least", F.lit(anything)))
    positives = written(_ranked(search(asked, _cell_positives(n_positives)), n_positives), "negatives-positives")
    edges = positives.select(*key, F.col("score").alias("edge"))

    # one window for each score that a positive has; whole percents of whole numbers, rounded up
    def percent(of, share):
        return F.ceil(of * F.lit(share).cast("decimal(20,0)") / F.lit(100).cast("decimal(20,0)")).cast("long")

    windows = edges.where("edge >= 0").distinct()
    found = []
    for at, step in enumerate(steps):
        open_ = windows.withColumn("least", percent(F.col("edge").cast("decimal(20,0)"), step))
        open_ = open_.groupBy(*key).agg(F.collect_list(F.struct("edge", "least")).alias("windows"))
        hits = _ranked(search(named.join(open_, key), _cell_negatives(n_negatives)), n_negatives, ["edge"])
        hits = written(hits, "negatives-found")
        if at == len(steps) - 1:
            found.append(hits)
            break
        full = hits.where(F.col("rank") == n_negatives).select(*key, "edge")
        found.append(written(hits.join(full, [*key, "edge"], "left_semi"), "negatives-full"))
        windows = written(windows.join(full, [*key, "edge"], "left_anti"), "negatives-open")
        if windows.isEmpty():
            break
    return positives, found
