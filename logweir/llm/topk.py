"""Exact top-k inner products, term at a time.

A vector is a sparse row of weighted terms: its components that are not zero. Queries and
candidates are dealt over a grid of blocks, so a task holds one block of each whatever the table's
size. There, each candidate block is turned into postings (term -> candidates and weights), every
term of a query adds its weighted posting into the query's dense score array, and the best k are
selected. The grid's partial lists are merged per query.
"""

from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

QUERY_ROWS = 1024
CANDIDATE_ROWS = 2048
#: Queries that share a pass over the postings; their score arrays stay in the processor's cache.
SCORED_AT_ONCE = 32
HIT_SCHEMA = "query_id long, query_no long, vec_id long, score long"


def quantised(vectors, id_col="vec_id", vector_col="embedding", scale=256):
    """vec_id, terms: floor(scale * x) in double arithmetic. Vectors that are null or hold a null
    or non-finite component are left out; an empty vector stays, with score 0 to everything."""
    big = F.lit(float(2**62))
    values = F.col(vector_col)
    usable = values.isNotNull() & ~F.exists(
        values, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == F.lit(float("inf")))
    )
    terms = F.transform(
        values,
        lambda x: F.floor(F.greatest(F.least(x.cast("double") * F.lit(float(scale)), big), -big)).cast("long"),
    )
    return vectors.where(usable).select(F.col(id_col).cast("long").alias("vec_id"), terms.alias("terms"))


def _matrix(column, width):
    """Rows of terms as one array; shorter rows lack the later terms."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lengths), width), np.int64)
    rows = np.repeat(np.arange(len(lengths)), lengths)
    starts = np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[rows, np.arange(len(flat)) - starts] = flat
    return out


def _width(column):
    return max([0, *np.diff(column.combine_chunks().offsets.to_numpy()).tolist()]) if len(column) else 0


def accumulate(queries, candidates):
    """Scores of every query against every candidate, in the narrowest integers that hold them."""
    most = float(np.abs(queries).max(initial=0)) * float(np.abs(candidates).max(initial=0))
    bound = most * max(1, queries.shape[1])
    kind = np.int32 if bound < 2**31 else np.int64 if bound < 2**62 else object
    scores = np.zeros((len(queries), len(candidates)), kind)
    for term in range(queries.shape[1]):
        column = candidates[:, term]
        asking = np.flatnonzero(queries[:, term])
        posting = np.flatnonzero(column)
        if not len(asking) or not len(posting):
            continue
        weights = queries[asking, term].astype(kind)
        if 2 * len(posting) >= len(column):  # nearly every candidate has the term
            added = np.multiply.outer(weights, column.astype(kind))
            if len(asking) == len(queries):
                scores += added
            else:
                scores[asking] += added
        else:
            scores[np.ix_(asking, posting)] += np.multiply.outer(weights, column[posting].astype(kind))
    if kind is object:
        scores = np.clip(scores, -(2**63), 2**63 - 1).astype(np.int64)
    return scores


def _best(scores, ids, own, k):
    """Places of the k best: score down, id up, null ids (the largest stand-in) last."""
    usable = np.flatnonzero(~own)
    if len(usable) > k:
        part = scores[usable]
        least = np.partition(part, len(part) - k)[len(part) - k]
        usable = usable[part >= least]
    order = np.lexsort((ids[usable], -scores[usable].astype(np.float64)))
    if len(order) and np.abs(scores[usable]).max() >= 2**53:
        order = np.array(sorted(range(len(usable)), key=lambda i: (-int(scores[usable[i]]), int(ids[usable[i]]))))
    return usable[order[:k]]


def _grid_cell(k):
    none = np.iinfo(np.int64).max

    def cell(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        found = [np.zeros(0, np.int64)] * 4
        if queries.num_rows and candidates.num_rows:
            width = max(_width(queries["terms"]), _width(candidates["terms"]))
            q, c = _matrix(queries["terms"], width), _matrix(candidates["terms"], width)
            q_ids, q_no = queries["vec_id"].to_numpy(), queries["query_no"].to_numpy()
            c_ids = candidates["vec_id"].fill_null(none).to_numpy()
            parts = []
            for start in range(0, len(q), SCORED_AT_ONCE):
                scores = accumulate(q[start : start + SCORED_AT_ONCE], c)
                for at, row in enumerate(scores, start):
                    best = _best(row, c_ids, c_ids == q_ids[at], k)
                    parts.append(
                        (np.full(len(best), q_ids[at]), np.full(len(best), q_no[at]), c_ids[best], row[best].astype(np.int64))
                    )
            found = [np.concatenate(column) for column in zip(*parts)]
        ids = pa.array(found[2], pa.int64(), mask=found[2] == none)
        columns = [pa.array(found[0], pa.int64()), pa.array(found[1], pa.int64()), ids, pa.array(found[3], pa.int64())]
        return pa.table(columns, names=["query_id", "query_no", "vec_id", "score"])

    return cell


def top_k(vectors, queries, k, query_rows=QUERY_ROWS, candidate_rows=CANDIDATE_ROWS):
    """query_id, rank from 1, vec_id, score: each query's k candidates of highest inner product.

    Both sides have vec_id and terms, as `quantised` makes them. A query's own row is any with its
    id. Ties go to the smaller id, a null id coming last; a score beyond 64 bits stands at the
    limit. A query repeated with the same terms is answered once; one id with different terms is
    answered for each. Repeated candidates are each listed. Fewer candidates than k are all
    listed; an empty table gives no rows.
    """
    queries = queries.where(F.col("vec_id").isNotNull()).dropDuplicates(["vec_id", "terms"])
    queries = queries.select("vec_id", "terms", F.xxhash64("terms").alias("query_no"))
    n_queries, n_candidates = queries.count(), vectors.count()
    q_blocks = max(1, ceil(n_queries / query_rows))
    c_blocks = max(1, ceil(n_candidates / candidate_rows))

    def blocks(n):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = queries.withColumn("q", F.pmod(F.xxhash64("vec_id", "query_no"), F.lit(q_blocks)).cast("int"))
    left = left.withColumn("c", blocks(c_blocks))
    right = vectors.withColumn(
        "c", F.pmod(F.xxhash64("vec_id", "terms"), F.lit(c_blocks)).cast("int")
    ).withColumn("q", blocks(q_blocks))
    hits = (
        left.groupBy("q", "c").cogroup(right.groupBy("q", "c")).applyInArrow(_grid_cell(k), HIT_SCHEMA)
    )
    order = Window.partitionBy("query_id", "query_no").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    ranked = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
