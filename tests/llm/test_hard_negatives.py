import random
from collections import Counter

import numpy as np
import pytest

from logweir.llm import hard_negatives as hard

SCHEMA = "vec_id long, embedding array<double>, label int, score long, terms string, rank int"


def brute(rows, n=5, low=80):
    """Rows are (id, whole numbers, label); anchors those of ids divisible by 100."""

    def score(a, b):
        return max(-(2**63), min(2**63 - 1, sum(x * y for x, y in zip(a, b))))

    def order(pair):
        return -pair[1], pair[0] is None, pair[0] or 0

    out = Counter()
    anchors = {(i, label, tuple(t)) for i, t, label in rows if i is not None and i % 100 == 0}
    for anchor_id, own, terms in anchors:
        scored = [(i, score(terms, t), label == own) for i, t, label in rows if i != anchor_id]
        positives = sorted([(i, s) for i, s, same in scored if same], key=order)[:n]
        for positive, ps in positives:
            window = [(i, s) for i, s, same in scored if not same and low * ps <= 100 * s <= 100 * ps]
            for rank, (negative, ns) in enumerate(sorted(window, key=order)[:n], 1):
                out[anchor_id, positive, rank, negative, ps, ns] += 1
    return out


def make(spark, rows, scale=1 / 256):
    full = [(i, None if t is None else [None if x is None else x * scale for x in t], label, 1, "t", 2) for i, t, label in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


def mined(frame, **settings):
    rows = hard.usable_rows(frame)
    found = hard.mine_negatives(rows, rows.where("vec_id % 100 = 0"), **settings)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return Counter(map(tuple, found.collect()))


@pytest.mark.parametrize("kind", ["dense", "sparse", "uneven", "huge", "zero", "negative"])
def test_threshold_join_finds_every_pair(kind):
    rng = np.random.default_rng(1)
    q, c = rng.integers(-50, 51, (70, 40)), rng.integers(-50, 51, (300, 40))
    if kind == "sparse":
        q, c = q * (rng.random(q.shape) < 0.1), c * (rng.random(c.shape) < 0.1)
    if kind == "uneven":
        q, c = q * np.arange(40) ** 2, c[:, :33] * np.arange(33) ** 2
    if kind == "huge":
        q, c = q[:5] * 2**56, c[:40] * 2**56
    if kind == "zero":
        q, c = q * 0, c[:, :0]
    width = max(q.shape[1], c.shape[1])
    whole = np.pad(q, ((0, 0), (0, width - q.shape[1]))).astype(object) @ np.pad(c, ((0, 0), (0, width - c.shape[1]))).astype(object).T
    whole = np.clip(whole, -(2**63), 2**63 - 1).astype(np.int64)
    for share in (0.999, 0.97, 0.5, 0.0):
        thresholds = np.array([np.sort(row)[int(share * (len(row) - 1))] for row in whole])
        if kind == "negative":
            thresholds = -np.abs(thresholds)
        thresholds[0], thresholds[1] = -(2**63), 2**62
        got = list(zip(*(x.tolist() for x in hard.threshold_join(q, thresholds, c))))
        want = [(i, j, int(whole[i, j])) for i in range(len(q)) for j in range(len(c)) if whole[i, j] >= thresholds[i]]
        assert sorted(got) == want


def test_index_leaves_out_what_norms_cover():
    rng = np.random.default_rng(2)
    rows = rng.integers(-50, 51, (200, 64)) * (1 + np.arange(64)) // 16
    index = hard.Index(rows, 400.0)
    left_out = np.array([np.sqrt((index.rows[i, : index.first[i]] ** 2).sum()) for i in range(200)])
    assert (left_out < 400).all() and index.first.mean() > 10
    assert not index.indexed[np.arange(64)[None, :] < index.first[:, None]].any()


def test_mine_equals_brute_force(spark):
    rnd = random.Random(4)
    rows = [(i, [rnd.randint(-60, 90) for _ in range(12)], rnd.randint(0, 3)) for i in range(1, 900)]
    rows += [(i, list(rows[5][1]), 2) for i in range(1000, 1040)]  # ties
    rows += [(7, list(rows[6][1]), rows[6][2])] * 3 + [(None, [50] * 12, 1)] * 7 + [(100, [80] * 12, 1)]
    rows += [(1100, [1, 2], 0), (1200, [], 3), (1300, [-5] * 12, 0), (1400, [9] * 12, 77), (1500, [0] * 12, 1)]
    whole = brute(rows)
    assert len({r[0] for r in whole}) > 8
    bad = [(200_000, None, 1), (200_100, [1, None], 1), (200_200, [1.0], None), (200_300, [float("nan"), 1], 1), (200_400, [float("inf")], 2)]
    frame = make(spark, rows + bad)
    assert mined(frame) == whole
    assert mined(frame, anchor_rows=3, candidate_rows=100) == whole
    assert mined(frame, steps=(80,)) == whole
    assert mined(frame.where("label = 1")) == Counter()
    assert mined(frame.limit(0)) == Counter()


def test_scores_beyond_doubles(spark):
    rows = [(100 * i, [2**40 + i, 3, 2**39 - i], i % 2) for i in range(8)] + [(3, [2**61] * 3, 0), (5, [2**61] * 3, 1)]
    rows = [(i, [x // 2**9 * 2**9 for x in t], label) for i, t, label in rows]
    assert mined(make(spark, rows)) == brute(rows)


def test_a_hot_vector_is_spread(spark):
    rnd = random.Random(5)
    rows = [(i, [rnd.randint(0, 60) for _ in range(6)], i % 5) for i in range(1, 400)] + [(None, [30] * 6, 0)] * 200
    rows += [(100, [40] * 6, 0)]
    assert mined(make(spark, rows), candidate_rows=64) == brute(rows)
