"""Completeness of one layer against another."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from logweir.operators import reconcile, validate_layers
from logweir.operators.reconcile import day_checksums, differing_days

SCHEMA = "d string, c string, other int"


def frame(spark, rows):
    return spark.createDataFrame([(d, c, 0) for d, c in rows], SCHEMA).repartition(3)


def compared(spark, upper, lower):
    found = reconcile(frame(spark, upper), frame(spark, lower), F.col("d"), F.col("c")).collect()
    return {(r.day, r.content): (r.n_upper, r.n_lower) for r in found}


def brute(upper, lower):
    a, b = Counter(upper), Counter(lower)
    return {key: (a[key], b[key]) for key in {*a, *b} if a[key] != b[key]}


ROWS = [(f"2024-01-{1 + i % 9:02d}", f"c{i}") for i in range(300)]


def test_one_row_lost_and_another_repeated_which_counts_cannot_see(spark):
    lower = [*ROWS[1:], ROWS[9]]
    assert ROWS[0][0] == ROWS[9][0] and len(lower) == len(ROWS)
    layers = {"upper": frame(spark, ROWS), "lower": frame(spark, lower)}
    checks = validate_layers(layers, follows={"lower": "upper"}).collect()
    assert [r.row_delta for r in checks if r.layer == "lower"] == [0]
    assert compared(spark, ROWS, lower) == {ROWS[0]: (1, 0), ROWS[9]: (1, 2)}
    day, content = F.col("d"), F.col("c")
    days = differing_days(day_checksums(layers["upper"], day, content), day_checksums(layers["lower"], day, content)).collect()
    assert [tuple(r) for r in days] == [(ROWS[0][0], 34, 34)]


@pytest.mark.parametrize("seed", range(4))
def test_equals_brute_force(spark, seed):
    rnd = random.Random(seed)
    pool = [*ROWS[:60], (None, "x"), (None, None), ("2024-01-01", None), ("", "y"), ("2024-01-02", "")]
    upper = [rnd.choice(pool) for _ in range(200)]
    lower = list(upper)
    for _ in range(seed * 3):
        lower.remove(rnd.choice(lower))
        lower.append(rnd.choice(pool))
    assert compared(spark, upper, lower) == brute(upper, lower)


def test_equal_and_empty_layers(spark):
    assert compared(spark, ROWS, ROWS[::-1]) == {}
    assert compared(spark, [], []) == {}
    assert compared(spark, ROWS[:2], []) == brute(ROWS[:2], [])
    hot = [("2024-01-01", "same")] * 5000
    assert compared(spark, hot, hot[1:]) == {hot[0]: (5000, 4999)}


def test_only_differing_days_are_compared_by_content(spark):
    upper, lower = frame(spark, ROWS), frame(spark, ROWS[1:])
    found = reconcile(upper, lower, F.col("d"), F.col("c"))
    assert [tuple(r) for r in found.collect()] == [(*ROWS[0], 1, 0)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftSemi") == 2 and "Cartesian" not in plan
