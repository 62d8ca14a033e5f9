"""Work tables that are removed once nothing reads them, and crowds that stay out of joins."""

import os
import random

import pytest
from pyspark.sql import functions as F

from logweir.llm import common, exact_dedup, hard_negatives, language_id, mixing, resampling, simhash


@pytest.fixture
def made(monkeypatch, tmp_path):
    paths = []

    def folder(spark, name):
        paths.append(str(tmp_path / f"{name}-{len(paths)}"))
        return paths[-1]

    monkeypatch.setattr(common, "work_folder", folder)
    return lambda: {os.path.basename(p).rsplit("-", 1)[0] for p in paths if os.path.exists(p)}


def test_operators_leave_only_what_their_result_reads(docs, made):
    n = docs.count()
    assert simhash.simhash_components(docs).count() == n
    assert made() == {"simhash-words", "simhash-rooted"}


def test_other_operators(spark, docs, made):
    n = docs.count()
    assert exact_dedup.exact_duplicates(docs).count() == n
    assert made() == {"dedup-directory", "dedup-index"}
    bench = docs.select("text").limit(3)
    assert resampling.importance_resample(docs, bench).count() == n
    assert "resample-features" not in made()
    language_id.train(docs)
    assert "language-texts" not in made()
    assert mixing.mix(docs).count() == n and "mix-copied" not in made()


def test_hard_negatives_leave_positives_and_hits(spark, made):
    rnd = random.Random(1)
    rows = spark.createDataFrame(
        [(i, [rnd.randint(1, 50) for _ in range(4)], i % 3) for i in range(300)], "vec_id long, terms array<long>, label int"
    )
    assert hard_negatives.mine_negatives(rows, rows.where("vec_id % 100 = 0")).count() > 0
    assert made() <= {"negatives-positives", "negatives-full", "negatives-found"}


def test_scratch_inside_a_scratch(spark, made):
    one = spark.range(3)
    with common.scratch() as outer:
        with common.scratch() as inner:
            a, b = common.written(one, "a"), common.written(one, "b")
            common.kept(inner, a)
            assert made() == {"a", "b"}
        assert made() == {"a"} and a.count() == 3
        common.discard(a)
        c = common.kept(outer, common.written(one, "c"))
    assert made() == {"c"} and c.count() == 3
    with pytest.raises(RuntimeError):
        with common.scratch():
            common.written(one, "d")
            raise RuntimeError
    assert made() == {"c"}


def test_near_copies_of_one_crowd_do_not_meet(spark):
    """A crowd and some other classes: no row reaches the join of crowds."""
    rnd = random.Random(3)
    base = rnd.getrandbits(64)
    words = {base} | {base ^ sum(1 << b for b in rnd.sample(range(64), 2)) for _ in range(2000)}
    words = list(words)
    signed = [(w - 2**64 if w >> 63 else w, base - 2**64 if base >> 63 else base) for w in words]
    others = [(rnd.getrandbits(63), None) for _ in range(200)]
    classes = spark.createDataFrame(signed + others, "word long, crowd long")
    variants = simhash._variants(classes, 4)
    assert variants.where("crowd is not null").count() == 64 * len(words)
    assert simhash.met_crowds(variants).count() == 0
    found = simhash.close_pairs(classes, 4)
    # a class of its own next to the crowd is linked to it
    near = base ^ 0b111
    lone = spark.createDataFrame([(near - 2**64 if near >> 63 else near, None)], "word long, crowd long")
    linked = simhash.close_pairs(classes.unionByName(lone), 4).collect()
    want = sum((w ^ near).bit_count() <= 4 for w in words if w != near)
    assert found.count() == 0 and len(linked) == want > 0


def test_a_large_group_of_near_copies(make):
    rnd = random.Random(4)
    base = [f"w{rnd.randrange(5000)}" for _ in range(400)]
    rows = []
    for i in range(20_000):
        text = list(base)
        text[i % 400] = f"x{i}"
        rows.append((i, " ".join(text[:60] if i % 5 == 0 else text), "a"))
    docs = make(rows).repartition(16)
    found = simhash.simhash_components(docs).groupBy("component_id").agg(F.count(F.lit(1)).alias("n")).collect()
    largest = max(r.n for r in found)
    assert sum(r.n for r in found) == 20_000 and largest > 12_000
