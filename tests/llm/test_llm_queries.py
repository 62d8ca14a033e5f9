"""Registered queries against their SQL, and the pipeline's stages."""

import itertools
import os
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

import __spark_entry__ as entry_module
import corpus_pipeline
from logweir.llm.queries import QUERIES, SQL

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for file in os.listdir(SF):
        con.sql(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{file}'")
    want = con.sql(SQL[name])
    got = QUERIES[name](spark, SF).select(*want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())


def test_registered():
    assert {*QUERIES, "pipeline"} <= set(entry_module.queries())
    assert [name[: name.index("_")] for name in QUERIES] == [f"op{n}" for n in range(1, 14)]


def folded(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", folded(text))
    if not words:
        return 0
    grams = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_survivors(rows):
    """Smallest id of each component of fingerprints that differ in at most four bits."""
    marks = [(i, brute_fingerprint(text)) for i, text in rows]
    root = list(range(len(marks)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in range(len(marks)):
        for b in range(a):
            if (marks[a][1] ^ marks[b][1]).bit_count() <= 4:
                root[top(a)] = top(b)
    least = {}
    for at, (i, _) in enumerate(marks):
        least[top(at)] = min(i, least.get(top(at), i))
    return set(least.values())


def wanted_words(rows):
    """{source: (words to take, longest document)}: 5, 2, 1 by source, 150 % of all, twice at most."""
    sizes, longest = Counter(), Counter()
    for _, text, source in rows:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
        sizes[source] += n
        longest[source] = max(longest[source], n)
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight, full = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}, set()
    while True:
        left = 1.5 * sum(sizes.values()) - sum(2 * sizes[s] for s in full)
        share = sum(weight[s] for s in order if s not in full)
        target = {s: 2.0 * sizes[s] if s in full else left * weight[s] / share for s in order}
        over = {s for s in order if s not in full and target[s] > 2 * sizes[s]}
        if not over:
            return {s: (target[s], longest[s]) for s in order}
        full |= over


def test_pipeline_stages_against_brute_force(spark):
    """Each stage's decisions worked out from its own input, on whole tables."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    scores = {r.doc_id: r.score for r in QUERIES["op8_quality"](spark, SF).collect()}
    results = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = [(r.doc_id, r.text, r.source) for r in docs.select("doc_id", "text", "source").collect()]
        columns = docs.columns
        docs = corpus_pipeline.written(stage(spark, docs, SF), f"test-{name}")
        after = [(r.doc_id, r.text, r.source) for r in docs.select("doc_id", "text", "source").collect()]
        assert docs.columns == columns
        results.append(name)
        if name == "quality":
            assert sorted(i for i, _, _ in after) == sorted(i for i, score in scores.items() if score >= 0.3)
        if name == "exact_dedup":
            last = {}
            for i, text, _ in before:
                last[folded(text)] = max(i, last.get(folded(text), i))
            assert sorted(i for i, _, _ in after) == sorted(last.values())
        if name == "near_dedup":
            assert {i for i, _, _ in after} == brute_survivors([(i, t) for i, t, _ in before])
        if name == "mix_sources":
            copies = Counter(i for i, _, _ in after)
            assert set(after) <= set(before) and max(copies.values()) <= 2
            for source, (target, longest) in wanted_words(before).items():
                taken = sum(len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, s in after if s == source)
                assert abs(taken - target) <= longest
    tokenizer = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.TOKENIZER))
    want = Counter()
    for i, text, _ in after:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        for piece, start in enumerate(range(0, len(ids), 2048)):
            some = ids[start : start + 2048]
            want[i, piece, start, len(some), zlib.crc32(np.array(some, "<u4").tobytes())] += 1
    packed = corpus_pipeline.run(spark, SF).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed) == want
    sequences = defaultdict(list)
    for r in packed:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        ends = [0, *itertools.accumulate(n for _, n in sorted(parts))]
        assert [at for at, _ in sorted(parts)] == ends[:-1] and ends[-1] <= 2048


def test_stages_on_nulls_empty_tables_and_other_columns(spark):
    """Null ids, texts and sources, repeated rows and columns with names that operators use."""
    rows = [(1, None, "en", None, 0, "a"), (None, "", None, "s", 0, "b"), (2, " word " * 30, "en", "s", 5, "c")]
    rows += [(2, " word " * 30, "en", "s", 5, "c")] * 3 + [(None, "WORD word", "en", None, 1, "d")] * 2
    schema = "doc_id long, text string, lang string, source string, n_chars long, row string"
    frame = spark.createDataFrame(rows, schema).selectExpr("*", "1 AS word", "2 AS copies", "3 AS kept", "'x' AS key", "0 AS row_no")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        for docs in (frame, frame.limit(0)):
            got = stage(spark, docs, SF)
            assert got.columns == docs.columns
            n = got.count()
            assert n <= 2 * docs.count()
            if name == "exact_dedup" and docs is frame:
                assert sorted((r.doc_id or 0, r.text or "") for r in got.collect()) == [(0, "WORD word"), (1, ""), (2, " word " * 30)]
            if name == "near_dedup" and docs is frame:
                assert sorted((r.doc_id or 0) for r in got.collect())[-2:] == [1, 2]
    name, packing = corpus_pipeline.STAGES[-1]
    assert packing(spark, frame, SF).where("piece = 0").count() == len(rows)
    assert packing(spark, frame.limit(0), SF).count() == 0


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.written(stage(spark, docs, SF), f"test-{name}")
        assert docs.columns == columns
        counts.append(docs.count())
    assert counts[0] >= counts[1] >= counts[2] >= counts[3] > 0
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert packed.where("piece = 0").count() == counts[4]
