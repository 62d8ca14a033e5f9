import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from logweir.llm import resampling
from logweir.llm.queries import QUERIES


def words_of(text):
    folded = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", folded)


def features(text):
    words = words_of(text)
    return words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def buckets_of(text):
    return [zlib.crc32(f.encode()) % 10_000 for f in features(text)]


def brute(docs, target):
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(buckets_of(text))
    for text in target:
        t.update(buckets_of(text))
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = [
        math.floor(1000 * math.log(((t[b] + 1.0) * (big_s + 10_000.0)) / ((s[b] + 1.0) * (big_t + 10_000.0))))
        for b in range(10_000)
    ]
    rows, able = [], []
    for doc_id, text in docs:
        found = buckets_of(text)
        weight = sum(gain[b] for b in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, len(found), weight, score, None])
        if len(words_of(text)) >= 20:
            able.append(rows[-1])
    able.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for rank, row in enumerate(able[: 25 * len(able) // 100], 1):
        row[4] = rank
    return Counter(map(tuple, rows))


def got(rows):
    return Counter((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in rows)


def test_moved_crc_composes():
    rnd = random.Random(1)
    firsts = [rnd.randbytes(rnd.randint(0, 50)) for _ in range(200)]
    seconds = [rnd.randbytes(rnd.choice([0, 1, 2, 7, 64, 300, 70_001])) for _ in range(200)]
    crcs = np.array([zlib.crc32(a) for a in firsts], np.uint32)
    lengths = np.array([len(b) for b in seconds])
    whole = resampling.moved_over(crcs, lengths) ^ np.array([zlib.crc32(b) for b in seconds], np.uint32)
    assert whole.tolist() == [zlib.crc32(a + b) for a, b in zip(firsts, seconds)]


@pytest.mark.parametrize("at_once, long_word", [(1 << 22, 1 << 12), (40, 5), (1, 1)])
def test_scan_finds_every_word_and_pair(monkeypatch, at_once, long_word):
    monkeypatch.setattr(resampling, "SCAN_BYTES", at_once)
    monkeypatch.setattr(resampling, "_LONG_WORDS", resampling.regex.compile(rb"[^ ]{%d,}" % (long_word + 1)))
    rnd = random.Random(2)
    parts = ["a", "B", "T", "L0", "T T", "é", "日本", " ", "  ", ".", "\n", "ab" * 9, "x1", "\x00", "ÀB"]
    texts = [None, "", " ", "one", "T", "L0 T1"]
    texts += ["".join(rnd.choice(parts) + rnd.choice(["", " "]) for _ in range(rnd.randint(0, 60))) for _ in range(60)]
    found = [Counter() for _ in texts]
    for group in resampling._groups(texts):
        of_words, words, of_pairs, pairs = resampling.scan(group)
        for of, bucket in [*zip(of_words, words), *zip(of_pairs, pairs)]:
            found[of][int(bucket)] += 1
    assert found == [Counter(buckets_of(text)) for text in texts]


def test_resample_equals_brute_force(spark):
    rnd = random.Random(3)
    vocabulary = ["w%d" % i for i in range(200)] + ["Élan", "don't", "日本語"]
    docs = [(1, None), (2, ""), (3, "... \n"), (None, None), (2**63 - 1, "One two"), (-(2**63), "two one")]
    docs += [(i, " ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(1, 80)))) for i in range(10, 150)]
    docs += [(7, "same words " * 12)] * 5 + [(None, "same words " * 12)] * 60
    docs += [(200, " ".join(rnd.choice(vocabulary) for _ in range(50_000))), (201, "x" * 300_000 + " y" * 30)]
    target = [" ".join(rnd.choice(vocabulary[:40]) for _ in range(30)) for _ in range(20)] + [None, ""]
    frame = spark.createDataFrame([(i, t, 1, 2) for i, t in docs], "doc_id long, text string, score int, bucket int")
    bench = spark.createDataFrame([(t,) for t in target], "text string")
    want = brute(docs, target)
    assert got(resampling.importance_resample(frame.repartition(5), bench).collect()) == want
    resampling_rows = resampling.ROWS_AT_ONCE
    try:
        resampling.ROWS_AT_ONCE = 7
        assert got(resampling.importance_resample(frame.repartition(3), bench).collect()) == want
    finally:
        resampling.ROWS_AT_ONCE = resampling_rows
    assert resampling.importance_resample(frame.limit(0), bench).collect() == []
    none = resampling.importance_resample(frame, bench.limit(0)).collect()
    assert got(none) == brute(docs, [])


def test_registered_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    target = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("text").collect()]
    assert got(QUERIES["op13_resample"](spark, sf).collect()) == brute(docs, target)
