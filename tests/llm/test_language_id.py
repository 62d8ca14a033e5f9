import math
import random
import zlib

import numpy as np
import pytest

from logweir.llm import language_id as ids
from logweir.llm.queries import QUERIES

SAMPLES = {
    "en": "the quick brown fox jumps over the lazy dog while every child watches from the window of the house",
    "de": "der schnelle braune fuchs springt über den faulen hund während jedes kind aus dem fenster zuschaut",
    "fr": "le rapide renard brun saute par dessus le chien paresseux pendant que chaque enfant regarde à la fenêtre",
    "ru": "быстрая коричневая лиса прыгает через ленивую собаку пока каждый ребенок смотрит из окна дома",
    "zh": "敏捷 的 棕色 狐狸 跳过 懒惰 的 狗 每个 孩子 都 从 房子 的 窗户 往外 看",
}


def sentence(rnd, lang, n=12):
    return " ".join(rnd.choice(SAMPLES[lang].split()) for _ in range(n))


def loop_encode(text):
    data = text.lower().encode()
    data = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in data)
    data = b" " + b" ".join(data.split()) + b" "
    counts = [0] * ids.FEATURES
    for n in ids.GRAMS:
        for at in range(len(data) - n + 1):
            h = int.from_bytes(data[at : at + n], "big") ^ (n * 0x9E3779B9 & 0xFFFFFFFF)
            h = h * 0x85EBCA6B % 2**32
            h = (h ^ h >> 15) * 0xC2B2AE35 % 2**32
            counts[h >> 20] += 1
    return [math.sqrt(c / sum(counts)) for c in counts]


@pytest.mark.parametrize("at_once", [1 << 20, 7, 1])
def test_encode_counts_every_gram(monkeypatch, at_once):
    monkeypatch.setattr(ids, "BYTES_AT_ONCE", at_once)
    for text in ["", "a", "ab", "Hello, World 42 times!", "日本 Élan\n\tx", SAMPLES["ru"]]:
        assert np.allclose(ids.encode(text), loop_encode(text), atol=1e-6)


@pytest.mark.parametrize("n", [0, 1, 2, 4, 6, 7, 40])
def test_codewords_are_apart(n):
    code = ids.codebook(n) if n else np.zeros((0, 0))
    apart = [(code[i] != code[j]).sum() for i in range(n) for j in range(i)]
    assert code.shape[0] == n and set(code.ravel().tolist()) <= {-1, 1}
    if 2 < n <= 6:
        assert min(apart) == 2 ** (n - 2)
    elif n > 6:
        assert min(apart) >= code.shape[1] / 5
    if n > 1:
        assert all(len(set(column)) == 2 for column in code.T.tolist())


def test_gradient_against_differences():
    rng = np.random.default_rng(3)
    rows, bits = rng.normal(0, 1, (9, 5)), rng.choice([-1, 1], (9, 2))
    weights, bias = rng.normal(0, 1, (5, 2)), rng.normal(0, 1, 2)

    def loss():
        total = 0.0
        for b in range(2):
            for row, bit in zip(rows, bits[:, b]):
                total += math.log1p(math.exp(-bit * (sum(x * w for x, w in zip(row, weights[:, b])) + bias[b]))) / 9
        return total + 0.05 * float((weights**2).sum())

    by_weight, by_bias = ids.gradient(rows, bits, weights, bias, shrink=0.1)
    for values, grad in ((weights, by_weight), (bias, by_bias)):
        for place in np.ndindex(values.shape):
            kept, found = values[place], []
            for step in (1e-5, -1e-5):
                values[place] = kept + step
                found.append(loss())
            values[place] = kept
            assert grad[place] == pytest.approx((found[0] - found[1]) / 2e-5, abs=1e-6)


def test_decoding_weighs_losses_and_survives_a_wrong_bit():
    code = ids.codebook(5)
    n_bits = code.shape[1]
    trust = np.linspace(0.5, 1.5, n_bits)
    model = ids.Model(list("abcde"), code, None, None, trust)
    rng = np.random.default_rng(4)
    margins = rng.normal(0, 2, (30, n_bits))
    for row, shares in zip(margins, model.decode(margins)):
        losses = [sum(t * math.log1p(math.exp(-c * m)) for t, c, m in zip(trust, word, row)) for word in code]
        whole = sum(math.exp(-x) for x in losses)
        assert np.allclose(shares, [math.exp(-x) / whole for x in losses])
    for language in range(5):
        for wrong in range(n_bits):
            heard = 3.0 * code[language]
            heard[wrong] *= -1
            assert model.decode(heard[None, :].astype(float))[0].argmax() == language


def test_identify(spark):
    rnd = random.Random(5)
    rows = [(1, None, "en"), (2, "", "de"), (3, " 12 .\n½", None), (4, "123", "fr"), (None, sentence(rnd, "en"), "en")]
    truth = {}
    for i in range(10, 500):
        lang = list(SAMPLES)[i % 5]
        truth[i] = lang
        rows.append((i, sentence(rnd, lang, rnd.randint(6, 40)), lang if i % 7 else None))
    rows += [(600, sentence(rnd, "de", 40_000), None), (601, sentence(rnd, "en", 8) + " " + sentence(rnd, "de", 8), None)]
    rows += [(602, "same text of the house", "en")] * 4
    frame = spark.createDataFrame([(*r, 1.0, "q") for r in rows], "doc_id long, text string, lang string, score double, held_out string")
    found = ids.identify_languages(frame.repartition(4))
    assert found.columns == ["doc_id", "held_out", "lang_pred", "score", "ambiguous", "runner_up"]
    found = found.collect()
    assert len(found) == len(rows)
    by_id = {r.doc_id: r for r in found}
    assert all(by_id[i].lang_pred == "und" and by_id[i].score == 0 for i in (1, 2, 3, 4))
    assert by_id[600].lang_pred == "de" and by_id[601].lang_pred in ("en", "de")
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in found)
    assert all(0 <= r.score <= 1 for r in found)
    held = [i for i in truth if by_id[i].held_out]
    assert len(held) > 50 and sum(by_id[i].lang_pred == truth[i] for i in held) >= 0.98 * len(held)
    # the sample's bound holds, with every language in it
    small = ids.train(frame, sample=40)
    assert small.languages == sorted(SAMPLES)
    one = ids.identify_languages(frame.where("lang = 'en' or doc_id < 5")).where("doc_id = 10").first()
    assert one.lang_pred == "en" and one.score == 1.0 and one.runner_up is None
    none = ids.identify_languages(frame.withColumn("lang", frame["lang"].substr(9, 1)).where("lang is null")).collect()
    assert all(r.lang_pred == "und" for r in none)
    assert ids.identify_languages(frame.limit(0)).collect() == []


def test_mixed_text_is_flagged():
    rnd = random.Random(6)
    texts = [(sentence(rnd, lang, 15), lang) for lang in SAMPLES for _ in range(60)]
    model = ids.fit(np.stack([ids.encode(t) for t, _ in texts]), [lang for _, lang in texts])
    clear = model.predict([sentence(rnd, lang, 15) for lang in SAMPLES for _ in range(10)])
    assert not any(flag for _, _, flag, _ in clear)
    mixed = [model.predict([sentence(rnd, "en", n) + " " + sentence(rnd, "de", 16 - n)])[0] for n in range(17)]
    assert any(flag for _, _, flag, _ in mixed)
    assert all({name, second} == {"en", "de"} for name, _, flag, second in mixed if flag)


def test_registered_query_is_right_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    found = QUERIES["op12_language_id"](spark, sf)
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang", "text")
    rows = [r for r in found.join(docs, "doc_id").where("held_out and lang is not null").collect() if ids.has_letter(r.text)]
    assert len(rows) > 100
    assert sum(r.lang_pred == r.lang for r in rows) / len(rows) > 0.98
