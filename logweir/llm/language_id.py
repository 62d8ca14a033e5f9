"""Language identification by error-correcting output codes.

Every language has a codeword of bits. For each bit, a binary classifier over hashed n-grams of the
text's bytes says whether the bit of the text's language is set. The languages' codewords are then
held against these margins: each bit's loss, weighted by how well its classifier does on the
training sample, adds up to a codeword's loss, and the codeword of least loss is the answer, so that
some wrong bits do no harm. Texts whose second-best codeword is nearly as good are flagged.
"""

import zlib
from math import ceil, log2

import numpy as np
import pandas as pd
import regex
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logweir.llm.common import discard, written

#: Lengths of the byte n-grams, and the hashed features that they share.
GRAMS = (1, 2, 3, 4)
FEATURES = 4096
#: The sample that the classifiers are fitted on: at most so many different texts, about equally
#: many of each language. Languages beyond the commonest so many are not learned.
SAMPLE_TEXTS = 4000
MOST_LANGUAGES = 1000
#: Bytes whose n-grams are counted at a time; bounds memory for very long texts.
BYTES_AT_ONCE = 1 << 20
#: Texts whose features are held at a time.
TEXTS_AT_ONCE = 256
STEPS = 250
SHRINK = 1e-5
#: Least lead of the best codeword's share over the next one's without the flag.
CLEAR_LEAD = 0.9
UNDETERMINED = "und"
SEED = 12

_LETTER = regex.compile(r"\p{L}")
#: All that is in ASCII and no letter is a blank.
_BLANKS = bytes(b if b >= 0x80 or chr(b).isalpha() else 0x20 for b in range(256))


def encode(text):
    """Square roots of the shares of the text's n-grams, so a row has length one (or zero)."""
    data = b" " + b" ".join(text.lower().encode("utf-8", "replace").translate(_BLANKS).split()) + b" "
    data = np.frombuffer(data, np.uint8)
    counts = np.zeros(FEATURES, np.int64)
    longest = max(GRAMS)
    for start in range(0, len(data), BYTES_AT_ONCE):
        # the n-grams that begin here may end in the next part
        part = data[start : start + BYTES_AT_ONCE + longest - 1].astype(np.uint32)
        begins = min(BYTES_AT_ONCE, len(data) - start)
        gram = np.zeros(len(part), np.uint32)
        for n in range(1, longest + 1):
            usable = len(part) - n + 1
            if usable <= 0:
                break
            gram = (gram[:usable] << np.uint32(8)) | part[n - 1 :]
            if n in GRAMS:
                hashed = (gram[:begins] ^ np.uint32(n * 0x9E3779B9 & 0xFFFFFFFF)) * np.uint32(0x85EBCA6B)
                hashed = (hashed ^ (hashed >> np.uint32(15))) * np.uint32(0xC2B2AE35)
                counts += np.bincount(hashed >> np.uint32(32 - (FEATURES.bit_length() - 1)), minlength=FEATURES)
    return np.sqrt(counts / max(1, counts.sum())).astype(np.float32)


def has_letter(text):
    return text is not None and _LETTER.search(text) is not None


def codebook(n, seed=SEED):
    """One row of +1 and -1 for each of n languages.

    Up to six languages have every way to part them in two; more have random bits, the best of some
    draws by how far the nearest two codewords are apart."""
    if n <= 6:
        bits = 2 ** (n - 1) - 1 if n > 1 else 0
        parts = [[row > 0 and (column + 1) >> (row - 1) & 1 for column in range(bits)] for row in range(n)]
        return np.where(np.array(parts, bool).reshape(n, bits), -1, 1)
    random = np.random.default_rng(seed)
    bits = ceil(10 * log2(n))
    best, apart = None, -1
    for _ in range(40):
        code = random.choice([-1, 1], (n, bits))
        # every bit has both values, and no two languages one codeword
        alike = code.astype(np.float32) @ code.T.astype(np.float32)
        least = (bits - (alike - 2 * bits * np.eye(n)).max()) / 2
        if least > apart and (np.abs(code.sum(0)) < n).all():
            best, apart = code, least
    return best


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


class Model:
    """Languages, their codewords, the bits' classifiers and the bits' weights."""

    def __init__(self, languages, code, weights, bias, trust):
        self.languages, self.code = languages, code
        self.weights, self.bias, self.trust = weights, bias, trust

    def margins(self, rows):
        return rows @ self.weights + self.bias

    def decode(self, margins):
        """Shares of the languages: how little loss each codeword has against the margins."""
        losses = np.zeros((len(margins), len(self.languages)))
        for bit in range(self.code.shape[1]):
            for sign in (-1, 1):
                loss = self.trust[bit] * np.logaddexp(0, -sign * margins[:, bit])
                losses[:, self.code[:, bit] == sign] += loss[:, None]
        share = np.exp(losses.min(1, keepdims=True) - losses)
        return share / share.sum(1, keepdims=True)

    def predict(self, texts):
        """(language, share, flagged, runner-up) of each text."""
        found = [(UNDETERMINED, 0.0, False, None)] * len(texts)
        readable = [at for at, text in enumerate(texts) if has_letter(text)]
        if not self.languages:
            return found
        for begin in range(0, len(readable), TEXTS_AT_ONCE):
            some = readable[begin : begin + TEXTS_AT_ONCE]
            share = self.decode(self.margins(np.stack([encode(texts[at]) for at in some])))
            order = np.argsort(-share, axis=1, kind="stable")
            for row, at in enumerate(some):
                first = order[row, 0]
                second = order[row, 1] if len(self.languages) > 1 else None
                next_share = 0.0 if second is None else share[row, second]
                found[at] = (
                    self.languages[first],
                    float(share[row, first]),
                    bool(share[row, first] - next_share < CLEAR_LEAD),
                    None if second is None else self.languages[second],
                )
        return found


def gradient(rows, bits, weights, bias, shrink=SHRINK):
    """Of each bit's mean logistic loss with its penalty: (by weight, by bias)."""
    d = (_sigmoid(rows @ weights + bias) - (bits > 0)) / len(rows)
    return rows.T @ d + shrink * weights, d.sum(0)


def fit(rows, labels, seed=SEED, steps=STEPS):
    """The model of these rows of features by accelerated gradient descent, all bits at once."""
    languages = sorted(set(labels))
    code = codebook(len(languages), seed)
    of = {language: row for row, language in enumerate(languages)}
    bits = code[[of[label] for label in labels]].astype(np.float32) if len(labels) else code
    n_bits = code.shape[1]
    weights, bias = np.zeros((FEATURES, n_bits), np.float32), np.zeros(n_bits, np.float32)
    trust = np.ones(n_bits)
    if n_bits:
        # rows have length one, and with the constant two: the loss curves at most 1 / 2
        rate, ahead_w, ahead_b, t = 2.0, weights, bias, 1.0
        for _ in range(steps):
            by_weight, by_bias = gradient(rows, bits, ahead_w, ahead_b)
            next_w, next_b = ahead_w - rate * by_weight, ahead_b - rate * by_bias
            t_next = (1 + (1 + 4 * t * t) ** 0.5) / 2
            push = (t - 1) / t_next
            ahead_w, ahead_b = next_w + push * (next_w - weights), next_b + push * (next_b - bias)
            weights, bias, t = next_w, next_b, t_next
        right = ((rows @ weights + bias > 0) == (bits > 0)).mean(0)
        trust = np.clip(2 * right - 1, 0.05, 1.0)
        trust = trust / trust.mean()
    return Model(languages, code, weights.astype(np.float32), bias.astype(np.float32), trust)


@F.pandas_udf(T.BinaryType())
def _packed(texts: pd.Series) -> pd.Series:
    return pd.Series([zlib.compress(encode(text).astype(np.float16).tobytes(), 1) for text in texts])


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(
    docs, id_col="doc_id", text_col="text", lang_col="lang", sample=SAMPLE_TEXTS, most_languages=MOST_LANGUAGES
):
    """A model from at most `sample` different texts of documents with a language that are not held
    out.

    The sample is drawn by hash of the text and about equally from the languages, so it does not
    depend on how the table is laid out or on how often a text is repeated. Null languages and texts
    without a letter count for nothing; a text with two languages is in the sample with both."""
    usable = F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}") & ~held_out(F.col(id_col))
    known = docs.where(usable).select(
        F.col(lang_col).alias("_lang"), F.xxhash64(F.lit(SEED), F.col(text_col)).alias("_no"), F.col(text_col).alias("_text")
    )
    different = written(known.select("_lang", "_no").distinct(), "language-texts")
    common = different.groupBy("_lang").agg(F.count(F.lit(1)).alias("_n"))
    common = common.orderBy(F.desc("_n"), "_lang").limit(most_languages)
    # an equal share of each language: its texts in order of hash, at the pace of its number
    turn = (F.col("_no") / F.lit(2.0**64) + 0.5) * F.col("_n")
    picked = (
        different.join(F.broadcast(common), "_lang")
        .select("_lang", "_no", turn.alias("_turn"))
        .orderBy("_turn", "_lang", "_no")
        .limit(sample)
        .select("_lang", "_no")
    )
    # at most `sample` rows of a name and a number
    rows = (
        known.join(F.broadcast(picked), ["_lang", "_no"])
        .dropDuplicates(["_lang", "_no"])
        .select("_lang", "_no", _packed("_text").alias("_row"))
        .orderBy("_lang", "_no")
        .collect()
    )
    discard(different)
    found = np.zeros((len(rows), FEATURES), np.float32)
    for at, row in enumerate(rows):
        found[at] = np.frombuffer(zlib.decompress(row["_row"]), np.float16)
    return fit(found, [row["_lang"] for row in rows])


def language_column(model, text):
    """Struct column lang_pred, score, ambiguous, runner_up."""

    @F.pandas_udf("lang_pred string, score double, ambiguous boolean, runner_up string")
    def udf(texts: pd.Series) -> pd.DataFrame:
        found = model.predict([text if isinstance(text, str) else None for text in texts])
        return pd.DataFrame(found, columns=["lang_pred", "score", "ambiguous", "runner_up"])

    return udf(text)


def identify_languages(docs, id_col="doc_id", text_col="text", lang_col="lang", **settings):
    """One row per input row: doc_id, held_out, lang_pred, score, ambiguous, runner_up.

    Null texts and texts without a letter are `und` with score 0, as is every text where nothing
    could be learned; where one language was learned, every other text has it with score 1.
    Repeated rows are judged alike. A null id is not held out. An empty table gives no rows."""
    model = train(docs, id_col, text_col, lang_col, **settings)
    return docs.select(
        F.col(id_col).alias("doc_id"),
        held_out(F.col(id_col)).alias("held_out"),
        language_column(model, F.col(text_col)).alias("found"),
    ).select("doc_id", "held_out", "found.*")
