"""Text quality by attention over passages (multiple-instance learning).

A text is cut into passages, each encoded by what share its byte kinds, pairs of byte kinds and
word lengths have. A hidden layer reads each passage, a gated attention layer learns from
labels of whole documents how much each passage counts, and the weighted passage is scored.
"""

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

PASSAGE_BYTES = 512
HIDDEN = 24
ATTENTION = 12
EPOCHS = 20
BATCH = 128
LEARNING_RATE = 0.01
SEED = 7
#: The sample that the classifier is fitted on: at most so many labelled documents, each whole, of
#: at most so many passages together.
SAMPLE_DOCS = 6000
SAMPLE_PASSAGES = 40_000
#: Passages encoded at a time; bounds memory for very long texts.
PASSAGES_AT_ONCE = 2048
ACCEPT = 0.3

KINDS = 20


def _byte_kinds():
    """Kind of each byte: letters by case and vowel, digits, space, line end, single signs."""
    kinds = np.full(256, 19, np.int32)
    for b in range(256):
        c = chr(b)
        if b >= 128:
            kinds[b] = 18 if b >= 192 else 17
        elif c in "aeiou":
            kinds[b] = 0
        elif c.islower():
            kinds[b] = 1
        elif c in "AEIOU":
            kinds[b] = 2
        elif c.isupper():
            kinds[b] = 3
        elif c.isdigit():
            kinds[b] = 4
    for number, signs in enumerate([" ", "\n\r", "\t\x0b\x0c", ".", ",", "!?", "\"'`", ":;", "-_", "|", "()[]{}<>", "*#$%&@^~+=/\\"], 5):
        for c in signs:
            kinds[ord(c)] = number
    return kinds


_KINDS = _byte_kinds()
N_FEATURES = KINDS + KINDS**2 + 2 + 12


def encode(text):
    """Rows of features, one for each passage, some passages at a time; an empty text is one passage
    of zeros."""
    data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    if len(data) == 0:
        yield np.zeros((1, N_FEATURES), np.float32)
    for start in range(0, len(data), PASSAGES_AT_ONCE * PASSAGE_BYTES):
        yield _encode_some(data[start : start + PASSAGES_AT_ONCE * PASSAGE_BYTES])


def _encode_some(data):
    n = -(-len(data) // PASSAGE_BYTES)
    kinds = _KINDS[data]
    passage = np.arange(len(data), dtype=np.int32) // PASSAGE_BYTES
    sizes = np.bincount(passage, minlength=n).astype(np.float32)[:, None]
    single = np.bincount(passage * KINDS + kinds, minlength=n * KINDS).reshape(n, -1)
    pair = kinds[:-1] * KINDS + kinds[1:]
    pairs = np.bincount(passage[:-1] * KINDS**2 + pair, minlength=n * KINDS**2).reshape(n, -1)
    space = (kinds >= 5) & (kinds <= 7)
    ends = np.flatnonzero(space)
    lengths = np.diff(np.concatenate([[-1], ends, [len(data)]])) - 1
    at = np.minimum(np.concatenate([ends, [len(data) - 1]]), len(data) - 1)
    real = lengths > 0
    lengths, word_at = lengths[real], passage[at[real]]
    binned = np.minimum(lengths, 24) // 2
    by_length = np.bincount(word_at * 13 + binned, minlength=n * 13).reshape(n, -1)[:, :12]
    n_words = np.maximum(1, np.bincount(word_at, minlength=n))[:, None]
    more = np.hstack([np.log1p(sizes) / 7.0, n_words / sizes])
    return np.hstack(
        [np.sqrt(single / sizes), np.sqrt(pairs / sizes), more, np.sqrt(by_length / n_words)]
    ).astype(np.float32)


class Model:
    """Hidden layer, gated attention and score; weights are plain arrays."""

    def __init__(self, mean, scale, weights):
        self.mean, self.scale, self.weights = mean, scale, weights

    def _read(self, passages):
        """Hidden values, the two halves of the gate and the weight of each passage."""
        w = self.weights
        x = (passages - self.mean) / self.scale
        h = np.tanh(x @ w["h"] + w["hb"])
        tanh, gate = np.tanh(h @ w["v"]), 1 / (1 + np.exp(-(h @ w["u"])))
        return x, h, tanh, gate, (tanh * gate) @ w["a"]

    def _judge(self, z):
        return 1 / (1 + np.exp(-(z @ self.weights["s"] + self.weights["sb"])))

    def bag_scores(self, passages, starts):
        """Scores of bags: rows of `passages` from each of `starts` on, and what they were made of."""
        x, h, tanh, gate, a = self._read(passages)
        bag = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(passages))))
        top = np.maximum.reduceat(a, starts)
        e = np.exp(a - top[bag])
        share = e / np.add.reduceat(e, starts)[bag]
        z = np.add.reduceat(share[:, None] * h, starts, axis=0)
        return self._judge(z), (x, h, tanh, gate, share, z, bag)

    def folded_score(self, chunks):
        """Score of one bag whose passages come in chunks: the highest weight, the sum of the shares
        and the weighted sum so far are all that is kept."""
        top, total, z = -np.inf, 0.0, 0.0
        for passages in chunks:
            _, h, _, _, a = self._read(passages)
            higher = max(top, float(a.max()))
            kept, e = np.exp(top - higher), np.exp(a - higher)
            top, total, z = higher, total * kept + e.sum(), z * kept + e @ h
        return float(self._judge((z / total)[None, :])[0])

    def score(self, texts):
        """Scores of texts, short ones together as far as they fill a chunk."""
        out, waiting, n = np.zeros(len(texts)), [], 0

        def flush():
            if waiting:
                bags = [bag for _, bag in waiting]
                starts = np.cumsum([0] + [len(bag) for bag in bags])[:-1]
                out[[at for at, _ in waiting]] = self.bag_scores(np.concatenate(bags), starts)[0]
                waiting.clear()

        for at, text in enumerate(texts):
            if 4 * len(text) > PASSAGES_AT_ONCE * PASSAGE_BYTES:
                out[at] = self.folded_score(encode(text))
                continue
            bag = next(encode(text))
            if n + len(bag) > PASSAGES_AT_ONCE:
                flush()
                n = 0
            waiting.append((at, bag))
            n += len(bag)
        flush()
        return out


def gradient(model, passages, starts, labels):
    """Of the mean log loss of these bags, by weight."""
    w = model.weights
    score, (x, h, tanh, gate, share, z, bag) = model.bag_scores(passages, starts)
    d = (score - labels) / len(labels)
    g = {"s": z.T @ d, "sb": np.array([d.sum()])}
    dz = d[:, None] * w["s"]
    along = (dz[bag] * h).sum(1)
    da = share * (along - np.add.reduceat(share * along, starts)[bag])
    g["a"] = (tanh * gate).T @ da
    dt = da[:, None] * w["a"] * gate * (1 - tanh**2)
    dg = da[:, None] * w["a"] * tanh * gate * (1 - gate)
    g["v"], g["u"] = h.T @ dt, h.T @ dg
    dh = (share[:, None] * dz[bag] + dt @ w["v"].T + dg @ w["u"].T) * (1 - h**2)
    g["h"], g["hb"] = x.T @ dh, dh.sum(0)
    return g


def fit(bags, labels, seed=SEED, epochs=EPOCHS):
    """The model of these bags of passages by gradient descent (Adam) on the log loss."""
    random = np.random.default_rng(seed)
    n = sum(len(bag) for bag in bags)
    mean = sum(bag.sum(0, dtype=np.float64) for bag in bags) / n
    scale = np.sqrt(sum(((bag - mean) ** 2).sum(0) for bag in bags) / n) + 0.02
    shape = {
        "h": (len(mean), HIDDEN), "hb": (HIDDEN,), "v": (HIDDEN, ATTENTION), "u": (HIDDEN, ATTENTION),
        "a": (ATTENTION,), "s": (HIDDEN,), "sb": (1,),
    }
    w = {k: random.normal(0, 1 / np.sqrt(s[0]), s) if k not in ("hb", "sb") else np.zeros(s) for k, s in shape.items()}
    model = Model(mean, scale, w)
    labels = np.asarray(labels, float)
    moment = {k: (np.zeros_like(x), np.zeros_like(x)) for k, x in w.items()}
    step = 0
    for epoch in range(epochs):
        order = random.permutation(len(bags))
        rate = LEARNING_RATE * (1 - epoch / epochs)
        for at in range(0, len(order), BATCH):
            some = order[at : at + BATCH]
            starts = np.cumsum([0] + [len(bags[i]) for i in some])[:-1]
            g = gradient(model, np.concatenate([bags[i] for i in some]).astype(np.float32), starts, labels[some])
            step += 1
            for k in w:
                grad = g[k] + (1e-4 * w[k] if k in ("h", "s") else 0)
                m, v = moment[k]
                m += 0.1 * (grad - m)
                v += 0.001 * (grad**2 - v)
                w[k] -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Model(mean.astype(np.float32), scale.astype(np.float32), {k: x.astype(np.float32) for k, x in w.items()})


def held_out(doc_id):
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


@F.pandas_udf(T.BinaryType())
def _packed_passages(texts: pd.Series) -> pd.Series:
    return pd.Series(
        [zlib.compress(np.concatenate(list(encode(text))).astype(np.float16).tobytes(), 1) for text in texts]
    )


def train(
    docs, labels, id_col="doc_id", text_col="text", label_col="quality", sample=SAMPLE_DOCS,
    sample_passages=SAMPLE_PASSAGES,
):
    """A model from at most `sample` labelled documents that are not held out.

    The sample is those with the smallest hashes of their ids, so it does not depend on how the
    tables are laid out, as far as they have at most `sample_passages` passages together; a document
    is in it whole or not at all. Null labels, labels other than 0 and 1 and labels without a
    document count for nothing; of repeated labels of one id the larger counts, of repeated
    documents of one id the text with the smallest hash. Without labels, or with one kind only,
    every score is the share of label 1 (a half without any)."""
    usable = F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(F.col(id_col))
    chosen = (
        labels.where(usable)
        .groupBy(F.col(id_col).alias("_id"))
        .agg(F.max(label_col).alias("_label"))
        .orderBy(F.xxhash64("_id", F.lit(SEED)), "_id")
        .limit(sample)
    )
    text = F.coalesce(F.col(text_col), F.lit(""))
    texts = docs.select(F.col(id_col).alias("_id"), text.alias("_text"), F.xxhash64(text).alias("_no"))
    # at most `sample` rows of a few numbers each, here and below
    n_passages = F.greatest(F.lit(1), F.ceil(F.octet_length("_text") / PASSAGE_BYTES)).alias("n")
    sizes = texts.join(F.broadcast(chosen), "_id").groupBy("_id", "_label").agg(F.min(F.struct("_no", n_passages)).alias("one"))
    order = Window.orderBy(F.xxhash64("_id", F.lit(SEED)), "_id")
    picked = sizes.withColumn("_before", F.sum("one.n").over(order)).where(F.col("_before") <= sample_passages)
    picked = picked.select("_id", "_label", F.col("one._no").alias("_no"))
    rows = (
        texts.join(F.broadcast(picked), ["_id", "_no"])
        .dropDuplicates(["_id"])
        .select("_id", "_label", _packed_passages("_text").alias("_passages"))
        .orderBy("_id")
        .collect()
    )
    bags = [np.frombuffer(zlib.decompress(r["_passages"]), np.float16).reshape(-1, N_FEATURES) for r in rows]
    found = [r["_label"] for r in rows]
    if len(set(found)) < 2:
        share = min(0.999, max(0.001, float(np.mean(found)))) if found else 0.5
        w = {"h": np.zeros((N_FEATURES, 1)), "hb": np.zeros(1), "v": np.zeros((1, 1)), "u": np.zeros((1, 1)),
             "a": np.zeros(1), "s": np.zeros(1), "sb": np.array([np.log(share / (1 - share))])}
        return Model(np.zeros(N_FEATURES), np.ones(N_FEATURES), w)
    return fit(bags, found)


def score_column(model, text):
    @F.pandas_udf(T.DoubleType())
    def udf(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(texts.tolist()), dtype=float)

    return udf(F.coalesce(text, F.lit("")))


def score_quality(docs, labels, id_col="doc_id", text_col="text", **settings):
    """One row per input row: doc_id, held_out, score, predicted.

    Null text is empty; empty texts have a score too; repeated rows get the same score. A null id is
    not held out. An empty table gives no rows."""
    model = train(docs, labels, id_col, text_col, **settings)
    scored = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(held_out(F.col(id_col)), F.lit(False)).alias("held_out"),
        score_column(model, F.col(text_col)).alias("score"),
    )
    return scored.withColumn("predicted", F.when(F.col("score") >= ACCEPT, 1).otherwise(0))


def keep_good(docs, labels, id_col="doc_id", text_col="text", **settings):
    """The documents that the classifier accepts, with the columns they came with. Null text counts
    as empty, repeated rows are judged alike, an empty table gives no rows."""
    model = train(docs, labels, id_col, text_col, **settings)
    return docs.where(score_column(model, F.col(text_col)) >= ACCEPT)
