"""Importance resampling of documents towards a target's distribution of word runs.

Words and pairs of adjacent words fall into buckets by CRC-32. The distinct words of some megabytes
of text at a time are the entries of an Aho-Corasick automaton, each between two delimiters, so that
a scan meets every word exactly once. An entry's payload is the word's CRC, the CRC of the word and
a blank, and the word's length; the CRC of a pair follows from the payloads of its two words alone,
by moving the first one's CRC over as many zero bytes as the second is long. Each text is scanned
once and its buckets are written, some three fifths of its size before compression; the corpus is
counted and each document scored from them. Gumbel noise drawn from the id turns the highest scores
into a sample without replacement.
"""

import zlib
from math import floor, log

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Window
from pyspark.sql import functions as F

from logweir.llm.common import discard, written

BUCKETS = 10_000
#: Whole percent of the eligible documents that are drawn, and words that make a document eligible.
SHARE = 25
LEAST_WORDS = 20
SEED = 7
#: Bytes of text that share an automaton; bounds its size and what a scan holds.
SCAN_BYTES = 1 << 22
#: A word of more bytes enters the automaton under a short name.
LONG_WORD = 1 << 12
#: Equal rows that one row of the draw stands for at most when they are told apart again.
ROWS_AT_ONCE = 4096

WORD_BYTES = b"0123456789abcdefghijklmnopqrstuvwxyz" + bytes(range(0x80, 0x100))
_FOLDED = bytes(range(256)).lower()
_TO_TEXT = bytes(b if b in WORD_BYTES else 0x20 for b in _FOLDED)
#: Names that no word has, as words hold no capitals: the start of a text, and words too long.
_START, _LONG = b"T", b"L"
_LONG_WORDS = regex.compile(rb"[^ ]{%d,}" % (LONG_WORD + 1))


def _one_zero_byte(crc):
    for _ in range(8):
        crc = crc >> 1 ^ (0xEDB88320 if crc & 1 else 0)
    return crc


def _move(crcs, table):
    return table[0][crcs & 255] ^ table[1][crcs >> 8 & 255] ^ table[2][crcs >> 16 & 255] ^ table[3][crcs >> 24]


def _zero_byte_tables(n_powers=48):
    """For each power of two, tables that move a CRC-32 over that many zero bytes: 256 values for
    each byte of the CRC."""
    columns = [_one_zero_byte(1 << bit) for bit in range(32)]
    values, tables = np.arange(256), []
    for _ in range(n_powers):
        table = np.zeros((4, 256), np.uint32)
        for bit, column in enumerate(columns):
            table[bit // 8] ^= np.where(values >> bit % 8 & 1, np.uint32(column), np.uint32(0))
        tables.append(table)
        columns = _move(np.array(columns, np.uint32), table).tolist()
    return tables


_TABLES = _zero_byte_tables()


def moved_over(crcs, lengths):
    """What CRCs add to the CRC of a text that goes on for so many more bytes."""
    out = crcs.astype(np.uint32, copy=True)
    for power in range(int(lengths.max(initial=0)).bit_length()):
        some = np.flatnonzero(lengths >> power & 1)
        out[some] = _move(out[some], _TABLES[power])
    return out


def _pieces(texts):
    """(number of the text, some of its bytes, whether their first word was counted before).

    Bytes are folded, and every byte that is in no word is a blank. A text of more than SCAN_BYTES
    is cut at blanks, and each further piece begins with the last word that came before it."""
    for number, text in enumerate(texts):
        data = text.encode("utf-8", "replace").translate(_TO_TEXT) if text else b""
        at, last = 0, b""
        while at < len(data):
            end = data.find(b" ", at + SCAN_BYTES)
            end = len(data) if end < 0 else end
            piece = data[at:end]
            yield number, last + b" " + piece, bool(last)
            last = (piece.rsplit(None, 1) or [last])[-1]
            at = end


def _groups(texts):
    group, size = [], 0
    for piece in _pieces(texts):
        group.append(piece)
        size += len(piece[1])
        if size >= SCAN_BYTES:
            yield group
            group, size = [], 0
    if group:
        yield group


def _dictionary(tokens, long_words):
    """An automaton over the tokens, each between two blanks, and the payloads of their words."""
    words = [long_words.get(token, token) for token in tokens]
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    for number, token in enumerate(tokens):
        automaton.add_word(f" {token.decode('latin-1')} ", number)
    automaton.make_automaton()
    crc = np.array([zlib.crc32(word) for word in words], np.uint32)
    crc_blank = np.array([zlib.crc32(word + b" ") for word in words], np.uint32)
    return automaton, crc, crc_blank, np.array([len(word) for word in words], np.int64)


def scan(group, buckets=BUCKETS):
    """Of these pieces: (text of each word, bucket of each word, text of each pair, its bucket)."""
    names = {}

    def short(match):
        return names.setdefault(match.group(), b"%b%d" % (_LONG, len(names)))

    between = b" %b " % _START
    body = between + between.join(_LONG_WORDS.sub(short, piece) for _, piece, _ in group) + b" "
    tokens = sorted(set(body.split()))
    start = tokens.index(_START)
    automaton, crc, crc_blank, length = _dictionary(tokens, {name: word for word, name in names.items()})
    hits = np.fromiter((hit for _, hit in automaton.iter(body.decode("latin-1"))), np.int64)
    starts = hits == start
    piece = np.cumsum(starts) - 1
    text = np.array([number for number, _, _ in group])[piece]
    again = np.array([counted for _, _, counted in group])[piece]
    after_start = np.concatenate([[False], starts[:-1]])
    single = ~starts & ~(after_start & again)
    second = np.flatnonzero(~starts & ~after_start)
    ends = hits[second]
    pairs = moved_over(crc_blank[hits[second - 1]], length[ends]) ^ crc[ends]
    return text[single], crc[hits[single]] % buckets, text[second], pairs % buckets


def _number_type(buckets):
    return np.dtype("<u2" if buckets <= 1 << 16 else "<u4")


def scanned(text, buckets=BUCKETS):
    """Struct column n_words, found: the buckets of the text's words and pairs as one row of numbers,
    null text being empty."""
    kind = _number_type(buckets)

    @F.pandas_udf("n_words long, found binary")
    def udf(texts: pd.Series) -> pd.DataFrame:
        n_words, parts = np.zeros(len(texts), np.int64), [[] for _ in range(len(texts))]
        for group in _groups(texts.tolist()):
            of_words, words, of_pairs, pairs = scan(group, buckets)
            first, last = group[0][0], group[-1][0]
            numbers = np.arange(first, last + 2)
            for of, found in ((of_words, words), (of_pairs, pairs)):
                # texts come in order, so each has a stretch of its own
                ends = np.searchsorted(of, numbers)
                data = found.astype(kind)
                for number in range(first, last + 1):
                    begin, end = ends[number - first], ends[number - first + 1]
                    if end > begin:
                        parts[number].append(data[begin:end].tobytes())
            n_words[first : last + 1] += np.bincount(of_words - first, minlength=last + 1 - first)
        return pd.DataFrame({"n_words": n_words, "found": [b"".join(some) for some in parts]})

    return udf(F.coalesce(text, F.lit("")))


def bucket_counts(found, buckets=BUCKETS):
    """bucket, n over all rows of a table with the one column `found`."""
    kind = _number_type(buckets)

    def count(batches):
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            numbers = np.frombuffer(b"".join(batch.column(0).to_pylist()), kind)
            counts += np.bincount(numbers, minlength=buckets)
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[seen])], ["bucket", "n"])

    return found.mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(corpus, target, buckets=BUCKETS):
    """Whole gains of all buckets from the counts {bucket: n} of corpus and target."""
    n_corpus, n_target = sum(corpus.values()), sum(target.values())
    gains = [
        floor(
            1000
            * log(
                (float(target.get(b, 0) + 1) * float(n_corpus + buckets))
                / (float(corpus.get(b, 0) + 1) * float(n_target + buckets))
            )
        )
        for b in range(buckets)
    ]
    return np.array(gains, np.int64)


def weigh(found, gains):
    """Struct column n_features, weight: the floored mean gain of the text's features."""
    kind = _number_type(len(gains))

    @F.pandas_udf("n_features long, weight long")
    def udf(rows: pd.Series) -> pd.DataFrame:
        numbers = [np.frombuffer(row, kind) for row in rows]
        n = np.array([len(some) for some in numbers], np.int64)
        total = np.array([gains[some].sum() for some in numbers], np.int64)
        return pd.DataFrame({"n_features": n, "weight": np.floor_divide(total, np.maximum(n, 1))})

    return udf(found)


def _noise(doc_id, seed):
    """Gumbel noise in thousandths, drawn from the id."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def importance_resample(
    docs, target, id_col="doc_id", text_col="text", target_col="text", share=SHARE,
    least_words=LEAST_WORDS, buckets=BUCKETS, seed=SEED,
):
    """One row per input row: doc_id, n_words, n_features, weight, score, rank (null if not drawn).

    Null text has no words; texts without features have weight 0. A null id draws the noise of an
    empty one and comes last among ties; repeated rows are drawn each by itself. An empty target
    leaves every bucket its smoothed share; an empty table gives no rows.
    """
    features = written(
        docs.select(F.col(id_col).cast("long").alias("doc_id"), scanned(F.col(text_col), buckets).alias("s")).select(
            "doc_id", "s.*"
        ),
        "resample-features",
    )
    aims = target.select(scanned(F.col(target_col), buckets).alias("s")).select("s.found")
    corpus = {r.bucket: r.n for r in bucket_counts(features.select("found"), buckets).collect()}
    wanted = {r.bucket: r.n for r in bucket_counts(aims, buckets).collect()}
    gains = bucket_gains(corpus, wanted, buckets)
    scored = features.select("doc_id", "n_words", weigh(F.col("found"), gains).alias("w"))
    scored = scored.select("doc_id", "n_words", "w.*")
    scored = scored.withColumn("score", F.col("weight") + _noise(F.col("doc_id"), seed))
    scored = written(scored, "resample-scores")
    discard(features)
    return draw(scored, share, least_words)


def draw(scored, share=SHARE, least_words=LEAST_WORDS):
    """`scored` with `rank` 1, 2, 3, ... for the highest `share` percent of the scores among rows of
    `least_words` words.

    Scores are whole numbers within some 10^5, so a table of how many rows have each is small. Only
    rows of a score that is drawn are ordered, each score by itself, with equal rows counted first
    and told apart afterwards."""
    columns = scored.columns
    able = F.col("n_words") >= least_words
    by_score = scored.where(able).groupBy("score").agg(F.count(F.lit(1)).alias("n"))
    higher = Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(0))
    starts = by_score.select(
        F.col("score").alias("_score"),
        F.coalesce(F.sum("n").over(higher), F.lit(0)).alias("_before"),
        F.floor(F.sum("n").over(everything) * share / 100).cast("long").alias("_drawn"),
    )
    starts = written(starts, "resample-starts")
    # one row for each of some 10^5 scores at most
    known = F.broadcast(starts)
    marked = scored.join(known, able & (F.col("score") == F.col("_score")), "left")
    chosen = F.coalesce(F.col("_before") < F.col("_drawn"), F.lit(False))
    rest = marked.where(~chosen).select(*columns, F.lit(None).cast("long").alias("rank"))
    equal = marked.where(chosen).groupBy(*columns, "_before", "_drawn").agg(F.count(F.lit(1)).alias("_n"))
    earlier = (
        Window.partitionBy("score")
        .orderBy(F.asc_nulls_last("doc_id"), "n_features", "n_words")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = equal.withColumn("_first", F.col("_before") + 1 + F.coalesce(F.sum("_n").over(earlier), F.lit(0)))

    def numbered(rows, n, first):
        return rows.withColumn("_at", F.explode(F.sequence(F.lit(0).cast("long"), n - 1))).withColumn(
            "rank", first + F.col("_at")
        )

    many = F.col("_n") > ROWS_AT_ONCE
    few = numbered(placed.where(~many), F.col("_n"), F.col("_first"))
    tasks = int(scored.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = placed.where(many).withColumn(
        "_part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / ROWS_AT_ONCE)))
    )
    parts = parts.repartition(tasks, "_part", "doc_id")
    begin = F.col("_part") * ROWS_AT_ONCE
    parts = numbered(parts, F.least(F.col("_n") - begin, F.lit(ROWS_AT_ONCE)), F.col("_first") + begin)
    rank = F.when(F.col("rank") <= F.col("_drawn"), F.col("rank")).alias("rank")
    ranked = few.select(*columns, rank).unionByName(parts.select(*columns, rank))
    return ranked.unionByName(rest)
