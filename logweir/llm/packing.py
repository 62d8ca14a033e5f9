"""Best-fit packing of tokenised documents into sequences, in bulk-synchronous rounds.

Documents are tokenised and cut where they lie. Pieces are counted by length and ranked within it,
over all tasks; sequences with room are runs of numbers with the same gap. A round sorts pieces and
gaps by size and sweeps over them: each piece gets its successor, the smallest free gap that holds
it, the longest pieces first, and ranks within the runs say which piece gets which sequence. Then
gaps shrink by what they took and the next round begins. When no piece is left that fits a gap, as
many new sequences open as the rest needs at least, for the longest pieces. Rounds see counted runs
only, some for each length that a sequence can hold, so they cost the same for any number of
documents. The placements are joined back to the pieces by length and rank.
"""

import re
import zlib
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from logweir.llm.common import discard, written

SEQUENCE_TOKENS = 2048
END_ID = 0
#: Chunks and runs whose ids a worker remembers; ids don't depend on it.
KNOWN_CHUNKS, KNOWN_RUNS = 1_500_000, 1_500_000
#: Signs of ASCII that are neither letters, digits nor white space.
SIGNS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
RANK_ROWS = 200_000
PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"


class ChunkTokenizer:
    """Ids of a text from the ids of its chunks between ASCII white space, each encoded once.

    Special tokens in a text are text as any other with `special_as_text`. Without, they get their
    own ids as the tokenizer gives by default; chunks that hold one are encoded alone, as written.

    The tokenizer drops white space and looks at nothing across it, so a text's ids are its chunks'
    ids in order. It also parts a run of letters from the signs after it; so a chunk of both takes
    its ids from those two, which recur more often. New runs are encoded together, blanks between
    them, and told apart by the tokens that end a word; other new chunks have a separator between
    them.
    """

    SEPARATOR = "\x01"
    TOGETHER = 256

    def __init__(self, path, special_as_text=True):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        added = self.tokenizer.get_added_tokens_decoder().values()
        special = [] if special_as_text else [token.content for token in added]
        if any(not content or content.split() != [content] for content in special):
            raise ValueError("a special token must not hold white space")
        # in any letter case: whether another case is special, the tokenizer alone says
        self.special = re.compile("|".join(map(re.escape, special)), re.IGNORECASE) if special else None
        (self.separator,) = self._encode([self.SEPARATOR])[0]
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, number in vocabulary.items():
            self.ends_word[number] = token.endswith("</w>")
        self.known, self.runs = {}, {"": b""}

    def _encode(self, texts):
        return [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _groups(self, items, glue):
        groups = [items[at : at + self.TOGETHER] for at in range(0, len(items), self.TOGETHER)]
        encoded = self._encode([glue.join(group) for group in groups])
        return [(group, np.array(ids, "<u4")) for group, ids in zip(groups, encoded)]

    def _learn_runs(self, runs):
        for group, ids in self._groups(runs, " "):
            packed, start = ids.tobytes(), 0
            ends = 4 * (np.flatnonzero(self.ends_word[ids]) + 1)
            if len(ends) != len(group):
                raise ValueError("a run of one kind of characters is not one word to the tokenizer")
            for run, end in zip(group, ends.tolist()):
                self.runs[run] = packed[start:end]
                start = end

    def _is_alone(self, text):
        return self.SEPARATOR in text or bool(self.special and self.special.search(text))

    def _learn_whole(self, texts):
        """Ids of chunks that are neither letters nor letters and signs."""
        alone = [text for text in texts if self._is_alone(text)]
        found = {t: np.array(ids, "<u4").tobytes() for t, ids in zip(alone, self._encode(alone))}
        rest = [text for text in texts if not self._is_alone(text)]
        for group, ids in self._groups(rest, f" {self.SEPARATOR} "):
            packed, start = ids.tobytes(), 0
            marks = 4 * np.flatnonzero(ids == self.separator)
            for text, mark in zip(group, [*marks.tolist(), len(packed)]):
                found[text] = packed[start:mark]
                start = mark + 4
        return found

    def _learn(self, chunks):
        split, whole, new = [], [], set()
        for chunk in chunks:
            text = chunk.decode("utf-8", "replace")
            run = text.rstrip(SIGNS)
            # beyond Latin letters, and for the dotted capital i, lower case may not be one letter
            if run.isalpha() and (run.isascii() or (max(run) < "\u0250" and "\u0130" not in run)):
                tail = text[len(run) :]
                split.append((chunk, run, tail))
                new.update((run, tail))
            else:
                whole.append((chunk, text))
        if len(self.runs) > KNOWN_RUNS:
            self.runs = {"": b""}
        self._learn_runs(sorted(run for run in new if run not in self.runs))
        runs = self.runs
        for chunk, run, tail in split:
            self.known[chunk] = runs[run] + runs[tail] if tail else runs[run]
        found = self._learn_whole([text for _, text in whole])
        for chunk, text in whole:
            self.known[chunk] = found[text]

    def encode(self, texts):
        """Each text's ids as little-endian 32-bit numbers. The tokenizer lower-cases all letters;
        those of ASCII are so beforehand, which makes more chunks equal."""
        split = []
        for text in texts:
            chunks = text.encode("utf-8", "replace")
            cased = self.special and self.special.search(text)
            split.append((chunks if cased else chunks.lower()).split())
        if len(self.known) > KNOWN_CHUNKS:
            self.known.clear()
        new = [chunk for chunk in set(chain.from_iterable(split)) if chunk not in self.known]
        if new:
            self._learn(new)
        look_up = self.known.__getitem__
        return [b"".join(map(look_up, chunks)) for chunks in split]


_TOKENIZERS = {}


def chunk_tokenizer(path):
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = ChunkTokenizer(path, special_as_text=False)
    return _TOKENIZERS[path]


def cut(ids, end_id=END_ID, most=SEQUENCE_TOKENS):
    """(start, length, crc32) of the pieces of one document, its end id added."""
    ids += end_id.to_bytes(4, "little")
    return [
        (start // 4, len(piece) // 4, zlib.crc32(piece))
        for start in range(0, len(ids), 4 * most)
        for piece in [ids[start : start + 4 * most]]
    ]


def tokenised_pieces(docs, tokenizer_path, id_col="doc_id", text_col="text", most=SEQUENCE_TOKENS):
    """doc_id, piece, start, length, ids_crc32: null text is empty, an empty one is its end id."""

    def pieces(batches):
        tokenizer = chunk_tokenizer(tokenizer_path)
        for batch in batches:
            ids, out = batch.column(0).to_pylist(), []
            for at in range(0, len(ids), 64):
                texts = batch.column(1).slice(at, 64).to_pylist()
                for doc_id, packed in zip(ids[at : at + 64], tokenizer.encode(texts)):
                    out += [(doc_id, n, *piece) for n, piece in enumerate(cut(packed, most=most))]
            columns = list(zip(*out)) or [[]] * 5
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    texts = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    return texts.mapInArrow(pieces, PIECE_SCHEMA)


def _running(column, order, by=()):
    """Sum of `column` in the rows before."""
    before = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(column).over(before), F.lit(0))


def sweep(pieces, gaps):
    """One round over runs of pieces (size, first rank, n) and of gaps (size, first sequence, n).

    Sizes are read from the largest to the smallest. A gap goes on top of those seen before, and a
    run of pieces takes from the top, which is its successor: the smallest free gap that holds it.
    Within two runs that meet, ranks decide which piece gets which sequence. Returns placements
    (size, first, n, sequence, gap), and the pieces and gaps that are left."""
    free, left, placed, smaller = [], [], [], []
    events = [(-size, 0, first, n) for size, first, n in gaps]
    events += [(-size, 1, first, n) for size, first, n in pieces]
    for size, is_piece, first, n in sorted(events):
        size = -size
        if not is_piece:
            free.append((size, first, n))
            continue
        while n and free:
            gap, sequence, room = free.pop()
            met = min(n, room)
            placed.append((size, first, met, sequence, gap))
            smaller.append((gap - size, sequence, met))
            first, n = first + met, n - met
            if room > met:
                free.append((gap, sequence + met, room - met))
        if n:
            left.append((size, first, n))
    return placed, left, free + [run for run in smaller if run[0]]


def opened(pieces, next_sequence, most):
    """New sequences for the longest pieces, as many as all the rest needs at least; called when no
    piece fits a gap, so that no packing could do with fewer."""
    need = -(-sum(size * n for size, _, n in pieces) // most)
    placed, left = [], []
    for size, first, n in sorted(pieces, reverse=True):
        take = min(n, need)
        if take:
            placed.append((size, first, take, next_sequence, most))
            need, next_sequence = need - take, next_sequence + take
        if n > take:
            left.append((size, first + take, n - take))
    gaps = [(most - size, sequence, n) for size, _, n, sequence, _ in placed if size < most]
    return placed, left, gaps, next_sequence


def place_runs(counts, most=SEQUENCE_TOKENS):
    """Placements (size, first, n, sequence, gap) of counted sizes: the pieces of that size with
    ranks from `first` on go to the n sequences from `sequence` on, at offset most - gap."""
    pieces, gaps, placements, next_sequence = [(size, 0, n) for size, n in counts], [], [], 0
    while pieces:
        placed, pieces, new, next_sequence = opened(pieces, next_sequence, most)
        placements += placed
        gaps += new
        while placed and pieces:
            placed, pieces, gaps = sweep(pieces, gaps)
            placements += placed
    return placements


def place_lengths(lengths, most=SEQUENCE_TOKENS):
    """`place_runs` of the table (length, n), which has at most `most` rows for any input."""

    def rounds(rows):
        placements = place_runs(list(zip(rows["length"].tolist(), rows["n"].tolist())), most)
        return pd.DataFrame(placements, columns=["size", "first", "n", "seq", "gap"], dtype="int64")

    return lengths.groupBy().applyInPandas(rounds, "size long, first long, n long, seq long, gap long")


def ranked_by_length(pieces, rank_rows=RANK_ROWS):
    """`rank` of a piece among those of its length, from 0, though one length may be most of them:
    counts of hashed parts of a length give each part its first rank."""
    parts = F.greatest(F.ceil(F.lit(pieces.count()) / rank_rows), F.lit(8))
    pieces = pieces.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece"), parts))
    sizes = pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    firsts = sizes.select("length", "part", _running("n", ["part"], ["length"]).alias("before"))
    order = Window.partitionBy("length", "part").orderBy("doc_id", "piece", "ids_crc32")
    ranked = pieces.withColumn("rank", F.row_number().over(order) - 1).join(firsts, ["length", "part"])
    return ranked.withColumn("rank", F.col("rank") + F.col("before")).drop("part", "before")


def pack(docs, tokenizer_path, id_col="doc_id", text_col="text", most=SEQUENCE_TOKENS):
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Only documents longer than a sequence are cut. Null and empty texts are one piece, the end id.
    Repeated rows are packed each; a null doc_id is a document like any other. An empty table gives
    no rows. Sequences have no gaps before their pieces.
    """
    tokenised = written(tokenised_pieces(docs, tokenizer_path, id_col, text_col, most), "pack-pieces")
    pieces = written(ranked_by_length(tokenised), "pack-ranks")
    discard(tokenised)
    lengths = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n"))
    lengths = written(lengths.coalesce(1), "pack-lengths")
    runs = written(place_lengths(lengths, most).coalesce(1), "pack-runs")
    discard(lengths)
    runs = runs.select(F.col("size").alias("of"), "first", "n", "seq", (F.lit(most) - F.col("gap")).alias("offset"))
    if runs.count() <= 200_000:  # some ten thousand in practice, at any number of documents
        runs = F.broadcast(runs)
    within = (F.col("length") == F.col("of")) & (F.col("rank") >= F.col("first"))
    joined = pieces.join(runs, within & (F.col("rank") < F.col("first") + F.col("n")))
    sequence = (F.col("seq") + F.col("rank") - F.col("first")).alias("sequence_id")
    return joined.select("doc_id", "piece", "start", "length", "ids_crc32", sequence, F.col("offset").cast("long"))
