"""Documents to packed sequences: quality, exact and near duplicates, mixing, packing.

STAGES are (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame, which
is written as Parquet and read again as the next one's docs. All but the last return the columns
they were given, whatever they are called; an empty table stays empty."""

import public_tokenizers

from logweir.llm.common import discard, kept, scratch, table, written
from logweir.llm.exact_dedup import drop_exact_duplicates
from logweir.llm.mixing import mixed_documents
from logweir.llm.packing import pack
from logweir.llm.quality import keep_good
from logweir.llm.simhash import drop_near_duplicates

TOKENIZER = "word_bpe_49k.json"
#: Near duplicates: four-word shingles, fingerprints that differ in at most four bits.
NEAR = {"shingle": 4, "max_bits": 4}


def quality(spark, docs, sf_dir):
    """Documents that the classifier rejects go. Null text counts as empty; rows that share an id
    are each judged by their own text."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark, docs, sf_dir):
    """Of equal texts the one with the largest id stays. Null text equals empty text; null ids
    count as the smallest."""
    return drop_exact_duplicates(docs)


def near_dedup(spark, docs, sf_dir):
    """Of each group of linked fingerprints the document with the smallest id stays. Null and empty
    texts are one group; null ids count as the largest; an empty table stays empty."""
    return drop_near_duplicates(docs, **NEAR)


def mix_sources(spark, docs, sf_dir):
    """Documents as often as the mix takes them, repeated rows each by itself. Null is a source
    like any other; documents without words come as often as the whole part of its share."""
    return mixed_documents(docs)


def packing(spark, docs, sf_dir):
    """The pieces of the documents in their sequences. Null text is empty: one closing token."""
    return pack(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality", quality),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("packing", packing),
]

#: Models, fingerprints and draws by hash aren't SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The stages in turn; what a stage wrote goes when the next one has written its result."""
    docs, before = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        with scratch() as tables:
            docs = kept(tables, written(stage(spark, docs, sf_dir), f"pipeline-{name}"))
        discard(*before)
        before = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)
