"""Packed ids against the tokenizer as it comes, special tokens in the text included."""

import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from logweir.llm import packing

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
TEXTS = ["a <|endoftext|> b", "A<|endoftext|>B", "<|startoftext|> It's x<|endoftext|><|endoftext|>.", "<|EndOfText|> Y", "<|endoftext|", "x\x01<|endoftext|> \x01", "no special"]


def test_special_tokens_have_the_plain_tokenizers_ids(spark):
    tokenizer, chunks = Tokenizer.from_file(TOKENIZER), packing.chunk_tokenizer(TOKENIZER)
    want = [tokenizer.encode(text, add_special_tokens=False).ids for text in TEXTS]
    assert [np.frombuffer(ids, "<u4").tolist() for ids in chunks.encode(TEXTS)] == want
    assert any(49407 in ids for ids in want)
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    crcs = {r.doc_id: r.ids_crc32 for r in packing.pack(docs, TOKENIZER).collect()}
    assert crcs == {n: zlib.crc32(np.array(ids + [0], "<u4").tobytes()) for n, ids in enumerate(want)}
