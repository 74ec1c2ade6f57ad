"""Counts against the unigram model of the ``tokenizers`` library."""

import os
import random

import pytest
from tokenizers import Tokenizer, models, pre_tokenizers

from plumbline.llm.queries import PIECES
from plumbline.llm.token_counts import count_tokens, piece_counter, read_pieces


def library(pieces, unknown_id, byte_fallback):
    tokenizer = Tokenizer(models.Unigram(pieces, unknown_id, byte_fallback))
    tokenizer.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    return lambda text: len(tokenizer.encode(text, add_special_tokens=False).ids)


def test_ties_and_unknown_characters():
    rng = random.Random(6)
    for seed in range(60):
        letters = "ab▁é😀"
        pieces = {"<unk>": 0.0}
        for _ in range(rng.randrange(2, 25)):
            pieces["".join(rng.choice(letters) for _ in range(rng.randrange(1, 5)))] = float(-rng.randrange(1, 5))
        fallback = bool(seed % 2)
        if fallback:
            pieces |= {f"<0x{b:02X}>": -9.0 for b in range(256)}
        vocabulary = list(pieces.items())
        expected, count = library(vocabulary, 0, fallback), piece_counter(vocabulary, 0, fallback)
        for _ in range(60):
            text = "".join(rng.choice("aaabbb é😀▁z") for _ in range(rng.randrange(1, 14)))
            assert count(text) == expected(text), (text, pieces)


@pytest.mark.skipif(not os.path.exists(PIECES), reason="no tokenizer file")
def test_public_vocabulary(spark):
    pieces = read_pieces(PIECES)
    texts = [None, "", " ", "  ", "a", " leading", "trailing ", "two  spaces\nand\tlines", "naïve 日本語 😀 <s> <unk> x", "word " * 20_000, "x" * 3_000]
    texts += [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, n_tokens string")
    expected = library(pieces, 0, True)
    for r in count_tokens(docs, pieces).collect():
        assert r.n_tokens == (expected(texts[r.doc_id]) if texts[r.doc_id] else 0), texts[r.doc_id]
    assert count_tokens(docs.limit(0), pieces).count() == 0
