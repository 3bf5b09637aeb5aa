"""Added tokens written out in a text, against the library as loaded."""

from __future__ import annotations

import zlib

import numpy as np

from headway.llm import packing
from headway.llm.queries import vocabulary_path

TEXTS = ["<|endoftext|> x", "a  <|endoftext|><|endoftext|>b", "x <|endoftext|>\n", "<|endoftext|>", "<|endoftext |>", "é  <|endoftext|>  汉", "plain", ""]


def test_document_ids_equal_the_unmodified_library():
    from tokenizers import Tokenizer

    other = Tokenizer.from_file(vocabulary_path())
    own = packing.ByteBpe(vocabulary_path())
    for text in TEXTS:
        assert np.frombuffer(own.document_ids(text), "<u4").tolist() == other.encode(text, add_special_tokens=False).ids, text


def test_pieces_hold_them(spark):
    docs = spark.createDataFrame([(1, "<|endoftext|> x")], "doc_id long, text string")
    (row,) = packing.pieces(docs, vocabulary_path()).collect()
    assert (row.length, row.ids_crc32) == (3, zlib.crc32(np.array([50256, 2124, 0], "<u4").tobytes()))
