"""op10's encoder looks a batch's chunks up once each, and its ids are those of the library."""

import random

import numpy as np
import public_tokenizers as pt
import pyarrow as pa
from tokenizers import Tokenizer

from perfkit.llm import token_files
from perfkit.llm.common import text_slices

ARGS = (pt.path("byte_bpe_50k.json"), pt.PATTERN)
PARTS = ["a", "The", "foo", "foo", " ", " ", " ", "\n", ",", ".", "!", "|", "'s", "-", "3", "42", "é", "×", "÷", "À", "ɏ", "ɐ",
         "¡", "ª", "²", "\t", "  ", " ", "\u0080", "­", "漢", "𝒳", "<|endoftext|>", "\x00", "\x7f", "ǀ", "foo,bar"]


def encoded(encoder, texts, limit):
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])
    return [np.frombuffer(ids, encoder.width).tolist() for _, data, off in text_slices(batch, "text", limit)
            for ids in encoder.encode(data, off).to_pylist()]


def test_ids_are_those_of_the_library():
    rng = random.Random(5)
    texts = ["".join(rng.choices(PARTS[:rng.choice((9, 16, len(PARTS)))], k=rng.choice((0, 1, 2, 5, 12, 30))))
             for _ in range(4000)] + [None, "", " ", "\n", "\na", "a\n", "a ", "word " * 3000 + "end", "x" * 500]
    library = Tokenizer.from_file(ARGS[0])
    ids = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    for limit in (1, 300, token_files.ENCODE_BYTES):
        assert encoded(token_files.library_encoder(*ARGS), texts, limit) == ids


def test_a_chunk_is_looked_up_once_a_batch(monkeypatch):
    asked = []
    encoder = token_files.library_encoder(*ARGS)
    known = encoder.chunks

    class Counted(dict):
        def __getitem__(self, chunk):
            asked.append(chunk)
            return known[chunk]

    monkeypatch.setattr(encoder, "chunks", Counted())
    encoded(encoder, ["Stones by the river, by the sea"] * 500, token_files.ENCODE_BYTES)
    assert sorted(asked) == sorted([b"Stones", b" by", b" the", b" river", b",", b" sea"])


def test_groups_of_chunks_join_up(monkeypatch):
    texts = ["one two three", "", "four, five", "six"]
    whole = encoded(token_files.library_encoder(*ARGS), texts, token_files.ENCODE_BYTES)
    monkeypatch.setattr(token_files, "LOOK_UP", 2)
    assert encoded(token_files.library_encoder(*ARGS), texts, token_files.ENCODE_BYTES) == whole
