"""Encoders are made once per process and never travel with the functions that use them."""

import public_tokenizers as pt

from perfkit.llm import byte_bpe
from perfkit.session import worker_cache

ARGS = (pt.path("byte_bpe_multi_50k.tiktoken"), pt.PATTERN)


def test_an_encoder_of_the_driver_does_not_travel(spark):
    own = byte_bpe.encoder(*ARGS)
    ids = b"".join(own.encode("Stones by the river"))
    docs = spark.createDataFrame([(1, "Stones by the river")], "doc_id long, text string")
    row = byte_bpe.bpe_roundtrip(docs, *ARGS, keep_ids=True).first()
    assert b"".join(i.to_bytes(4, "little") for i in row["ids"]) == ids
    assert row["decoded"] == b"Stones by the river"


def test_an_encoder_outlasts_the_function_that_made_it():
    assert worker_cache()["byte encoders"][ARGS] is byte_bpe.encoder(*ARGS)
