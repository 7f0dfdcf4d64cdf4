"""The dense projection against plain sums; vectors are added up by batches, not by expressions per element."""

import hashlib

import numpy as np
import pytest

from perfkit.operators import embed as em

V = {"a": 3, "b": 5}


def plain(version, vec, dim):
    out = []
    for j in range(1, dim + 1):
        total = 0.0
        for i, x in enumerate(vec, 1):
            total += x * (1.0 if hashlib.md5(f"{version}::{i}::{j}".encode()).hexdigest()[0] < "8" else -1.0)
        out.append(total)
    return out


@pytest.mark.parametrize("kind", ["float", "double"])
def test_projection_adds_up_in_order(spark, kind):
    rng = np.random.default_rng(1)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=5) * 10.0 ** rng.integers(-3, 4)]) for i in range(50)]
    rows += [(60, None), (61, [1.0, None, 2.0, 3.0, 4.0]), (None, [0.0] * 5)]
    df = spark.createDataFrame(rows, f"doc_id long, embedding array<{kind}>").coalesce(1)
    made = em.embed_dense(df, V, 5)
    assert made.schema["embedding"].dataType == df.schema["embedding"].dataType
    got = {(r["version"], r["doc_id"]): r["embedding"] for r in made.collect()}
    cast = (lambda v: [float(np.float32(x)) for x in v]) if kind == "float" else list
    for i, vec in rows:
        assert got["b", i] == vec
        want = None if vec is None else [None] * 3 if None in vec else cast(plain("a", vec, 3))
        assert got["a", i] == want
    assert "zip_with" not in made._jdf.queryExecution().toString()


def test_another_width_is_an_error(spark):
    df = spark.createDataFrame([(7, [1.0, 2.0])], "doc_id long, embedding array<float>")
    with pytest.raises(Exception, match="vector width of id 7 is not 5"):
        em.embed_dense(df, V, 5).collect()
