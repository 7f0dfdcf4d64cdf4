"""Versioned embedders and the version build.

Two built-in embedders and a plug-in:

* dense projection (Arrow batches): a version sums all dimensions of a source vector, with hashed
  signs, into ``d`` outputs;
* hashed text (Arrow batches): a version hashes tokens into ``dim`` buckets and counts them;
* user models (Arrow batches).

Every version is built in one pass over the input, so the text is read once however many versions
there are. No embedder groups, joins or repartitions.
Dense vectors are stored as given (float32) and sparse ones as integer counts;
cosine normalisation (F9) happens in double when scoring, which keeps scores
exact for integer counts.
"""

from __future__ import annotations

import hashlib
import sys
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perfkit.functions import text_hash as th
from perfkit.functions.vectors import l2_normalize
from perfkit.session import worker_cache


# Functions of this module run in Python workers; pickle them by value so workers
# need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

def doc_text(docs: DataFrame) -> DataFrame:
    """``(doc_id, text)`` with text = title, newline, body."""
    return docs.select("doc_id", F.concat(F.coalesce("title", F.lit("")), F.lit("\n"), F.coalesce("body", F.lit(""))).alias("text"))


def _signs(version: str, dim: int, width: int) -> np.ndarray:
    """The projection of a version: ``width`` rows of ``dim`` signs, + where the md5 of
    ``version::input::output`` (from 1) begins with a hex digit below 8."""
    return np.array([[1.0 if hashlib.md5(f"{version}::{i}::{j}".encode()).hexdigest()[0] < "8" else -1.0
                      for j in range(1, dim + 1)] for i in range(1, width + 1)])


def embed_dense(df: DataFrame, versions: dict[str, int], width: int, id_col: str = "doc_id",
                vec_col: str = "embedding") -> DataFrame:
    """Dense projection embedder: ``(version, doc_id, embedding)`` per version.

    Every version reads all ``width`` dimensions of the source vector. A version of that width is
    the vector itself; any other is its product with a matrix of hashed signs, one sum per output
    (cosines are about kept, the better the more outputs), added up in double in the order of the
    dimensions. The element type stays. A vector of another width is an error, a null vector stays
    null, and a null element makes every sum null.
    """
    signs = {v: _signs(v, dim, width) for v, dim in versions.items() if dim != width}

    def embed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, vec = batch.column("doc_id"), batch.column("embedding")
            missing = np.asarray(vec.is_null())
            wrong = np.flatnonzero(vec.value_lengths().fill_null(width).to_numpy(zero_copy_only=False) != width)
            if len(wrong):
                raise ValueError(f"vector width of id {ids[int(wrong[0])].as_py()} is not {width}")
            flat = vec.flatten()
            holes = np.asarray(flat.is_null()).reshape(-1, width).any(axis=1)
            x = flat.cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, width)
            for version, dim in versions.items():
                out = vec
                if dim != width:
                    total = np.zeros((len(x), dim))
                    for i in range(width):
                        total += x[:, i:i + 1] * signs[version][i]
                    sums = pa.array(total.ravel(), mask=np.repeat(holes, dim)).cast(vec.type.value_type, safe=False)
                    ends = np.concatenate([[0], np.cumsum(~missing * dim)]).astype(np.int32)
                    out = pa.ListArray.from_arrays(pa.array(ends), sums, mask=pa.array(missing))
                yield pa.RecordBatch.from_arrays([pa.array([version] * len(batch), pa.string()), ids, out],
                                                 names=["version", "doc_id", "embedding"])

    src = df.select(F.col(id_col).alias("doc_id"), F.col(vec_col).alias("embedding"))
    types = [src.schema[c].dataType.simpleString() for c in src.columns]
    return src.mapInArrow(embed, f"version string, doc_id {types[0]}, embedding {types[1]}")


#: Tokens that a worker keeps with their buckets, about.
HELD_TOKENS = 300_000
#: Bytes of a text split at a time.
SLICE = 1 << 20


class Buckets(dict):
    """Token -> number; ``of[version][number]`` is its bucket. A token is hashed when first seen."""

    def __init__(self, versions: dict[str, int]):
        super().__init__()
        self.hashed = [(f"{v}{th.SEP}".encode(), d) for v, d in versions.items()]
        self.of = np.zeros((len(versions), 1024), dtype=np.int32)

    def __missing__(self, token: bytes) -> int:
        number = len(self)
        if number == self.of.shape[1]:
            self.of = np.concatenate([self.of, np.zeros_like(self.of)], axis=1)
        for i, (prefix, dim) in enumerate(self.hashed):
            self.of[i, number] = int.from_bytes(hashlib.md5(prefix + token).digest()[:4], "big") % dim
        self[token] = number
        return number

    def numbers(self, tokens: Counter) -> np.ndarray:
        """Numbers of a text's tokens, valid until the next call: a full table starts anew between texts."""
        if len(self) >= HELD_TOKENS:
            self.clear()
        return np.fromiter(map(self.__getitem__, tokens), dtype=np.int64, count=len(tokens))


def token_counts(text: str) -> Counter:
    """Occurrences of each token; a text without tokens has one empty token."""
    data = text.encode()
    if len(data) <= SLICE:
        return Counter(data.split() or (b"",))
    found, at = Counter(), 0
    while at < len(data):
        end = data.find(b" ", at + SLICE)
        end = len(data) if end < 0 else end
        found.update(data[at:end].split())
        at = end
    return found or Counter((b"",))


def embed_text(df: DataFrame, versions: dict[str, int], id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """Hashed-text embedder: ``(version, doc_id, indices, counts)``, indices ascending.

    A document's tokens are all in its row, so its sparse vectors are built inside the row, with no
    shuffle: its distinct tokens are counted once, each is hashed once per version (and looked up when
    it comes again), and the counts of a bucket are added. Null texts have no vector.
    """
    def embed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = worker_cache().setdefault(("buckets", *versions.items()), Buckets(versions))
        for batch in batches:
            indices, counts = [[] for _ in versions], [[] for _ in versions]
            for text in batch.column("text"):
                tokens = token_counts(text.as_py())
                numbers = table.numbers(tokens)
                times = np.fromiter(tokens.values(), dtype=np.int64, count=len(tokens))
                for i in range(len(versions)):
                    total = np.bincount(table.of[i, numbers], weights=times)  # sums below 2 ** 53 are exact
                    at = np.flatnonzero(total)
                    indices[i].append(at.astype(np.int32))
                    counts[i].append(total[at].astype(np.int64))
            for i, version in enumerate(versions if len(batch) else ()):
                ends = pa.array(np.cumsum([0, *map(len, indices[i])]).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([version] * len(batch), pa.string()), batch.column("doc_id"),
                     *(pa.ListArray.from_arrays(ends, pa.array(np.concatenate(x))) for x in (indices[i], counts[i]))],
                    names=["version", "doc_id", "indices", "counts"])

    src = df.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(embed, f"version string, doc_id {kind}, indices array<int>, counts array<bigint>")


#: Models that a worker keeps.
HELD_MODELS = 8


def embed_with(df: DataFrame, versions: dict[str, object], id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """X1 plug-in: embed with user models, ``(version, doc_id, embedding array<float>)``.

    ``versions`` maps a version name to a factory ``() -> model`` where
    ``model(list[str]) -> array-like (n, dim)``. All versions come from one pass over the texts, a
    batch at a time (a null text is an empty one). A factory runs once per Python worker process; the
    worker keeps the model for later tasks.
    """
    key = uuid.uuid4().hex  # models of one call are not those of another

    def embed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = worker_cache().setdefault("models", {})
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for version, factory in versions.items():
                if (key, version) not in held:
                    while len(held) >= max(HELD_MODELS, len(versions)):
                        held.pop(next(iter(held)))
                    held[key, version] = factory()
                made = held[key, version](texts)
                rows = [np.asarray(v, dtype=np.float32) for v in made]
                if len(rows) != len(texts):
                    raise ValueError(f"version {version}: {len(rows)} vectors for {len(texts)} texts")
                ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
                flat = pa.array(np.concatenate(rows) if rows else np.zeros(0, np.float32))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([version] * len(batch), pa.string()), batch.column("doc_id"),
                     pa.ListArray.from_arrays(pa.array(ends), flat)], names=["version", "doc_id", "embedding"])

    src = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(embed, f"version string, doc_id {kind}, embedding array<float>")


def normalized_dense(vectors: DataFrame) -> DataFrame:
    """F9 applied to stored dense vectors: ``(version, doc_id, embedding array<double>)``."""
    return vectors.select("version", "doc_id", l2_normalize(F.col("embedding")).alias("embedding"))


def exploded(vectors: DataFrame) -> DataFrame:
    """Long form ``(version, doc_id, pos, weight)`` of dense or sparse vectors."""
    if "embedding" in vectors.columns:
        return vectors.select("version", "doc_id",
                              F.posexplode("embedding").alias("pos", "weight"))
    z = vectors.select("version", "doc_id", F.explode(F.arrays_zip("indices", "counts")).alias("z"))
    return z.select("version", "doc_id", F.col("z.indices").alias("pos"),
                    F.col("z.counts").cast("double").alias("weight"))


def build_rows(vectors: DataFrame, built_at: int) -> DataFrame:
    """One ``builds`` row per version: ``(version, built_at, doc_count)``."""
    return vectors.groupBy("version").agg(F.count("*").alias("doc_count")) \
                  .select("version", F.lit(int(built_at)).cast("bigint").alias("built_at"), "doc_count")


def build_version(docs: DataFrame, versions: dict[str, int], built_at: int,
                  kind: str = "text", width: int | None = None) -> tuple[DataFrame, DataFrame]:
    """V1: embed every document under each version; returns ``(vectors, builds)``.

    An empty input is an error, as in the reference. ``kind`` is ``text`` (docs
    with ``doc_id, text``) or ``dense`` (``doc_id, embedding`` of ``width`` dimensions).
    """
    if docs.isEmpty():
        raise ValueError("no documents to index")
    vec = embed_text(docs, versions) if kind == "text" else embed_dense(docs, versions, width)
    return vec, build_rows(vec, built_at)
