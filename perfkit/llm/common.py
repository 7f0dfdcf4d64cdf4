"""Helpers shared by the operators: table access, the shared folder, vectorised text passes.

Python-side passes work on an Arrow string column as one byte buffer with offsets, so words,
windows and rolling hashes are numpy expressions over the whole batch, not per-row loops.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from perfkit.session import checkpoint_dir

#: Text bytes handled at once by one vectorised pass; a longer single text is one slice by itself.
SLICE_BYTES = 2 << 20

#: Byte classes: word separators are space and the control characters 9 to 13.
SEPARATOR = np.zeros(256, dtype=bool)
SEPARATOR[[0x20, 9, 10, 11, 12, 13]] = True


def ship(module: str) -> None:
    """Pickle a module's functions by value: executors need no installed copy of this package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the folder that all executors share."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage and survives lost executors."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def extend(schema: StructType, ddl: str) -> StructType:
    return StructType(schema.fields + StructType.fromDDL(ddl).fields)


def text_key(text: Column) -> Column:
    """Tells rows with one id but different texts apart; equal rows have equal results."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def packed(docs: DataFrame) -> DataFrame:
    """doc_id, text, text_key, and the other columns in one struct, where their names clash with none."""
    others = [F.col(c) for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", text_key(F.col("text")).alias("text_key"),
                       (F.struct(*others) if others else F.lit(0)).alias("others"))


def unpacked(columns: list[str]) -> list[Column]:
    """The columns of a packed table by name."""
    return [F.col(c) if c in ("doc_id", "text") else F.col("others").getField(c).alias(c) for c in columns]


def match_rows(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Join on (doc_id, text_key), null ids included; the right side's keys are dropped."""
    r = right.withColumnRenamed("doc_id", "_rid").withColumnRenamed("text_key", "_rkey")
    return left.join(r, left["doc_id"].eqNullSafe(r["_rid"]) & (left["text_key"] == r["_rkey"]),
                     how).drop("_rid", "_rkey")


def small(df: DataFrame, rows: int) -> DataFrame:
    """Marked for broadcast only when it is counted to have at most ``rows`` rows."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def text_slices(batch: pa.RecordBatch, column: str,
                limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Row ranges of about ``limit`` text bytes: (rows, UTF-8 bytes, offsets). Null text is empty."""
    col = pc.fill_null(batch.column(column), "" if pa.types.is_string(batch.schema.field(column).type) else b"")
    if len(col) == 0:
        return
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    raw = col.buffers()
    off = np.frombuffer(raw[1], dtype=np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1]
    off = off.astype(np.int64)
    data = np.frombuffer(raw[2], dtype=np.uint8) if raw[2] is not None else np.zeros(0, np.uint8)
    i = 0
    while i < len(col):
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, side="right")) - 1)
        yield batch.slice(i, j - i), data[off[i]:off[j]], off[i:j + 1] - off[i]
        i = j


def word_spans(data: np.ndarray, offsets: np.ndarray,
               separator: np.ndarray = SEPARATOR) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and each row's first word index (len rows + 1)."""
    word = np.empty(len(data) + 1, dtype=bool)
    word[:-1] = ~separator[data]
    word[-1] = False
    before = np.zeros(len(data) + 1, dtype=bool)
    before[1:] = word[:-1]
    cut = offsets[:-1]
    before[cut] = False
    starts = np.flatnonzero(word & ~before)
    after = np.zeros(len(data), dtype=bool)
    after[:] = word[1:]
    ends_at = offsets[1:] - 1
    after[ends_at[ends_at >= 0]] = False
    ends = np.flatnonzero(word[:-1] & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


class RollingHash:
    """Polynomial hashes modulo 2**64 of any span of a sequence, from one prefix sum.

    ``seed`` picks the multiplier and the value table; two seeds give an independent pair.
    """

    _powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __init__(self, values: np.ndarray, seed: int):
        rng = np.random.default_rng(seed)
        base = int(rng.integers(1, 1 << 60)) * 8 + 3
        if values.dtype == np.uint8:
            values = rng.integers(0, 1 << 64, 256, dtype=np.uint64)[values]
        else:
            values = mix(values + rng.integers(0, 1 << 64, 1, dtype=np.uint64))
        up, down = self._table(seed, base, len(values) + 1)
        self.sums = np.zeros(len(values) + 1, dtype=np.uint64)
        np.cumsum(values * up[:len(values)], out=self.sums[1:])
        self.down = down

    @classmethod
    def _table(cls, seed: int, base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        have = cls._powers.get(seed)
        if have is None or len(have[0]) < n:
            size = max(n, 1 << 16)
            both = []
            for b in (base, pow(base, -1, 1 << 64)):
                p = np.full(size, b, dtype=np.uint64)
                p[0] = 1
                both.append(np.cumprod(p))
            have = (both[0], both[1])
            if size <= 2 * SLICE_BYTES:
                cls._powers[seed] = have
        return have

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.down[starts] + (ends - starts).astype(np.uint64))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and odd multiplications), wrapping."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive entries, by doubling."""
    m, have = x, 1
    while have * 2 <= width:
        m = np.minimum(m[:-have], m[have:])
        have *= 2
    if have < width:
        m = np.minimum(m[:len(m) - (width - have)], m[width - have:])
    return m


def anchor_runs(gram: np.ndarray, row_first: np.ndarray, span: int,
                width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Winnowing by runs. A window is ``span`` consecutive items of one row; its anchor is the
    leftmost least ``gram`` value among its first ``width`` positions, so equal windows have
    equal anchors wherever they stand. Returns (row, anchor, lo, hi), item indices into the
    batch: the windows that start in [lo, hi] have that anchor.
    """
    none = np.zeros(0, dtype=np.int64)
    total = int(row_first[-1])
    lengths = np.diff(row_first)
    if not (lengths >= span).any():
        return none, none, none, none
    key = (gram[:total] & np.uint64(0xFFFFFFFF00000000)) | np.arange(total, dtype=np.uint64)
    low = sliding_min(key, width)
    usable = np.maximum(lengths - span + 1, 0)
    rows = np.repeat(np.arange(len(lengths)), usable)
    begin = np.cumsum(usable) - usable
    starts = np.arange(int(usable.sum())) - np.repeat(begin, usable) + np.repeat(row_first[:-1], usable)
    anchor = (low[starts] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.ones(len(starts), dtype=bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (rows[1:] != rows[:-1])
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(starts)) - 1
    return rows[at], anchor[at], starts[at], starts[last]


def merge_spans(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of half-open intervals as maximal runs (touching intervals join)."""
    if len(starts) == 0:
        return starts, ends
    order = np.argsort(starts, kind="stable")
    s, e = starts[order], np.maximum.accumulate(ends[order])
    new = np.ones(len(s), dtype=bool)
    new[1:] = s[1:] > e[:-1]
    at = np.flatnonzero(new)
    return s[at], e[np.append(at[1:], len(s)) - 1]


ship(__name__)
