"""Removal of byte strings that occur more than once, by distributed prefix doubling.

A suffix array over every byte would take several times the input per sorting round, so the
positions that are ranked are a locally consistent sample: each window of ``span`` bytes has an
anchor (the least hash of GRAM bytes among its first WIDTH ones), and equal windows have equal
anchors at equal offsets. Rounds compare longer and longer strings around the anchors by pairs
of ranks (fingerprints) at growing offsets, and drop what has become unique:

1. bytes [0, 100) and [100, 200) after the anchor, as one pair: anchors with a unique pair go;
2. the windows of an anchor, ordered by their offset to it, are cut into aligned blocks of 128. A
   block's union is the string that all its windows cover together, its core what they share.
   A repeated union settles all of the block's windows as repeated, a unique core as unique;
3. blocks of neither kind are halved three times over, to blocks of 16, and settled likewise;
4. what is left is compared window by window.

A settled block still stands for its string in later rounds if an open one has the same core: one
copy per distinct union does. Ranks are grouped by partially aggregated counts and joined back,
so a string with very many copies never gathers in one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perfkit.llm.common import (RollingHash, anchor_runs, extend, match_rows, merge_spans, ship, stored, text_key,
                                text_slices)

SPAN = 400
WIDTH = 200
GRAM = 16
BLOCKS = (128, 16, 1)


def _block_hashes(h: RollingHash, anchor, row_lo, row_hi, x, size: int, span: int):
    """Union and core of the blocks of windows that start x .. x + size - 1 bytes before an anchor,
    with a mask of the unions that lie within their row."""
    a, b = anchor - x - (size - 1), anchor - x + span
    inside = (a >= row_lo) & (b <= row_hi)
    union = h.spans(np.where(inside, a, 0), np.where(inside, b, 0))
    c, d = anchor - x, anchor - x - (size - 1) + span
    return union, inside, h.spans(np.clip(c, row_lo, row_hi), np.clip(d, row_lo, row_hi))


def positions(docs: DataFrame, span: int = SPAN) -> DataFrame:
    """The ranked positions of every row: (doc_id, text_key, at, from, to, head, next, and union and
    core of up to two blocks); windows that start from..to bytes before ``at`` belong to it."""
    size = BLOCKS[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, off in text_slices(batch, "text"):
                n = len(data)
                h = RollingHash(data, 31)
                at = np.arange(max(0, n - GRAM + 1))
                gram = np.concatenate([h.spans(at, at + GRAM), np.zeros(n - len(at), dtype=np.uint64)])
                row, anchor, lo, hi = anchor_runs(gram, off, span, WIDTH)
                near, far = anchor - hi, anchor - lo
                half = (span - WIDTH) // 2
                cols = [rows.column("doc_id").take(pa.array(row)), rows.column("text_key").take(pa.array(row)),
                        pa.array((anchor - off[row]).astype(np.int32)), pa.array(near.astype(np.int16)),
                        pa.array(far.astype(np.int16)),
                        pa.array(h.spans(anchor, anchor + half).view(np.int64)),
                        pa.array(h.spans(anchor + half, anchor + 2 * half).view(np.int64))]
                for x in (0, size):
                    used = (near < x + size) & (far >= x)
                    u, inside, c = _block_hashes(h, anchor, off[row], off[row + 1], x, size, span)
                    cols += [pa.array(u.view(np.int64), mask=~(used & inside)),
                             pa.array(c.view(np.int64), mask=~used)]
                yield pa.RecordBatch.from_arrays(cols, names=schema.fieldNames())

    src = docs.select("doc_id", text_key(F.col("text")).alias("text_key"), "text")
    schema = extend(src.drop("text").schema, "at int, from smallint, to smallint, head long, next long, "
                                             "u0 long, c0 long, u1 long, c1 long")
    return src.mapInArrow(run, schema)


def _settle(blocks: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """One round over (doc_id, text_key, at, x, from, to, own, u, c): the own blocks settled as
    repeated, and the blocks that the next round needs."""
    unions = (blocks.where("u IS NOT NULL").groupBy("x", "u")
              .agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "text_key", "at")).alias("one"))
              .where("n > 1").select(F.col("x").alias("ux"), F.col("u").alias("uu"), "one"))
    cores = (blocks.groupBy("x", "c").agg(F.count("*").alias("n")).where("n > 1")
             .select(F.col("x").alias("cx"), F.col("c").alias("cc")))
    # Written before they are joined: the joins can then split a string with very many copies.
    unions, cores = stored(unions, "unions"), stored(cores, "cores")
    marked = (blocks.join(cores, (F.col("x") == F.col("cx")) & (F.col("c") == F.col("cc")), "left_semi")
              .join(unions, (F.col("x") == F.col("ux")) & (F.col("u") == F.col("uu")), "left"))
    me = F.struct("doc_id", "text_key", "at")
    marked = stored(marked.withColumn("repeated", F.col("one").isNotNull())
                    .withColumn("stands", F.col("one").eqNullSafe(me)).drop("one", "ux", "uu"), f"blocks-{size}")
    open_own = marked.where("own AND NOT repeated")
    open_cores = stored(open_own.select(F.col("x").alias("cx"), F.col("c").alias("cc")).distinct(), "open")
    rest = (marked.where("(NOT own AND NOT repeated) OR stands")
            .join(open_cores, (F.col("x") == F.col("cx")) & (F.col("c") == F.col("cc")), "left_semi")
            .withColumn("own", F.lit(False))
            # What stands for others shows all its windows, not only those of its own anchor.
            .withColumn("from", F.col("x")).withColumn("to", (F.col("x") + size - 1).cast("smallint")))
    return marked.where("own AND repeated"), open_own.unionByName(rest).drop("u", "c", "repeated", "stands")


def _contexts(docs: DataFrame, blocks: DataFrame, span: int) -> DataFrame:
    """The bytes around each block: ``body``, in which the anchor is at ``mid``."""
    size = BLOCKS[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, off in text_slices(batch, "text"):
                asked = rows.column("asked")
                row = np.repeat(np.arange(len(asked)), asked.value_lengths().to_numpy())
                asked = asked.flatten()
                at = off[row] + asked.field("at").to_numpy()
                x = asked.field("x").to_numpy().astype(np.int64)
                a = np.maximum(at - x - (size - 1), off[row])
                b = np.minimum(at - x + span, off[row + 1])
                raw = data.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id").take(pa.array(row)), rows.column("text_key").take(pa.array(row))]
                    + [asked.field(c) for c in ("at", "x", "from", "to", "own")]
                    + [pa.array([raw[i:j] for i, j in zip(a, b)], pa.binary()), pa.array((at - a).astype(np.int32))],
                    names=schema.fieldNames())

    per_row = blocks.groupBy("doc_id", "text_key").agg(
        F.collect_list(F.struct("at", "x", "from", "to", "own")).alias("asked"))
    src = docs.select("doc_id", text_key(F.col("text")).alias("text_key"), "text")
    schema = extend(src.drop("text").schema,
                    "at int, x smallint, from smallint, to smallint, own boolean, body binary, mid int")
    return match_rows(src, per_row, "inner").mapInArrow(run, schema)


def _smaller(contexts: DataFrame, size: int, span: int) -> DataFrame:
    """The blocks of ``size`` in each block's from..to, with union and core taken from its bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, off in text_slices(batch, "body"):
                h = RollingHash(data, 31)
                lo = rows.column("from").to_numpy().astype(np.int64)
                hi = rows.column("to").to_numpy().astype(np.int64)
                first = lo // size
                count = hi // size - first + 1
                row = np.repeat(np.arange(len(count)), count)
                x = (np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count) + first[row]) * size
                mid = off[row] + rows.column("mid").to_numpy()[row]
                u, inside, c = _block_hashes(h, mid, off[row], off[row + 1], x, size, span)
                pick = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(k).take(pick) for k in ("doc_id", "text_key", "at", "own")]
                    + [pa.array(x.astype(np.int16)), pa.array(np.maximum(x, lo[row]).astype(np.int16)),
                       pa.array(np.minimum(x + size - 1, hi[row]).astype(np.int16)),
                       pa.array(u.view(np.int64), mask=~inside), pa.array(c.view(np.int64))],
                    names=schema.fieldNames())

    schema = extend(contexts.select("doc_id", "text_key", "at", "own").schema,
                    "x smallint, from smallint, to smallint, u long, c long")
    return contexts.mapInArrow(run, schema)


def repeated_spans(docs: DataFrame, span: int = SPAN) -> DataFrame:
    """(doc_id, text_key, spans): byte ranges [from, to) of windows that occur elsewhere too."""
    docs = docs.select("doc_id", "text").withColumn("text", F.coalesce("text", F.lit("")))
    ranked = positions(docs, span)
    pairs = ranked.groupBy("head", "next").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    held = stored(ranked.join(stored(pairs, "pairs"), ["head", "next"], "left_semi").drop("head", "next"), "ranked")

    size = BLOCKS[0]
    both = F.array(*[F.struct(F.lit(x).cast("smallint").alias("x"), F.col(f"u{i}").alias("u"),
                              F.col(f"c{i}").alias("c")) for i, x in enumerate((0, size))])
    blocks = (held.select("doc_id", "text_key", "at", "from", "to", F.explode(both).alias("b"))
              .select("doc_id", "text_key", "at", "b.x", F.greatest("from", "b.x").alias("from"),
                      F.least("to", (F.col("b.x") + size - 1).cast("smallint")).alias("to"),
                      F.lit(True).alias("own"), "b.u", "b.c").where("c IS NOT NULL"))
    settled, left = _settle(blocks, BLOCKS[0])
    done = [settled]
    contexts = stored(_contexts(docs, left, span), "contexts")
    settled, left = _settle(_smaller(contexts, BLOCKS[1], span), BLOCKS[1])
    done.append(settled)

    keys = ["doc_id", "text_key", "at", "x"]
    ask = left.withColumn("_x", F.col("x") - F.col("x") % size).groupBy("doc_id", "text_key", "at", "_x").agg(
        F.collect_list(F.struct("x", "from", "to", "own")).alias("parts"))
    ask = ask.select(*[F.col(c).alias(f"r_{c}") for c in keys[1:3]], F.col("doc_id").alias("r_doc_id"), "_x", "parts")
    parts = contexts.drop("from", "to", "own").join(
        ask, F.col("doc_id").eqNullSafe(F.col("r_doc_id")) & (F.col("text_key") == F.col("r_text_key"))
        & (F.col("at") == F.col("r_at")) & (F.col("x") == F.col("_x")))
    parts = parts.select("doc_id", "text_key", "at", "body", "mid", F.explode("parts").alias("p"))
    single = stored(_smaller(parts.select("doc_id", "text_key", "at", "p.own", "p.from", "p.to", "body", "mid"),
                             1, span).drop("u"), "windows")
    twice = single.groupBy("x", "c").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    done.append(single.where("own").join(stored(twice, "twice"), ["x", "c"], "left_semi"))

    spans = [d.select("doc_id", "text_key", (F.col("at") - F.col("to")).alias("from"),
                      (F.col("at") - F.col("from") + span).alias("to")) for d in done]
    found = spans[0].unionByName(spans[1]).unionByName(spans[2])
    return found.groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("from", "to")).alias("spans"))


def suffix_dedup(docs: DataFrame, span: int = SPAN, keep: bool = False) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_bytes, n_removed, n_spans (maximal removed runs),
    kept_sha256 and, with ``keep``, kept (the remaining bytes) and removed (the runs).

    Null and empty texts have no bytes. Repeated rows are places like any other, so a text of
    ``span`` bytes or more that occurs in two rows is removed from both, null doc_ids included.
    Extra columns are not carried. Empty table: empty result.
    """
    schema = extend(docs.select("doc_id").schema, "n_bytes long, n_removed long, n_spans long, kept_sha256 string"
                    + ", kept binary, removed array<struct<start: long, stop: long>>" * keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, off in text_slices(batch, "text"):
                spans = rows.column("spans")
                bounds = np.concatenate([[0], np.cumsum(spans.value_lengths().fill_null(0).to_numpy())])
                flat = spans.flatten()
                lo = flat.field("from").to_numpy(zero_copy_only=False).astype(np.int64)
                hi = flat.field("to").to_numpy(zero_copy_only=False).astype(np.int64)
                raw = memoryview(data.tobytes())
                out = {c: [] for c in schema.fieldNames()[1:]}
                for i in range(rows.num_rows):
                    mine = raw[off[i]:off[i + 1]]
                    s, e = merge_spans(lo[bounds[i]:bounds[i + 1]], hi[bounds[i]:bounds[i + 1]])
                    edges = [0, *np.stack([s, e], axis=1).ravel().tolist(), len(mine)]
                    digest, kept = hashlib.sha256(), []
                    for a, b in zip(edges[::2], edges[1::2]):
                        digest.update(mine[a:b])
                        if keep:
                            kept.append(mine[a:b])
                    out["n_bytes"].append(len(mine))
                    out["n_removed"].append(int((e - s).sum()))
                    out["n_spans"].append(len(s))
                    out["kept_sha256"].append(digest.hexdigest())
                    if keep:
                        out["kept"].append(b"".join(kept))
                        out["removed"].append([{"start": a, "stop": b} for a, b in zip(s.tolist(), e.tolist())])
                kinds = {"kept_sha256": pa.string(), "kept": pa.binary(),
                         "removed": pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))}
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id")] + [pa.array(v, kinds.get(c, pa.int64())) for c, v in out.items()],
                    names=schema.fieldNames())

    left = docs.select("doc_id", text_key(F.col("text")).alias("text_key"), "text")
    return match_rows(left, repeated_spans(docs, span), "left").drop("text_key").mapInArrow(run, schema)


ship(__name__)
