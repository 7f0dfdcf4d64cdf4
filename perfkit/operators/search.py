"""Exact top-k retrieval by cosine similarity.

Every query is scored against every document of its version, exactly; pairs are
never materialised as rows. The plan:

1. Vectors of documents and queries are written to the shared folder (unless they are a stored
   table already) and counted there.
2. Documents are dealt into numbered parts and queries into numbered blocks, each of about
   ``max_block_bytes`` as a float64 matrix at most. Spark pairs every part with every block of its
   version; a task holds one pair at a time and scores it in tiles of at most ``TILE_CELLS`` scores. Its
   state is the top k of one block's queries. Nothing is collected or broadcast. Parts are counted from
   bytes alone, not from cores: every further part sends k more candidates per query.
3. ``row_number() <= k`` by ``(score desc, doc_id)``, first over groups of a
   query's candidates and then over ``(version, qid)``, merges the pairs' rows.

A vector that is null or not of its version's width, a queried version without a
width, declared or measured on documents, and an empty query set are errors. A
version of declared width without documents has no hits.

Scores are ``dot / sqrt(|q|^2 |d|^2)`` in float64, rounded to 9 decimals so equal
scores tie and break by ``doc_id`` (N10); a zero vector scores 0 (N14). For
integer counts every term is exact, so scores match other engines bit for bit.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perfkit.session import written

# Functions of this module run in Python workers; pickle them by value so workers
# need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

HIT_SCHEMA = "version string, qid bigint, doc_id bigint, score double"
ROUND = 9


#: Scores held at once by the kernel: queries x documents of one tile.
TILE_CELLS = 1 << 21
#: Squared lengths outside this range are not trusted to single precision.
PLAIN = (1e-100, 1e100)
#: A query with more than one in FEW documents of a tile near its k-th score is scored against all of them.
FEW = 64
#: Groups in the first merge of the tasks' candidates.
MERGE_PARTS = 64


def _lists(rows: pa.Table, col: str) -> tuple[np.ndarray, np.ndarray]:
    """(lengths, flat values) of a list column; a null list has length -1."""
    lists = rows.column(col).combine_chunks()
    lists = lists if isinstance(lists, pa.Array) else pa.concat_arrays(lists.chunks)
    lengths = lists.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    return lengths, lists.flatten().to_numpy(zero_copy_only=False)


def _matrix(rows: pa.Table, col: str, dim: int) -> np.ndarray:
    """Vectors as float64 rows. A vector that is missing or of another width than its version's is an
    error, never cut or padded."""
    if "indices" not in rows.column_names:
        lengths, flat = _lists(rows, col)
        wrong = np.flatnonzero(lengths != dim)
        if len(wrong):
            i = int(wrong[0])
            who = rows.column("doc_id" if "doc_id" in rows.column_names else "qid")[i].as_py()
            width = "no vector" if lengths[i] < 0 else f"{lengths[i]} dimensions"
            raise ValueError(f"version {rows.column('version')[i].as_py()}, id {who}: {width}, expected {dim}")
        return flat.astype(np.float64).reshape(len(rows), dim)
    lengths, at = _lists(rows, "indices")
    out = np.zeros((len(rows), dim), dtype=np.float64)
    out[np.repeat(np.arange(len(rows)), np.maximum(lengths, 0)), at] = _lists(rows, "counts")[1]
    return out


def _vector_dims(df: DataFrame) -> dict[str, int]:
    """Largest vector length per version (dense) or declared bucket count (sparse)."""
    if "indices" in df.columns:
        d = df.groupBy("version").agg(F.max(F.array_max("indices")).alias("d"))
        return {r["version"]: int(r["d"] or 0) + 1 for r in d.collect()}
    col = "embedding" if "embedding" in df.columns else "query_vec"
    d = df.groupBy("version").agg(F.max(F.size(col)).alias("d"))
    return {r["version"]: int(r["d"] or 0) for r in d.collect()}


def _merge_topk(best_s, best_i, s, ids, k):
    """Per-row top-k of ``[best | s]`` by (score desc, id asc)."""
    cs = np.concatenate([best_s, s], axis=1)
    ci = np.concatenate([best_i, np.broadcast_to(ids, s.shape)], axis=1)
    m = cs.shape[1]
    if m > k:
        kth = -np.partition(-cs, k - 1, axis=1)[:, k - 1:k]
        keep = cs >= kth
        counts = keep.sum(axis=1)
        if (counts == k).all():
            cs = cs[keep].reshape(len(cs), k)
            ci = ci[keep].reshape(len(ci), k)
        else:  # ties at the k-th score: keep every tied candidate, trimmed below
            width = int(counts.max())
            ns = np.full((len(cs), width), -np.inf)
            ni = np.full((len(cs), width), np.iinfo(np.int64).max, dtype=np.int64)
            for r in range(len(cs)):
                sel = np.nonzero(keep[r])[0]
                ns[r, : len(sel)] = cs[r, sel]
                ni[r, : len(sel)] = ci[r, sel]
            cs, ci = ns, ni
    order = np.lexsort((ci, -cs), axis=1)[:, :k]
    return np.take_along_axis(cs, order, 1), np.take_along_axis(ci, order, 1)


def _units(x: np.ndarray, squares: np.ndarray) -> np.ndarray:
    """Rows of length 1 in single precision; a zero row stays zero."""
    return (x / np.sqrt(np.where(squares > 0, squares, 1.0))[:, None]).astype(np.float32)


def _scores(dots: np.ndarray, squares: np.ndarray) -> np.ndarray:
    """Rounded cosines from products and products of the squared lengths; 0 where a vector is zero."""
    den = np.sqrt(squares)
    out = np.zeros_like(den)
    np.divide(dots, den, out=out, where=den > 0)
    return np.round(out, ROUND, out=out)


def _plain(squares: np.ndarray) -> bool:
    return bool(((squares == 0) | ((squares > PLAIN[0]) & (squares < PLAIN[1]))).all())


def _pair_kernel(k: int, dims: dict[str, int]):
    """Scores one part of the documents against one block of queries: top k per query.

    A pass in single precision leaves out what is below a query's k-th score by more than its error;
    what is left is scored in double precision.
    """

    def run(docs: pa.Table, queries: pa.Table) -> pa.Table:
        if not len(docs) or not len(queries):
            return pa.table({"version": pa.array([], pa.string()), "qid": pa.array([], pa.int64()),
                             "doc_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        version = queries.column("version")[0].as_py()
        dim = dims[version]
        q = _matrix(queries, "query_vec", dim)
        qn = np.einsum("ij,ij->i", q, q)
        margin = (dim + 8) * 2.0 ** -23  # twice the most that a cosine in single precision is off
        q_unit = _units(q, qn)
        best_s = np.full((len(q), k), -np.inf)
        best_i = np.full((len(q), k), np.iinfo(np.int64).max, dtype=np.int64)
        step = max(1, TILE_CELLS // max(256, dim))
        for lo in range(0, len(docs), step):
            part = docs.slice(lo, step)
            d = _matrix(part, "embedding", dim)
            dn = np.einsum("ij,ij->i", d, d)
            d_unit = _units(d, dn)
            ids = part.column("doc_id").to_numpy()
            plain = _plain(qn) and _plain(dn)
            rows = max(1, TILE_CELLS // len(d))
            for at in range(0, len(q), rows):
                near = q_unit[at:at + rows] @ d_unit.T
                floor = best_s[at:at + rows, -1] - margin
                if not np.isfinite(floor).all() and len(d) > k:
                    floor = np.maximum(floor, np.partition(near, -k, axis=1)[:, -k].astype(np.float64) - 2 * margin)
                open_cells = near >= np.float32(floor - margin)[:, None] if plain else np.ones(near.shape, dtype=bool)
                count = open_cells.sum(axis=1)
                few = np.flatnonzero((count > 0) & (count <= max(k, len(d) // FEW)))
                many = np.flatnonzero(count > max(k, len(d) // FEW))
                if len(few):
                    r, c = np.nonzero(open_cells[few])
                    s = np.empty(len(r))
                    for i in range(0, len(r), step):
                        j = slice(i, i + step)
                        s[j] = np.einsum("ij,ij->i", q[at + few[r[j]]], d[c[j]])
                    s = _scores(s, qn[at + few[r]] * dn[c])
                    place = np.arange(len(r)) - (np.cumsum(count[few]) - count[few])[r]
                    sc = np.full((len(few), int(count[few].max())), -np.inf)
                    who = np.full(sc.shape, np.iinfo(np.int64).max, dtype=np.int64)
                    sc[r, place], who[r, place] = s, ids[c]
                    best_s[at + few], best_i[at + few] = _merge_topk(best_s[at + few], best_i[at + few], sc, who, k)
                if len(many):
                    sc = _scores(q[at + many] @ d.T, np.outer(qn[at + many], dn))
                    best_s[at + many], best_i[at + many] = _merge_topk(best_s[at + many], best_i[at + many], sc,
                                                                       ids[None, :], k)
        real = np.isfinite(best_s)
        found = np.repeat(queries.column("qid").to_numpy(), real.sum(axis=1))
        return pa.table({"version": pa.array([version] * len(found), pa.string()), "qid": found,
                         "doc_id": best_i[real], "score": best_s[real]})

    return run


def _by_version(values: dict[str, int]) -> Column:
    out = F.lit(None).cast("int")
    for version, n in values.items():
        out = F.when(F.col("version") == version, n).otherwise(out)
    return out


def topk(docs: DataFrame, queries: DataFrame, k: int = 5, dims: dict[str, int] | None = None,
         max_block_bytes: int = 64 << 20, stored: bool = False) -> DataFrame:
    """Exact top-k documents per query and version: ``(version, qid, rank, doc_id, score)``.

    ``docs``: ``(version, doc_id, embedding)`` or ``(version, doc_id, indices, counts)``;
    ``queries``: ``(version, qid, query_vec)`` or ``(version, qid, indices, counts)``.
    ``dims`` is the vector width of each version (the version definitions); when
    omitted it is measured. ``stored`` says that ``docs`` is a stored table, cheap to read again.
    """
    qcols = ["version", "qid"] + (["indices", "counts"] if "indices" in queries.columns else ["query_vec"])
    dcols = ["version", "doc_id"] + (["indices", "counts"] if "indices" in docs.columns else ["embedding"])
    docs = docs.select(*dcols) if stored else written(docs.select(*dcols), "vectors")
    queries = written(queries.select(*qcols), "queries")
    if dims is None:
        dims = _vector_dims(docs)
        qdims = _vector_dims(queries)
        dims = {v: max(d, qdims.get(v, 0)) for v, d in dims.items()}
    # One row per version: versions are few names.
    wanted = {r["version"]: r["count"] for r in queries.groupBy("version").count().collect()}
    if not wanted:
        raise RuntimeError("no golden queries; load them first")
    held = {r["version"]: r["count"] for r in docs.groupBy("version").count().collect()}
    missing = set(wanted) - set(dims)
    if missing:
        raise ValueError(f"no documents or no width for version(s) {sorted(map(str, missing))}")
    blocks, parts = {}, {}
    wanted = {v: n for v, n in wanted.items() if held.get(v)}
    for version, n in wanted.items():
        width = 8 * max(1, dims[version])
        if width > max_block_bytes:
            raise ValueError(f"one query of version {version} needs {width} bytes, over the block of {max_block_bytes}")
        blocks[version] = -(-n * width // max_block_bytes)
        parts[version] = -(-held[version] * width // max_block_bytes)

    def dealt(df: DataFrame, key: str, own: tuple[str, dict], other: tuple[str, dict]) -> DataFrame:
        """Every row with its own number, once for each number of the other side."""
        return df.where(F.col("version").isin(*wanted)).withColumns({
            own[0]: F.pmod(F.xxhash64(key), _by_version(own[1])).cast("int"),
            other[0]: F.explode(F.sequence(F.lit(0), _by_version(other[1]) - 1))})

    cell = ["version", "part", "block"]
    left = dealt(docs, "doc_id", ("part", parts), ("block", blocks)).groupBy(*cell)
    right = dealt(queries, "qid", ("block", blocks), ("part", parts)).groupBy(*cell)
    hits = left.cogroup(right).applyInArrow(_pair_kernel(k, dims), HIT_SCHEMA)
    best = [F.desc("score"), "doc_id"]
    # Every pair sends up to k candidates per query: merge them in groups first.
    some = Window.partitionBy("version", "qid", "part").orderBy(*best)
    hits = (hits.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(MERGE_PARTS)))
            .withColumn("rank", F.row_number().over(some)).where(F.col("rank") <= k).drop("rank", "part"))
    w = Window.partitionBy("version", "qid").orderBy(*best)
    return (hits.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select("version", "qid", "rank", "doc_id", "score"))
