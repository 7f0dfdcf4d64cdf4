"""Divergence of the sources of a language, on run-length columns.

Terms are counted per (language, source) in one pass. A language's vocabulary is then reordered so
that terms with equal counts stand together (a range sort by their counts per source), cut into
shards, and every source's counts over a shard become a column of runs. Two sources are compared on
the intersection of their runs: the divergence of a pair of counts is worked out once and multiplied
by the length of the stretch. All arithmetic is on integers and exact.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perfkit.llm.common import ship, stored

#: Bytes that end a term: ASCII but for letters; A-Z becomes a-z.
TERM = bytes(b if b >= 0x80 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
MIN_DOCS = 3
UNIT = 1_000_000_000
#: Terms, and counts other than zero, of a shard at most.
SHARD_TERMS, SHARD_COUNTS = 1 << 15, 1 << 20
#: Sources of a language that are compared in one task with as many others.
BLOCK = 32
#: Ranks of the most overrepresented terms that are reported.
TOP_TERMS = 200
#: Distinct (language, source, term) that a task holds before it hands its counts on.
HELD_TERMS = 300_000
#: Bytes of a text split at a time.
STREAM = 1 << 20


def terms(text: str) -> Iterator[list[bytes]]:
    """Lower-cased terms of a text in UTF-8, some at a time."""
    data = text.encode().translate(TERM)
    at = 0
    while at < len(data):
        end = data.find(b" ", at + STREAM) if len(data) - at > STREAM else -1
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences, and rows that have the term."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], dict[bytes, list[int]]] = {}
        size = 0

        def flush() -> pa.RecordBatch:
            lang, source, term, n, rows = [], [], [], [], []
            for (a, b), of in held.items():
                lang += [a] * len(of)
                source += [b] * len(of)
                term += of
                n += [x[0] for x in of.values()]
                rows += [x[1] for x in of.values()]
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(lang, pa.string()), pa.array(source, pa.string()), pa.array(term, pa.binary()).cast(pa.string()),
                 pa.array(n, pa.int64()), pa.array(rows, pa.int64())], names=["lang", "source", "term", "n", "docs"])

        for batch in batches:
            for lang, source, text in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(),
                                          batch.column("text")):
                of = held.setdefault((lang, source), {})
                size -= len(of)
                slices = terms(text.as_py())
                row = Counter(next(slices, []))
                for more in slices:
                    row.update(more)
                for term, n in row.items():
                    have = of.get(term)
                    if have is None:
                        of[term] = [n, 1]
                    else:
                        have[0] += n
                        have[1] += 1
                size += len(of)
                if size > HELD_TERMS:
                    yield flush()
                    size = 0
        if size:
            yield flush()

    counted = docs.mapInArrow(count, "lang string, source string, term string, n long, docs long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(n: Column, total: Column, size: Column) -> Column:
    """1 + floor(UNIT * (n + 1) / (total + size)), exactly: the product may exceed 64 bits."""
    wide = F.lit(UNIT).cast("decimal(10,0)") * (n + 1).cast("decimal(20,0)")
    return F.call_function("div", wide, (total + size).cast("decimal(20,0)")) + 1


def divergence(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def run_columns(kept: DataFrame) -> DataFrame:
    """(lang, shard, n_terms, gid, ends, counts) for ``kept`` (lang, counts: [(gid, n)] by gid): the
    runs of every group that has terms in the shard. A run ends before the position in ``ends``."""

    def columns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, made, lang = TaskContext.get().partitionId() << 32, 0, None
        gids: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        sizes: list[np.ndarray] = []
        n_terms = n_counts = 0

        def shard() -> pa.RecordBatch:
            nonlocal made, n_terms, n_counts
            gid, n = np.concatenate(gids), np.concatenate(counts)
            position = np.repeat(np.arange(n_terms), np.concatenate(sizes))
            order = np.argsort(gid, kind="stable")
            gid, n, position = gid[order], n[order], position[order]
            cuts = np.flatnonzero(np.diff(gid)) + 1
            lo, hi = [0, *cuts.tolist()], [*cuts.tolist(), len(gid)]
            ends, values = zip(*(run_lengths(position[a:b], n[a:b], n_terms) for a, b in zip(lo, hi)))
            out = pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(lo), pa.string()), pa.array([base + made] * len(lo), pa.int64()),
                 pa.array([n_terms] * len(lo), pa.int64()), pa.array(gid[lo]),
                 pa.array(ends, pa.list_(pa.int32())), pa.array(values, pa.list_(pa.int64()))],
                names=["lang", "shard", "n_terms", "gid", "ends", "counts"])
            made += 1
            n_terms = n_counts = 0
            gids.clear(), counts.clear(), sizes.clear()
            return out

        for batch in batches:
            here = batch.column("lang").to_pylist()
            lists = batch.column("counts")
            off = lists.offsets.to_numpy()
            flat = lists.values
            gid, n = flat.field("gid").to_numpy(), flat.field("n").to_numpy()
            at = 0
            while at < len(here):
                if n_terms and here[at] != lang:
                    yield shard()
                lang = here[at]
                end = at + 1
                room = min(len(here), at + SHARD_TERMS - n_terms)
                while end < room and here[end] == lang and n_counts + off[end] - off[at] < SHARD_COUNTS:
                    end += 1
                gids.append(gid[off[at]:off[end]])
                counts.append(n[off[at]:off[end]])
                sizes.append(np.diff(off[at:end + 1]))
                n_terms += end - at
                n_counts += int(off[end] - off[at])
                at = end
                if n_terms >= SHARD_TERMS or n_counts >= SHARD_COUNTS:
                    yield shard()
        if n_terms:
            yield shard()

    ordered = kept.repartitionByRange("lang", F.size("counts"), "counts").sortWithinPartitions(
        "lang", F.size("counts"), "counts")
    return ordered.select("lang", "counts").mapInArrow(
        columns, "lang string, shard long, n_terms long, gid long, ends array<int>, counts array<long>")


def run_lengths(position: np.ndarray, n: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Runs (ends, values) of a column of ``size`` entries that is zero but at ``position`` (ascending)."""
    # every entry begins a run at its position, and one of zeros after it unless the next entry follows
    bounds = np.stack([position, position + 1], axis=1).reshape(-1)
    values = np.stack([n, np.zeros_like(n)], axis=1).reshape(-1)
    keep = np.ones(len(bounds), dtype=bool)
    keep[1:-1:2] = bounds[1:-1:2] != bounds[2::2]
    keep[-1] = bounds[-1] < size
    start, value = bounds[keep], values[keep]
    if start[0] > 0:
        start, value = np.insert(start, 0, 0), np.insert(value, 0, 0)
    new = np.ones(len(start), dtype=bool)
    new[1:] = value[1:] != value[:-1]
    start, value = start[new], value[new]
    return np.append(start[1:], size).astype(np.int32), value


def shares(counts: np.ndarray, total: int) -> np.ndarray:
    """``share`` for the counts of a column; distinct counts are few, and their products may be long."""
    distinct, at = np.unique(counts, return_inverse=True)
    return np.array([1 + UNIT * (c + 1) // total for c in distinct.tolist()], dtype=np.int64)[at]


def intersect(a_ends: np.ndarray, a: np.ndarray, b_ends: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """The sums of the divergences of a from b and of b from a over all positions."""
    ends = np.union1d(a_ends, b_ends)
    p, q = a[np.searchsorted(a_ends, ends)], b[np.searchsorted(b_ends, ends)]
    length = np.diff(ends, prepend=0)
    square = (p - q) ** 2
    return int((square // q * length).sum()), int((square // p * length).sum())


def pair_sums(columns: DataFrame, groups: DataFrame, langs: DataFrame) -> DataFrame:
    """(a, b, value) for every two groups of a language with terms, both ways.

    Sources are dealt into blocks; a task compares two blocks on one shard, so neither a language nor
    a source gathers in one task. Groups without terms in a shard take part with one run of zeros.
    """
    dealt = groups.join(langs, "lang").select(
        "gid", "lang", (F.col("total") + F.col("size")).alias("whole"),
        F.expr(f"cast((place - 1) div {BLOCK} as int)").alias("block"),
        F.expr(f"cast((members - 1) div {BLOCK} as int)").alias("last"))
    shards = columns.select("lang", "shard", "n_terms").distinct()
    every = shards.join(dealt, "lang").join(columns.select("shard", "gid", "ends", "counts"), ["shard", "gid"], "left")
    filled = every.select(
        "shard", "gid", "whole", "block",
        F.coalesce("ends", F.array(F.col("n_terms").cast("int"))).alias("ends"),
        F.coalesce("counts", F.array(F.lit(0).cast("long"))).alias("counts"),
        F.explode(F.sequence(F.lit(0), F.col("last"))).alias("other"))
    paired = filled.withColumns({"lo": F.least("block", "other"), "hi": F.greatest("block", "other")})

    def compare(table: pa.Table) -> pa.Table:
        block, lo, hi = (table.column(c).to_numpy() for c in ("block", "lo", "hi"))
        gid = table.column("gid").to_pylist()
        ends = [np.array(x.values) for x in table.column("ends")]
        p = [shares(np.array(x.values), int(w)) for x, w in
             zip(table.column("counts"), table.column("whole").to_pylist())]
        left = np.flatnonzero(block == lo[0]).tolist()
        right = left if lo[0] == hi[0] else np.flatnonzero(block == hi[0]).tolist()
        out: list[tuple[int, int, int]] = []
        for i in left:
            for j in right:
                if left is not right or gid[i] < gid[j]:
                    there, back = intersect(ends[i], p[i], ends[j], p[j])
                    out += [(gid[i], gid[j], there), (gid[j], gid[i], back)]
        a, b, value = zip(*out) if out else ((), (), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "value": pa.array(value, pa.int64())})

    made = paired.groupBy("shard", "lo", "hi").applyInArrow(compare, "a long, b long, value long")
    return made.groupBy("a", "b").agg(F.sum("value").alias("value"))


def source_divergence(docs: DataFrame) -> DataFrame:
    """Divergence between the sources of each language of ``docs`` (text, lang, source): lang, source,
    part, item, value, rank.

    A language keeps the terms of MIN_DOCS rows or more. Part ``pair``: the item is each other source
    of the language, the value the sum over kept terms of floor((p - q)^2 / q), with p the group's
    smoothed share of the term (see ``share``) and q the item's; 0 where no term is kept. Part ``term``: the
    items are the kept terms that the group has with p above the language's share q, to rank TOP_TERMS.

    Null text, lang and source are empty strings; every row is a document, repeated ones too. Groups
    without terms take part. Ties rank by item. Very long texts are read in slices. Other columns do
    not matter. An empty table gives an empty result.
    """
    docs = docs.select(*(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("text", "lang", "source")))
    groups = stored(docs.select("lang", "source").distinct().select(
        "lang", "source", F.monotonically_increasing_id().alias("gid")), "groups")
    counted = term_counts(docs).join(groups, ["lang", "source"])
    kept = stored(counted.groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.sum("n").alias("n"),
        F.array_sort(F.collect_list(F.struct("gid", "n"))).alias("counts")).where(F.col("docs") >= MIN_DOCS), "kept")
    each = kept.select("lang", "term", F.col("n").alias("lang_n"), F.inline("counts"))
    totals = each.groupBy("gid").agg(F.sum("n").alias("total"))
    langs = kept.groupBy("lang").agg(F.sum("n").alias("lang_total"), F.count("*").alias("size"))
    place = Window.partitionBy("lang").orderBy("gid")
    members = groups.groupBy("lang").agg(F.count("*").alias("members"))
    groups = stored(groups.withColumn("place", F.row_number().over(place)).join(members, "lang").join(
        totals, "gid", "left").withColumn("total", F.coalesce("total", F.lit(0))), "groups")
    langs = stored(langs, "langs")

    sums = pair_sums(stored(run_columns(kept), "columns"), groups, langs)
    a = groups.select("lang", F.col("gid").alias("a"), "source")
    b = groups.select("lang", F.col("gid").alias("b"), F.col("source").alias("item"))
    pairs = a.join(b, "lang").where("a != b").join(sums, ["a", "b"], "left").select(
        "lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).alias("value"))

    shared = each.join(groups.select("gid", "source", "total"), "gid").join(langs, "lang").withColumns({
        "p": share(F.col("n"), F.col("total"), F.col("size")),
        "q": share(F.col("lang_n"), F.col("lang_total"), F.col("size"))}).where("p > q")
    found = shared.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                          divergence(F.col("p"), F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    top = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= TOP_TERMS)
    return pairs.withColumn("rank", F.row_number().over(order)).unionByName(top)


ship(__name__)
