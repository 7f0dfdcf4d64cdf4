"""SimHash near-duplicates by pigeonring filtering.

A fingerprint's 64 bits form a ring of SEGMENTS segments. If two fingerprints differ in at most
``distance`` bits, some segment starts a chain in which the first l segments together differ in
at most floor(l * distance / SEGMENTS) bits, for every l (the strong pigeonhole on a ring). The
index keys are the chain's first two segments: with distance 4 and 5 segments the first must be
equal and both together may differ in one bit, so a fingerprint is filed under five keys and
also visits the keys with one bit of the second segment flipped. Pairs that meet are pruned by
the longer chains before the full Hamming check.

Equal fingerprints are one vertex. In a key with many fingerprints the links are found by a
search that removes what it has reached, so a dense group yields a spanning set of links, not
all its pairs; components are unchanged by that.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perfkit.llm.common import extend, match_rows, packed, ship, stored, text_key, unpacked
from perfkit.llm.components import components

SHINGLE_WORDS = 4
DISTANCE = 4
SEGMENTS = 5
HASH_SEED = 42
#: Widths of the ring's segments, low bits first.
WIDTHS = (13, 13, 13, 13, 12)
#: Keys with more fingerprints than this are linked by search instead of by pairs: a size switch that leaves the
#: chain filter out there, so the Hamming check alone decides. The links connect the same fingerprints either way.
PAIRED = 64


def fingerprint(text: str | None, shingle: int = SHINGLE_WORDS) -> int:
    """Majority bits of the shingles' hashes; 0 for a text without words."""
    words = (text or "").encode().lower().split()  # bytes: A-Z only, ASCII white space only
    if not words:
        return 0
    if len(words) <= shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    hash64 = xxhash.xxh64_intdigest
    h = np.fromiter((hash64(g, HASH_SEED) for g in grams), dtype=np.uint64)
    counts = np.zeros(64, dtype=np.int64)
    for i in range(0, len(h), 1 << 16):  # bounded scratch for very long texts
        counts += np.unpackbits(h[i:i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1,
                                bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(h), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, text_key, fp) per row of ``docs``; fp is the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column("text")
            fp = np.array([fingerprint(text[i].as_py(), shingle) for i in range(len(text))], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_key"),
                                              pa.array(fp.view(np.int64))], names=["doc_id", "text_key", "fp"])

    src = docs.select("doc_id", text_key(F.col("text")).alias("text_key"), "text")
    return src.mapInArrow(run, extend(src.drop("text").schema, "fp long"))


def _segments(fp: np.ndarray, widths: tuple[int, ...]) -> list[np.ndarray]:
    out, at = [], 0
    for w in widths:
        out.append((fp >> np.uint64(at)) & np.uint64((1 << w) - 1))
        at += w
    return out


def _budgets(distance: int, segments: int) -> list[int]:
    return [length * distance // segments for length in range(1, segments + 1)]


def ring_pairs_ok(a: np.ndarray, b: np.ndarray, start: np.ndarray, distance: int = DISTANCE,
                  widths: tuple[int, ...] = WIDTHS) -> np.ndarray:
    """Chain filter, then the Hamming check of what is left."""
    n, at = len(widths), np.concatenate([[0], np.cumsum(widths)]).astype(np.uint64)
    masks = np.array([((1 << w) - 1) << int(at[i]) for i, w in enumerate(widths)], dtype=np.uint64)
    alive = np.arange(len(a))
    total = np.zeros(len(a), dtype=np.int64)
    for length, budget in enumerate(_budgets(distance, n), 1):
        seg = masks[(start[alive] + length - 1) % n]
        total = total + np.bitwise_count((a[alive] ^ b[alive]) & seg)
        fits = total <= budget
        alive, total = alive[fits], total[fits]
    ok = np.zeros(len(a), dtype=bool)
    ok[alive[np.bitwise_count(a[alive] ^ b[alive]) <= distance]] = True
    return ok


def spanning_links(fp: np.ndarray, distance: int = DISTANCE) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect whatever pairs within ``distance`` connect, one per reached member."""
    left, us, vs = fp, [], []
    queue: list[np.ndarray] = []
    while len(left):
        if not queue:
            queue, left = [left[:1]], left[1:]
        x = queue.pop()
        for one in x:
            near = np.bitwise_count(left ^ one) <= distance
            if near.any():
                us.append(np.full(int(near.sum()), one))
                vs.append(left[near])
                queue.append(left[near])
                left = left[~near]
    none = np.zeros(0, dtype=np.uint64)
    return (np.concatenate(us) if us else none, np.concatenate(vs) if vs else none)


def links(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Distinct ``fp`` rows -> (u, v) links that span all pairs within ``distance``."""
    if _budgets(distance, SEGMENTS)[:2] != [0, 1]:
        raise ValueError(f"the keys serve a distance of {SEGMENTS - 1}, not {distance}")
    n = SEGMENTS

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for piece in np.array_split(fp, max(1, len(fp) // 4096)):
                seg = _segments(piece, WIDTHS)
                for i in range(n):
                    j = (i + 1) % n
                    head = (np.uint64(i) << np.uint64(32)) | (seg[i] << np.uint64(16))
                    yield _key_rows(head | seg[j], piece, True)
                    for bit in range(WIDTHS[j]):
                        yield _key_rows(head | (seg[j] ^ np.uint64(1 << bit)), piece, False)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows arrive sorted by key; a key that spans batches is carried over."""
        kept: list[np.ndarray] = []
        for batch in batches:
            rows = np.stack([pc.cast(batch.column(c), pa.int64()).to_numpy(zero_copy_only=False) for c in range(3)])
            if rows.shape[1] == 0:
                continue
            cut = int(np.searchsorted(rows[0], rows[0][-1], side="left"))
            if cut:
                yield from _meet_keys(np.concatenate([*kept, rows[:, :cut]], axis=1), distance)
                kept = [rows[:, cut:]]
            else:
                kept.append(rows)  # one key longer than a batch
        if kept:
            yield from _meet_keys(np.concatenate(kept, axis=1), distance)

    filed = prints.select("fp").mapInArrow(keys, "key long, fp long, home boolean")
    return (filed.repartition("key").sortWithinPartitions("key")
            .mapInArrow(meet, "u long, v long").distinct())


def _key_rows(key: np.ndarray, fp: np.ndarray, home: bool) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(fp.view(np.int64)),
                                       pa.array(np.full(len(fp), home))], names=["key", "fp", "home"])


def _meet_keys(rows: np.ndarray, distance: int) -> Iterator[pa.RecordBatch]:
    """All keys in ``rows`` (key, fp, home): links between fingerprints that share a key."""
    key, fp, home = rows[0], rows[1].view(np.uint64), rows[2].astype(bool)
    new = np.ones(len(key), dtype=bool)
    new[1:] = key[1:] != key[:-1]
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, len(key)))
    homes = np.add.reduceat(home.astype(np.int64), first)
    us, vs = [], []
    small = (size > 1) & (homes > 0) & (size <= PAIRED)
    for length in np.unique(size[small]):
        at = first[small & (size == length)][:, None] + np.arange(length)
        i, j = np.triu_indices(length, 1)
        for block in np.array_split(at, max(1, len(at) * len(i) >> 20)):
            a, b = block[:, i].ravel(), block[:, j].ravel()
            worth = home[a] | home[b]
            a, b = a[worth], b[worth]
            ok = ring_pairs_ok(fp[a], fp[b], (key[a] >> 32).astype(np.int64), distance)
            us.append(fp[a[ok]])
            vs.append(fp[b[ok]])
    for k in np.flatnonzero((size > PAIRED) & (homes > 0)):
        u, v = spanning_links(fp[first[k]:first[k] + size[k]], distance)
        us.append(u)
        vs.append(v)
    if us:
        u, v = np.concatenate(us), np.concatenate(vs)
        if len(u):
            yield pa.RecordBatch.from_arrays([pa.array(np.maximum(u.view(np.int64), v.view(np.int64))),
                                              pa.array(np.minimum(u.view(np.int64), v.view(np.int64)))],
                                             names=["u", "v"])


def simhash_components(docs: DataFrame, shingle: int = SHINGLE_WORDS, distance: int = DISTANCE) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, text_key, fingerprint (hex), component_id.

    component_id is the smallest doc_id reachable over links of at most ``distance`` bits. Null
    and wordless texts have fingerprint zero and link like any other; a null doc_id belongs to
    its component but never names one (null if it has no other id); repeated rows give repeated
    results; extra columns are not carried.
    """
    prints = stored(fingerprints(docs, shingle), "fingerprints")
    vertex = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(links(prints.select("fp").distinct(), distance))
    named = (vertex.join(roots.withColumnRenamed("u", "fp"), "fp", "left")
             .withColumn("root", F.coalesce("root", "fp")))
    # The least id of each component: components are summed by partial aggregation.
    named = stored(named, "vertices")
    ids = stored(named.groupBy("root").agg(F.min("least").alias("component_id")), "components")
    by_print = named.join(ids, "root").select("fp", "component_id")
    return (prints.join(by_print, "fp")
            .select("doc_id", "text_key", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))


def one_per_component(docs: DataFrame, shingle: int = SHINGLE_WORDS, distance: int = DISTANCE) -> DataFrame:
    """The rows of ``docs`` whose doc_id names their component.

    Rows that repeat that id (equal or not) are reduced to the least text key, equal rows to one.
    Rows of a component without any id all stay, as none can be told to be first.
    """
    marked = packed(docs)
    parts = simhash_components(docs, shingle, distance)
    first = (parts.where(F.col("doc_id") == F.col("component_id"))
             .groupBy("doc_id").agg(F.min("text_key").alias("text_key")))
    nameless = parts.where(F.col("component_id").isNull()).select("doc_id", "text_key").distinct()
    named = marked.join(first.withColumnRenamed("text_key", "_key"), "doc_id").where("text_key = _key").drop("_key")
    out = named.dropDuplicates(["doc_id"]).unionByName(match_rows(marked, nameless, "inner"))
    return out.select(unpacked(docs.columns))


ship(__name__)
