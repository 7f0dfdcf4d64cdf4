"""Toxicity scores by a factorization machine over hashed terms.

A text is the set of its words, hashed into buckets. The machine adds, to a weight per bucket, the
inner product of two short vectors for every pair of buckets in the text, so that a word can
count for more (or less) beside another, also one that tells nothing alone; the pair sum is computed
in linear time from sums of the vectors and of their squares, and divided by the number of buckets
that have vectors, as the many pairs of a long text would else drown its weights. Words that stand near each
other, as an insult beside a group's name, are a field of their own: they have further vectors, whose products
are summed over all pairs of words less than WINDOW apart and divided by the square root of the text's length in windows,
so that a long text doesn't take them away. Weights and vectors are fitted by adaptive gradient steps on a
bounded sample of the labelled rows, the near vectors last, on what the rest leaves unexplained; scoring covers every whole
text, one pass, no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perfkit.llm.common import RollingHash, extend, ship, text_key, text_slices, word_spans

BUCKET_BITS = 18
FACTORS = 4
#: Labelled rows that the fit uses at most (those with the least hash of their id).
TRAIN_ROWS = 16_000
#: A bucket counts only if so many training rows have it.
MIN_ROWS = 5
EPOCHS = 10
BATCH = 128
STEP = 1.0
FACTOR_STEP, BIAS_STEP = 1.0, 0.1
#: Size of the first factors; the squared gradients that their steps start from; both suit rows of summed gradients.
FACTOR_SIZE, FACTOR_SEEN = 0.1, 1.0
SHRINK = 1e-3
#: Pull of a factor to zero for each row that has its bucket; of a near factor, for each place where it stands.
FACTOR_SHRINK = 3e-3
NEAR_SHRINK = 8e-3
#: Words are near if fewer places lie between them.
WINDOW = 5
#: Training rows of more words have no part in the fit of the near factors.
NEAR_WORDS = 2_048
SPARSE = 8.0
SEED = 5
THRESHOLD = 0.3
FOLDS, HELD_OUT = 4, 2

#: Words are runs of ASCII letters and digits and of bytes of other characters.
BREAK = np.ones(256, dtype=bool)
BREAK[0x80:] = False
BREAK[list(b"abcdefghijklmnopqrstuvwxyz0123456789")] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def places(data: np.ndarray, off: np.ndarray, bits: int = BUCKET_BITS) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of every word in text order, and where each row's begin."""
    low = LOWER[data]
    starts, ends, first = word_spans(low, off, BREAK)
    return (RollingHash(low, 41).spans(starts, ends) >> np.uint64(64 - bits)).astype(np.int64), first


def distinct(words: np.ndarray, first: np.ndarray, bits: int = BUCKET_BITS) -> tuple[np.ndarray, np.ndarray]:
    """The distinct buckets of each row, ascending, and where each row's begin."""
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    both = np.unique((row.astype(np.uint64) << np.uint64(bits)) | words.astype(np.uint64))
    return ((both & np.uint64((1 << bits) - 1)).astype(np.int64),
            np.searchsorted(both >> np.uint64(bits), np.arange(len(first))))


def buckets(data: np.ndarray, off: np.ndarray, bits: int = BUCKET_BITS) -> tuple[np.ndarray, np.ndarray]:
    return distinct(*places(data, off, bits), bits)


def _row_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0, dtype=np.float64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def _near_sums(v: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each word, the sum of the vectors of the words near it, itself excluded."""
    total = np.concatenate([np.zeros((1, v.shape[1])), np.cumsum(v, axis=0, dtype=np.float64)])
    row, i = np.repeat(np.arange(len(first) - 1), np.diff(first)), np.arange(len(v))
    return total[np.minimum(i + WINDOW, first[1:][row])] - total[np.maximum(i - WINDOW + 1, first[:-1][row])] - v


def _near_scale(first: np.ndarray) -> np.ndarray:
    return 1.0 / np.sqrt(np.maximum(np.diff(first) / WINDOW, 1.0))


@dataclass
class Machine:
    bias: float
    weight: np.ndarray
    factor: np.ndarray
    near: np.ndarray | None = None

    def margin(self, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(margin of each row, sums of the row's factors)."""
        v = self.factor[ids]
        s = _row_sums(v, bounds)
        paired = np.maximum(_row_sums((v != 0).any(axis=1), bounds), 1.0)
        pairs = 0.5 * (s * s - _row_sums(v * v, bounds)).sum(axis=1) / paired
        return self.bias + _row_sums(self.weight[ids], bounds) + pairs, s

    def near_margin(self, words: np.ndarray, first: np.ndarray) -> np.ndarray:
        """What near words add to the margin of each row, given by its words in order."""
        v = self.near[words]
        return 0.5 * _row_sums((v * _near_sums(v, first)).sum(axis=1), first) * _near_scale(first)

    def score(self, ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Scores without the near words."""
        return _sigmoid(self.margin(ids, bounds)[0])

    def score_words(self, words: np.ndarray, first: np.ndarray) -> np.ndarray:
        return _sigmoid(self.margin(*distinct(words, first))[0] + self.near_margin(words, first))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def fit(ids: np.ndarray, bounds: np.ndarray, label: np.ndarray, bits: int = BUCKET_BITS,
        factors: int = FACTORS, epochs: int = EPOCHS, seed: int = SEED) -> Machine:
    """Fits on rows given by their distinct buckets. Without rows every score is near zero."""
    rng = np.random.default_rng(seed)
    size, n = 1 << bits, len(label)
    rate = (label.sum() + 0.01) / (n + 1.0)
    m = Machine(float(np.log(rate / (1 - rate))), np.zeros(size), rng.normal(0, FACTOR_SIZE, (size, factors)))
    common = np.bincount(ids, minlength=size) >= MIN_ROWS
    m.factor[~common] = 0.0
    keep = common[ids]
    bounds = np.concatenate([[0], np.cumsum(keep)])[bounds]
    ids = ids[keep]
    sizes = np.diff(bounds)
    # Proximal steps for the weights: a weight stays zero until its summed gradients pass SPARSE, so
    # words that say nothing have none. Every bucket that counts takes part in pairs.
    pull, seen = np.zeros(size), np.zeros(size)
    g_factor, g_bias = np.full((size, factors), FACTOR_SEEN), 1e-3
    for _ in range(epochs):
        order = rng.permutation(n)
        for at in range(0, n, BATCH):
            rows = order[at:at + BATCH]
            lengths = sizes[rows]
            cut = np.concatenate([[0], np.cumsum(lengths)])
            mine = ids[np.repeat(bounds[rows] - cut[:-1], lengths) + np.arange(cut[-1])]
            margin, sums = m.margin(mine, cut)
            error = _sigmoid(margin) - label[rows]
            per = np.repeat(error, lengths)
            bucket, where = np.unique(mine, return_inverse=True)
            g = np.bincount(where, weights=per, minlength=len(bucket))
            before = seen[bucket]
            seen[bucket] += g * g
            pull[bucket] += g - (np.sqrt(seen[bucket]) - np.sqrt(before)) / STEP * m.weight[bucket]
            z = pull[bucket]
            m.weight[bucket] = np.where(np.abs(z) <= SPARSE, 0.0, (np.sign(z) * SPARSE - z) / (
                (1.0 + np.sqrt(seen[bucket])) / STEP + SHRINK))
            near = (np.repeat(sums, lengths, axis=0) - m.factor[mine]) * (per / np.repeat(lengths, lengths))[:, None]
            gv = np.stack([np.bincount(where, weights=near[:, f], minlength=len(bucket)) for f in range(factors)], axis=1)
            gv += FACTOR_SHRINK * np.bincount(where, minlength=len(bucket))[:, None] * m.factor[bucket]
            g_factor[bucket] += gv * gv
            m.factor[bucket] -= FACTOR_STEP * gv / np.sqrt(g_factor[bucket])
            gb = float(error.mean())
            g_bias += gb * gb
            m.bias -= BIAS_STEP * gb / np.sqrt(g_bias)
    return m


def fit_near(m: Machine, words: np.ndarray, first: np.ndarray, label: np.ndarray, margin: np.ndarray,
             common: np.ndarray, epochs: int = EPOCHS, seed: int = SEED) -> Machine:
    """Fits the near factors of ``m`` on rows given by their words in order; ``margin`` is what the rest of
    the machine gives them. Only ``common`` buckets (a boolean each) have near factors."""
    rng = np.random.default_rng(seed)
    size, factors = m.factor.shape
    m.near = rng.normal(0, FACTOR_SIZE, (size, factors))
    m.near[~common] = 0.0
    lengths, seen = np.diff(first), np.full((size, factors), FACTOR_SEEN)
    for _ in range(epochs):
        order = rng.permutation(len(label))
        for at in range(0, len(label), BATCH):
            rows = order[at:at + BATCH]
            cut = np.concatenate([[0], np.cumsum(lengths[rows])])
            mine = words[np.repeat(first[rows] - cut[:-1], lengths[rows]) + np.arange(cut[-1])]
            v = m.near[mine]
            beside, scale = _near_sums(v, cut), _near_scale(cut)
            error = _sigmoid(margin[rows] + 0.5 * _row_sums((v * beside).sum(axis=1), cut) * scale) - label[rows]
            bucket, where = np.unique(mine, return_inverse=True)
            g = beside * np.repeat(error * scale, lengths[rows])[:, None]
            g = np.stack([np.bincount(where, weights=g[:, f], minlength=len(bucket)) for f in range(factors)], axis=1)
            g = np.where(common[bucket][:, None], g, 0.0)
            g += NEAR_SHRINK * np.bincount(where, minlength=len(bucket))[:, None] * m.near[bucket]
            seen[bucket] += g * g
            m.near[bucket] -= FACTOR_STEP * g / np.sqrt(seen[bucket])
    return m


def fit_all(words: np.ndarray, first: np.ndarray, short: np.ndarray, ids: np.ndarray, bounds: np.ndarray,
            label: np.ndarray) -> Machine:
    """Weights and factors from the rows' distinct buckets, near factors from the words of the rows marked
    ``short`` (the others have none in ``words``)."""
    m = fit(ids, bounds, label)
    margin = np.zeros(len(label))
    for at in range(0, len(label), BATCH):
        cut = bounds[at:at + BATCH + 1]
        margin[at:at + BATCH] = m.margin(ids[cut[0]:cut[-1]], cut - cut[0])[0]
    kept = np.concatenate([[0], np.cumsum(np.diff(first)[short])])
    common = np.bincount(ids, minlength=len(m.weight)) >= MIN_ROWS
    return fit_near(m, words, kept, label[short], margin[short], common)


def held_out(doc_id: str = "doc_id"):
    """True for the rows whose labels must not be learnt from; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % FOLDS == HELD_OUT, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Machine:
    """Fits on at most ``rows`` labelled rows outside the held-out fold. Rows with a null id or a null
    label are left out; an id with several labels has the greatest; of an id's repeated rows those with the
    least text hashes come first. What is fetched is bounded by ``rows``, NEAR_WORDS and the number of buckets."""
    chosen = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).where(~held_out())
              .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, off in text_slices(batch, "text"):
                words, first = places(data, off)
                ids, bounds = distinct(words, first)
                lengths = np.diff(first)
                short = lengths <= NEAR_WORDS
                kept = np.concatenate([[0], np.cumsum(np.where(short, lengths, 0))])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("text_key"), part.column("toxic"),
                     _lists(bounds, ids), _lists(kept, words[np.repeat(short, lengths)]), pa.array(short)],
                    names=["doc_id", "text_key", "toxic", "ids", "words", "short"])

    # ``rows`` bounds the broadcast side.
    text = (docs.select("doc_id", text_key(F.col("text")).alias("text_key"), "text").join(F.broadcast(chosen), "doc_id")
            .select("doc_id", "text_key", "toxic", "text"))
    got = (text.mapInArrow(hashed, extend(text.drop("text").schema, "ids array<int>, words array<int>, short boolean"))
           .orderBy(F.xxhash64("doc_id"), "doc_id", "text_key").limit(rows).orderBy("doc_id", "text_key").toArrow())
    ids, bounds = _flat(got.column("ids"))
    words, first = _flat(got.column("words"))
    short, toxic = got.column("short").to_numpy().astype(bool), got.column("toxic").to_numpy().astype(float)
    del got  # the flat copies are enough
    return fit_all(words, first, short, ids, bounds, toxic)


def _lists(bounds: np.ndarray, values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values.astype(np.int32)))


def _flat(lists: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The values of a column of lists, and where each row's begin."""
    values = [c.flatten().to_numpy() for c in lists.chunks]
    lengths = [c.value_lengths().to_numpy() for c in lists.chunks]
    none = np.zeros(0, np.int32)
    return np.concatenate([none, *values]), np.concatenate([[0], np.cumsum(np.concatenate([none, *lengths]), dtype=np.int64)])


def toxicity(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, held_out, score in 0..1, predicted (1 if the score is
    at least ``threshold``).

    Null and empty texts have no terms and get the score of the bias alone. Only the text enters
    a score; repeated rows score alike; extra columns are not carried.
    """
    machine = train(docs, labels, rows)
    tables = (machine.weight, machine.factor, machine.near)
    model = docs.sparkSession.sparkContext.broadcast(  # 2**BUCKET_BITS rows
        (machine.bias, *(x.astype(np.float32) for x in tables)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Machine(*model.value)
        for batch in batches:
            for part, data, off in text_slices(batch, "text"):
                score = m.score_words(*places(data, off))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), pa.array(score),
                     pa.array((score >= threshold).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    src = docs.select("doc_id", held_out().alias("held_out"), "text")
    return src.mapInArrow(run, extend(src.drop("text").schema, "score double, predicted int"))


ship(__name__)
