"""Spelling variants: words that differ by one code point, and the chains of forms they make.

Words are counted in one pass. The exact neighbours come from a dictionary of trie nodes: a word's
prefixes are nodes of a trie, its suffixes are nodes of a trie of reversed words, and every node has
a number. A word without its code point i is the pair (node of the prefix before i, node of the
suffix after i), a word split at i the pair (prefix, suffix); pairs of numbers are equal where the
strings are. Words that meet in a pair therefore differ by exactly one replaced code point (both
skip it), or by one inserted or deleted (one skips what the other lacks). A pair has at most one
split word and one word per letter, so no group grows with the data.

Nodes of up to SHALLOW letters carry their letters as number; deeper ones are numbered by a written
dictionary, which also spares the shuffle the prefixes that very many words share.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perfkit.llm.common import ship, stored

#: Bytes of Latin-1: a-z and U+00C0 to U+00FF are letters, any other becomes a separator.
LETTERS = bytes(b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256))
MIN_LENGTH, MIN_COUNT = 5, 3
#: Every so many-th (document, run) loses a code point.
DROP_EVERY = 97
#: A form has at least so many times the word's occurrences.
FORM_RATIO = 2
#: Distinct words that a task holds before it hands its counts on.
HELD_WORDS = 300_000
#: Characters of a text split at a time.
STREAM = 1 << 20
#: Letters of a node that fit into its number (7 bytes and their count).
SHALLOW = 7
#: Longer nodes are keyed by the digest of their letters, so that long words cost linear space.
KEY_LETTERS = 31
SPLIT, SKIP, SKIP_AGAIN = 0, 1, 2


def runs(text: str) -> Iterator[list[bytes]]:
    """Lower-cased runs of a text as Latin-1 bytes (one per code point), some at a time."""
    data = text.encode("latin-1", "replace").lower().translate(LETTERS)
    at = 0
    while at < len(data):
        end = data.find(b" ", at + STREAM) if len(data) - at > STREAM else -1
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) over ``docs`` (doc_id, text): runs after the deletions, of MIN_LENGTH code points or more."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[bytes, int] = {}

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in total], pa.string()),
                                              pa.array(list(total.values()), pa.int64())], names=["word", "n"])
            total.clear()
            return out

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                seed = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for some in runs(text.as_py() or ""):
                    for word, n in Counter(some).items():
                        if len(word) < MIN_LENGTH:
                            continue
                        h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), seed)
                        if h % DROP_EVERY == 0:
                            i = h % len(word)
                            word = word[:i] + word[i + 1:]
                            if len(word) < MIN_LENGTH:
                                continue
                        total[word] = total.get(word, 0) + n
                    if len(total) > HELD_WORDS:
                        yield flush()
        if total:
            yield flush()

    counted = docs.select("doc_id", "text").mapInArrow(count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def vocabulary(docs: DataFrame) -> DataFrame:
    """(id, word, n) of words with MIN_COUNT occurrences or more; ids ascend in code-point order."""
    words = word_counts(docs).where(F.col("n") >= MIN_COUNT)
    return stored(stored(words, "words").orderBy("word").select(
        F.monotonically_increasing_id().alias("id"), "word", "n"), "vocabulary")


def node_keys(letters: bytes) -> Iterator[bytes]:
    """Keys of the nodes of more than SHALLOW letters on a word's path."""
    for i in range(SHALLOW + 1, min(len(letters), KEY_LETTERS) + 1):
        yield letters[:i]
    if len(letters) > KEY_LETTERS:
        digest = hashlib.sha256(letters[:KEY_LETTERS])
        for i in range(KEY_LETTERS, len(letters)):
            digest.update(letters[i:i + 1])
            yield digest.digest()


def deep_nodes(vocab: DataFrame) -> DataFrame:
    """(id, nodes): numbers of a word's deep prefix nodes by length, then of its deep suffix nodes."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, place, key = [], [], []
            for number, word in zip(batch.column("id").to_pylist(), batch.column("word").to_pylist()):
                letters = word.encode("latin-1")
                have = [*node_keys(letters), *node_keys(letters[::-1])]
                ids += [number] * len(have)
                place += range(len(have))
                key += have
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(place, pa.int32()),
                                              pa.array(key, pa.binary())], names=["id", "place", "key"])

    paths = vocab.where(F.length("word") > SHALLOW).select("id", "word").mapInArrow(
        keys, "id long, place int, key binary")
    paths = stored(paths, "paths")
    numbers = stored(paths.select("key").distinct().select(
        "key", (F.monotonically_increasing_id() + F.lit(1 << 62)).alias("node")), "nodes")
    numbered = paths.join(numbers, "key").groupBy("id").agg(
        F.array_sort(F.collect_list(F.struct("place", "node"))).alias("nodes"))
    return numbered.select("id", F.col("nodes.node").alias("nodes"))


def _numbers(letters: np.ndarray, deep: np.ndarray) -> np.ndarray:
    """Node numbers of all prefixes, the empty one included, of words of one length (a row each)."""
    m, length = letters.shape
    out = np.zeros((m, length + 1), dtype=np.int64)
    for i in range(1, min(length, SHALLOW) + 1):
        out[:, i] = ((out[:, i - 1] & ((1 << 56) - 1)) << 8) | letters[:, i - 1]
        out[:, i] |= i << 56
    out[:, SHALLOW + 1:] = deep
    return out


def node_pairs(vocab: DataFrame) -> DataFrame:
    """(prefix, suffix, id, n, kind): every word's split points and skipped code points. In a run of
    equal letters only the first skip counts as a deletion (the others give the same word)."""

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [w.encode("latin-1") for w in batch.column("word").to_pylist()]
            lengths = np.array([len(w) for w in words], dtype=np.int64)
            number, n = batch.column("id").to_numpy(), batch.column("n").to_numpy()
            nodes = batch.column("nodes")
            for length in np.unique(lengths).tolist():
                rows = np.flatnonzero(lengths == length)
                step = max(1, (1 << 17) // length)
                for of in (rows[i:i + step] for i in range(0, len(rows), step)):
                    letters = np.frombuffer(b"".join(words[i] for i in of), dtype=np.uint8).reshape(len(of), length)
                    deep = max(0, length - SHALLOW)
                    both = (nodes.take(pa.array(of)).flatten().to_numpy().reshape(len(of), 2 * deep) if deep
                            else np.zeros((len(of), 0), dtype=np.int64))
                    prefix = _numbers(letters.astype(np.int64), both[:, :deep])
                    suffix = _numbers(letters[:, ::-1].astype(np.int64), both[:, deep:])[:, ::-1]
                    again = np.zeros(letters.shape, dtype=bool)
                    again[:, 1:] = letters[:, 1:] == letters[:, :-1]
                    kind = np.concatenate([np.full(prefix.shape, SPLIT, dtype=np.int8),
                                           np.where(again, SKIP_AGAIN, SKIP).astype(np.int8)], axis=1)
                    width = kind.shape[1]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate([prefix, prefix[:, :-1]], axis=1).reshape(-1)),
                         pa.array(np.concatenate([suffix, suffix[:, 1:]], axis=1).reshape(-1)),
                         pa.array(np.repeat(number[of], width)), pa.array(np.repeat(n[of], width)),
                         pa.array(kind.reshape(-1))], names=["prefix", "suffix", "id", "n", "kind"])

    return vocab.join(deep_nodes(vocab), "id", "left").select("id", "word", "n", "nodes").mapInArrow(
        pairs, "prefix long, suffix long, id long, n long, kind byte")


def near_words(vocab: DataFrame) -> DataFrame:
    """(id, n_near, best) of words with near words; best: (n, -id) of the most frequent, smallest one.

    Two near words meet in exactly one pair of nodes, so counts add up over pairs.
    """
    met = node_pairs(vocab).groupBy("prefix", "suffix").agg(
        F.collect_list(F.struct("n", F.negative("id").alias("back"), "kind")).alias("met"))
    met = met.where(F.size("met") > 1).select("met", F.explode("met").alias("x"))
    split, deleted = F.lit(SPLIT), F.lit(SKIP)

    def near(y):
        both_skip = (F.col("x.kind") != split) & (y["kind"] != split)
        one_skips = (((F.col("x.kind") == split) & (y["kind"] == deleted))
                     | ((F.col("x.kind") == deleted) & (y["kind"] == split)))
        return (y["back"] != F.col("x.back")) & (both_skip | one_skips)

    found = met.select(F.negative("x.back").alias("id"), F.filter("met", near).alias("near")).where(F.size("near") > 0)
    best = F.array_max(F.transform("near", lambda y: F.struct(y["n"].alias("n"), y["back"].alias("back"))))
    return found.groupBy("id").agg(F.sum(F.size("near")).cast("long").alias("n_near"), F.max(best).alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(id, root) for ``forms`` (id, form), whose chains have no cycle: pointers are doubled until all
    stand. Occurrences at least double along a chain, so few rounds are needed."""
    at = stored(forms.select("id", F.col("form").alias("root")), "roots")
    while True:
        then = at.select(F.col("id").alias("root"), F.col("root").alias("further"))
        on = stored(at.join(then, "root", "left").select("id", F.coalesce("further", "root").alias("root"),
                                                         F.col("further").isNotNull().alias("moved")), "roots")
        if on.where("moved").isEmpty():
            return on.select("id", "root")
        at = on.select("id", "root")


def spelling_variants(docs: DataFrame) -> DataFrame:
    """Words of ``docs`` (doc_id, text) with their near words and forms: word, n, n_near, form, form_n,
    root.

    Words are the runs of ASCII letters and U+00C0 to U+00FF, A-Z lower-cased, after the deletions
    that the check sum of ``<doc_id>:<run>`` decides, with MIN_LENGTH code points and MIN_COUNT
    occurrences. Two words are near if one code point is inserted, deleted or replaced; a word's form is
    its near word of most occurrences (ties: smallest), if these are FORM_RATIO times its own; its
    root is where its forms lead.

    Null texts have no words, a null id counts as an empty one; every row counts, repeated ones too.
    Very long texts are read in slices; a word may have any length. Other columns do not matter. An
    empty table gives an empty result.
    """
    vocab = vocabulary(docs)
    near = vocab.join(near_words(vocab), "id", "left").select(
        "id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(F.col("best.n") >= FORM_RATIO * F.col("n"), F.negative("best.back")).alias("form_id"),
        F.col("best.n").alias("best_n"))
    near = stored(near, "near")
    rooted = roots(near.where("form_id is not null").select("id", F.col("form_id").alias("form")))
    name = vocab.select(F.col("id").alias("form_id"), F.col("word").alias("form"))
    last = vocab.select(F.col("id").alias("root_id"), F.col("word").alias("root"))
    found = (near.where("form_id is not null").join(rooted.withColumnRenamed("root", "root_id"), "id")
             .join(name, "form_id").join(last, "root_id"))
    alone = near.where("form_id is null").withColumns({"form": F.lit(None).cast("string"), "root": F.col("word")})
    out = found.select("word", "n", "n_near", "form", F.col("best_n").alias("form_n"), "root")
    return out.unionByName(alone.select("word", "n", "n_near", "form", F.lit(None).cast("long").alias("form_n"), "root"))


ship(__name__)
