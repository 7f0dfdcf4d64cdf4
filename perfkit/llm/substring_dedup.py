"""Removal of long word passages that an earlier document already has.

1. Every window of ``span`` words gets an anchor, the least hash of GRAM consecutive words among
   its leading ones; neighbouring windows share anchors, so a document is a list of passages
   (anchor, first window, last window). Equal windows have equal anchors wherever they stand.
2. Only anchors found under two or more document ids can hold a shared window. Equal passages of
   an anchor are one passage with the least document id.
3. Passages of an anchor are compared in a shard: a compressed FM-index over those that some later
   document could repeat, against which the passages of later documents are streamed; matching
   statistics by backward search give the stretches of at least ``span`` words, and the least
   document that has each.
4. An anchor with very many different passages is split by longer context until each part has one:
   its windows are grouped by their whole content. So no shard holds an unbounded group.
5. Windows with an earlier document are mapped back to rows and their words removed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perfkit.llm.common import (RollingHash, anchor_runs, extend, match_rows, packed, ship, stored, text_key,
                                text_slices, unpacked, word_spans)
from perfkit.llm.fm_index import FMIndex

SPAN = 50
GRAM = 8
#: Anchors with more different passages than this are split by longer context: a size switch that leaves the
#: FM-index for a grouping by whole windows. The result is the same for every value (tested with 0).
SPLIT = 2000
#: Words of passages in one FM-index, unless a single anchor has more.
SHARD_WORDS = 200_000
#: Null ids count as the greatest.
LAST = (1 << 63) - 1


def _windows(data: np.ndarray, off: np.ndarray, seed: int):
    """Word bounds, first word of each row, and a hash over the row's words."""
    starts, ends, first = word_spans(data, off)
    words = RollingHash(data, 11).spans(starts, ends)
    return starts, ends, first, RollingHash(words, seed)


def passages(docs: DataFrame, span: int = SPAN) -> DataFrame:
    """(doc_id, text_key, anchor, first, last, content): the windows starting at words first..last
    of a row have this anchor; content tells different passages of an anchor apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, off in text_slices(batch, "text"):
                _, _, first, h = _windows(data, off, 21)
                n = int(first[-1])
                at = np.arange(max(0, n - GRAM + 1))
                gram = np.concatenate([h.spans(at, at + GRAM), np.zeros(n - len(at), dtype=np.uint64)])
                row, anchor, lo, hi = anchor_runs(gram, first, span, span - GRAM + 1)
                content = h.spans(lo, hi + span) ^ ((anchor - lo).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id").take(pa.array(row)), rows.column("text_key").take(pa.array(row)),
                     pa.array(gram[anchor].view(np.int64)), pa.array((lo - first[row]).astype(np.int32)),
                     pa.array((hi - first[row]).astype(np.int32)), pa.array(content.view(np.int64))],
                    names=["doc_id", "text_key", "anchor", "first", "last", "content"])

    src = docs.select("doc_id", text_key(F.col("text")).alias("text_key"), "text")
    return src.mapInArrow(run, extend(src.drop("text").schema,
                                      "anchor long, first int, last int, content long"))


def _fetch(docs: DataFrame, wanted: DataFrame, span: int) -> DataFrame:
    """Reads passages out of the texts: ``text`` of a passage to index, or, for a split anchor, the
    content hashes of its windows."""

    names = ["anchor", "content", "least", "anchor_least", "anchor_most", "passage", "windows"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, off in text_slices(batch, "text"):
                starts, ends, first, h = _windows(data, off, 22)
                asked = rows.column("wanted")
                row = np.repeat(np.arange(len(asked)), np.asarray(asked.value_lengths()))
                asked = asked.flatten()
                lo = first[row] + asked.field("first").to_numpy(zero_copy_only=False)
                hi = first[row] + asked.field("last").to_numpy(zero_copy_only=False)
                split = asked.field("split").to_numpy(zero_copy_only=False)
                raw = data.tobytes()
                text = [None if s else raw[a:b] for s, a, b in zip(split, starts[lo], ends[hi + span - 1])]
                hashes = [h.spans(np.arange(a, b + 1), np.arange(a, b + 1) + span).view(np.int64) if s else None
                          for s, a, b in zip(split, lo, hi)]
                yield pa.RecordBatch.from_arrays(
                    [asked.field(c) for c in ("anchor", "content", "least", "anchor_least", "anchor_most")]
                    + [pa.array(text, pa.binary()), pa.array(hashes, pa.list_(pa.int64()))], names=names)

    per_doc = wanted.groupBy("doc_id", "text_key").agg(F.collect_list(F.struct(
        "anchor", "content", "least", "anchor_least", "anchor_most", "first", "last", "split")).alias("wanted"))
    src = docs.select("doc_id", text_key(F.col("text")).alias("text_key"), "text")
    return (match_rows(src, per_doc, "inner").select("text", "wanted")
            .mapInArrow(run, "anchor long, content long, least long, anchor_least long, anchor_most long, "
                             "passage binary, windows array<long>"))


def _search(found: DataFrame, span: int) -> DataFrame:
    """(anchor, content, starts): window starts, relative to the passage, that a smaller id has."""

    def shard(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
        _, data, off = next(text_slices(rows, "passage", limit=1 << 40))
        starts, ends, first = word_spans(data, off)
        symbols = np.unique(RollingHash(data, 11).spans(starts, ends), return_inverse=True)[1].astype(np.int64) + 1
        least = rows.column("least").to_numpy()
        indexed = np.flatnonzero(least < rows.column("anchor_most").to_numpy())
        asked = np.flatnonzero(least > rows.column("anchor_least").to_numpy())
        lengths = np.diff(first)
        fm = FMIndex(symbols[np.repeat(np.isin(np.arange(len(least)), indexed), lengths)], lengths[indexed],
                     int(symbols.max(initial=0)) + 1)
        ask = np.repeat(np.isin(np.arange(len(least)), asked), lengths)
        offsets = np.concatenate([[0], np.cumsum(lengths[asked])])
        long, place = fm.matching_statistics(symbols[ask], offsets)
        which, earliest = fm.least_per_class(least[indexed], span)
        owner = np.repeat(np.arange(len(asked)), lengths[asked])
        hit = np.flatnonzero(long >= span)
        hit = hit[earliest[which[place[hit]]] < least[asked][owner[hit]]]
        begin = hit - offsets[owner[hit]]
        per = np.concatenate([[0], np.cumsum(np.bincount(owner[hit], minlength=len(asked)))])
        return pa.RecordBatch.from_arrays(
            [rows.column("anchor").take(pa.array(asked)), rows.column("content").take(pa.array(asked)),
             pa.ListArray.from_arrays(pa.array(per.astype(np.int32)), pa.array(begin.astype(np.int32)))],
            names=["anchor", "content", "starts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Whole anchors, in order, until a shard is full."""
        waiting: list[pa.RecordBatch] = []
        held = 0
        for batch in batches:
            anchor = batch.column("anchor").to_numpy()
            cuts = np.flatnonzero(anchor[1:] != anchor[:-1]) + 1
            at = 0
            if waiting and len(anchor) and waiting[-1].column("anchor")[-1].as_py() != anchor[0]:
                cuts = np.concatenate([[0], cuts])
            for cut in [*cuts.tolist(), None]:
                piece = batch.slice(at, None if cut is None else cut - at)
                if piece.num_rows:
                    waiting.append(piece)
                    held += piece.column("passage").nbytes // 6
                if cut is None:
                    break
                at = cut
                if held >= SHARD_WORDS:
                    yield shard(waiting)
                    waiting, held = [], 0
        if waiting:
            yield shard(waiting)

    return (found.where(F.col("passage").isNotNull())
            .select("anchor", "content", "least", "anchor_least", "anchor_most", "passage")
            .repartition("anchor").sortWithinPartitions("anchor")
            .mapInArrow(run, "anchor long, content long, starts array<int>"))


def shared_spans(docs: DataFrame, span: int = SPAN, split: int = SPLIT) -> DataFrame:
    """(doc_id, text_key, spans): word ranges [from, to) of windows that a smaller doc_id has."""
    rank = F.coalesce(F.col("doc_id"), F.lit(LAST))
    all_passages = passages(docs, span)
    shared = (all_passages.groupBy("anchor").agg(F.min(rank).alias("anchor_least"), F.max(rank).alias("anchor_most"))
              .where("anchor_least < anchor_most"))
    # Written before it is joined: the join can then split an anchor with very many rows.
    held = stored(all_passages.join(stored(shared, "shared"), "anchor"), "passages")
    distinct = held.groupBy("anchor", "content").agg(
        F.min(F.struct(rank.alias("least"), "doc_id", "text_key", "first", "last")).alias("at"),
        F.min("anchor_least").alias("anchor_least"), F.min("anchor_most").alias("anchor_most"))
    distinct = stored(distinct.select("anchor", "content", "anchor_least", "anchor_most", "at.*"), "distinct")
    many = (distinct.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1")
            .select("anchor", (F.col("n") > split).alias("split")))
    found = stored(_fetch(docs, distinct.join(stored(many, "many"), "anchor"), span), "contents")

    searched = _search(found, span)
    each = found.where(F.col("windows").isNotNull()).select(
        "anchor", "content", "least", F.posexplode("windows").alias("start", "window"))
    first_of = stored(each.groupBy("window").agg(F.min("least").alias("earliest")), "first-windows")
    hot = (each.join(first_of, "window").where("earliest < least")
           .groupBy("anchor", "content").agg(F.collect_list("start").alias("starts")))
    starts = searched.unionByName(hot)

    owner = distinct.select("anchor", "content", "least").join(starts, ["anchor", "content"], "left")
    mine = held.join(stored(owner, "starts"), ["anchor", "content"])
    whole = F.array(F.struct(F.col("first").alias("from"), (F.col("last") + span).alias("to")))
    some = F.transform(F.coalesce("starts", F.array().cast("array<int>")),
                       lambda s: F.struct((F.col("first") + s).alias("from"), (F.col("first") + s + span).alias("to")))
    return (mine.withColumn("spans", F.when(rank > F.col("least"), whole).otherwise(some))
            .where(F.size("spans") > 0)
            .groupBy("doc_id", "text_key").agg(F.flatten(F.collect_list("spans")).alias("spans")))


def substring_dedup(docs: DataFrame, span: int = SPAN, split: int = SPLIT) -> DataFrame:
    """Rows of ``docs`` with their other columns, and n_words, n_removed, kept (the remaining words,
    joined by one space). ``docs`` columns of these names are replaced.

    Null or empty text has no words and an empty ``kept``. A null doc_id counts as the greatest:
    it loses passages to every other id and gives none. Rows that repeat an id don't take
    passages from each other. A text shorter than ``span`` words is unchanged. Empty table: empty
    result.
    """
    made = ["n_words", "n_removed", "kept"]
    carried = [c for c in docs.columns if c not in made]
    left = packed(docs)
    schema = extend(left.drop("text_key").schema, "n_words long, n_removed long, kept string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, off in text_slices(batch, "text"):
                starts, ends, first = word_spans(data, off)
                spans = rows.column("spans")
                gone = np.zeros(len(starts) + 1, dtype=np.int64)
                row = np.repeat(np.arange(len(spans)), spans.value_lengths().fill_null(0).to_numpy())
                flat = spans.flatten()
                lo = first[row] + flat.field("from").to_numpy(zero_copy_only=False)
                hi = first[row] + flat.field("to").to_numpy(zero_copy_only=False)
                np.add.at(gone, lo, 1)
                np.add.at(gone, hi, -1)
                keep = np.cumsum(gone[:-1]) <= 0
                # Kept words, each followed by a space, as one gather of bytes; a row's last space goes.
                s, e = starts[keep], ends[keep]
                size = e - s + 1
                out = np.cumsum(size) - size
                total = int(size.sum())
                pick = np.arange(total) + np.repeat(s - out, size)
                joined = np.append(data, np.uint8(32))[np.minimum(pick, len(data))]
                joined[out + size - 1] = 32
                kept_first = np.concatenate([[0], np.cumsum(keep)])[first]
                text_at = np.concatenate([out, [total]])[kept_first]
                raw = joined.tobytes()
                texts = [raw[a:max(a, b - 1)].decode() for a, b in zip(text_at[:-1], text_at[1:])]
                n = np.diff(first)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(c) for c in ("doc_id", "text", "others")]
                    + [pa.array(n.astype(np.int64)), pa.array((n - np.diff(kept_first)).astype(np.int64)),
                       pa.array(texts, pa.string())], names=schema.fieldNames())

    out = match_rows(left, shared_spans(docs, span, split), "left").drop("text_key").mapInArrow(run, schema)
    return out.select(*unpacked(carried), *made)


def without_shared(docs: DataFrame, span: int = SPAN) -> DataFrame:
    """``docs`` with shared passages cut out: a text that loses words becomes its remaining words,
    others stay as they are; n_chars, if there, is the new length."""
    here = packed(docs).drop("text_key")
    out = substring_dedup(here, span)
    cut = F.col("n_removed") > 0
    out = out.select("doc_id", F.when(cut, F.col("kept")).otherwise(F.col("text")).alias("text"), "others",
                     cut.alias("cut"))
    cols = unpacked(docs.columns)
    if "n_chars" in docs.columns:
        i = docs.columns.index("n_chars")
        kind = docs.schema["n_chars"].dataType
        cols[i] = F.when(F.col("cut"), F.char_length("text").cast(kind)).otherwise(cols[i]).alias("n_chars")
    return out.select(cols)


ship(__name__)
