"""Packing token sequences by hierarchical residual best fit.

Every task encodes its documents, cuts the long ones into pieces of the capacity and packs its pieces
by best fit, longest first. Nearly full sequences are final. The emptiest of the others go up a tree:
they are dealt into groups, where each counts as one item of its fill, and are packed by best fit
again, round by round, until one group is left. Only lengths and check sums travel, never ids.

Ids come from a tokenizer with word ends that drops white space. Chunks between white space are
encoded separately there, so a text is split by plain string operations and chunks are looked up;
new words go to the library's merges, and irregular texts to the library whole.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from perfkit.llm.common import ship, stored
from perfkit.llm.token_files import BYTE_CHARS, Words

CAPACITY = 2048
#: A sequence with at most so much room (a share of the capacity) is nearly full, and final.
NEARLY_FULL = 1 / 64
#: Pieces packed at once by a task, a unit of the first round.
UNIT_PIECES = 1 << 16
#: A unit or group hands up at most so many sequences, the emptiest; what it keeps is final as it is.
HAND_UP = 256
#: Sequences that one group of a later round packs, about.
GROUP = 4096
END_ID = 0
#: Characters of a text split at a time.
STREAM = 1 << 18
#: Texts of other characters are irregular (classes, case or composition may differ between libraries).
_ODD = re.compile("[^\\x20-\\x7E\\t\\n\\r\\u00A1-\\u012F\\u0132-\\u024F]")
#: Marks next to each other are one piece.
_MARKS_TOGETHER = re.compile("[^\\s0-9A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u024F]{2}")
_SINGLE_MARKS = ",.;:!?|"
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


class WordEncoder:
    """Ids of texts as little-endian unsigned 32-bit bytes, for tokenizers with word ends."""

    def __init__(self, path: str):
        # One text is encoded at a time: the library's threads would only compete with Spark's tasks.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.library = Tokenizer.from_file(path)
        self.merges = self.library.model.tokenize
        self.specials = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.known = Words(self._chunk)

    def _whole(self, text: str) -> bytes:
        ids = self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids
        return np.array(ids, dtype="<u4").tobytes()

    def _chunk(self, chunk: str) -> bytes:
        """A word is one piece and goes straight to the library's merges; any other chunk is split there."""
        if not chunk.isalpha():
            word = chunk.rstrip(_MARKS)
            if word.isalpha():
                return self.known[word] + self.known[chunk[len(word):]]
            return self._whole(chunk)
        raw = chunk if chunk.isascii() else chunk.encode().decode("latin-1").translate(BYTE_CHARS)
        return b"".join([t.id.to_bytes(4, "little") for t in self.merges(raw)])

    @staticmethod
    def _split(text: str) -> list[str]:
        """Chunks of a regular text; a mark is a piece of its own where it stands beside no other."""
        text = text.lower()
        if not _MARKS_TOGETHER.search(text):
            for mark in _SINGLE_MARKS:
                if mark in text:
                    text = text.replace(mark, f" {mark} ")
        return text.split()

    def encode(self, text: str) -> Iterator[bytes]:
        """The ids of a text, in runs."""
        if _ODD.search(text) or any(s in text for s in self.specials):
            yield self._whole(text)
            return
        at = 0
        while at < len(text):
            end = text.find(" ", at + STREAM) if len(text) - at > STREAM else -1
            end = len(text) if end < 0 else end
            yield b"".join(map(self.known.__getitem__, self._split(text[at:end])))
            at = end


_ENCODERS: dict[str, WordEncoder] = {}


def word_encoder(path: str) -> WordEncoder:
    """The worker's encoder, made once per process."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def cut(runs: Iterator[bytes], capacity: int) -> Iterator[tuple[int, int, int, int]]:
    """(piece, start, length, crc32) of one document's ids, END_ID added."""
    size, piece, held = 4 * capacity, 0, b""
    for run in (*runs, END_ID.to_bytes(4, "little")):
        held = held + run if held else run
        at = 0
        while len(held) - at > size:
            yield piece, piece * capacity, capacity, zlib.crc32(held[at:at + size])
            piece, at = piece + 1, at + size
        held = held[at:]
    yield piece, piece * capacity, len(held) // 4, zlib.crc32(held)


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best fit, longest first: (sequence, offset) of every item and the fill of every sequence.

    Sequences are numbered as they are opened. ``room`` has a bit for every size of room that an
    open sequence has, so the least sufficient room is its lowest bit from the item's length on.
    """
    sequence, offset = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
    fill: list[int] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    room = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[i])
        enough = room >> length
        if enough:
            r = length + (enough & -enough).bit_length() - 1
            s = by_room[r].pop()
            if not by_room[r]:
                room ^= 1 << r
        else:
            r, s = capacity, len(fill)
            fill.append(0)
        sequence[i], offset[i] = s, capacity - r
        fill[s] += length
        if r > length:
            by_room[r - length].append(s)
            room |= 1 << (r - length)
    return sequence, offset, np.array(fill, dtype=np.int64)


def handed_up(fill: np.ndarray, capacity: int) -> np.ndarray:
    """Which sequences go up: not nearly full, and among the HAND_UP emptiest."""
    up = fill < capacity - int(capacity * NEARLY_FULL)
    if up.sum() > HAND_UP:
        keep = np.argsort(fill, kind="stable")[:HAND_UP]
        some = np.zeros(len(fill), dtype=bool)
        some[keep] = True
        up &= some
    return up


def cut_and_pack(docs: DataFrame, path: str, capacity: int) -> DataFrame:
    """The first round, without a shuffle: pieces with their sequence, their offset there, the
    sequence's fill and whether it goes up."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, made, base = word_encoder(path), [], TaskContext.get().partitionId() << 40

        def unit() -> pa.RecordBatch:
            nonlocal base
            doc_id, piece, start, length, crc = zip(*made)
            sequence, offset, fill = best_fit(np.array(length), capacity)
            up = handed_up(fill, capacity)
            out = pa.RecordBatch.from_arrays(
                [pa.array(doc_id, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array(sequence + base),
                 pa.array(offset), pa.array(fill[sequence]), pa.array(up[sequence])],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence", "offset", "fill", "up"])
            base += len(fill)
            made.clear()
            return out

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                for p in cut(encoder.encode(text.as_py() or ""), capacity):
                    made.append((doc_id, *p))
                    if len(made) == UNIT_PIECES:
                        yield unit()
        if made:
            yield unit()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        pack, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence long, offset long, "
              "fill long, up boolean")


def merge_round(items: DataFrame, groups: int, capacity: int) -> DataFrame:
    """One round over (sequence, fill): (sequence, into, shift, fill, up). A merged sequence has the
    number of the item at its start."""

    def merge(table: pa.Table) -> pa.Table:
        table = table.sort_by("sequence")
        number = table.column("sequence").to_numpy()
        sequence, shift, fill = best_fit(table.column("fill").to_numpy(), capacity)
        first = np.zeros(len(fill), dtype=np.int64)
        first[sequence[shift == 0]] = number[shift == 0]
        up = handed_up(fill, capacity)
        return pa.table({"sequence": number, "into": first[sequence], "shift": shift, "fill": fill[sequence],
                         "up": up[sequence]})

    dealt = items.withColumn("part", F.pmod(F.xxhash64("sequence"), F.lit(groups)))
    return dealt.groupBy("part").applyInArrow(
        merge, "sequence long, into long, shift long, fill long, up boolean")


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """Packs ``docs`` (doc_id, text) into few sequences of at most ``capacity`` tokens. Per piece:
    doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its text's ids and END_ID; null and empty texts have END_ID alone. Only documents
    longer than the capacity are cut. Every row is a document of its own, also where ids repeat or
    are null. Very long texts are encoded in runs. Extra columns are not carried; an empty table
    gives an empty result. Equal lengths are packed in row order, so sequence numbers may differ
    between partitionings of the same rows.
    """
    pieces = stored(cut_and_pack(docs, path, capacity), "pieces")
    going = pieces.where("up and offset = 0").select("sequence", "fill")
    moves: list[DataFrame] = []
    while (n := going.count()) > 1:
        groups = -(-n // GROUP)
        out = stored(merge_round(going, groups, capacity), "merged")
        moves.append(out.select("sequence", "into", "shift"))
        if groups == 1:
            break
        going = out.where("up and shift = 0").select("sequence", "fill")
    if not moves:
        placed = pieces.withColumn("sequence_id", F.col("sequence"))
    else:
        last = moves.pop()
        while moves:  # a sequence that moved in one round moves on with the sequence it went into
            then = last.select(F.col("sequence").alias("into"), F.col("into").alias("to"), F.col("shift").alias("by"))
            last = moves.pop().join(then, "into", "left").select(
                "sequence", F.coalesce("to", "into").alias("into"),
                (F.col("shift") + F.coalesce("by", F.lit(0))).alias("shift"))
        placed = pieces.join(last, "sequence", "left").withColumns({
            "sequence_id": F.coalesce("into", "sequence"),
            "offset": F.col("offset") + F.coalesce("shift", F.lit(0))})
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


ship(__name__)
