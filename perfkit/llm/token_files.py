"""Token ids in files of Simple-8b words.

A 64-bit word holds a selector in its top four bits and, below, as many ids of one width as fit
in 60 bits. Selector 0 is an escape: the word's low bits number an entry of the block's escape
list, for ids of more than 60 bits. Ids are packed in blocks; a file ends with its block table
(where each block's words and escapes begin and how many ids it has) and its document table, so
any block, and any document, can be decoded by itself and a block is decoded by array operations.

    file  = block* | block table | document table | footer
    block = words (u64 each) | escapes (u64 each)
    block table    = per block: file offset, words, escapes, ids (u64 each)
    document table = per document: id (i64), 1 if the id is null (u64), ids (u64)
    footer = offsets of both tables, numbers of blocks and documents, MAGIC (u64 each)

All numbers are little-endian.
"""

from __future__ import annotations

import codecs
import math
import os
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from perfkit.llm.common import extend, scratch, ship, stored, text_key, text_slices
from perfkit.llm.pieces import Memo, TextEncoder
from perfkit.session import worker_cache

#: Selector 1 .. 14: ids in a word; each has 60 // count bits.
COUNTS = (60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
BLOCK_IDS = 1 << 16
#: Bits of each number below 2 ** 16.
BIT_LENGTHS = np.frexp(np.arange(1 << 16, dtype=np.float64))[1].astype(np.uint8)
# The characters that byte-level vocabularies write for bytes. Printing ones stand for
# themselves, the others follow from 256 on.
_PRINTING = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_CHARS = {b: 256 + i for i, b in enumerate(sorted(set(range(256)) - set(_PRINTING)))}
BYTE_TEXT = "".join(chr(BYTE_CHARS.get(b, b)) for b in range(256))
#: Entries of one generation of the memo of words.
HELD_WORDS = 1_000_000
#: Text bytes encoded at a time, and chunks looked up at a time.
ENCODE_BYTES = 4 << 20
LOOK_UP = 1 << 20
#: What a byte of a text can be. Others are second bytes, or first ones of U+00C0 to U+023F.
_WHITE, _ODD, _WORD, _MARK, _EDGE = 1, 2, 3, 4, 5
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[[*range(0x20), 0x7F, *range(0xCA, 256)]] = _ODD
_KIND[[0x20, 0x0A]] = _WHITE
_KIND[[*b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"]] = _WORD
_BEFORE_LETTERS = frozenset(np.flatnonzero(_KIND == _WORD).tolist()) - {*b"0123456789"} | {0x20}
_KIND[[*b",.;:!?|"]] = _MARK
_KIND[[0xC2, 0xC9]] = _EDGE  # U+0080 to U+00A0 and U+0250 to U+027F are odd
MAGIC = int.from_bytes(b"S8BIDS01", "little")
END_ID = 0


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, escapes) of the ids; each word takes the most ids that fit."""
    ids = ids.astype(np.uint64)
    n = len(ids)
    if n == 0:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.uint64)
    top = int(ids.max())
    if top < 1 << 16:
        bits = BIT_LENGTHS[ids]
    elif top < 1 << 20:
        bits = np.frexp(ids.astype(np.float64))[1].astype(np.uint8)
    else:
        bits = sum((ids >> np.uint64(w) != 0).astype(np.uint8) for w in range(64))
    # Where a count of ids does not fit, no larger one does: a place takes as many as there are fitting counts.
    fitting = np.zeros(n, dtype=np.uint8)
    padded_bits = np.concatenate([bits, np.zeros(60, dtype=np.uint8)])
    most, have = np.zeros(n, dtype=np.uint8), 0
    for count in reversed(COUNTS):
        for i in range(have, count):
            np.maximum(most, padded_bits[i:i + n], out=most)
        have = count
        fits = most <= 60 // count
        if not fits.any():
            break
        fitting += fits
    step = np.array((1, *reversed(COUNTS)), dtype=np.uint8)[fitting].tobytes()
    chain, at = [], 0
    while at < n:
        chain.append(at)
        at += step[at]
    start = np.array(chain)
    taken = fitting[start].astype(np.int64)
    selector = np.where(taken > 0, len(COUNTS) + 1 - taken, 0)
    words = np.zeros(len(start), dtype=np.uint64)
    padded = np.concatenate([ids, np.zeros(60, dtype=np.uint64)])
    for s in np.unique(selector):
        of = np.flatnonzero(selector == s)
        if s == 0:
            words[of] = np.arange(len(of), dtype=np.uint64)
            continue
        first, mine = start[of], np.full(len(of), s << 60, dtype=np.uint64)
        for i in range(COUNTS[s - 1]):
            mine |= padded[first + i] << np.uint64(i * (60 // COUNTS[s - 1]))
        words[of] = mine
    return words, ids[start[selector == 0]]


def unpack(words: np.ndarray, escapes: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` ids of a block."""
    selector = (words >> np.uint64(60)).astype(np.int64)
    count = np.array((1, *COUNTS))[selector]
    start = np.cumsum(count) - count
    out = np.zeros(int(count.sum()), dtype=np.uint64)
    for s in np.unique(selector):
        of = np.flatnonzero(selector == s)
        if s == 0:
            out[start[of]] = escapes[words[of]]
            continue
        first, mine, width = start[of], words[of], 60 // COUNTS[s - 1]
        for i in range(COUNTS[s - 1]):
            out[first + i] = (mine >> np.uint64(i * width)) & np.uint64((1 << width) - 1)
    return out[:n]


class Writer:
    """Writes one file; ids of documents are appended in order."""

    def __init__(self, stream):
        self.stream, self.waiting, self.held, self.at = stream, [], 0, 0
        self.blocks: list[tuple[int, int, int, int]] = []
        self.docs: list[tuple[int, int, int]] = []
        self.n_ids = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append((doc_id or 0, int(doc_id is None), len(ids)))
        self.n_ids += len(ids)
        while len(ids):
            part, ids = ids[:BLOCK_IDS - self.held], ids[BLOCK_IDS - self.held:]
            self.waiting.append(part)
            self.held += len(part)
            if self.held == BLOCK_IDS:
                self._flush()

    def _write(self, numbers: np.ndarray) -> None:
        raw = numbers.astype("<u8").tobytes() if numbers.dtype != np.int64 else numbers.astype("<i8").tobytes()
        self.stream.write(raw)
        self.at += len(raw)

    def _flush(self) -> None:
        if self.held:
            words, escapes = pack(np.concatenate(self.waiting))
            self.blocks.append((self.at, len(words), len(escapes), self.held))
            self._write(words)
            self._write(escapes)
            self.waiting, self.held = [], 0

    def close(self) -> None:
        self._flush()
        block_at = self.at
        self._write(np.array(self.blocks, dtype=np.uint64).reshape(-1))
        doc_at = self.at
        self._write(np.array(self.docs, dtype=np.int64).reshape(-1))
        self._write(np.array([block_at, doc_at, len(self.blocks), len(self.docs), MAGIC], dtype=np.uint64))
        self.stream.close()


class Reader:
    def __init__(self, source):
        self.source = source
        size = source.size()
        block_at, doc_at, n_blocks, n_docs, magic = self._read(size - 40, 5, "<u8").tolist()
        if magic != MAGIC:
            raise ValueError("not a token file")
        self.blocks = self._read(block_at, 4 * n_blocks, "<u8").astype(np.int64).reshape(-1, 4)
        self.docs = self._read(doc_at, 3 * n_docs, "<i8").astype(np.int64).reshape(-1, 3)

    def _read(self, at: int, n: int, kind: str) -> np.ndarray:
        return np.frombuffer(self.source.read_at(8 * n, at), dtype=kind)

    def block(self, i: int) -> np.ndarray:
        at, n_words, n_escapes, n = self.blocks[i].tolist()
        raw = self._read(at, n_words + n_escapes, "<u8")
        return unpack(raw[:n_words].astype(np.uint64), raw[n_words:].astype(np.uint64), n)

    def documents(self) -> Iterator[tuple[int | None, Iterator[np.ndarray]]]:
        """(doc_id, its ids in runs) in file order; the runs are to be read before going on."""
        held, block = np.zeros(0, dtype=np.uint64), 0
        for doc_id, null, n in self.docs.tolist():
            runs = []
            while n:
                if not len(held):
                    held, block = self.block(block), block + 1
                runs.append(held[:n])
                held, n = held[n:], n - len(runs[-1])
            yield (None if null else doc_id), iter(runs)


class Words(Memo):
    """A memo of more entries: words are many, and a merge costs more than a place."""

    def keep(self, key: str, value: bytes) -> None:
        if len(self) >= HELD_WORDS:
            self.older = dict(self)
            self.clear()
        self[key] = value


def _after_word(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether a letter or digit ends before each place of a regular text (not told below U+00C0)."""
    last, first = data[at - 1], data[np.maximum(at - 2, 0)]
    sign = (first == 0xC3) & ((last == 0x97) | (last == 0xB7))  # times and divided by
    return (_KIND[last] == _WORD) | ((last >= 0x80) & (first > 0xC2) & ~sign)


def _odd_rows(data: np.ndarray, off: np.ndarray, kind: np.ndarray, white: np.ndarray) -> np.ndarray:
    """The rows that TextEncoder.regular() refuses."""
    edge = np.flatnonzero(kind == _EDGE)
    after = data[edge + 1]
    full = np.flatnonzero(np.diff(off))
    begin, end = off[full], off[full + 1] - 1
    pairs = white[1:][np.diff(white) == 1]
    bad = np.concatenate([np.flatnonzero(kind == _ODD), edge[np.where(data[edge] == 0xC2, after <= 0xA0, after >= 0x90)],
                          begin[data[begin] == 0x20], end[data[end] == 0x20], pairs[~np.isin(pairs, begin)]])
    return np.unique(np.searchsorted(off, bad, "right") - 1)


class BatchEncoder:
    """Ids of the texts of a batch, as little-endian numbers of ``width``.

    Texts are cut into chunks that the library would encode separately: a single space or line break
    begins one, and so does a mark after a letter or digit. Arrow numbers the distinct chunks, so that
    each is looked up once a batch, and puts their ids in place. An irregular text is one chunk.
    """

    def __init__(self, pattern: str, encode_piece: Callable[[bytes], list[int]],
                 encode_text: Callable[[str], list[int]], specials: list[str], width: str):
        self.split = regex.compile(pattern)
        self.encode_piece, self.encode_text = encode_piece, encode_text
        self.specials = [s.encode() for s in specials]
        self.formats = [struct.Struct(f"<{n}{'H' if width == '<u2' else 'I'}") for n in range(32)]
        self.width = width
        self.chunks = Words(self._chunk)
        self.pieces = Memo(self._piece)

    def _packed(self, ids: list[int]) -> bytes:
        n = len(ids)
        return self.formats[n].pack(*ids) if n < len(self.formats) else np.array(ids, dtype=self.width).tobytes()

    def _piece(self, piece: str) -> bytes:
        return self._packed(self.encode_piece(piece.encode()))

    def _chunk(self, chunk: bytes) -> bytes:
        if chunk[1:].isalpha() and chunk[0] in _BEFORE_LETTERS:  # ASCII letters only
            return self._packed(self.encode_piece(chunk))
        text = chunk.decode()
        rest = text[1:] if text[0] in " \n" else text
        if rest.isalpha() and text[0] != "\n" and (text.isascii() or max(text) < "\u0250"):
            return self._packed(self.encode_piece(chunk))
        if TextEncoder.regular(rest) and not any(s in chunk for s in self.specials):
            return b"".join(map(self.pieces.__getitem__, self.split.findall(text)))
        return self._packed(self.encode_text(text))

    def _starts(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Where chunks begin."""
        kind = _KIND[data]
        cut = kind == _WHITE
        odd = _odd_rows(data, off, kind, np.flatnonzero(cut)).tolist()
        marks = np.flatnonzero(kind == _MARK)
        marks = marks[marks > 0]
        cut[marks[_after_word(data, marks)]] = True
        for special in self.specials:
            # A special token's string in a text is what the library makes of it in context.
            if special in (whole := data.tobytes()):
                odd += [i for i in range(len(off) - 1) if special in whole[off[i]:off[i + 1]]]
        for i in odd:
            cut[off[i]:off[i + 1]] = False
        cut[off[:-1][np.diff(off) > 0]] = True
        return np.flatnonzero(cut)

    def _look_up(self, data: np.ndarray, edges: np.ndarray) -> pa.Array:
        """The ids of the chunks between ``edges``."""
        mine = data[edges[0]:edges[-1]]
        at = (edges - edges[0]).astype(np.int32)
        chunks = pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(at), pa.py_buffer(mine)])
        numbered = chunks.dictionary_encode()
        known = list(map(self.chunks.__getitem__, numbered.dictionary.to_numpy(zero_copy_only=False)))
        return pa.array(known, pa.binary()).take(numbered.indices)

    def encode(self, data: np.ndarray, off: np.ndarray) -> pa.Array:
        """The ids of each text, given as UTF-8 bytes with offsets."""
        starts = self._starts(data, off)
        if not len(starts):
            return pa.array([b""] * (len(off) - 1), pa.binary())
        edges = np.append(starts, len(data))
        ids = pa.concat_arrays([self._look_up(data, edges[i:i + LOOK_UP + 1]) for i in range(0, len(starts), LOOK_UP)])
        _, at, values = ids.buffers()
        ends = np.frombuffer(at, dtype=np.int32)[ids.offset:][np.searchsorted(starts, off)]
        return pa.Array.from_buffers(pa.binary(), len(off) - 1, [None, pa.py_buffer(ends), values])


def id_width(library: Tokenizer) -> str:
    """Ids take two bytes where the vocabulary allows it."""
    return "<u2" if library.get_vocab_size() <= 1 << 16 else "<u4"


def library_encoder(path: str, pattern: str) -> BatchEncoder:
    """The worker's encoder, kept from task to task: pieces go to the merges of the tokenizer library,
    irregular texts to the library as a whole."""
    encoders = worker_cache().setdefault("library encoders", {})
    if path not in encoders:
        # One text is encoded at a time: the library's threads would only compete with Spark's tasks.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        library = Tokenizer.from_file(path)
        merges = library.model.tokenize

        def piece(raw: bytes) -> list[int]:
            return [t.id for t in merges(codecs.charmap_decode(raw, "strict", BYTE_TEXT)[0])]

        encoders[path] = BatchEncoder(
            pattern, piece, lambda text: library.encode(text, add_special_tokens=False).ids,
            [t.content for t in library.get_added_tokens_decoder().values()], id_width(library))
    return encoders[path]


def _bounds(docs: DataFrame, parts: int) -> tuple[list[int], int]:
    """Ascending doc_ids that cut the table into about equal parts (an id with very many rows fills
    several), and the number of further parts for null ids."""
    shares = [i / parts for i in range(1, parts)]
    row = docs.agg(F.percentile_approx("doc_id", F.array(*map(F.lit, shares)), 100 * parts).alias("at") if shares
                   else F.lit(None).alias("at"), F.count("*").alias("n"), F.count("doc_id").alias("known")).first()
    missing = row["n"] - row["known"]
    return list(row["at"] or []), math.ceil(parts * missing / row["n"]) if row["n"] else 0


def write_tokens(docs: DataFrame, path: str, pattern: str, folder: str) -> DataFrame:
    """Encodes ``docs`` (doc_id, text), appends END_ID to each text and writes one file per part, in
    ascending doc_id order over the parts, null ids last. Returns the stored manifest (part, file,
    n_docs, n_ids): files of lost or repeated task attempts are not in it.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bounds, null_parts = _bounds(docs, parts)
    cuts = np.array(bounds, dtype=np.int64)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = library_encoder(path, pattern)
        for batch in batches:
            for rows, data, off in text_slices(batch, "text", ENCODE_BYTES):
                known = rows.column("doc_id")
                ids = known.fill_null(0).to_numpy(zero_copy_only=False)
                tie = rows.column("text_key").to_numpy()
                share = (tie.astype(np.float64) + 2.0 ** 63) / 2.0 ** 64
                left, right = np.searchsorted(cuts, ids, "left"), np.searchsorted(cuts, ids, "right")
                null = np.asarray(known.is_null())
                left = np.where(null, len(cuts) + 1, left)
                right = np.where(null, len(cuts) + max(null_parts, 1), right)
                part = np.minimum(left + (share * (right - left + 1)).astype(np.int64), right)
                yield pa.RecordBatch.from_arrays([known, rows.column("text_key"), pa.array(part.astype(np.int32)),
                                                  enc.encode(data, off)], names=schema.fieldNames())

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, writer, name = [], None, None

        def finish() -> None:
            if writer is not None:
                writer.close()
                made.append((part, name, len(writer.docs), writer.n_ids))

        store, root = pafs.FileSystem.from_uri(folder)
        part = None
        for batch in batches:
            for doc_id, p, raw in zip(*(batch.column(c) for c in ("doc_id", "part", "tokens"))):
                if writer is None or p.as_py() != part:
                    finish()
                    part = p.as_py()
                    name = f"ids-{part:06d}-{uuid.uuid4().hex}"
                    store.create_dir(root, recursive=True)
                    writer = Writer(store.open_output_stream(f"{root}/{name}"))
                ids = np.frombuffer(raw.as_buffer(), dtype=width)
                writer.add(doc_id.as_py(), np.append(ids, ids.dtype.type(END_ID)))
        finish()
        if made:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*made)],
                                             names=["part", "file", "n_docs", "n_ids"])

    width = id_width(Tokenizer.from_file(path))
    src = docs.select("doc_id", text_key(F.col("text")).alias("text_key"), "text")
    schema = extend(src.drop("text").schema, "part int, tokens binary")
    total = len(cuts) + 1 + null_parts
    dealt = src.mapInArrow(encode, schema).repartitionById(total, F.col("part"))
    ordered = dealt.sortWithinPartitions(F.col("part"), F.col("doc_id").asc_nulls_last(), "text_key")
    return stored(ordered.mapInArrow(write, "part long, file string, n_docs long, n_ids long"), "manifest")


def read_tokens(manifest: DataFrame, folder: str, keep_ids: bool = False) -> DataFrame:
    """Per document of the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32
    (of the ids as little-endian unsigned 32-bit integers) and, with ``keep_ids``, ids."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    based = manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))  # a row per file
    ddl = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * keep_ids

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for name, base in zip(batch.column("file").to_pylist(), batch.column("base").to_pylist()):
                rows: list[tuple] = []
                with store.open_input_file(f"{root}/{name}") as source:
                    for doc_id, runs in Reader(source).documents():
                        crc, n, ids = 0, 0, []
                        for run in runs:
                            crc = zlib.crc32(run.astype("<u4").tobytes(), crc)
                            n += len(run)
                            if keep_ids:
                                ids.append(run)
                        rows.append((doc_id, base, n, crc, *([np.concatenate(ids).astype(np.int64)] if keep_ids else [])))
                        base += n
                        if len(rows) == 4096:
                            yield as_batch(rows)
                            rows = []
                if rows:
                    yield as_batch(rows)

    def as_batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64()] * 4 + [pa.list_(pa.int64())] * keep_ids
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                          names=[c.split(" ")[0] for c in ddl.split(", ")])

    files = max(1, manifest.count())
    return based.select("file", "base", F.row_number().over(Window.orderBy("part")).alias("i")).repartitionById(
        files, (F.col("i") - 1).cast("int")).mapInArrow(read, ddl)


def token_files(docs: DataFrame, path: str, pattern: str, folder: str | None = None,
                keep_ids: bool = False) -> DataFrame:
    """Writes ``docs`` (doc_id, text) as token files under ``folder`` (default: the shared folder)
    and reads them back: see write_tokens and read_tokens.

    Null and empty texts have the end id alone. Rows that repeat an id follow each other in the
    order of their texts' hashes, so equal rows are interchangeable. Null ids come last. Extra
    columns are not carried. An empty table writes no file and gives an empty result.
    """
    folder = folder or scratch(docs.sparkSession, "tokens")
    folder = folder if "://" in folder else f"file://{folder}"
    return read_tokens(write_tokens(docs, path, pattern, folder), folder, keep_ids)


ship(__name__)
