"""Byte-level BPE encoding without running merges, and decoding.

Bytes are mapped to Latin-1 characters so that an Aho-Corasick automaton over all tokens runs on
them. A piece is encoded from the longest token at each place; a token may follow another only if
the two, merged from scratch, come out as themselves again (memoised), else the next shorter
token is tried, else the previous token is given up and its end marked as a dead end. Every place
is marked at most once, so the work is linear in the piece; the result equals that of the merges.

Pieces (the matches of the split pattern) repeat heavily, so their ids are memoised in bounded
tables. A very long text is split as a stream.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from perfkit.llm.common import extend, ship
from perfkit.llm.pieces import TextEncoder
from perfkit.session import worker_cache

#: Entries of the table of token pairs; a full table is emptied.
PAIRS = 1_000_000

def load_ranks(path: str) -> dict[bytes, int]:
    """A rank file: one base64 token and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


class Vocabulary:
    """Tokens with the tables that the encoder needs; made once per worker."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {i: b for b, i in ranks.items()}
        self._fits: dict[int, bool] = {}
        # The tokens at a token's right and left edge while it is being merged, last first.
        self._right_edge: dict[bytes, list[bytes]] = {}
        self._left_edge: dict[bytes, list[bytes]] = {}
        self.finder = ahocorasick.Automaton()
        # Tokens that no sequence of merges produces can't occur in an encoding.
        reachable = set()
        for b in sorted(ranks, key=ranks.__getitem__):
            parts = self.merge(b, down_to=2)
            if len(b) == 1:
                self._right_edge[b], self._left_edge[b] = [b], [b]
            elif len(parts) == 2 and all(p in reachable for p in parts):
                self._right_edge[b] = [b, *self._right_edge[parts[1]]]
                self._left_edge[b] = [b, *self._left_edge[parts[0]]]
            else:
                continue
            reachable.add(b)
            self.finder.add_word(b.decode("latin-1"), (ranks[b], len(b)))
        self.finder.make_automaton()
        #: Of each token, the longest token that is a proper prefix of it, with its length.
        self.shorter: dict[int, tuple[int, int]] = {}
        for b in reachable:
            for end in range(len(b) - 1, 0, -1):
                if b[:end] in reachable:
                    self.shorter[ranks[b]] = (ranks[b[:end]], end)
                    break

    def merge(self, piece: bytes, down_to: int = 1) -> list[bytes]:
        """The defining procedure, for short inputs: merge the adjacent pair of least rank first."""
        parts = [bytes([b]) for b in piece]
        never = len(self.ranks) + 256
        while len(parts) > down_to:
            rank, i = min((self.ranks.get(parts[i] + parts[i + 1], never), i) for i in range(len(parts) - 1))
            if rank == never:
                break
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def fits(self, left: int, right: int) -> bool:
        """Whether ``right`` may follow ``left``: merging both from bytes never joins across."""
        pair = left << 32 | right
        known = self._fits.get(pair)
        if known is None:
            if len(self._fits) >= PAIRS:
                self._fits.clear()
            known = self._fits[pair] = self._stay_apart(self.bytes_of[left], self.bytes_of[right])
        return known

    def _stay_apart(self, left: bytes, right: bytes) -> bool:
        rank, never = self.ranks, len(self.ranks) + 256
        ls, rs = self._right_edge[left], self._left_edge[right]
        i, j = len(ls) - 1, len(rs) - 1
        while True:
            across = rank.get(ls[i] + rs[j], never)
            next_l = rank[ls[i - 1]] if i else never
            next_r = rank[rs[j - 1]] if j else never
            # Of equal ranks the leftmost pair merges first.
            if across < next_l and across <= next_r and across < never:
                return False
            if not i and not j:
                return True
            if next_l <= next_r:
                i -= 1
            else:
                j -= 1

    def encode_piece(self, piece: bytes) -> list[int]:
        """Token ids of one piece."""
        if piece in self._left_edge:
            return [self.ranks[piece]]
        n, text = len(piece), piece.decode("latin-1")
        known, shorter = self._fits.get, self.shorter
        # The longest token at each place in turn is the answer if no neighbours clash.
        out = [token[0] for _, token in self.finder.iter_long(text)]
        before = out[0]
        for token in out[1:]:
            fit = known(before << 32 | token)
            if not (fit or fit is None and self.fits(before, token)):
                break
            before = token
        else:
            return out
        longest: list = [None] * n
        for last, token in self.finder.iter(text):
            longest[last - token[1] + 1] = token  # ends ascend: the longest comes last
        dead = set()  # places from which no token leads on
        out: list[tuple[int, int]] = []
        at, token = 0, longest[0]
        before = -1
        while at < n:
            end = at + token[1]
            if end not in dead:
                fit = True if before < 0 else known(before << 32 | token[0])
                if fit or fit is None and self.fits(before, token[0]):
                    out.append(token)
                    before, at = token[0], end
                    if at < n:
                        token = longest[at]
                    continue
            token = shorter.get(token[0])
            if token is None:
                dead.add(at)
                token = out.pop()
                at -= token[1]
                before = out[-1][0] if out else -1
        return [t[0] for t in out]


class Encoder(TextEncoder):
    def __init__(self, vocabulary: Vocabulary, pattern: str):
        super().__init__(pattern, lambda piece: vocabulary.encode_piece(piece.encode()))
        self.vocabulary = vocabulary

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.vocabulary.bytes_of.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


def encoder(path: str, pattern: str) -> Encoder:
    """The worker's encoder for a rank file, kept from task to task; ``path`` must exist on every executor."""
    encoders = worker_cache().setdefault("byte encoders", {})
    key = (path, pattern)
    if key not in encoders:
        encoders[key] = Encoder(Vocabulary(load_ranks(path)), pattern)
    return encoders[key]


def bpe_roundtrip(docs: DataFrame, path: str, pattern: str, keep_ids: bool = False) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_tokens, ids_sha256, decoded_sha256 (of the bytes
    decoded from the ids again) and, with ``keep_ids``, ids (array of int) and decoded (binary).

    Null and empty texts have no ids; repeated rows give repeated results; null doc_ids are
    carried; extra columns are not. One row in, one row out, no shuffle.
    """
    schema = extend(docs.select("doc_id").schema, "n_tokens long, ids_sha256 string, decoded_sha256 string"
                    + ", ids array<int>, decoded binary" * keep_ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, pattern)
        for batch in batches:
            out = {c: [] for c in schema.fieldNames()[1:]}
            for text in batch.column("text"):
                ids_hash, decoded_hash, n = hashlib.sha256(), hashlib.sha256(), 0
                ids, decoded = [], []
                for run_ids in enc.encode(text.as_py() or ""):
                    raw = enc.decode(run_ids)
                    ids_hash.update(run_ids)
                    decoded_hash.update(raw)
                    n += len(run_ids) // 4
                    if keep_ids:
                        ids.append(run_ids)
                        decoded.append(raw)
                out["n_tokens"].append(n)
                out["ids_sha256"].append(ids_hash.hexdigest())
                out["decoded_sha256"].append(decoded_hash.hexdigest())
                if keep_ids:
                    out["ids"].append(np.frombuffer(b"".join(ids), dtype="<u4").astype(np.int32))
                    out["decoded"].append(b"".join(decoded))
            kinds = {"n_tokens": pa.int64(), "ids": pa.list_(pa.int32()), "decoded": pa.binary()}
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id")] + [pa.array(v, kinds.get(c, pa.string())) for c, v in out.items()],
                names=schema.fieldNames())

    return docs.select("doc_id", "text").mapInArrow(run, schema)


ship(__name__)
