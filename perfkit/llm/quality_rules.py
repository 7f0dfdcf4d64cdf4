"""Quality rules as a short-circuit cascade.

Each rule has a cost and a rejection rate, estimated on a sample; rules run in descending order
of rejection per cost, and a rule only sees the rows that no earlier rule has rejected. The
verdict is the conjunction of all rules, so it does not depend on the estimated order. Cost is
counted work (array elements passed over), not time, and the sample is drawn by the texts' hash,
so the order, and with it ``rejected_by``, is the same in every run over the same texts.

Defined cases: null or empty text has no words and fails the base rule; repeated rows are judged
each by themselves; other columns are untouched. An empty table gives an empty result, with the rules
in listed order. A text of any length is judged whole, as a slice by itself if it is over SLICE_BYTES;
memory is some ten times the longest text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perfkit.llm.common import RollingHash, SEPARATOR, extend, ship, text_slices, word_spans

MIN_WORDS = 20
REPEAT_WINDOW = 8
MAX_REPEAT_PERCENT = 30
MAX_SYMBOL_PERCENT = 10
MEAN_WORD_CHARS = (2.0, 30.0)
MAX_DUP_LINE_PERCENT = 60
MAX_SHOUTED_PERCENT = 60
MAX_BAR_PERCENT = 25
MAX_LETTERLESS_PERCENT = 50
SAMPLE_FRACTION = 0.02
SAMPLE_SEED = 17

SYMBOL = np.zeros(256, dtype=bool)
SYMBOL[list(b"#*$%&|<>")] = True


class Texts:
    """One slice of texts; parts that several rules share are computed once, on first use.

    ``work`` counts the array elements that were passed over so far.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets
        self.work = 0
        self._made: dict[str, object] = {}

    def _once(self, name: str, make: Callable[[], object]):
        if name not in self._made:
            self._made[name] = make()
        return self._made[name]

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def subset(self, keep: np.ndarray) -> "Texts":
        """The texts of the kept rows. Words and counts per row go along; hashes are made anew if needed."""
        lengths = np.diff(self.offsets)
        out = Texts(self.data[np.repeat(keep, lengths)],
                    np.concatenate([[0], np.cumsum(lengths[keep])]).astype(np.int64))
        if "words" in self._made:
            starts, ends, first = self._made["words"]
            per_row = np.diff(first)
            here = np.repeat(keep, per_row)
            shift = np.repeat(self.offsets[:-1][keep] - out.offsets[:-1], per_row[keep])
            out._made["words"] = (starts[here] - shift, ends[here] - shift,
                                  np.concatenate([[0], np.cumsum(per_row[keep])]).astype(np.int64))
        for name in ("chars", "repeat"):
            if name in self._made:
                out._made[name] = self._made[name][keep]
        return out

    def per_row(self, flags: np.ndarray) -> np.ndarray:
        """Sums of a per-byte array over each row."""
        self.work += 3 * len(flags)
        sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return sums[self.offsets[1:]] - sums[self.offsets[:-1]]

    def words(self):
        return self._once("words", self._words)

    def _words(self):
        self.work += 8 * len(self.data)
        return word_spans(self.data, self.offsets)

    def byte_hash(self) -> RollingHash:
        return self._once("hash", self._byte_hash)

    def _byte_hash(self) -> RollingHash:
        self.work += 4 * len(self.data)
        return RollingHash(self.data, 11)

    def n_words(self) -> np.ndarray:
        return np.diff(self.words()[2])

    def word_chars(self) -> np.ndarray:
        return self._once("chars", lambda: self.per_row(~SEPARATOR[self.data] & ((self.data & 0xC0) != 0x80)))

    def n_symbols(self) -> np.ndarray:
        return self.per_row(SYMBOL[self.data])

    def words_where(self, byte_flags: np.ndarray) -> np.ndarray:
        """Per row, the number of words with a flagged byte."""
        starts, ends, first = self.words()
        self.work += 3 * len(self.data) + 4 * len(starts)
        sums = np.concatenate([[0], np.cumsum(byte_flags, dtype=np.int64)])
        hit = np.concatenate([[0], np.cumsum(sums[ends] > sums[starts])])
        return hit[first[1:]] - hit[first[:-1]]

    def n_dup_lines(self) -> np.ndarray:
        self.work += 4 * len(self.data)
        brk = np.flatnonzero(self.data == 10)
        if len(brk) == 0:
            return np.zeros(len(self), dtype=np.int64)
        # A row of n breaks has n + 1 lines; boundaries of rows bound lines too.
        starts = np.sort(np.concatenate([self.offsets[:-1], brk + 1]))
        ends = np.sort(np.concatenate([brk, self.offsets[1:]]))
        row = np.searchsorted(self.offsets[1:], ends, side="left")
        has = np.concatenate([[0], np.cumsum(~SEPARATOR[self.data])])
        keep = has[ends] > has[starts]
        starts, ends, row = starts[keep], ends[keep], row[keep]
        return self._repeats(self.byte_hash().spans(starts, ends), row, later_only=True)

    def _repeats(self, h: np.ndarray, row: np.ndarray, later_only: bool) -> np.ndarray:
        self.work += 8 * len(h) * max(1, len(h).bit_length())  # sorted by two keys
        order = np.lexsort((h, row))
        same = (h[order][1:] == h[order][:-1]) & (row[order][1:] == row[order][:-1])
        dup = np.zeros(len(h), dtype=bool)
        dup[order[1:]] = same
        if not later_only:
            dup[order[:-1]] |= same
            return dup
        return np.bincount(row[dup], minlength=len(self)).astype(np.int64)

    def n_repeat_words(self) -> np.ndarray:
        return self._once("repeat", self._n_repeat_words)

    def _n_repeat_words(self) -> np.ndarray:
        starts, ends, first = self.words()
        n, k = len(starts), REPEAT_WINDOW
        self.work += 20 * n  # hashes of words and windows, covered words
        row = np.repeat(np.arange(len(self)), np.diff(first))
        if n < k:
            return np.zeros(len(self), dtype=np.int64)
        at = np.flatnonzero(row[k - 1:] == row[:n - k + 1])
        grams = RollingHash(self.byte_hash().spans(starts, ends), 12).spans(at, at + k)
        dup = at[self._repeats(grams, row[at], later_only=False)]
        edge = np.zeros(n + 1, dtype=np.int64)
        np.add.at(edge, dup, 1)
        np.add.at(edge, dup + k, -1)
        covered = np.cumsum(edge[:n]) > 0
        return np.bincount(row[covered], minlength=len(self)).astype(np.int64)


def percent_over(part: np.ndarray, whole: np.ndarray, limit: float) -> np.ndarray:
    return 100 * part > limit * whole


@dataclass(frozen=True)
class Rule:
    """``rejects`` maps a slice of texts to one boolean per row."""
    name: str
    rejects: Callable[[Texts], np.ndarray]


def base_rejects(t: Texts) -> np.ndarray:
    return (t.n_words() < MIN_WORDS) | percent_over(t.n_repeat_words(), t.n_words(), MAX_REPEAT_PERCENT)


def _symbols(t: Texts) -> np.ndarray:
    return percent_over(t.n_symbols(), t.word_chars(), MAX_SYMBOL_PERCENT)


def _word_length(t: Texts) -> np.ndarray:
    mean = t.word_chars() / np.maximum(t.n_words(), 1)
    return (mean < MEAN_WORD_CHARS[0]) | (mean > MEAN_WORD_CHARS[1])


def _dup_lines(t: Texts) -> np.ndarray:
    lines = t.per_row(t.data == 10) + 1
    return percent_over(t.n_dup_lines(), lines, MAX_DUP_LINE_PERCENT)


def _shouted(t: Texts) -> np.ndarray:
    return percent_over(t.words_where(t.data == ord("!")), t.n_words(), MAX_SHOUTED_PERCENT)


def _bars(t: Texts) -> np.ndarray:
    return percent_over(t.words_where(t.data == ord("|")), t.n_words(), MAX_BAR_PERCENT)


def _letterless(t: Texts) -> np.ndarray:
    low = t.data | 0x20
    letter = ((low >= 97) & (low <= 122)) | (t.data >= 0x80)
    return percent_over(t.n_words() - t.words_where(letter), t.n_words(), MAX_LETTERLESS_PERCENT)


RULES = (
    Rule("symbols", _symbols),
    Rule("word_length", _word_length),
    Rule("dup_lines", _dup_lines),
    Rule("shouted_words", _shouted),
    Rule("bar_words", _bars),
    Rule("letterless_words", _letterless),
    Rule("base", base_rejects),
)


def estimate(df: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text",
             fraction: float = SAMPLE_FRACTION, seed: int = SAMPLE_SEED) -> list[tuple[str, float, float]]:
    """(rule, work per row, rejected share) on a sample of texts; one row per rule comes back.

    A text is in the sample if its hash is: the same texts are drawn however the table is laid out.
    """

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spent, gone, n = np.zeros(len(rules)), np.zeros(len(rules)), 0
        for batch in batches:
            for rows, data, off in text_slices(batch, "text"):
                n += rows.num_rows
                for at in range(rows.num_rows):  # row by row, so that the work does not depend on the slices
                    lo, hi = off[at], off[at + 1]
                    for i, rule in enumerate(rules):
                        fresh = Texts(data[lo:hi], np.array([0, hi - lo]))  # nothing shared: each rule pays for all
                        gone[i] += rule.rejects(fresh).sum()
                        spent[i] += fresh.work
        yield pa.RecordBatch.from_pydict({"name": [r.name for r in rules], "spent": spent.astype(np.int64),
                                          "gone": gone.astype(np.int64), "n": np.full(len(rules), n)})

    text = F.coalesce(F.col(text_col), F.lit(""))
    drawn = F.abs(F.xxhash64(text, F.lit(seed)).cast("double")) < fraction * 2.0 ** 63
    rows = (df.select(text.alias("text")).where(drawn if fraction < 1 else F.lit(True))
            .mapInArrow(probe, "name string, spent long, gone long, n long")
            .groupBy("name").agg(F.sum("spent").alias("spent"), F.sum("gone").alias("gone"), F.sum("n").alias("n"))
            .collect())
    return [(r["name"], r["spent"] / max(r["n"], 1), r["gone"] / max(r["n"], 1)) for r in rows]


def order_rules(rules: tuple[Rule, ...], stats: list[tuple[str, float, float]]) -> tuple[Rule, ...]:
    """Most rejections per work first; a rule without figures, or a tie, keeps its listed place."""
    rate = {name: share / max(cost, 1e-9) for name, cost, share in stats}
    return tuple(sorted(rules, key=lambda r: -rate.get(r.name, 0.0)))


def run_cascade(texts: Texts, cascade: tuple[Rule, ...]) -> np.ndarray:
    """Per text the number of the first rule that rejects it, -1 for none. Each rule gets the texts that are
    still open, and no others."""
    by = np.full(len(texts), -1)
    left, at = texts, np.arange(len(texts))  # at: the row of each text in left
    for i, rule in enumerate(cascade):
        if not len(at):
            break
        out = rule.rejects(left)
        if out.any():
            by[at[out]] = i
            left, at = left.subset(~out), at[~out]
    return by


def quality_rules(df: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES,
                  features: bool = False, fraction: float = SAMPLE_FRACTION) -> DataFrame:
    """``df`` with ``kept`` and ``rejected_by`` (the first rule of the cascade that rejects).

    ``features`` adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed,
    which are then computed for every row. Columns of ``df`` with these names are replaced.
    """
    cascade = order_rules(rules, estimate(df, rules, text_col, fraction))
    new = ["kept boolean", "rejected_by string"]
    if features:
        new += [f"{c} long" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
        new.append("base_failed boolean")
    names = [c.split(" ")[0] for c in new]
    carried = [c for c in df.columns if c not in names]
    schema = extend(df.select(carried).schema, ", ".join(new))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, off in text_slices(batch, text_col):
                by = run_cascade(Texts(data, off), cascade)
                cols = [rows.column(c) for c in carried]
                cols += [pa.array(by < 0), pa.array([None if i < 0 else cascade[i].name for i in by], pa.string())]
                if features:  # for every row, so apart from the cascade
                    whole = Texts(data, off)
                    cols += [pa.array(getattr(whole, c)().astype(np.int64)) for c in names[2:-1]]
                    cols.append(pa.array(base_rejects(whole)))
                yield pa.RecordBatch.from_arrays(cols, names=[*carried, *names])

    return df.select(*carried).mapInArrow(judge, schema)


ship(__name__)
