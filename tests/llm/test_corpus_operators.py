"""Packing, spelling variants and source divergence against their plain versions."""

import random
import zlib
from collections import defaultdict

import brute
import numpy as np
import public_tokenizers as pt
import pytest
from tokenizers import Tokenizer

from perfkit.llm import best_fit_packing as packing
from perfkit.llm import source_divergence as sources
from perfkit.llm import spelling_variants as spelling

DOCS = "doc_id bigint, text string, lang string, source string, id bigint, term string, sequence string"
PATH = pt.path("word_bpe_49k.json")


def make(spark, rows):
    return spark.createDataFrame([(*r, 1, "t", "s") for r in rows], DOCS).repartition(3)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    stems = ["river", "stones", "naïveté", "château", "running", "letters", "bookkeeper", "abcdefghijklm", "zoo"]

    def word():
        w = rng.choice(stems) + rng.choice(["", "", "", "s", "ly"])
        if rng.random() < 0.15:
            i = rng.randrange(len(w))
            w = w[:i] + rng.choice(["", "x", "é", w[i] * 2]) + w[i + 1:]
        return w.capitalize() if rng.random() < 0.2 else w

    def text(n):
        return " ".join(word() + rng.choice(["", "", ",", ".", "!?", "'s", " 12"]) for _ in range(n))

    out = [(i, text(rng.randint(0, 200)), rng.choice(["en", "fr"]), rng.choice("abcdé")) for i in range(60)]
    out += [(100, None, "en", "a"), (101, "", None, None), (102, "  \n\t ", "de", "only"), (103, "日本語 のテキスト", "ja", "j")]
    out += [(104, text(8000), "en", "a"), (105, "w" * 3000, "en", "b"), (105, "w" * 3000, "en", "b")]
    out += [(None, "w" * 3000 + "x " + text(50), "fr", None), (3, out[3][1], "en", "c"), (3, out[3][1], "en", "c")]
    out += [(106, "<|endoftext|> don't stop I'LL 3½ á Ωx y ﬁne <|startoftext|>", "en", "a")]
    out += [(107, "rest, and... rest\r\n(rest)\tRest rest ÀÉÎ×÷ÿ ǅ", "en", "a")]
    return out


def lists(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def check_packing(out, rows, capacity):
    library = Tokenizer.from_file(PATH)
    want = []
    for doc_id, text, *_ in rows:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        for i, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at:at + capacity]
            want.append((doc_id, i, at, len(part), zlib.crc32(part.tobytes())))
    assert lists(out, "doc_id", "piece", "start", "length", "ids_crc32") == sorted(want, key=repr)
    bins = defaultdict(list)
    for r in out.collect():
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins), np.array([w[3] for w in want])


def test_packing(spark, rows):
    out = packing.pack_documents(make(spark, rows), PATH)
    n, lengths = check_packing(out, rows, 2048)
    assert n <= len(packing.best_fit(lengths, 2048)[2]) + 1


def test_packing_goes_up_the_tree(spark, rows, monkeypatch):
    monkeypatch.setattr(packing, "GROUP", 6)
    monkeypatch.setattr(packing, "HAND_UP", 3)
    many = [(i, r[1], r[2], r[3]) for i, r in enumerate(rows * 4)]
    out = packing.pack_documents(make(spark, many).repartition(12), PATH, 512)
    n, lengths = check_packing(out, many, 512)
    assert n <= 1.05 * len(packing.best_fit(lengths, 512)[2]) + 2


def test_packing_of_empty_table(spark):
    assert packing.pack_documents(make(spark, []), PATH).count() == 0


def test_best_fit_takes_the_least_sufficient_room():
    sequence, offset, fill = packing.best_fit(np.array([5, 7, 3, 10, 2]), 10)
    assert sequence.tolist() == [2, 1, 1, 0, 2] and offset.tolist() == [0, 0, 7, 0, 5] and fill.tolist() == [10, 10, 7]


def test_a_nearly_full_sequence_stays_and_few_go_up():
    fill = np.array([2048, 2020, 2010, 100, 1500])
    assert packing.handed_up(fill, 2048).tolist() == [False, False, True, True, True]
    assert packing.handed_up(np.arange(1000), 2048).sum() == packing.HAND_UP


def test_variants(spark, rows):
    out = spelling.spelling_variants(make(spark, rows))
    want = brute.variants(brute.variant_words([(r[0], r[1]) for r in rows]))
    assert lists(out, "word", "n", "n_near", "form", "form_n", "root") == sorted(want, key=repr)
    assert any(w[3] and w[5] != w[3] for w in want) or any(w[3] for w in want)
    assert spelling.spelling_variants(make(spark, [])).count() == 0


def test_variants_chains_ties_and_runs(spark):
    long = "q" * 40 + "r" * 30
    words = {"aaaaa": 3, "aaaaaa": 6, "aaaaab": 6, "aaaabb": 13, "zzzzz": 3, "zzzzzz": 5, "zzzyz": 6, "zzzxz": 6,
             long: 4, long[:50] + long[51:]: 9, long + "s": 8, "tiny": 9}
    text = " ".join(w for w, n in words.items() for _ in range(n))
    doc_id = next(i for i in range(10_000) if all(zlib.crc32(f"{i}:{w}".encode()) % 97 for w in words))
    out = spelling.spelling_variants(make(spark, [(doc_id, text, "en", "a")]))
    want = brute.variants(brute.variant_words([(doc_id, text)]))
    assert lists(out, "word", "n", "n_near", "form", "form_n", "root") == sorted(want, key=repr)
    root = {w[0]: w[5] for w in want}
    assert root["aaaaa"] == "aaaabb" or root["aaaaa"] in words


def test_near_words_on_random_vocabulary(spark):
    rng = random.Random(5)
    words = {"".join(rng.choice("abé") for _ in range(rng.randint(5, 12))): rng.randint(3, 60) for _ in range(700)}
    vocab = spark.createDataFrame([(i, w, words[w]) for i, w in enumerate(sorted(words))], "id long, word string, n long")
    got = {r["id"]: r["n_near"] for r in spelling.near_words(vocab).collect()}
    order = sorted(words)
    want = {i: k for i, w in enumerate(order) if (k := sum(brute.near(w, v) for v in order))}
    assert got == want


def test_divergence(spark, rows):
    out = sources.source_divergence(make(spark, rows))
    cols = ["lang", "source", "part", "item", "value", "rank"]
    assert lists(out, *cols) == sorted(brute.divergence([r[1:4] for r in rows]), key=repr)
    assert out.columns == cols
    assert sources.source_divergence(make(spark, [])).count() == 0


def test_divergence_over_shards_and_blocks(spark, rows, monkeypatch):
    monkeypatch.setattr(sources, "SHARD_TERMS", 7)
    monkeypatch.setattr(sources, "BLOCK", 2)
    monkeypatch.setattr(sources, "HELD_TERMS", 5)
    monkeypatch.setattr(sources, "STREAM", 16)
    out = sources.source_divergence(make(spark, rows))
    assert lists(out, "lang", "source", "part", "item", "value", "rank") == sorted(
        brute.divergence([r[1:4] for r in rows]), key=repr)


def test_run_lengths():
    for size, entries in ((5, {0: 2, 1: 2, 3: 1}), (4, {3: 1}), (3, {0: 1, 1: 2, 2: 2}), (6, {2: 5})):
        column = np.array([entries.get(i, 0) for i in range(size)])
        ends, values = sources.run_lengths(np.array(list(entries)), np.array(list(entries.values())), size)
        assert np.repeat(values, np.diff(ends, prepend=0)).tolist() == column.tolist()
        assert (values[1:] != values[:-1]).all() and ends[-1] == size


def test_shares_beyond_64_bits():
    assert sources.shares(np.array([10 ** 12, 0, 10 ** 12]), 10 ** 13).tolist() == [100_000_001, 1, 100_000_001]
