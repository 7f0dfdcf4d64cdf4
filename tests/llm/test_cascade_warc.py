"""The cascade's open rows, and archives that are cut or foreign."""

import gzip
import io

import numpy as np
import pytest

from perfkit.llm import quality_rules as qr
from perfkit.llm import warc


def texts(rows):
    data = [t.encode() for t in rows]
    return qr.Texts(np.frombuffer(b"".join(data), np.uint8), np.concatenate([[0], np.cumsum([len(d) for d in data])]))


ROWS = ["# # # # # # #", "", "plain words that are long enough to pass every rule of the cascade without any doubt at "
        "all in this place today", "a\na\na\na\na", "!! !! !! !!", "x | y | z | w", "1 2 3 4", "naïve œuvre " * 30,
        "w\n" * 50, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen "
        "seventeen eighteen nineteen twenty"]


def counted(rules, seen):
    def wrap(rule):
        def rejects(t):
            seen.append((rule.name, len(t)))
            return rule.rejects(t)
        return qr.Rule(rule.name, rejects)
    return tuple(wrap(r) for r in rules)


@pytest.mark.parametrize("rules", [qr.RULES, qr.RULES[::-1], qr.RULES[3:] + qr.RULES[:3]])
def test_rules_see_open_rows_only(rules):
    alone = np.array([r.rejects(texts(ROWS)) for r in rules])  # every rule on every row
    want = [next((i for i in range(len(rules)) if alone[i, j]), -1) for j in range(len(ROWS))]
    seen = []
    assert qr.run_cascade(texts(ROWS), counted(rules, seen)).tolist() == want
    still_open = [sum(w < 0 or w >= i for w in want) for i in range(len(rules))]
    assert seen == [(r.name, n) for r, n in zip(rules, still_open) if n]
    assert sum(n for _, n in seen) < len(rules) * len(ROWS)


def test_cascade_of_no_rows():
    seen = []
    assert len(qr.run_cascade(texts([]), counted(qr.RULES, seen))) == 0 and not seen


def test_subset_keeps_words():
    t = texts(ROWS)
    t.words(), t.word_chars()
    keep = np.array([i % 3 != 1 for i in range(len(ROWS))])
    part, fresh = t.subset(keep), texts([r for r, k in zip(ROWS, keep) if k])
    for a, b in zip(part.words(), fresh.words()):
        assert a.tolist() == b.tolist()
    for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"):
        assert getattr(part, name)().tolist() == getattr(fresh, name)().tolist()


def test_order_is_the_same_in_every_layout(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(ROWS * 5)], "doc_id long, text string")
    a = qr.estimate(df.repartition(1), fraction=0.6)
    b = qr.estimate(df.repartition(7, "doc_id"), fraction=0.6)
    assert sorted(a) == sorted(b) and any(n for _, n, _ in a)
    assert qr.order_rules(qr.RULES, []) == qr.RULES


def record(kind, block, **fields):
    head = [f"WARC/1.0", f"WARC-Type: {kind}", *[f"{k.replace('_', '-')}: {v}" for k, v in fields.items()]]
    if "Content_Length" not in fields:
        head.append(f"Content-Length: {len(block)}")
    return "\r\n".join([*head, "", ""]).encode() + block + b"\r\n\r\n"


def read(data):
    return list(warc.read_records(gzip.GzipFile(fileobj=io.BytesIO(gzip.compress(data)))))


HTTP = b"HTTP/1.1 200 OK\r\nContent-Length: 5\r\n\r\nhello"
OWN = {"WARC_Record_ID": "<urn:page:7>", "Content_Type": "application/http;msgtype=response"}


def test_records_of_other_kinds_are_skipped():
    rows = read(record("warcinfo", b"software: x\r\n" * 1000) + record("response", HTTP, **OWN) + record("metadata", b""))
    assert [(r[1], r[2], r[5], r[6], r[8]) for r in rows] == [(7, "response", b"hello", 5, True)]


@pytest.mark.parametrize("kind", ["warcinfo", "response", "revisit"])
def test_cut_records_are_errors(kind):
    whole = record(kind, HTTP, **OWN)
    for cut in (whole[:-8], record(kind, HTTP, **OWN, Content_Length=5000)):
        with pytest.raises(ValueError, match="ends inside"):
            read(cut)


def test_cut_gzip_member_is_an_error():
    data = gzip.compress(record("response", HTTP + np.random.default_rng(1).bytes(9000), **OWN))
    with pytest.raises(EOFError):
        list(warc.read_records(gzip.GzipFile(fileobj=io.BytesIO(data[:-3000]))))


def test_foreign_records():
    rows = read(record("response", b"93.184.216.34", WARC_Record_ID="<urn:page:x>", Content_Type="text/dns")
                + record("revisit", b"", WARC_Record_ID="<urn:uuid:1>", WARC_Refers_To="<urn:page:99999999999999999999>")
                + record("response", HTTP, WARC_Payload_Digest="md5:abc", **OWN))
    assert [(r[1], r[2], r[3], r[5], r[6]) for r in rows] == [
        (None, "response", None, b"93.184.216.34", 13), (None, "revisit", None, b"", None), (7, "response", None, b"hello", 5)]
    assert rows[1][7] is None


def test_records_without_length_or_version_are_errors():
    with pytest.raises(ValueError, match="no length"):
        read(record("response", HTTP, Content_Length="many"))
    with pytest.raises(ValueError, match="not a record"):
        read(b"hello\r\n")


def test_wrong_digest_is_an_error():
    with pytest.raises(ValueError, match="payload digest"):
        read(record("response", HTTP, WARC_Payload_Digest="sha1:" + "A" * 32, **OWN))
