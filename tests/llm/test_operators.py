"""Every operator against its plain version, on rows with nulls, ties, repeats and odd columns."""

import base64
import hashlib
import random
import zlib

import brute
import numpy as np
import public_tokenizers as pt
import pytest
import tiktoken
from tokenizers import Tokenizer

from perfkit.llm import (byte_bpe, decontaminate, fm_index, html_extract, quality_rules, simhash_dups,
                         substring_dedup, suffix_dedup, token_files, toxicity, warc)

DOCS = "doc_id bigint, text string, lang string, anchor string, spans string, fp bigint"


def prose(rng, n):
    return " ".join(rng.choice(["the", "of", "river", "Stone", "blue", "naïve", "ran", "on", "two", "12"]) +
                    rng.choice(["", "", "s", "ly", ","]) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    shared, long = prose(rng, 70), prose(rng, 300)
    out = [(i, prose(rng, rng.randint(0, 160))) for i in range(30)]
    out += [(30 + i, f"{prose(rng, 20)} {shared}\n{prose(rng, 20)}") for i in range(5)]
    out += [(40 + i, long) for i in range(3)] + [(50, long + " end"), (51, long.replace("river", "rivers", 1))]
    out += [(60, None), (61, ""), (62, "   \n\t"), (63, prose(rng, 20_000)), (64, "line here\n" * 12)]
    out += [(40, long), (40, shared), (None, long), (None, shared), (None, None), (7, out[7][1])]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(d, t, "x", "a", "s", 1) for d, t in rows], DOCS).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def got(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def same(df, cols, want):
    assert got(df, *cols) == sorted(want, key=repr)


def test_quality(docs, rows, none):
    cols = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    out = quality_rules.quality_rules(docs, features=True)
    same(out, ["doc_id", *cols], [(d, *brute.quality(t)) for d, t in rows])
    assert not any(r["kept"] and r["base_failed"] for r in out.collect())
    assert quality_rules.quality_rules(none).count() == 0


def test_quality_verdict_ignores_order(docs):
    a = quality_rules.quality_rules(docs, rules=quality_rules.RULES, fraction=1.0)
    b = quality_rules.quality_rules(docs, rules=quality_rules.RULES[::-1], fraction=0.0)
    assert got(a, "doc_id", "text", "kept") == got(b, "doc_id", "text", "kept")


def test_simhash(docs, rows, none):
    out = simhash_dups.simhash_components(docs)
    same(out, ["doc_id", "fingerprint", "component_id"], brute.simhash_groups(rows))
    assert simhash_dups.simhash_components(none).count() == 0
    kept = simhash_dups.one_per_component(docs)
    ids = [r["doc_id"] for r in kept.collect()]
    assert len(ids) == len(set(ids)) and kept.columns == docs.columns
    assert set(ids) == {c for _, _, c in brute.simhash_groups(rows) if c is not None}


def test_simhash_links_of_dense_keys_connect_all():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 64, 40, dtype=np.uint64)
    flips = np.array([sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 6), replace=False)) for _ in range(400)],
                     dtype=np.uint64)
    fp = np.unique(base[rng.integers(0, 40, 400)] ^ flips)
    u, v = simhash_dups.spanning_links(fp)
    at = {int(x): i for i, x in enumerate(fp)}
    pairs = [(i, j) for i in range(len(fp)) for j in range(i) if int(fp[i] ^ fp[j]).bit_count() <= 4]
    assert brute.groups(range(len(fp)), pairs) == brute.groups(
        range(len(fp)), [(at[int(a)], at[int(b)]) for a, b in zip(u, v)])


@pytest.mark.parametrize("split", [0, 2000])
def test_substring(docs, rows, none, split):
    out = substring_dedup.substring_dedup(docs.select("doc_id", "text", "lang"), split=split)
    hashed = [(r["doc_id"], r["n_words"], r["n_removed"], brute.sha(r["kept"].encode())) for r in out.collect()]
    assert sorted(hashed, key=repr) == sorted(brute.shared_words(rows), key=repr)
    assert substring_dedup.substring_dedup(none).count() == 0


def test_matching_statistics_against_brute_force():
    rng = np.random.default_rng(0)
    for _ in range(60):
        lengths = rng.integers(1, 15, rng.integers(1, 6))
        symbols = rng.integers(1, 5, lengths.sum()).astype(np.int64)
        fm = fm_index.FMIndex(symbols, lengths, 6)
        seqs = [tuple(symbols[a:a + n]) for a, n in zip(np.cumsum(lengths) - lengths, lengths)]
        subs = {s[i:j] for s in seqs for i in range(len(s)) for j in range(i + 1, len(s) + 1)}
        pattern = rng.integers(0, 6, 12).astype(np.int64)
        found, _ = fm.matching_statistics(pattern, np.array([0, 12]))
        p = tuple(pattern)
        assert found.tolist() == [max([0, *(j - i for j in range(i + 1, 13) if p[i:j] in subs)]) for i in range(12)]


def test_suffix(docs, rows, none):
    same(suffix_dedup.suffix_dedup(docs), ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
         brute.repeated_bytes(rows))
    assert suffix_dedup.suffix_dedup(none).count() == 0


def test_suffix_on_periodic_and_overlapping_text(spark):
    rows = [(1, "ab" * 700), (2, "x" * 399), (3, "x" * 401), (4, "q" + "ab" * 300 + "r"), (5, "é" * 500)]
    same(suffix_dedup.suffix_dedup(spark.createDataFrame(rows, "doc_id bigint, text string")),
         ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"], brute.repeated_bytes(rows))


def test_decontaminate(spark, docs, rows, none):
    rng = random.Random(9)
    items = [(1, " ".join(rows[34][1].split()[22:60])), (2, rows[5][1].upper() if rows[5][1] else "x"), (3, None), (4, ""),
             (5, "blue river"), (None, "the of"), (6, prose(rng, 30)), (1, prose(rng, 14)), (11, "blues, RIVER!")]
    bench = spark.createDataFrame([(i, t, "c") for i, t in items], "item_id bigint, text string, start string")
    out = decontaminate.decontaminate(docs, bench)
    cols = [(r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], brute.sha(",".join(r["items"]).encode()),
             r["contaminated"]) for r in out.collect()]
    assert sorted(cols, key=repr) == sorted(brute.contamination(rows, items), key=repr)
    assert decontaminate.decontaminate(none, bench).count() == 0
    assert not any(r["n_hit"] for r in decontaminate.decontaminate(docs, bench.limit(0)).collect())


def test_decontaminate_hits_end_within_short_documents(spark):
    rows = [(k, " ".join(f"v{j}" for j in range(k))) for k in range(5, 16)]
    items = [(1, rows[1][1]), (2, rows[3][1]), (3, rows[7][1])]  # of 6, 8 and 12 words
    out = decontaminate.decontaminate(spark.createDataFrame(rows, "doc_id bigint, text string"),
                                      spark.createDataFrame(items, "item_id bigint, text string")).collect()
    cols = [(r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], brute.sha(",".join(r["items"]).encode()),
             r["contaminated"]) for r in out]
    assert sorted(cols) == sorted(brute.contamination(rows, items))
    assert {r["doc_id"]: r["n_hit"] for r in out if r["n_hit"]} == {k: 6 if k < 8 else 8 if k < 12 else 12 for k in range(6, 16)}
    assert all(h["start"] + h["length"] <= r["n_words"] for r in out for h in r["hits"] or [])


def ranks():
    return byte_bpe.load_ranks(pt.path("byte_bpe_multi_50k.tiktoken"))


def test_byte_bpe(docs, rows, none):
    enc = tiktoken.Encoding("own", pat_str=pt.PATTERN, mergeable_ranks=ranks(), special_tokens={})
    want = []
    for d, t in rows:
        ids = enc.encode_ordinary(t or "")
        want.append((d, len(ids), brute.sha(np.array(ids, "<u4").tobytes()), brute.sha((t or "").encode())))
    args = (pt.path("byte_bpe_multi_50k.tiktoken"), pt.PATTERN)
    same(byte_bpe.bpe_roundtrip(docs, *args), ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"], want)
    assert byte_bpe.bpe_roundtrip(none, *args).count() == 0


def test_byte_bpe_odd_texts():
    enc = tiktoken.Encoding("own", pat_str=pt.PATTERN, mergeable_ranks=ranks(), special_tokens={})
    own = byte_bpe.encoder(pt.path("byte_bpe_multi_50k.tiktoken"), pt.PATTERN)
    rng = random.Random(4)
    parts = ["a", "ab", "th", "ing", " ", "  ", "\n", "\n\n", " \n", "é", "日本", "😀", "12", "!!", "'s", "\t", "\x1c",
             " ", "\u0085", "aaaa", "<|endoftext|>"]
    for _ in range(2000):
        s = "".join(rng.choice(parts) for _ in range(rng.randint(0, 30)))
        assert b"".join(own.encode(s)) == np.array(enc.encode_ordinary(s), "<u4").tobytes(), s
    for s in ("aab" * 3000, "ab" * 20000, " x" * 200_000):
        assert b"".join(own.encode(s)) == np.array(enc.encode_ordinary(s), "<u4").tobytes()


def test_simple8b():
    rng = np.random.default_rng(1)
    for _ in range(200):
        n = int(rng.integers(0, 300))
        v = (rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2)) >> rng.integers(0, 64, n).astype(np.uint64)
        words, escapes = token_files.pack(v)
        assert (token_files.unpack(words, escapes, n) == v).all()
    assert len(token_files.pack(np.zeros(600, dtype=np.uint64))[0]) == 10


def test_token_files(docs, rows, none, tmp_path):
    lib = Tokenizer.from_file(pt.path("byte_bpe_50k.json"))
    args = (pt.path("byte_bpe_50k.json"), pt.PATTERN)
    out = sorted(token_files.token_files(docs, *args, folder=str(tmp_path), keep_ids=True).collect(),
                 key=lambda r: r["start"])
    at = 0
    for r in out:
        assert r["start"] == at and r["n_tokens"] == len(r["ids"]) and r["ids"][-1] == token_files.END_ID
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        at += r["n_tokens"]
    assert [brute.order(r["doc_id"]) for r in out] == sorted(brute.order(r["doc_id"]) for r in out)
    want = [(d, lib.encode(t or "", add_special_tokens=False).ids + [0]) for d, t in rows]
    assert sorted(((r["doc_id"], r["ids"]) for r in out), key=repr) == sorted(want, key=repr)
    assert token_files.token_files(none, *args).count() == 0


PAGES = "page_id bigint, url string, html string, host string, path string, first bigint"


@pytest.fixture(scope="module")
def pages(spark):
    body = "<p>{0} one two three.</p><p>More &amp; more<br>text {0}</p>"
    page = ("<html><head><title>T</title><style>p{{}}</style></head><body><nav><a href=/>home</a></nav>"
            "<div class='cookie-notice'>We use cookies</div><div id=c{1} class='post-{1}'><h1>Title {0}</h1>" + body +
            "<div class=advert>buy</div><form><p>mail</p></form></div><div class=comments><p>first!</p></div>"
            "<aside><p>side</p></aside><footer>foot</footer><script>var x='<p>no</p>'</script></body></html>")
    rows = [(i, f"https://h{i % 2}.org/{i}", page.format(f"text{i % 6}", i)) for i in range(12)]
    rows += [(20, None, None), (21, "no url", ""), (22, "http://h1.org/x", "<p>alone"), (None, "http://h1.org/y", rows[0][2]),
             (3, "http://h1.org/3", rows[3][2]), (23, "http://h0.org/z", "x" * 3_000_000), (24, "http://h0.org/w", "")]
    return spark.createDataFrame([(*r, "h", "p", 0) for r in rows], PAGES), rows


def test_warc(pages, tmp_path, spark):
    df, rows = pages
    chunks = warc.warc_roundtrip(df, str(tmp_path)).collect()
    first, want = {}, []
    for p, _, h in rows:
        if p is not None:
            first[h or ""] = min(first.get(h or "", p), p)
    for p, _, h in rows:
        raw = (h or "").encode()
        other = first.get(h or "") if p != first.get(h or "") else None
        want.append((p, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(),
                     "response" if other is None else "revisit", other))
    last = [(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"])
            for r in chunks if r["last"]]
    assert sorted(last, key=repr) == sorted(want, key=repr)
    big = sorted((r["chunk"], r["data"], r["payload_digest"]) for r in chunks if r["page_id"] == 23)
    assert len(big) == 3 and b"".join(d for _, d, _ in big) == b"x" * 3_000_000
    assert big[0][2] == base64.b32encode(hashlib.sha1(big[0][1]).digest()).decode()
    assert warc.warc_roundtrip(spark.createDataFrame([], PAGES)).count() == 0


def test_html(pages, spark):
    df, rows = pages
    out = {(r["page_id"], r["url"]): r for r in html_extract.extract_pages(df).collect()}
    assert len(out) == len(rows)
    for p, u, h in rows:
        r = out[p, u]
        if h and h.startswith("<html"):
            k = h.split("Title ")[1].split("<")[0]
            assert r["text"] == f"Title {k}\n\n{k} one two three.\n\nMore & more text {k}", r
        elif not h:
            assert r["text"] == ""
        assert r["n_chars"] == len(r["text"])
    assert out[22, "http://h1.org/x"]["text"] == "alone"
    assert html_extract.extract_pages(spark.createDataFrame([], PAGES)).count() == 0


def test_html_two_templates_and_text_beside_the_article(spark):
    def words(k, n):
        return " ".join(f"w{k}x{j}" for j in range(n))

    links = "<ul><li><a href=/a>one link</a></li><li><a href=/b>two link</a></li></ul>"
    rows = []
    for i in range(20):  # the majority has its article where the minority has a small box
        main = (f"<div class=main><p>{words(i, 80)}</p></div>" if i < 15 else
                f"<div class=main><p>box {i}</p></div><div class=long><p>{words(i, 80)}</p><p>{words(i, 9)}</p></div>")
        rows.append((i, "http://a.org/x" if i % 2 else None, f"<html><body>{links}{main}</body></html>"))
    rows.append((30, "http://b.org/x", f"<html><body><div><div class=post><p>{words(1, 70)}</p></div>"
                                       f"<p>{words(2, 30)}</p></div>{links}</body></html>"))
    df = spark.createDataFrame([(*r, "h", "p", 0) for r in rows], PAGES)
    out = {r["page_id"]: r["text"] for r in html_extract.extract_pages(df).collect()}
    assert all(out[i] == words(i, 80) for i in range(15))
    assert all(out[i].split("\n\n")[-2:] == [words(i, 80), words(i, 9)] for i in range(15, 20))
    assert out[30] == f"{words(1, 70)}\n\n{words(2, 30)}"


ARTICLE = "<p>" + "long story of a <span>river</span> and a stone " * 8 + "</p>"


@pytest.mark.parametrize("open_, close", [
    ("<div class='content-sidebar-wrap'><article>", "</article></div>"),
    ("<div class='layout has-sidebar'><div class=x>", "</div></div>"),
    ("<section class='post with-comments'>", "</section>"),
    ("<form id='aspnetForm'><div class='widget page'><main>", "</main></div></form>"),
    ("<span class=promo><div><span>", "</span></div></span>")])
def test_html_wrappers_named_like_furniture(open_, close):
    story = " ".join(ARTICLE[3:-4].replace("<span>", "").replace("</span>", "").split())
    side = "<div class=sidebar><p>side <span>x</span> text</p></div><form><p>mail</p></form>"
    talk = "<div class=comments>" + "<article class=comment><p>what a story it was</p></article>" * 40 + "</div>"
    page = "<html><body><nav>home</nav>{}" + open_ + ARTICLE + "{}" + close + "{}</body></html>"
    assert html_extract.extract(page.format("", "", ""), None)[0] == story
    within = "" if "span" in open_ else side
    assert html_extract.extract(page.format(side, within, side), None)[0] == story
    if "article" in open_ or "main" in open_:
        assert html_extract.extract(page.format("", "", talk), None)[0] == story


def test_html_short_article_beside_longer_furniture():
    page = "<html><body><div class=ad><p>buy this now, buy it here, buy two</p></div><article><p>short one</p></article></body></html>"
    assert html_extract.extract(page, None)[0] == "short one"


def test_html_is_not_empty_where_all_is_named_furniture():
    page = "".join(f"<div class=widget><p>part {k} of a text</p></div>" for k in range(3))
    assert html_extract.extract(page, None)[0] == "\n\n".join(f"part {k} of a text" for k in range(3))


def test_toxicity(spark):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(1500):
        t = prose(rng, 30)
        toxic = rng.random() < 0.3
        if toxic:
            t += " " + rng.choice(["scumbag", "numbskull"]) + " " + prose(rng, 10)
        rows.append((i, t, "en"))
        labels.append((i, int(toxic)))
    rows += [(5000, None, "x"), (5001, "", "x"), (None, "a scumbag", "x"), (5000, None, "x")]
    labels += [(None, 1), (5000, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, score string")
    marks = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    out = toxicity.toxicity(docs, marks).collect()
    truth = dict(labels)
    assert len(out) == len(rows)
    held = [r for r in out if r["held_out"] and r["doc_id"] in truth and truth[r["doc_id"]] is not None]
    assert all((zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) == r["held_out"] for r in out if r["doc_id"] is not None)
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) > 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 and (r["score"] >= 0.3) == r["predicted"] for r in out)
    assert len({r["score"] for r in out if r["doc_id"] in (5000, 5001)}) == 1
    assert toxicity.toxicity(docs.limit(0), marks).count() == 0
    assert toxicity.toxicity(docs, marks.limit(0)).count() == len(rows)


def test_toxicity_of_pairs_whose_words_tell_nothing_alone():
    def rows(each, n, seed):
        rng = random.Random(seed)
        pairs = [("kin", "vermin", 1), ("folk", "guests", 1), ("kin", "guests", 0), ("folk", "vermin", 0)] * each
        texts, label = [], []
        for k in range(n):
            toxic = pairs[k][2] if k < len(pairs) else int(rng.random() < 0.5)
            words = [f"w{rng.randrange(400)}" for _ in range(30)]
            words += pairs[k][:2] if k < len(pairs) else ["scumbag"] * toxic
            rng.shuffle(words)
            texts.append(" ".join(words).encode())
            label.append(toxic)
        off = np.concatenate([[0], np.cumsum([len(x) for x in texts])])
        return *toxicity.buckets(np.frombuffer(b"".join(texts), np.uint8), off), np.array(label, float), len(pairs)

    for each, n, least in ((100, 2000, 0.85), (40, 1500, 0.65)):
        *train, _ = rows(each, n, 1)
        ids, bounds, label, pairs = rows(200, 1200, 2)
        right = (toxicity.fit(*train).score(ids, bounds) >= 0.5) == label
        assert right[:pairs].mean() > least and right[pairs:].mean() > 0.97, (each, right[:pairs].mean())


def test_toxicity_of_near_words_in_long_texts():
    def rows(each, n, seed):
        """Texts of 202 words; in the first ones two words that tell nothing alone stand side by side."""
        rng = random.Random(seed)
        pairs = [("kin", "vermin", 1), ("folk", "guests", 1), ("kin", "guests", 0), ("folk", "vermin", 0)] * each
        texts, label = [], []
        for k in range(n):
            toxic = pairs[k][2] if k < len(pairs) else int(rng.random() < 0.5)
            words = [f"w{rng.randrange(400)}" for _ in range(200)]
            at = rng.randrange(len(words))
            words[at:at] = pairs[k][:2] if k < len(pairs) else ["scumbag"] * toxic
            texts.append(" ".join(words).encode())
            label.append(toxic)
        off = np.concatenate([[0], np.cumsum([len(x) for x in texts])])
        return *toxicity.places(np.frombuffer(b"".join(texts), np.uint8), off), np.array(label, float), len(pairs)

    words, first, label, _ = rows(100, 2000, 1)
    machine = toxicity.fit_all(words, first, np.ones(len(label), bool), *toxicity.distinct(words, first), label)
    words, first, label, pairs = rows(200, 1200, 2)
    right = (machine.score_words(words, first) >= 0.5) == label
    alone = (machine.score(*toxicity.distinct(words, first)) >= 0.5) == label
    assert right[:pairs].mean() > 0.8 and right[pairs:].mean() > 0.95
    assert alone[:pairs].mean() < 0.65  # the near factors make the difference


def test_toxicity_trains_on_long_and_repeated_rows(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "NEAR_WORDS", 50)
    text = {i: ("scumbag " if i % 2 else "friend ") * (40 if i % 3 else 60) for i in range(400)}
    docs = spark.createDataFrame([(i, t) for i, t in text.items()] + [(1, text[1])] * 300, "doc_id bigint, text string")
    marks = spark.createDataFrame([(i, i % 2) for i in text], "doc_id bigint, toxic int")
    out = toxicity.toxicity(docs, marks, rows=200).collect()
    assert len(out) == 700 and np.mean([r["predicted"] == r["doc_id"] % 2 for r in out]) > 0.97
