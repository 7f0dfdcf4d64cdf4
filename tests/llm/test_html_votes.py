"""Votes of a host's pages on furniture without telling names, and pages that once took quadratic time."""

import random
import time
from collections import defaultdict

import pytest

from perfkit.llm import html_extract as he

COLS = "page_id long, url string, html string"
NOTE = "Travellers are asked to read our terms of carriage before they leave the harbour, and to keep their papers at hand."


def words(rng, n):
    return " ".join(rng.choice(["river", "stone", "blue", "ran", "over", "two", "hills"]) + str(rng.randint(0, 999)) for _ in range(n))


def page(rng, note=NOTE, sections=3):
    body = "".join(f"<h2>Summary</h2><p>{words(rng, 30)}</p>" for _ in range(sections))
    return f"<body><div class=q1><div class=z>{note}</div><div class=k7>{body}</div><div class=z2>{note[::-1]}</div></div></body>"


def article(html):
    inside = html[html.index("<div class=k7>") + 14:html.index("</div><div class=z2>")]
    return "\n\n".join(inside.replace("</h2>", "<h2>").replace("</p>", "<h2>").replace("<p>", "<h2>").split("<h2>")).strip()


def plain(text):
    return "\n\n".join(t for t in text.split("\n\n") if t)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    out = [(i, "http://many.example/a", page(rng)) for i in range(6)]
    out += [(10 + i, "http://few.example/a", page(rng)) for i in range(2)]
    same = page(rng)
    out += [(20 + i, "http://copies.example/a", same) for i in range(5)]
    out += [(30 + i, None, None) for i in range(4)] + [(40, "http://many.example/e", ""), (None, "x", "<p>alone</p>")]
    base = words(rng, 300)  # near copies: the article repeats on every page
    out += [(50 + i, "http://near.example/a", f"<div class=m><p>{base}</p></div><div class=d>{words(rng, 12)}</div>")
            for i in range(5)]
    return out


def brute_repeated(rows):
    seen = defaultdict(dict)
    for _, url, html in rows:
        host = url.split("/")[2] if url and "//" in url else ""
        found = he.blocks(html or "")
        total = sum(he._running(t, n) for _, t, n in found)
        for path in {p for p, _, _ in found}:
            mine = [(t, n) for p, t, n in found if p == path]
            seen[host, path][tuple(found)] = (tuple(t for t, _ in mine), sum(he._running(*m) for m in mine), total)
    out = defaultdict(set)
    for (host, path), pages in seen.items():
        texts, good, total = zip(*pages.values())
        if len(texts) >= 3 and 2 * len(set(texts)) <= len(texts) and 2 * sum(good) < sum(total):
            out[host].add(he.path_key(path))
    return out


def test_votes_against_brute_force(spark, rows):
    df = spark.createDataFrame(rows, COLS).repartition(3)
    got = {r["host"]: set(r["repeated"]) for r in he.host_paths(df).collect() if r["repeated"]}
    assert got == brute_repeated(rows) and set(got) == {"many.example"}


def test_voted_furniture_goes_and_articles_stay(spark, rows):
    out = {r["page_id"]: r["text"] for r in he.extract_pages(spark.createDataFrame(rows, COLS).repartition(3)).collect()}
    for i in range(6):
        assert out[i] == plain(article(rows[i][2]))  # the headings repeat too, but inside of the article
        assert NOTE in he.extract(rows[i][2], None)[0]  # without votes
    assert NOTE in out[10] and all(NOTE in out[20 + i] for i in range(5))  # too few different pages
    assert out[30] == out[40] == "" and out[None] == "alone"
    near = [r for r in rows if r[1] == "http://near.example/a"]
    assert all(len(out[p].split()) == 312 for p, _, _ in near)


def test_empty_table(spark):
    assert he.extract_pages(spark.createDataFrame([], COLS)).count() == 0


@pytest.mark.parametrize("html", [
    "<a " * 300_000, "<!" * 300_000, "</" * 300_000, "<div>" * 60_000 + "t", "<div>t" * 40_000, '<a href="' * 100_000,
    "<a href='\"" * 100_000, "<script " * 100_000, "<svg>" * 100_000, "<ul><li>" * 30_000 + "t", "<form>" * 30_000 + "t",
    "<tr><td><table><tr>" + "<div>" * 9_000 + "<td>t</td>" * 9_000, "<a " + "class= " * 100_000 + ">", "<" * 500_000],
    ids=range(14))
def test_linear_time(html):
    began = time.process_time()
    he.extract(html, None)
    assert time.process_time() - began < 2


def test_tags_without_end():
    assert he.extract("<p>one <b two</p><p title='a>b' class=\"c<d\">three</p>", None)[0] == "one\n\nthree"
    assert he.extract("<p>it's <a title=it's href=x>a fine</a> day, isn't it</p>", None)[0] == "it's a fine day, isn't it"
