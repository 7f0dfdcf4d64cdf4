"""Main text of web pages by consensus paths of their host.

Every page's containers are scored by the running text that they hold; a page votes for its best
ones by generalised path (tags with classes, digits removed) and votes are summed per host. On each
page the host's most voted path that holds nearly all of that page's running text says where the
article is; without one, the page uses its own best container. The pages of a host also vote on what
is furniture: a path whose text is the same on most of the different pages that have it. Outside of
the innermost container of the article, blocks at such paths are left out, whatever their names; so are
blocks that are at least half links outside of the container. Parts that are furniture by tag never count as text; a name or a
form makes furniture only of what is not a wrapper of the article (see _wrappers).
"""

from __future__ import annotations

import html as html_lib
import re
from collections import defaultdict
from collections.abc import Collection, Iterator
from dataclasses import dataclass
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from perfkit.llm.common import extend, ship, stored

#: Containers that a page votes for.
VOTES = 3
#: Paths that are kept per host; a page that fits none of them uses its own container.
HOST_PATHS = 8
#: A container is one to vote for or to use if it holds this share of the page's running text.
HELD_SHARE = 0.9
#: A path is furniture of its host if it stands on so many different pages, ...
REPEAT_PAGES = 3
#: ... with no more different texts than this share of them, ...
REPEAT_TEXTS = 0.5
#: ... and holds less than this share of their running text (pages may be near copies of each other).
REPEAT_SHARE = 0.5
#: Host paths are broadcast up to so many bytes, else joined by shuffle.
BROADCAST_BYTES = 32 << 20
#: Containers further down count as part of the one at this depth, and an end tag closes nothing that is
#: more levels up. No text is lost by it; time and path lengths stay bounded on pages of very deep nesting.
MAX_DEPTH = 512
#: A link's text counts against its container.
LINK_COST = 2
ARTICLE_BONUS = 1.5
ROOT_WEIGHT = 0.6
DEPTH_WEIGHT = 0.99

# HTML element kinds, and names that sites give to furniture.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
FURNITURE_TAGS = set("nav aside footer button select dialog menu iframe object svg canvas video audio "
                     "head title noscript template textarea".split())
BLOCK_TAGS = set("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption "
                 "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol "
                 "optgroup option p pre section summary table tbody td tfoot th thead title tr ul".split())
CLOSED_BY_OWN = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr"}, "th": {"tr"},
                 "option": {"select"}}
FURNITURE_NAMES = set("ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner "
                      "nav navbar navigation menu sidebar footer masthead cookie cookies consent gdpr notice notices "
                      "alert popup modal overlay comment comments disqus reply replies responses share sharing social "
                      "related recommended recommendations breadcrumb breadcrumbs newsletter subscribe subscription "
                      "signup login search form widget toolbar pagination pager skip disclaimer complementary "
                      "contentinfo".split())
#: Furniture that may hold articles of its own or more text than the page's article.
ASIDE_NAMES = set("comment comments disqus reply replies responses related recommended recommendations".split())
ARTICLE_NAMES = set("article post entry story content main body text".split())

# An attribute list ends at the next < or > outside of a quoted value. Nothing is tried twice: the list
# always matches up to there, and a quote without an end is an ordinary character.
_ATTRIBUTES = r"(?:[^<>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+"
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|textarea|title|iframe|svg)\b" + _ATTRIBUTES
    + r">.*?(?:</\1\s*>|\Z)|<(/?)([a-zA-Z][^\s/<>]*+)(" + _ATTRIBUTES + r")>?+|<[!?/][^>]*+>?+", re.S | re.I)
_NAMING = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def _names(attributes: str) -> tuple[list[str], set[str]]:
    """Classes without digits, and all words of class, id and role."""
    classes, words = [], set()
    for m in _NAMING.finditer(attributes):
        value = m[2] or m[3] or m[4] or ""
        if m[1].lower() == "class":
            classes = sorted({re.sub(r"\d+", "", c) for c in value.split()} - {""})
        words.update(w.lower() for w in _WORDS.findall(value))
    return classes, words


@dataclass
class _Named:
    """An element that its name, or being a form, marks as furniture."""

    parent: int
    aside: bool
    articles: int = 0
    good: int = 0


def _wrappers(named: list[_Named], articles: int, good: int) -> list[bool]:
    """Which marked elements are no furniture, as they hold an article or most of the page's running text.

    Most is over half, or beside an article that is outside of them over HELD_SHARE (a notice can be
    longer than a short article). Beside one, comments and related pages are furniture in any case.
    """
    for mark in reversed(named):  # children come after their parents
        if mark.parent >= 0:
            named[mark.parent].articles += mark.articles
            named[mark.parent].good += mark.good
    out = []
    for mark in named:
        beside = articles > mark.articles
        holds = mark.articles > 0 or mark.good > (HELD_SHARE if beside else 0.5) * good
        out.append(holds and not (mark.aside and beside))
    return out


def blocks(page: str) -> list[tuple[str, str, int]]:
    """(path, text, characters in links) of a page's blocks in order, without furniture.

    A path is of the open containers, outermost first, joined by '/'. If nothing is left, only what
    is furniture by tag is left out.
    """
    out: list[tuple[str, str, int, int]] = []  # path, text, characters in links, innermost marked element
    # tag, path, furniture by tag, marked element, plain inline, in article or main
    stack: list[tuple[str, str, bool, int, bool, bool]] = []
    open_tags: dict[str, int] = defaultdict(int)
    paths: dict[tuple[str, str], str] = {}
    pending: list[str] = []
    named: list[_Named] = []
    state = {"link": 0, "in_link": 0, "articles": 0}

    def flush() -> None:
        text = " ".join("".join(pending).split())
        if text:
            path, mark = (stack[-1][1], stack[-1][3]) if stack else ("", -1)
            out.append((path, text, state["link"], mark))
        pending.clear()
        state["link"] = 0

    def push(tag: str, *rest) -> None:
        stack.append((tag, *rest))
        open_tags[tag] += 1

    def close(tag: str, within: set[str] = frozenset(), inline: bool = False) -> None:
        if not open_tags[tag]:
            return
        for i in range(len(stack) - 1, max(-1, len(stack) - 1 - MAX_DEPTH), -1):
            if stack[i][0] == tag:
                if inline and not all(s[4] for s in stack[i:]):
                    flush()
                for gone in stack[i:]:
                    open_tags[gone[0]] -= 1
                del stack[i:]
                return
            if stack[i][0] in within:
                return

    def take(raw: str) -> None:
        if raw and not (stack and stack[-1][2]):
            text = html_lib.unescape(raw) if "&" in raw else raw
            pending.append(text)
            if state["in_link"]:
                state["link"] += len(text)

    at = 0
    for m in _TOKEN.finditer(page):
        take(page[at:m.start()])
        at = m.end()
        if m[3] is None:
            continue
        closing, tag, attributes = m[2], m[3].lower(), m[4]
        if tag == "a":
            state["in_link"] = 0 if closing else 1
        if tag == "br":
            take(" ")
            continue
        block = tag in BLOCK_TAGS
        if block:
            flush()
        if closing:
            if block or any(s[0] == tag for s in stack[-8:]):
                close(tag, inline=not block)
            continue
        if tag in VOID:
            continue
        if block:
            close("p", {"td", "th", "li", "div", "section", "article", "blockquote", "body"})
            if tag in CLOSED_BY_OWN:
                close(tag, CLOSED_BY_OWN[tag])
        classes, words = _names(attributes) if "=" in attributes else ([], set())
        inherited, mark = (stack[-1][2], stack[-1][3]) if stack else (False, -1)
        in_article = bool(stack) and stack[-1][5]
        furniture = inherited or tag in FURNITURE_TAGS or (tag == "header" and not in_article)
        marked = False
        if not furniture and tag in ("article", "main"):
            if not words & FURNITURE_NAMES:
                state["articles"] += 1
                if mark >= 0:
                    named[mark].articles += 1
        elif not furniture and tag not in ("html", "body"):
            marked = tag == "form" or bool(words & FURNITURE_NAMES) or ("header" in words and not in_article)
        if attributes.endswith("/") and not block:
            continue
        if block or furniture or marked:
            if (furniture or marked) and not inherited:
                flush()
            before = stack[-1][1] if stack else ""
            path = before
            if tag != "p" and len(stack) < MAX_DEPTH:
                step = ".".join([tag, *classes])
                path = paths.setdefault((before, step), f"{before}/{step}".lstrip("/"))  # one string per path
            if marked:
                named.append(_Named(mark, bool(words & ASIDE_NAMES) and not words & ARTICLE_NAMES))
                mark = len(named) - 1
            push(tag, path, furniture, mark, False, in_article or tag in ("article", "main"))
        elif mark >= 0 and any(s[0] == tag for s in stack[-8:]):
            push(tag, stack[-1][1], False, mark, True, in_article)  # so that its end does not close a marked one
    take(page[at:])
    flush()
    if not named:
        return [(path, text, linked) for path, text, linked, _ in out]
    total = 0
    for _, text, linked, mark in out:
        good = _running(text, linked)
        total += good
        if mark >= 0:
            named[mark].good += good
    kept: list[bool] = []
    for element, wraps in zip(named, _wrappers(named, state["articles"], total)):
        kept.append(wraps and (element.parent < 0 or kept[element.parent]))
    left = [(path, text, linked) for path, text, linked, mark in out if mark < 0 or kept[mark]]
    return left or [(path, text, linked) for path, text, linked, _ in out]


def _running(text: str, linked: int) -> int:
    return max(0, len(text) - LINK_COST * linked)


def score_containers(found: list[tuple[str, str, int]]) -> list[tuple[str, float]]:
    """The containers that hold HELD_SHARE of the page's running text, best first."""
    held: dict[str, int] = defaultdict(int)
    total = 0
    for path, text, linked in found:
        good = _running(text, linked)
        total += good
        held[path] += good
    levels: dict[int, list[str]] = defaultdict(list)
    for path in held:
        levels[path.count("/")].append(path)
    for depth in range(max(levels, default=0), 0, -1):  # sums go up, every path once
        for path in levels[depth]:
            parent = path.rsplit("/", 1)[0]
            if parent not in held:
                levels[depth - 1].append(parent)
            held[parent] += held[path]
    scored = []
    for path, good in held.items():
        last = path.rsplit("/", 1)[-1]
        if not good or good < HELD_SHARE * total or re.match(r"h[1-6]\b", last):
            continue
        words = {w.lower() for w in _WORDS.findall(last)}
        weight = ROOT_WEIGHT if last.split(".")[0] in ("html", "body") else 1.0
        if weight == 1.0 and words & ARTICLE_NAMES:
            weight = ARTICLE_BONUS
        scored.append((path, good / total * weight * DEPTH_WEIGHT ** path.count("/")))
    return sorted(scored, key=lambda x: (-x[1], x[0]))


def path_key(path: str) -> int:
    """64 bits of a path, as stored for furniture."""
    return int.from_bytes(blake2b(path.encode(), digest_size=8).digest(), "little", signed=True)


def extract(page: str, host_paths: list[str] | None, repeated: Collection[int] = ()) -> tuple[str, str | None]:
    """(main text, path of its container), given the host's paths by falling votes and its furniture's keys.

    Running text is kept wherever it is, unless it stands at a repeated path outside of the article's
    innermost container; blocks that are at least half links only in the container.
    """
    found = blocks(page)
    again = {path for path in {path for path, _, _ in found} if repeated and path_key(path) in repeated}
    own = score_containers([b for b in found if b[0] not in again])
    if not own:
        again, own = set(), score_containers(found)
    if not own:
        return "\n\n".join(text for _, text, _ in found), None
    fit = {path for path, _ in own}
    path = next((p for p in host_paths or () if p in fit), own[0][0])
    inner = max(fit, key=lambda p: (p.count("/"), p))  # all of them are above each other

    def under(p: str, container: str) -> bool:
        return p == container or p.startswith(container + "/")

    return "\n\n".join(text for p, text, linked in found
                       if (p not in again or under(p, inner)) and (under(p, path) or _running(text, linked))), path


def host_of(url: str) -> "F.Column":
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def page_votes(page: str) -> list[tuple[str, int, int, int, int, int]]:
    """(path, votes, key of the page's blocks, key of the path's text, its running text, the page's), a row for
    each path with text or votes; a path without text of its own has null keys."""
    found = blocks(page)
    votes = dict(score_containers(found)[:VOTES])
    texts: dict[str, list[str]] = defaultdict(list)
    good: dict[str, int] = defaultdict(int)
    for path, text, linked in found:
        texts[path].append(text)
        good[path] += _running(text, linked)
    whole = path_key("\0".join(f"{path}\0{text}" for path, text, _ in found))
    total = sum(good.values())
    return [(path, round(1000 * votes.get(path, 0)), whole if path in texts else None,
             path_key("\0".join(texts[path])) if path in texts else None, good.get(path, 0), total)
            for path in sorted({*texts, *votes})]


def host_paths(pages: DataFrame) -> DataFrame:
    """(host, paths, repeated): the HOST_PATHS paths with the most votes, of equal ones the first in order, and
    the keys of all furniture paths. Pages with equal blocks count once for furniture, so copies make none."""

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(host, *row) for host, page in zip(batch.column("host").to_pylist(), batch.column("html"))
                    for row in page_votes(page.as_py() or "")]
            if rows:
                kinds = [pa.string(), pa.string(), *[pa.int64()] * 5]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                                 names=["host", "path", "votes", "page", "text", "good", "total"])

    ddl = "host string, path string, votes long, page long, text long, good long, total long"
    cast = pages.select(host_of("url").alias("host"), "html").mapInArrow(vote, ddl)
    # Step by step, each with partial sums: different pages, then different texts, then paths.
    by_page = cast.groupBy("host", "path", "page", "text").agg(
        F.sum("votes").alias("votes"), F.first("good").alias("good"), F.first("total").alias("total"))
    has = F.col("text").isNotNull()
    by_text = by_page.groupBy("host", "path", "text").agg(
        F.sum("votes").alias("votes"), *[F.sum(F.when(has, c).otherwise(0)).alias(n)
                                         for n, c in (("pages", F.lit(1)), ("good", F.col("good")), ("total", F.col("total")))])
    by_path = stored(by_text.groupBy("host", "path").agg(
        *[F.sum(c).alias(c) for c in ("votes", "pages", "good", "total")], F.count("text").alias("texts"))
        .where(f"votes > 0 or (pages >= {REPEAT_PAGES} and texts <= {REPEAT_TEXTS} * pages"
               f" and good < {REPEAT_SHARE} * total)"), "path-votes")
    rank = F.row_number().over(Window.partitionBy("host").orderBy(F.desc("votes"), "path"))  # trimmed before the shuffle
    best = by_path.where("votes > 0").withColumn("rank", rank).where(F.col("rank") <= HOST_PATHS)
    first = (best.groupBy("host").agg(F.array_sort(F.collect_list(F.struct("rank", "path"))).alias("b"))
             .select("host", F.col("b.path").alias("paths")))
    key = F.udf(lambda path: path_key(path), "long")
    furniture = (by_path.where(f"pages >= {REPEAT_PAGES} and texts <= {REPEAT_TEXTS} * pages"
                               f" and good < {REPEAT_SHARE} * total")
                 .groupBy("host").agg(F.collect_set(key("path")).alias("repeated")))
    return first.join(furniture, "host", "full")


def extract_pages(pages: DataFrame) -> DataFrame:
    """Per row of ``pages`` (page_id, url, html): page_id, url, text, n_chars, path (null if none).

    Null and empty html give an empty text; pages whose url is null or has no host vote and are
    extracted as one host; repeated rows vote and are extracted each; null page_ids are carried;
    extra columns are not. Empty table: empty result. A page of any length or nesting is parsed whole, in
    time linear in its length (tags that never end included); see MAX_DEPTH.
    """
    paths = stored(host_paths(pages), "host-paths")
    size = F.octet_length(F.concat_ws("", "host", "paths")) + 8 * F.size(F.coalesce("repeated", F.array().cast("array<long>"))) + 64
    if (paths.agg(F.sum(size).alias("n")).first()["n"] or 0) <= BROADCAST_BYTES:
        paths = F.broadcast(paths)
    keyed = pages.select("page_id", "url", "html", host_of("url").alias("host"))
    schema = extend(pages.select("page_id", "url").schema, "text string, n_chars long, path string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys: dict[str, frozenset[int]] = {}  # per host, made once in a batch
            got = []
            for page, host, known, again in zip(batch.column("html"), batch.column("host").to_pylist(),
                                                batch.column("paths"), batch.column("repeated")):
                if host not in keys:
                    keys[host] = frozenset(again.as_py() or ())
                got.append(extract(page.as_py() or "", known.as_py(), keys[host]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array([t for t, _ in got], pa.string()),
                 pa.array([len(t) for t, _ in got], pa.int64()), pa.array([p for _, p in got], pa.string())],
                names=schema.fieldNames())

    return keyed.join(paths, "host", "left").select("page_id", "url", "html", "host", "paths", "repeated").mapInArrow(run, schema)


ship(__name__)
