"""Plain single-process versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BENCH_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def ascii_lower(s):
    return re.sub("[A-Z]", lambda m: m.group().lower(), s)


def sha(b):
    return hashlib.sha256(b).hexdigest()


def order(doc_id):
    """Null ids come last."""
    return (doc_id is None, doc_id or 0)


def quality(text):
    text = text or ""
    words = WORD.findall(text)
    grams = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if grams[tuple(words[i:i + 8])] > 1 for j in range(i, i + 8)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered),
            n < 20 or 100 * len(covered) > 30 * n)


def simhash(text):
    words = WORD.findall(ascii_lower(text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(ids, linked):
    """Smallest id that each item reaches; ``linked`` yields index pairs."""
    parent = list(range(len(ids)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in linked:
        parent[find(i)] = find(j)
    least = defaultdict(list)
    for i, d in enumerate(ids):
        if d is not None:
            least[find(i)].append(d)
    return [min(least[find(i)], default=None) for i in range(len(ids))]


def simhash_groups(rows):
    """(doc_id, fingerprint hex, component) per (doc_id, text)."""
    fp = [simhash(t) for _, t in rows]
    pairs = ((i, j) for i in range(len(fp)) for j in range(i) if (fp[i] ^ fp[j]).bit_count() <= 4)
    return [(d, f"{f:016x}", c) for (d, _), f, c in zip(rows, fp, groups([d for d, _ in rows], pairs))]


def shared_words(rows, span=50):
    """(doc_id, n_words, n_removed, kept_sha256) per (doc_id, text)."""
    words = [WORD.findall(t or "") for _, t in rows]
    first = {}
    for (d, _), w in zip(rows, words):
        for i in range(len(w) - span + 1):
            key = tuple(w[i:i + span])
            first[key] = min(first.get(key, order(d)), order(d))
    out = []
    for (d, _), w in zip(rows, words):
        gone = {j for i in range(len(w) - span + 1) if first[tuple(w[i:i + span])] < order(d)
                for j in range(i, i + span)}
        out.append((d, len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone).encode())))
    return out


def repeated_bytes(rows, span=400):
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) per (doc_id, text)."""
    raw = [(t or "").encode() for _, t in rows]
    seen = Counter(r[i:i + span] for r in raw for i in range(len(r) - span + 1))
    out = []
    for (d, _), r in zip(rows, raw):
        gone = bytearray(len(r))
        for i in range(len(r) - span + 1):
            if seen[r[i:i + span]] > 1:
                gone[i:i + span] = b"\x01" * span
        runs = sum(1 for i, x in enumerate(gone) if x and (i == 0 or not gone[i - 1]))
        out.append((d, len(r), sum(gone), runs, sha(bytes(b for b, x in zip(r, gone) if not x))))
    return out


def contamination(rows, items, span=13):
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) per (doc_id, text)."""
    windows = defaultdict(set)
    for item, text in items:
        w = BENCH_WORD.findall(ascii_lower(text or ""))
        if w and item is not None:
            for i in range(max(1, len(w) - span + 1)):
                windows[tuple(w[i:i + span])].add(str(item))
    lengths = {len(w) for w in windows}
    out = []
    for d, text in rows:
        w = BENCH_WORD.findall(ascii_lower(text or ""))
        hit, owners = set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in windows:
                    hit.update(range(i, i + n))
                    owners |= windows[tuple(w[i:i + n])]
        out.append((d, len(w), len(hit), len(owners), sha(",".join(sorted(owners)).encode()),
                    len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


def variant_words(rows):
    """Word counts after the deletions, for rows of (doc_id, text)."""
    count = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = ascii_lower(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            count[run] += 1
    return {w: n for w, n in count.items() if len(w) >= 5 and n >= 3}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def variants(count):
    form, out = {}, []
    around = {w: [v for v in count if abs(len(v) - len(w)) < 2 and near(w, v)] for w in count}
    for w, n in count.items():
        best = min(around[w], key=lambda v: (-count[v], v), default=None)
        if best is not None and count[best] >= 2 * n:
            form[w] = best
    for w, n in count.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, n, len(around[w]), form.get(w), count.get(form.get(w)), root))
    return out


def divergence(rows):
    """Rows of (lang, source, part, item, value, rank) for rows of (text, lang, source)."""
    rows = [(t or "", a or "", s or "") for t, a, s in rows]
    found = [(a, s, Counter(re.findall("[^\x00-\x40\x5B-\x60\x7B-\x7F]+", ascii_lower(t)))) for t, a, s in rows]
    out = []
    for lang in {a for a, _, _ in found}:
        docs = Counter(t for a, _, c in found if a == lang for t in c)
        kept = {t for t, n in docs.items() if n >= 3}
        column = {s: Counter() for a, s, _ in found if a == lang}
        whole = Counter()
        for a, s, c in found:
            if a == lang:
                column[s].update({t: n for t, n in c.items() if t in kept})
                whole.update({t: n for t, n in c.items() if t in kept})
        share = lambda c, t: 1 + 10 ** 9 * (c[t] + 1) // (sum(c.values()) + len(kept))
        p = {s: {t: share(c, t) for t in kept} for s, c in column.items()}
        q = {t: share(whole, t) for t in kept}
        f = lambda x, y: (x - y) ** 2 // y
        for s in column:
            pairs = [(-sum(f(p[s][t], p[o][t]) for t in kept), o.encode(), o) for o in column if o != s]
            terms = [(-f(p[s][t], q[t]), t.encode(), t) for t in kept if column[s][t] and p[s][t] > q[t]]
            out += [(lang, s, "pair", o, -v, i) for i, (v, _, o) in enumerate(sorted(pairs), 1)]
            out += [(lang, s, "term", t, -v, i) for i, (v, _, t) in enumerate(sorted(terms)[:200], 1)]
    return out


def kept_by_quality(text):
    """The verdict of all quality rules."""
    n, chars, symbols, dup, _, failed = quality(text)
    text = text or ""
    words = WORD.findall(text)
    with_letter = sum(1 for w in words if re.search("[A-Za-z\u0080-\U0010FFFF]", w))
    return not (failed or 100 * symbols > 10 * chars or not 2 * n <= chars <= 30 * n or
                100 * dup > 60 * (text.count("\n") + 1) or 100 * sum("!" in w for w in words) > 60 * n or
                100 * sum("|" in w for w in words) > 25 * n or 100 * (n - with_letter) > 50 * n)


def without_shared(rows, span=50):
    """(doc_id, text) with shared passages cut; texts that lose nothing stay as they are."""
    first = {}
    words = [WORD.findall(t or "") for _, t in rows]
    for (d, _), w in zip(rows, words):
        for i in range(len(w) - span + 1):
            key = tuple(w[i:i + span])
            first[key] = min(first.get(key, d), d)
    out = []
    for (d, t), w in zip(rows, words):
        gone = {j for i in range(len(w) - span + 1) if first[tuple(w[i:i + span])] < d for j in range(i, i + span)}
        out.append((d, " ".join(x for i, x in enumerate(w) if i not in gone) if gone else t))
    return out


def pipeline(rows, items, encode):
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of all stages, for rows with distinct ids."""
    rows = [(d, t) for d, t in rows if kept_by_quality(t)]
    rows = [(d, t) for (d, t), (_, _, c) in zip(rows, simhash_groups(rows)) if c == d]
    rows = without_shared(rows)
    rows = [(d, t) for (d, t), mark in zip(rows, contamination(rows, items)) if not mark[-1]]
    out = []
    for d, t in rows:
        ids = encode(t or "")
        out.append((d, len(ids), sha(b"".join(i.to_bytes(4, "little") for i in ids)), sha((t or "").encode())))
    return out
