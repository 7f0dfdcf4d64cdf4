"""Benchmark decontamination by winnowing, in DataFrame functions only.

Words are hashed, hashes of ``gram`` consecutive words are formed, and of every sliding window of
``span - gram + 1`` grams the least hash is kept as a fingerprint. Two texts that share ``span``
consecutive words share all grams of that stretch and so its least one: joining the fingerprints
of documents and benchmark items finds every shared stretch of at least ``span`` words. Around
each hit the windows that contain it are then compared word by word with the items' windows.

Items of fewer than ``span`` words are one window; their whole-item hash is a fingerprint of its
own length, looked up among all document grams of that length.

Everything per document is array expressions in the scan; only fingerprints leave it, and
only documents with a hit are read again. Arrays are exploded by the outer form: for the inner
one Spark infers a filter on the array and pushes a copy of its whole computation below.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perfkit.llm.common import match_rows, packed, small, stored, text_key, unpacked

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SPAN = 13
GRAM = 6
#: A contaminated document has at least one hit word in this many words.
HIT_SHARE = 20
#: Fingerprints, windows or document keys are broadcast up to so many rows, else joined by shuffle.
BROADCAST_ROWS = 200_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. Texts that are ASCII throughout take the fast built-in."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, _UPPER, _LOWER))


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(f"({WORD})"), F.lit(1))


def _shifted(a: Column, b: Column, step: int, f) -> Column:
    """f(a[i], b[i + step]) for every i that has both."""
    n = F.greatest(F.least(F.size(a), F.size(b) - step), F.lit(0))
    return F.zip_with(F.slice(a, F.lit(1), n), F.slice(b, F.lit(step + 1), n), f)


def _with_grams(df: DataFrame, lengths: set[int], prefix: str = "_g") -> DataFrame:
    """Adds _g<k>: the hashes of all k consecutive entries of _g1, for each wanted k, by doubling."""
    have = {1}
    for k in sorted(lengths):
        while k not in have:
            a = max(h for h in have if h <= k)
            b = max(h for h in have if h <= k - a)
            df = df.withColumn(f"{prefix}{a + b}", _shifted(
                F.col(f"{prefix}{a}"), F.col(f"{prefix}{b}"), a, lambda x, y: F.xxhash64(x, y)))
            have.add(a + b)
    return df


def _with_minima(df: DataFrame, source: str, width: int, out: str) -> DataFrame:
    """Adds ``out``: the least of every ``width`` consecutive entries of ``source``, by doubling."""
    col, have = source, 1
    while have < width:
        step = min(have, width - have)
        df = df.withColumn(f"_m{have + step}", _shifted(F.col(col), F.col(col), step, lambda x, y: F.least(x, y)))
        col, have = f"_m{have + step}", have + step
    return df.withColumn(out, F.col(col))


def _with_fingerprints(df: DataFrame, shorts: list[int], span: int, gram: int) -> DataFrame:
    """From ``words``: ``fps``, the distinct winnowed fingerprints, and all grams of short lengths."""
    df = df.withColumn("_g1", F.transform("words", lambda w: F.xxhash64(w)))
    df = _with_grams(df, {gram, *shorts})
    df = _with_minima(df, f"_g{gram}", span - gram + 1, "_low")
    return df.withColumn("fps", F.array_distinct(F.concat("_low", *[F.col(f"_g{k}") for k in shorts])))


def decontaminate(docs: DataFrame, benchmark: DataFrame, span: int = SPAN, gram: int = GRAM,
                  share: int = HIT_SHARE) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, text_key, n_words, n_hit, n_items, items (sorted
    item ids as strings), hits (start and length in words of every matched window), contaminated.

    Null and empty texts have no words, are never hit, and match no item; items without words
    occur nowhere; items with a null id are ignored, an item id that repeats owns the windows of
    all its rows. Repeated document rows give repeated results; null doc_ids are allowed; extra
    columns are not carried. Empty tables: no document rows, or no hits.
    """
    items = stored(benchmark.where(F.col("item_id").isNotNull() & F.col("text").isNotNull())
                   .select(F.col("item_id").cast("string").alias("item_id"), words_of(F.col("text")).alias("words"))
                   .where(F.size("words") > 0), "items")
    n = F.size("words")
    shorts = sorted(r[0] for r in items.where(n < span).select(n).distinct().collect())  # fewer than span values
    windows = stored(items.select("item_id", F.explode(
        F.when(n < span, F.array("words")).otherwise(
            F.transform(F.sequence(F.lit(1), F.greatest(n - span + 1, F.lit(1))),
                        lambda s: F.slice("words", s, F.lit(span))))).alias("win")).distinct(), "windows")
    # A whole short item is one gram of its length; longer grams of other items only add candidates.
    wanted = small(stored(_with_fingerprints(items, shorts, span, gram)
                           .select(F.explode_outer("fps").alias("fp")).where("fp IS NOT NULL").distinct(),
                           "fingerprints"), BROADCAST_ROWS)

    src = docs.select("doc_id", text_key(F.col("text")).alias("text_key"), "text")
    full = src.select("doc_id", "text_key", words_of(F.col("text")).alias("words")).withColumn("n_words", n)
    prints = (_with_fingerprints(full, shorts, span, gram)
              .select("doc_id", "text_key", "n_words", F.posexplode_outer("fps").alias("i", "fp")))
    seen = (prints.join(wanted.withColumn("wanted", F.lit(1)), "fp", "left")
            .groupBy("doc_id", "text_key")
            .agg(F.max("n_words").cast("long").alias("n_words"),
                 F.count(F.when(F.coalesce("i", F.lit(0)) == 0, 1)).alias("copies"),
                 F.max("wanted").alias("wanted")))
    seen = stored(seen, "seen")

    suspects = small(seen.where("wanted = 1").select("doc_id", "text_key"), BROADCAST_ROWS)
    again = stored(match_rows(src, suspects, "inner").dropDuplicates(["doc_id", "text_key"])
                   .select("doc_id", "text_key", words_of(F.col("text")).alias("words")), "suspects")
    marks = []
    grams = _with_grams(again.withColumn("_g1", F.transform("words", lambda w: F.xxhash64(w))), {gram, *shorts})
    for k, reach in [(gram, span)] + [(k, k) for k in shorts]:
        # Shorter texts have no window of this length; items as short are found by their own length.
        at = grams.where(n >= reach).select("doc_id", "text_key", n.alias("n"), F.posexplode_outer(f"_g{k}").alias("p", "fp"))
        marks.append(at.join(wanted, "fp", "left_semi").select("doc_id", "text_key", F.explode(F.sequence(
            F.greatest(F.col("p") - (reach - k), F.lit(0)),
            F.greatest(F.least(F.col("p"), F.col("n") - reach), F.greatest(F.col("p") - (reach - k), F.lit(0)))))
            .alias("start")).select("doc_id", "text_key", "start", F.lit(reach).alias("length")))
    marked = marks[0]
    for m in marks[1:]:
        marked = marked.unionByName(m)
    starts = marked.groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("start", "length")).alias("starts"))
    spans = match_rows(again, starts, "inner").select("doc_id", "text_key", F.explode(F.transform(
        "starts", lambda s: F.struct(s["start"].alias("start"), s["length"].alias("length"),
                                     F.slice("words", s["start"] + 1, s["length"]).alias("win")))).alias("w"))
    known = small(windows.select("win").distinct(), BROADCAST_ROWS)
    matched = stored(spans.select("doc_id", "text_key", "w.*").join(known, "win"), "matched")

    covered = (matched.select("doc_id", "text_key", F.explode(
        F.sequence(F.col("start"), F.col("start") + F.col("length") - 1)).alias("word"))
        .distinct().groupBy("doc_id", "text_key").agg(F.count("*").alias("n_hit")))
    places = matched.groupBy("doc_id", "text_key").agg(
        F.array_sort(F.collect_set(F.struct("start", "length"))).alias("hits"))
    owners = (matched.select("doc_id", "text_key", "win").distinct().join(small(windows, BROADCAST_ROWS), "win")
              .groupBy("doc_id", "text_key").agg(F.array_sort(F.collect_set("item_id")).alias("items")))
    out = match_rows(match_rows(match_rows(seen, covered, "left"), places, "left"), owners, "left")
    hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return (out.withColumn("n_hit", hit)
            .withColumn("items", F.coalesce("items", F.array().cast("array<string>")))
            .withColumn("_copy", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))))
            .select("doc_id", "text_key", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items",
                    "hits", ((F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))).alias("contaminated")))


def clean_documents(docs: DataFrame, benchmark: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """The rows of ``docs`` that are not contaminated."""
    bad = (decontaminate(docs, benchmark, span, gram).where("contaminated")
           .select("doc_id", "text_key").distinct())
    return match_rows(packed(docs), bad, "left_anti").select(unpacked(docs.columns))
