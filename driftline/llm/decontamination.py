"""Benchmark decontamination, DataFrame functions only.

Words are lower-cased (A-Z) runs of ASCII letters, digits and non-ASCII characters. Every run of
WINDOW words of a benchmark item is a window; an item of fewer words is one window of its own
length. The windows form a small hash set. Documents are scanned window by window: each window
length gets one rolling array of 64-bit hashes (built by doubling, so a window costs a few hash
calls and not its length), which is probed against the broadcast set. Hits are then verified on the
words themselves, in the documents that have any.

The set is broadcast only after it has been counted; above MAX_BROADCAST_WINDOWS the probe is an
ordinary join of the window hashes.

Cases: null or wordless texts and items have no windows; rows that repeat doc_id and text are the
same document and give one output row each; items without id are one item that is counted but not listed;
equal windows of several items list all of them; other columns are ignored (``clean`` hands all of
them on); empty tables on either side give no hits; long texts are scanned whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftline.llm.text import ALNUM_SEP, ascii_lower, doc_key, let, shifted, split_words
from driftline.session import materialize

WINDOW = 13
MAX_BROADCAST_WINDOWS = 1_000_000  # 24 bytes each
MIN_PERCENT = 5  # hit words of a contaminated document


def words_of(text: Column) -> Column:
    return split_words(ascii_lower(text), ALNUM_SEP)


def item_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item_id, gram, len): the distinct windows of each item, as arrays of words."""
    w = items.select("item_id", words_of(F.col("text")).alias("w")).filter(F.size("w") > 0)
    size = F.least(F.lit(window), F.size("w"))
    start = F.explode(F.sequence(F.lit(1), F.size("w") - size + 1))
    return (w.select("item_id", "w", size.alias("len"), start.alias("at"))
            .select("item_id", F.slice("w", F.col("at"), F.col("len")).alias("gram"), "len").distinct())


def rolling_hashes(df: DataFrame, words: str, lengths: list[int]) -> DataFrame:
    """Add ``_h<n>`` for each length n: the hash of the n words from every position on; too
    short at the end means fewer entries. Powers of two come from two halves, other lengths
    from the power below and the rest."""
    def pair(a: Column, b: Column) -> Column:
        return F.zip_with(F.slice(a, F.lit(1), F.size(b)), b, lambda x, y: F.xxhash64(x, y))

    have = {1: "_h1"}
    df = df.withColumn("_h1", F.transform(words, lambda w: F.xxhash64(w)))

    def need(n: int) -> str:
        nonlocal df
        if n not in have:
            low = 1 << (n.bit_length() - 1)
            low = low // 2 if low == n else low
            a, b = need(low), need(n - low)
            df = df.withColumn(f"_h{n}", pair(F.col(a), shifted(F.col(b), low)))
            have[n] = f"_h{n}"
        return have[n]

    for n in lengths:
        need(n)
    return df


def find_hits(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, _th, at, len, item_id): verified occurrences of item windows; ``at`` counts
    words from 0. ``docs`` needs doc_id and text."""
    grams = materialize(item_windows(items, window), "windows")
    # at most ``window`` different lengths
    lengths = sorted(r["len"] for r in grams.select("len").distinct().collect())
    one = rolling_hashes(grams, "gram", lengths)
    value = F.coalesce(*[F.when(F.col("len") == n, F.col(f"_h{n}")[0]) for n in lengths]) if lengths else F.lit(None).cast("bigint")
    one = materialize(one.select("item_id", "gram", "len", value.alias("h")), "hashes")
    probe = one.select("h", "len").distinct()
    if probe.count() <= MAX_BROADCAST_WINDOWS:
        probe = F.broadcast(probe)
    w = docs.select(*doc_key(), words_of(F.col("text")).alias("w"))
    hashed = rolling_hashes(w, "w", lengths)
    at = [F.transform(f"_h{n}", lambda h, i: F.struct(h.alias("h"), i.alias("at"), F.lit(n).alias("len"))) for n in lengths]
    none = F.array().cast("array<struct<h:bigint,at:int,len:int>>")
    if len(lengths) == 1:
        found = hashed.select("doc_id", "_th", F.posexplode_outer(f"_h{lengths[0]}").alias("at", "h"), F.lit(lengths[0]).alias("len"))
    else:
        found = hashed.select("doc_id", "_th", F.explode_outer(F.concat(none, *at)).alias("s")).select("doc_id", "_th", "s.*")
    found = materialize(found.join(probe, ["h", "len"], "left_semi"), "hits")
    # verify on the words of the documents that were hit
    spots = found.distinct().groupBy("doc_id", "_th").agg(F.collect_list(F.struct("h", "at", "len")).alias("spots"))
    same = F.col("d.doc_id").eqNullSafe(F.col("s.doc_id")) & (F.col("d._th") == F.col("s._th"))
    text = docs.select(*doc_key(), "text")
    text = text.alias("d").join(spots.alias("s"), same).select("d.doc_id", "d._th", "d.text", "s.spots")
    text = text.dropDuplicates(["doc_id", "_th"]).withColumn("w", words_of(F.col("text")))
    spot = let(F.col("w"), lambda w: F.transform("spots", lambda s: F.struct(
        s.h.alias("h"), s.at.alias("at"), s.len.alias("len"), F.slice(w, s.at + 1, s.len).alias("gram"))))
    spot = text.select("doc_id", "_th", F.explode_outer(spot).alias("s")).select("doc_id", "_th", "s.*")
    return spot.join(one, ["h", "len", "gram"]).select("doc_id", "_th", "at", "len", "item_id")


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per row of ``docs``: doc_id, _th, n_words, n_hit, n_items, items (sorted as
    strings), hit_words (positions of hit words, sorted) and contaminated."""
    hits = find_hits(docs, items, window)
    per = hits.groupBy("doc_id", "_th").agg(
        F.collect_set(F.struct("at", "len")).alias("at"), F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("items"),
        F.max(F.col("item_id").isNull().cast("int")).alias("nameless"))
    covered = F.array_sort(F.array_distinct(F.flatten(F.transform("at", lambda s: F.sequence(s.at, s.at + s.len - 1)))))
    per = per.select("doc_id", "_th", "items", "nameless", covered.alias("hit"))
    n_words = F.size(words_of(F.col("text"))).cast("bigint")
    all_docs = docs.select(*doc_key(), n_words.alias("n_words"))
    same = F.col("d.doc_id").eqNullSafe(F.col("p.doc_id")) & (F.col("d._th") == F.col("p._th"))
    out = all_docs.alias("d").join(per.alias("p"), same, "left").select(
        "d.doc_id", "d._th", "d.n_words", F.coalesce(F.size("p.hit"), F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce("p.items", F.array().cast("array<string>")).alias("items"), F.col("p.hit").alias("hit"), F.coalesce("p.nameless", F.lit(0)).alias("nameless"))
    return out.select(
        "doc_id", "_th", "n_words", "n_hit", (F.size("items") + F.col("nameless")).cast("bigint").alias("n_items"), "items",
        F.coalesce("hit", F.array().cast("array<int>")).alias("hit_words"),
        ((F.col("n_hit") > 0) & (100 * F.col("n_hit") >= MIN_PERCENT * F.col("n_words"))).alias("contaminated"))


def drop_contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, all columns kept."""
    bad = contamination(docs, items, window).filter("contaminated").select("doc_id", "_th").distinct()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    rows = rows.select("_row", F.col("_row.doc_id").alias("doc_id"), F.xxhash64("_row.text").alias("_th"))
    same = F.col("r.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("r._th") == F.col("b._th"))
    return rows.alias("r").join(bad.alias("b"), same, "left_anti").select("_row.*")


def remove_spans(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with the hit words cut out of each text instead: the pieces between them are
    kept as written. All columns are kept."""
    hit = contamination(docs, items, window).filter("n_hit > 0").select("doc_id", "_th", "hit_words").dropDuplicates(["doc_id", "_th"])
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    rows = rows.select("_row", F.col("_row.doc_id").alias("doc_id"), F.xxhash64("_row.text").alias("_th"))
    same = F.col("r.doc_id").eqNullSafe(F.col("h.doc_id")) & (F.col("r._th") == F.col("h._th"))
    both = rows.alias("r").join(hit.alias("h"), same, "left").select("_row", "hit_words")
    # gaps[i] precedes word i; one gap more than words
    word, gap = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", r"[\x00-\x2F\x3A-\x60\x7B-\x7F]*"
    both = both.withColumn("_w", F.regexp_extract_all("_row.text", F.lit(f"{gap}{word}"), F.lit(0)))
    tail = F.regexp_extract("_row.text", f"({gap})$", 1)
    kept = F.array_except(F.sequence(F.lit(0), F.size("_w") - 1), F.col("hit_words"))
    left = F.array_join(let(F.col("_w"), lambda w: F.transform(kept, lambda i: F.get(w, i))), "")
    text = F.when(F.col("hit_words").isNull(), F.col("_row.text")).otherwise(F.concat(left, tail))
    cols = [text.alias("text") if c == "text" else F.col(f"_row.`{c}`").alias(c) for c in docs.columns]
    return both.select(*cols)
