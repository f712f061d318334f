"""Quality rules by distribution divergence, DataFrame functions only.

Every document gets plain counts (words, symbols, repeated lines, repeated three-word windows)
and two histograms: its character classes and the common words of its declared language. The
reference of a language is the mean histogram of all documents that declare it, each document with
the same weight whatever its length (one grouped aggregate over the whole table, at most one row per
listed language plus one over everything).
A document is rejected when the Jensen-Shannon distance (base 2, 0 to 1) to its reference
exceeds a limit; short documents and thin references are not judged by distance.

Cases: null and empty texts have no words, fail the base rule and are not kept; an unknown or null
language is compared with the characters of all documents and not with any word list; repeated
rows are judged each; other columns are ignored (``filter_quality`` hands all of them on); an empty
table gives an empty result; very long texts are judged whole, as one row.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftline.llm.text import SPACE_SEP, computed, let, shifted, split_words

# Frequent function words of each language.
COMMON_WORDS = {
    "en": ["the", "of", "and", "to", "in", "is", "was", "for", "that", "with", "on", "at"],
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "ist", "für", "auf"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "est", "que", "qui"],
    "es": ["de", "la", "que", "el", "en", "y", "los", "se", "del", "un", "por", "con"],
}
# Character classes in the order they are taken out of the text; the rest is "other".
CLASSES = [("lower", r"[a-z]+"), ("space", SPACE_SEP), ("upper", r"[A-Z]+"), ("digit", r"[0-9]+"),
           ("stop", r"[.,;:!?'\"()\-]+"), ("symbol", r"[#*$%&|<>]+"), ("ascii", r"[\x00-\x7F]+")]
SYMBOLS = r"[^#*$%&|<>]+"
CODES = "abcdefghijkl"
EVERY = "*"  # the reference over all documents

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MIN_JUDGED_CHARS = 200
MIN_JUDGED_WORDS = 100
MIN_REFERENCE_DOCS = 20
SHARE = 10_000  # histograms are summed as whole numbers of this many parts
MAX_CHAR_DISTANCE = 0.30
MAX_WORD_DISTANCE = 0.30


def _codes(words: list[str]) -> Column:
    """The code letter of each of a document's words that is listed; longer words need no lookup."""
    table = F.create_map(*[x for w, c in zip(words, CODES, strict=True) for x in (F.lit(w), F.lit(c))])
    longest = max(map(len, words))
    return F.transform("_words", lambda w: F.when(F.length(w) <= longest, F.element_at(table, F.lower(w))))


def histograms(docs: DataFrame) -> DataFrame:
    """``docs`` with columns text, lang (and others) plus ``_words``, ``_lang`` (a listed language
    or EVERY), ``_chars`` and ``_common``: counts per character class and per common word, the
    last entry counting all other words."""
    lang = F.when(F.col("lang").isin(list(COMMON_WORDS)), F.col("lang")).otherwise(F.lit(EVERY))
    df = docs.withColumn("text", F.coalesce("text", F.lit(""))).withColumn("_lang", lang)
    df = df.withColumn("_words", split_words(F.col("text"), SPACE_SEP))
    # take the classes out one by one, each step on what the one before has left
    rest = "text"
    for i, (_, pattern) in enumerate(CLASSES):
        df = df.withColumn(f"_r{i}", F.regexp_replace(rest, pattern, ""))
        df = df.withColumn(f"_k{i}", F.length(rest) - F.length(f"_r{i}"))
        rest = f"_r{i}"
    counts = [F.col(f"_k{i}") for i in range(len(CLASSES))] + [F.length(rest)]
    df = df.withColumn("_chars", F.array(*counts))
    code = None
    for name, words in COMMON_WORDS.items():
        pick = _codes(words)
        code = F.when(F.col("_lang") == name, pick) if code is None else code.when(F.col("_lang") == name, pick)
    df = df.withColumn("_codes", F.coalesce(F.array_join(code, ""), F.lit("")))
    hits = [F.length("_codes") - F.length(F.regexp_replace("_codes", c, "")) for c in CODES]
    df = df.withColumn("_common", F.array(*hits, F.size("_words") - F.length("_codes")))
    return df.drop("_codes", *[f"_r{i}" for i in range(len(CLASSES))], *[f"_k{i}" for i in range(len(CLASSES))])


def references(hist: DataFrame) -> DataFrame:
    """(_lang, docs, ref_chars, ref_common): shares summed over the documents of a listed language
    and, as EVERY, over all documents. At most len(COMMON_WORDS) + 1 rows whatever the input."""
    n, k = len(CLASSES) + 1, len(CODES) + 1

    def share(name: str) -> Column:
        total = F.greatest(F.aggregate(name, F.lit(0), lambda s, x: s + x), F.lit(1))
        return let(total, lambda n: F.transform(name, lambda x: F.floor(x.cast("bigint") * SHARE / n)))

    hist = hist.select("_lang", share("_chars").alias("_chars"), share("_common").alias("_common"), (F.size("_words") > 0).alias("_any"))
    sums = ([F.sum(F.col("_chars")[i]).alias(f"c{i}") for i in range(n)] + [F.sum(F.col("_common")[i]).alias(f"w{i}") for i in range(k)])
    per = hist.groupBy("_lang").agg(F.count(F.when(F.col("_any"), 1)).alias("docs"), *sums)
    total = [F.sum(f"c{i}").alias(f"c{i}") for i in range(n)] + [F.lit(0).cast("bigint").alias(f"w{i}") for i in range(k)]
    both = per.filter(F.col("_lang") != EVERY).unionByName(per.agg(F.lit(EVERY).alias("_lang"), F.lit(0).cast("bigint").alias("docs"), *total))
    return both.select("_lang", "docs", F.array(*[f"c{i}" for i in range(n)]).alias("ref_chars"),
                       F.array(*[f"w{i}" for i in range(k)]).alias("ref_common"))


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two count arrays (base 2); null if one of them is all zero."""
    def total(a: Column) -> Column:
        return F.aggregate(a, F.lit(0.0), lambda s, x: s + x)

    def part(x: Column, m: Column) -> Column:
        return F.when(x > 0, x * F.log(x / m)).otherwise(F.lit(0.0))

    def shares(a: Column) -> Column:
        return let(F.nullif(total(a), F.lit(0.0)), lambda n: F.transform(a, lambda x: x / n))

    ps, qs = shares(p), shares(q)
    terms = F.zip_with(ps, qs, lambda a, b: part(a, (a + b) / 2) + part(b, (a + b) / 2))
    return F.sqrt(F.greatest(total(terms) / (2 * math.log(2)), F.lit(0.0)))


def _base_counts(df: DataFrame) -> DataFrame:
    """Plain counts from text and ``_words``."""
    words = F.col("_words")
    # windows by hash, sorted with their places; equal neighbours are compared word by word
    first = lambda a, k: F.slice(a, F.lit(1), F.greatest(F.size(words) - k, F.lit(0)))
    two = F.zip_with(first(words, 1), shifted(words, 1), lambda a, b: F.xxhash64(a, b))
    three = F.zip_with(first(two, 2), shifted(words, 2), lambda h, c: F.xxhash64(h, c))
    df = df.withColumn("_tri", F.sort_array(F.transform(three, lambda h, i: F.struct(h.alias("h"), i.alias("i")))))

    def same(a: Column, b: Column) -> Column:
        equal = [F.get(words, a.i + k) == F.get(words, b.i + k) for k in range(3)]
        return reduce(lambda x, y: x & y, equal, a.h == b.h)

    pairs = F.zip_with("_tri", shifted(F.col("_tri"), 1), lambda a, b: F.when(same(a, b), F.array(a.i, b.i)))
    found = F.flatten(F.filter(pairs, lambda x: x.isNotNull()))
    covered = F.array_distinct(F.flatten(F.transform(found, lambda i: F.array(i, i + 1, i + 2))))
    df = df.withColumn("_lines", F.filter(F.split("text", "\n"), lambda x: F.regexp_like(x, F.lit(r"[^\x20\x09-\x0D]"))))
    long = {
        "n_words": F.size(words),
        "word_chars": reduce(lambda a, b: a + b, [F.col("_chars")[i] for i in range(len(CLASSES) + 1)]) - F.col("_chars")[1],
        "n_symbols": F.length(F.regexp_replace("text", SYMBOLS, "")),
        "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")),
        "n_repeat_words": F.size(covered),
    }
    return df.withColumns({k: v.cast("bigint") for k, v in long.items()}).drop("_tri", "_lines")


def judge(docs: DataFrame) -> DataFrame:
    """``docs`` as one struct ``_row`` plus the counts, distances and verdict of each row."""
    src = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    src = src.withColumn("text", F.col("_row.text")).withColumn("lang", F.col("_row.lang"))
    refs = references(histograms(src.select("text", "lang")))
    every = refs.filter(F.col("_lang") == EVERY).select(F.col("_lang").alias("_every"), F.col("ref_chars").alias("all_chars"))
    df = _base_counts(histograms(src)).withColumn("_every", F.lit(EVERY))
    df = df.join(F.broadcast(refs), "_lang", "left").join(F.broadcast(every), "_every", "left")

    thin = F.coalesce(F.col("docs") < MIN_REFERENCE_DOCS, F.lit(True))
    df = df.withColumn("_ref", F.when(thin, F.col("all_chars")).otherwise(F.col("ref_chars")))
    df = df.withColumn("char_distance", F.when(F.col("word_chars") >= MIN_JUDGED_CHARS, js_distance(F.col("_chars"), F.col("_ref"))))
    df = df.withColumn("word_distance", F.when((F.col("n_words") >= MIN_JUDGED_WORDS) & ~thin,
                                               js_distance(F.col("_common"), F.col("ref_common"))))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    far = (F.coalesce(F.col("char_distance") > MAX_CHAR_DISTANCE, F.lit(False))
           | F.coalesce(F.col("word_distance") > MAX_WORD_DISTANCE, F.lit(False)))
    df = df.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & ~far)
    out = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "char_distance", "word_distance"]
    return computed(df.select("_row", *out), *out)


def filter_quality(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass, all columns kept."""
    return judge(docs).filter("kept").select("_row.*")
