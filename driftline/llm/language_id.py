"""Language identification of web pages by Bayesian evidence fusion.

Three kinds of evidence are combined per page:

* *Text.* Naive Bayes over hashed letter trigrams. The trigram counts per language come from all
  texts of the training table (grouped aggregate over all its languages; more than MAX_LANGUAGES are refused). Trigrams
  overlap, so the log likelihood of a page is tempered to at most EFFECTIVE_GRAMS of them.
* *Declared markup language.* The ``lang`` attribute of the page, through the counted table of
  declared against text languages, smoothed.
* *Address.* Languages of the other pages of the host, shrunk towards its registered domain, the
  domain's towards the address suffix and the suffix's towards all pages. Counts come from
  grouped aggregates of the text votes; a page's own vote is left out of its prior.

Cases: null or empty html has no text and no vote; null urls share the empty host; an unknown or
absent declaration is one common value; ties go to the language first by name; repeated rows are
judged each; rows of the training table without a language or text teach nothing; without any training language
the result has null languages; other columns are ignored; empty tables give empty results.
"""

from __future__ import annotations

import html as markup
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftline.llm.hosts import host_levels
from driftline.llm.text import text_chunks
from driftline.session import materialize

MAX_LANGUAGES = 512  # more raise an error; none is ever left out
BUCKETS = 4096
EFFECTIVE_GRAMS = 60
PRIOR = 5.0  # strength of the level above, in pages
DECLARED_PRIOR = 2.0

_LETTER = np.full(256, 0x20, np.uint8)
_LETTER[0x61:0x7B] = np.arange(0x61, 0x7B)
_LETTER[0x41:0x5B] = np.arange(0x61, 0x7B)
_LETTER[0x80:] = np.arange(0x80, 0x100)


def trigrams(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, text) of every letter trigram of some texts; runs of other characters are one blank."""
    x = _LETTER[data]
    owner = np.repeat(np.arange(len(off) - 1), np.diff(off))
    keep = np.ones(len(x), bool)
    keep[1:] = (x[1:] != 0x20) | (x[:-1] != 0x20) | (owner[1:] != owner[:-1])
    x, owner = x[keep].astype(np.uint32), owner[keep]
    if len(x) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    same = owner[2:] == owner[:-2]
    h = (x[:-2] << np.uint32(16) | x[1:-1] << np.uint32(8) | x[2:]) * np.uint32(2654435761)
    return (h >> np.uint32(20)).astype(np.int64)[same], owner[2:][same]


def _counts(languages: list[str]):
    index = {name: i for i, name in enumerate(languages)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(languages), BUCKETS), np.int64)
        for b in batches:
            which = np.array([index[v] for v in b.column("lang").to_pylist()], np.int64)
            for lo, hi, data, off in text_chunks(b.column("text")):
                gram, text = trigrams(data, off)
                total += np.bincount(which[lo:hi][text] * BUCKETS + gram, minlength=total.size).reshape(total.shape)
        lang, bucket = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(lang.astype(np.int32)), pa.array(bucket.astype(np.int32)), pa.array(total[lang, bucket])],
                                         names=["language", "bucket", "n"])
    return run


def train_text_model(docs: DataFrame, max_languages: int = MAX_LANGUAGES) -> tuple[list[str], np.ndarray]:
    """(languages, log probability per language and bucket) from all rows of ``docs`` (lang, text)."""
    known = docs.select("lang", "text").filter("lang IS NOT NULL AND text IS NOT NULL")
    found = known.select("lang").distinct().limit(max_languages + 1).collect()
    if len(found) > max_languages:
        raise ValueError(f"the training table has more than {max_languages} languages")
    languages = sorted(r["lang"] for r in found)
    table = np.zeros((len(languages), BUCKETS))
    if languages:
        cells = known.mapInArrow(_counts(languages), "language int, bucket int, n bigint")
        for r in cells.groupBy("language", "bucket").agg(F.sum("n").alias("n")).collect():  # at most languages x BUCKETS
            table[r["language"], r["bucket"]] = r["n"]
    table += 0.5
    return languages, np.log(table / table.sum(1, keepdims=True))


_DROP = re.compile(r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>")
_DECLARED = re.compile(r"(?is)<html\b[^>]*?\slang\s*=\s*[\"']?([a-z]+)")


def visible_text(page: str | None) -> str:
    return markup.unescape(_DROP.sub(" ", page or ""))


def declared_language(page: str | None) -> str | None:
    found = _DECLARED.search(page or "")
    return found[1].lower() if found else None


def _text_scores(languages: list[str], model: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            pages = b.column("html").to_pylist()
            texts = pa.array([visible_text(p) for p in pages], pa.large_string())
            score, n = np.zeros((len(pages), len(languages))), np.zeros(len(pages), np.int64)
            for lo, hi, data, off in text_chunks(texts):
                gram, text = trigrams(data, off)
                n[lo:hi] = np.bincount(text, minlength=hi - lo)
                for i in range(len(languages)):
                    score[lo:hi, i] = np.bincount(text, model[i][gram], hi - lo)
            score *= (np.minimum(n, EFFECTIVE_GRAMS) / np.maximum(n, 1))[:, None]
            vote = np.where(n > 0, score.argmax(1) if languages else 0, -1).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [b.column("page_id"), b.column("url"), pa.array([declared_language(p) for p in pages], pa.string()), pa.array(n),
                 pa.array(list(score), pa.list_(pa.float64())), pa.array(vote)], names=["page_id", "url", "declared", "n_grams", "score", "vote"])
    return run


def _votes(size: int) -> Column:
    return F.array(*[F.count(F.when(F.col("vote") == i, 1)) for i in range(size)])


def _sum_votes(name: str, size: int) -> Column:
    return F.array(*[F.sum(F.col(name)[i]) for i in range(size)])


def _shrunk(counts: Column, prior: Column, strength: float) -> Column:
    """Shares of a count array, pulled towards a prior distribution."""
    total = F.aggregate(counts, F.lit(0.0), lambda s, x: s + x)
    return F.zip_with(counts, prior, lambda c, p: (c + strength * p) / (total + strength))


def identify(pages: DataFrame, docs: DataFrame) -> DataFrame:
    """One row per row of ``pages`` (page_id, url, html); ``docs`` (lang, text) teaches the text
    model. Returns page_id, host, declared, n_grams, text_language, language, posterior."""
    languages, model = train_text_model(docs)
    size = len(languages)
    scored = pages.select("page_id", "url", "html").mapInArrow(
        _text_scores(languages, model), "page_id bigint, url string, declared string, n_grams bigint, score array<double>, vote int")
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), "://([^/?#]*)", 1))
    scored = scored.withColumn("host", host)
    domain, suffix = host_levels(F.col("host"))
    scored = scored.withColumns({"domain": domain, "suffix": suffix})
    scored = scored.withColumn("known", F.when(F.col("declared").isin(languages), F.col("declared")).otherwise(F.lit("")))
    scored = materialize(scored.drop("url"), "page-scores")
    names = F.array(*[F.lit(x) for x in languages]).cast("array<string>")
    if size == 0:
        none = F.lit(None).cast("string")
        return scored.select("page_id", "host", "declared", "n_grams", none.alias("text_language"), none.alias("language"),
                             F.lit(None).cast("double").alias("posterior"))

    # counts per level, each summed from the one below
    hosts = scored.groupBy("host", "domain", "suffix").agg(_votes(size).alias("ch"))
    domains = hosts.groupBy("domain", "suffix").agg(_sum_votes("ch", size).alias("cd"))
    suffixes = domains.groupBy("suffix").agg(_sum_votes("cd", size).alias("cs"))
    levels = hosts.join(domains.drop("suffix"), "domain").join(suffixes, "suffix").select("host", "ch", "cd", "cs")
    # one row per listed language and one for the rest
    said = scored.groupBy("known").agg(_votes(size).alias("cw"))
    every = said.agg(_sum_votes("cw", size).alias("call")).select(F.lit(1).alias("_one"), "call")
    said = said.withColumn("_one", F.lit(1)).join(every, "_one").drop("_one")
    df = scored.join(levels, "host").join(F.broadcast(said), "known")

    uniform = F.array(*[F.lit(1.0 / size)] * size)
    own = F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: (i == F.col("vote")).cast("int"))
    df = df.withColumn("own", own)
    less = lambda c: F.zip_with(c, "own", lambda a, o: a - o)
    df = df.withColumns({c: less(c) for c in ("ch", "cd", "cs", "cw", "call")})
    df = df.withColumn("p0", _shrunk(F.col("call"), uniform, 1.0))
    df = df.withColumn("ps", _shrunk(F.col("cs"), F.col("p0"), PRIOR))
    df = df.withColumn("pd", _shrunk(F.col("cd"), F.col("ps"), PRIOR))
    df = df.withColumn("ph", _shrunk(F.col("ch"), F.col("pd"), PRIOR))
    # P(declared | language) up to a factor: P(language | declared) / P(language)
    df = df.withColumn("pw", F.zip_with(_shrunk(F.col("cw"), F.col("p0"), DECLARED_PRIOR), "p0", lambda a, b: a / b))
    logs = F.zip_with(F.zip_with("score", "ph", lambda s, p: s + F.log(p)), "pw", lambda s, w: s + F.log(w))
    df = df.withColumn("logs", logs).withColumn("top", F.array_max("logs"))
    odds = F.aggregate(F.transform("logs", lambda x: F.exp(x - F.col("top"))), F.lit(0.0), lambda s, x: s + x)
    best = F.get(names, (F.array_position("logs", F.col("top")) - 1).cast("int"))
    text = F.when(F.col("vote") >= 0, F.get(names, F.col("vote")))
    return df.select("page_id", "host", "declared", "n_grams", text.alias("text_language"), best.alias("language"), (1 / odds).alias("posterior"))
