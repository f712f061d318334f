"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics of every whole text are computed once, vectorised over Arrow batches, and written as a
narrow table. Trees are fitted on a bounded, hash-ordered sample of the labelled training rows
(MAX_TRAIN_ROWS, the only part that is not over all data): features are cut into BINS quantile bins,
every level of a tree is grown from gradient histograms. The trees are flattened into arrays
(feature, threshold, value; the children of node i are 2i + 1 and 2i + 2), and scoring walks all trees
for a whole batch with numpy.

Inputs of a score are statistics of the text only. Cases: null and empty texts have all-zero
statistics and are scored like any other; rows with equal texts get equal scores; a null doc_id is not held
out and never labelled; labels that are null or belong to no document are not used; without labels,
or with one label only, every score is the smoothed share of label 1; extra columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftline.llm.text import text_chunks, word_hashes
from driftline.session import materialize

MAX_TRAIN_ROWS = 30_000
BINS = 64
TREES = 120
DEPTH = 4
RATE = 0.1
MIN_LEAF_WEIGHT = 3.0
RIDGE = 1.0
PREDICT_FROM = 0.3
FOLDS = 5

# Frequent short words of English, German, French and Spanish.
COMMON = ("the of and to in is was for that with on at der die und den von zu das mit ist für auf "
          "de la le et les des en un du est que qui el y los se del por con").split()
FEATURES = ["log_words", "log_bytes", "word_length", "longest_word", "upper", "digit", "symbol", "stop", "shout", "high", "space",
            "lines_per_word", "repeated_lines", "distinct_words", "common", "top_word", "repeated_pairs", "short_words"]

_CLASS = {name: np.zeros(256, bool) for name in ("upper", "digit", "symbol", "stop", "shout", "high", "space")}
_CLASS["upper"][0x41:0x5B] = True
_CLASS["digit"][0x30:0x3A] = True
_CLASS["symbol"][list(b"#*$%&|<>@^~_=+{}[]\\/")] = True
_CLASS["stop"][list(b".,;:")] = True
_CLASS["shout"][list(b"!?")] = True
_CLASS["high"][0x80:] = True
_CLASS["space"][list(b" \t\n\x0b\x0c\r")] = True


def _common_hashes() -> np.ndarray:
    data = np.frombuffer(" ".join(COMMON).encode(), np.uint8)
    return np.unique(word_hashes(data, np.array([0, len(data)]))[0])


def _most(h: np.ndarray) -> tuple[int, int]:
    """(distinct values, count of the most frequent one)."""
    if len(h) == 0:
        return 0, 0
    s = np.sort(h)
    edge = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1], [True]]))
    return len(edge) - 1, int(np.diff(edge).max())


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of FEATURES per text."""
    out, listed = [], _common_hashes()
    for lo, hi, data, off in text_chunks(texts):
        n, size = hi - lo, np.diff(off)
        x = np.zeros((n, len(FEATURES)))
        h, first = word_hashes(data, off)
        words = np.diff(first)

        def per_text(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
            return np.diff(np.concatenate([[0], np.cumsum(flags)])[at])

        some, any_bytes = np.maximum(words, 1), np.maximum(size, 1)
        space = per_text(_CLASS["space"][data], off)
        x[:, 0], x[:, 1] = np.log1p(words), np.log1p(size)
        x[:, 2] = (size - space) / some
        for j, name in enumerate(("upper", "digit", "symbol", "stop", "shout", "high"), 4):
            x[:, j] = per_text(_CLASS[name][data], off) / any_bytes
        x[:, 10] = space / any_bytes
        breaks = per_text(data == 0x0A, off)
        x[:, 11] = breaks / some
        x[:, 14] = per_text(np.isin(h, listed), first) / some
        inside = ~_CLASS["space"][data]
        raw = data.tobytes()
        for i in range(n):
            a, b = first[i], first[i + 1]
            if a == b:
                continue
            text = raw[off[i]:off[i + 1]]
            lengths = np.diff(np.flatnonzero(np.concatenate([[True], ~inside[off[i]:off[i + 1]], [True]]))) - 1
            lengths = lengths[lengths > 0]
            x[i, 3], x[i, 17] = lengths.max(), (lengths <= 3).mean()
            lines = [s for s in text.split(b"\n") if s.strip()]
            x[i, 12] = 1 - len(set(lines)) / len(lines)
            w = h[a:b]
            distinct, top = _most(w)
            x[i, 13], x[i, 15] = distinct / len(w), top / len(w)
            if len(w) > 1:
                pairs = w[:-1] * np.uint64(0x9E3779B97F4A7C15) + w[1:]
                x[i, 16] = 1 - _most(pairs)[0] / len(pairs)
        out.append(x)
    return np.concatenate(out) if out else np.zeros((0, len(FEATURES)))


# ---------------------------------------------------------------- trees

@dataclass
class Trees:
    """Flattened complete trees: one row per tree, 2^(DEPTH+1) - 1 nodes."""
    base: float
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        total, rows = np.full(len(x), self.base), np.arange(len(x))
        depth = (self.feature.shape[1] + 1).bit_length() - 2
        for f, t, v in zip(self.feature, self.threshold, self.value, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, f[node]] > t[node])
            total += v[node]
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray) -> Trees:
    """Boost logistic trees on binned features."""
    n, width = x.shape
    share = (y.sum() + 0.5) / (n + 1)
    nodes = 2 ** (DEPTH + 1) - 1
    base = float(np.log(share / (1 - share)))
    if n == 0 or y.min() == y.max():
        return Trees(base, np.zeros((0, nodes), np.int64), np.zeros((0, nodes)), np.zeros((0, nodes)))
    edges = [np.unique(np.quantile(x[:, j], np.arange(1, BINS) / BINS)) for j in range(width)]
    binned = np.stack([np.searchsorted(e, x[:, j]) for j, e in enumerate(edges)], 1)
    total = np.full(n, base)
    feature, threshold, value = [], [], []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-total))
        g, w = y - p, np.maximum(p * (1 - p), 1e-9)
        f, t, v = np.zeros(nodes, np.int64), np.full(nodes, np.inf), np.zeros(nodes)
        node = np.zeros(n, np.int64)
        for level in range(DEPTH + 1):
            first, count = 2 ** level - 1, 2 ** level
            at = node - first
            sg, sw = np.bincount(at, g, count), np.bincount(at, w, count)
            v[first:first + count] = RATE * sg / (sw + RIDGE)
            if level == DEPTH:
                break
            best = np.zeros(count)
            for j in range(width):
                key = at * BINS + binned[:, j]
                hg = np.bincount(key, g, count * BINS).reshape(count, BINS).cumsum(1)[:, :-1]
                hw = np.bincount(key, w, count * BINS).reshape(count, BINS).cumsum(1)[:, :-1]
                rg, rw = sg[:, None] - hg, sw[:, None] - hw
                gain = hg ** 2 / (hw + RIDGE) + rg ** 2 / (rw + RIDGE) - (sg ** 2 / (sw + RIDGE))[:, None]
                gain[(hw < MIN_LEAF_WEIGHT) | (rw < MIN_LEAF_WEIGHT)] = 0
                gain[:, len(edges[j]):] = 0
                cut = gain.argmax(1)
                better = gain[np.arange(count), cut] > best + 1e-9
                best[better] = gain[np.arange(count), cut][better]
                f[first:first + count][better] = j
                t[first:first + count][better] = edges[j][cut[better]]
            node = 2 * node + 1 + (x[np.arange(n), f[node]] > t[node])
        total += v[node]
        feature.append(f)
        threshold.append(t)
        value.append(v)
    return Trees(base, np.array(feature), np.array(threshold), np.array(value))


# ---------------------------------------------------------------- Spark

def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        x = statistics(b.column("text"))
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(x[:, j]) for j in range(x.shape[1]))], names=["doc_id", *FEATURES])


def document_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and FEATURES of every row of ``docs`` (needs doc_id, text)."""
    schema = "doc_id bigint, " + ", ".join(f"{f} double" for f in FEATURES)
    return docs.select(F.col("doc_id").cast("bigint"), F.col("text")).mapInArrow(_statistics, schema)


def train(stats: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAIN_ROWS) -> Trees:
    """Fit on at most ``max_rows`` labelled rows outside the held-out fold, the first in hash order. Of
    several labels of an id the smallest counts, of several texts the one with the smallest
    statistics, so the fit does not depend on how rows are dealt to partitions."""
    known = labels.select("doc_id", F.col("quality").alias("_label")).filter("_label IN (0, 1) AND doc_id IS NOT NULL")
    known = known.groupBy("doc_id").agg(F.min("_label").alias("_label"))
    known = known.filter(~held_out(F.col("doc_id"))).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    rows = stats.join(F.broadcast(known), "doc_id").groupBy("doc_id").agg(F.min(F.struct("_label", *FEATURES)).alias("r"))
    rows = rows.select("doc_id", "r.*").toPandas()
    rows = rows.sort_values("doc_id")
    return fit(rows[FEATURES].to_numpy(float), rows["_label"].to_numpy(float))


def score_quality(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAIN_ROWS) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted."""
    stats = materialize(document_statistics(docs), "statistics")
    trees = train(stats, labels, max_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.stack([b.column(f).to_numpy(zero_copy_only=False) for f in FEATURES], 1)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(trees.score(x))], names=["doc_id", "score"])

    out = stats.mapInArrow(run, "doc_id bigint, score double")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= PREDICT_FROM).cast("int").alias("predicted"))
