"""Line dedup by winnowing over line hashes.

A text is cut into lines: at line breaks and, since many texts are one long line, after sentence
ends. Lines are compared by their words (runs of anything but ASCII white space); a line without
words belongs to the one before it. A *window* is a shortest run of consecutive lines with at least
MIN_WORDS words, taken from every line forwards and from every line backwards.

* *Fingerprints.* Of each window the smallest line hash is its fingerprint. Windows whose fingerprint
  occurs at one place only are left out early; this changes no result.
* *Windows.* All windows are written with 128-bit hashes of their lines, and repeats are found by
  grouping these. No positions are joined and no match is extended; overlapping windows chain up to
  the whole run.
* *Deletion.* The first occurrence of a window, by (doc_id, text hash, line), stays. Lines covered by
  any later one go.

So a line goes if and only if it lies in a run of whole lines of at least MIN_WORDS words that occurs
earlier. ``passage_dedup`` finds runs that start or end inside a line as well.

Cases: null and wordless texts have no lines and stay as they are; a null doc_id orders last; rows
that repeat doc_id and text are the same document, get the same text and do not delete each other
(different ids with equal texts do); a run that overlaps its own earlier occurrence is deleted
from its second start on; other columns are kept; an empty table gives an empty result; long texts are
processed whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from driftline.llm.text import SPACE_BYTES, _powers, doc_key, mix, text_chunks, word_hashes
from driftline.session import materialize

MIN_WORDS = 50


class Lines:
    """Lines of some texts: ``first`` (index of each text's first line, one entry more),
    ``start`` (byte where a line starts, one entry more), ``words`` (before each line, one
    entry more) and two 64-bit hashes of each line."""

    def __init__(self, data: np.ndarray, off: np.ndarray):
        h, first_word = word_hashes(data, off, lower=False)
        n = len(data)
        cut = np.zeros(n + 2, bool)
        cut[1:n + 1] |= data == 0x0A
        stop = (data == 0x2E) | (data == 0x21) | (data == 0x3F)
        cut[2:n + 1] |= stop[:-1] & (data[1:] == 0x20)
        cut[off] = True
        cut[n] = True
        edge = np.flatnonzero(cut[:n + 1])
        # words before each edge; a piece without words joins the one before it
        inside = SPACE_BYTES[data]
        begin = inside.copy()
        begin[1:] &= ~inside[:-1]
        glued = off[1:-1]
        glued = glued[(glued > 0) & (glued < n)]
        begin[glued] |= inside[glued]
        before = np.concatenate([[0], np.cumsum(begin)])
        count = before[edge]
        keep = np.append(np.diff(count) > 0, False)
        self.start, self.words = edge[keep], count[keep]
        self.first = np.searchsorted(self.words, first_word)
        self.words = np.append(self.words, len(h))
        pw, inv = _powers(len(h) + 1)
        for name, seed in (("a", 0x51ED270B), ("b", 0x2C1B3C6D)):
            p = np.zeros(len(h) + 1, np.uint64)
            np.cumsum(mix(h ^ np.uint64(seed)) * pw[:len(h)], out=p[1:])
            value = (p[self.words[1:]] - p[self.words[:-1]]) * inv[self.words[:-1]]
            setattr(self, name, mix(value ^ np.diff(self.words).astype(np.uint64)))
        self.owner = np.repeat(np.arange(len(off) - 1), np.diff(self.first))

    def windows(self, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(lo, hi, at): lines [lo, hi) of each distinct window, and its fingerprint's line."""
        w, n = self.words, len(self.a)
        lines = np.arange(n)
        end = np.searchsorted(w, w[:-1] + least)  # forwards
        ok = end <= self.first[self.owner + 1] if n else np.zeros(0, bool)
        begin = np.searchsorted(w, w[1:] - least, "right") - 1  # backwards
        ok2 = (begin >= self.first[self.owner]) & (w[1:] - least >= 0) if n else ok
        lo, hi = np.concatenate([lines[ok], begin[ok2]]), np.concatenate([end[ok], lines[ok2] + 1])
        lo, hi = np.unique(np.stack([lo, hi]), axis=1) if len(lo) else (lo, hi)
        at = lo.copy()
        if len(lo):  # smallest hash per window, by a table of minima over powers of two
            level, span, rank = [lines], 1, np.argsort(np.argsort(self.a, kind="stable"), kind="stable")
            while span < (hi - lo).max():
                a = level[-1]
                b = np.concatenate([a[span:], np.full(min(span, n), a[-1])])[:n]
                level.append(np.where(rank[b] < rank[a], b, a))
                span *= 2
            k = np.log2(hi - lo).astype(np.int64)
            for j in np.unique(k):
                m = k == j
                x, y = level[j][lo[m]], level[j][hi[m] - (1 << j)]
                at[m] = np.where(rank[y] < rank[x], y, x)
        return lo, hi, at

    def window_hashes(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        pw, inv = _powers(len(self.a) + 1)
        out = []
        for h in (self.a, self.b):
            p = np.zeros(len(h) + 1, np.uint64)
            np.cumsum(h * pw[:len(h)], out=p[1:])
            out.append(mix((p[hi] - p[lo]) * inv[lo] ^ (hi - lo).astype(np.uint64)).view(np.int64))
        return out[0], out[1]


def _take(b: pa.RecordBatch, lo: int, rows: np.ndarray) -> list[pa.Array]:
    return [b.column(c).take(pa.array(rows + lo)) for c in ("doc_id", "_th")]


def _windows(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, _, data, off in text_chunks(b.column("text")):
                x = Lines(data, off)
                s, e, at = x.windows(least)
                if len(s):
                    owner = x.owner[s]
                    h1, h2 = x.window_hashes(s, e)
                    base = x.first[owner]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x.a[at].view(np.int64)), pa.array(h1), pa.array(h2), *_take(b, lo, owner),
                         *(pa.array((v - base).astype(np.int32)) for v in (at, s, e))],
                        names=["print", "h1", "h2", "doc_id", "_th", "at", "lo", "hi"])
    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hand rows on with the text that is left where lines are deleted, null elsewhere."""
    for b in batches:
        runs = b.column("runs")
        texts, gone, lost = [None] * b.num_rows, np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows, np.int64)
        hit = np.flatnonzero(runs.is_valid().to_numpy(zero_copy_only=False))
        for lo, hi, data, off in text_chunks(b.column("_row").field("text").take(pa.array(hit))) if len(hit) else ():
            x = Lines(data, off)
            for i, row in enumerate(hit[lo:hi].tolist()):
                f, l = int(x.first[i]), int(x.first[i + 1])
                drop = np.zeros(l - f, bool)
                for r in runs[row].as_py():
                    drop[r["lo"]:r["hi"]] = True
                edges = np.append(x.start[f:l], off[i + 1])
                if l > f:
                    edges[0] = off[i]
                texts[row] = b"".join(data[edges[k]:edges[k + 1]].tobytes() for k in np.flatnonzero(~drop)).decode("utf-8", "replace")
                gone[row], lost[row] = drop.sum(), np.diff(x.words[f:l + 1])[drop].sum()
        yield pa.RecordBatch.from_arrays([b.column("_row"), pa.array(texts, pa.string()), pa.array(gone), pa.array(lost)],
                                         names=["_row", "left", "lines_deleted", "words_deleted"])


def _same(a: str, b: str):
    return F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")) & (F.col(f"{a}._th") == F.col(f"{b}._th"))


def repeated_runs(docs: DataFrame, least: int = MIN_WORDS) -> DataFrame:
    """(doc_id, _th, lo, hi): lines [lo, hi) of the windows that occur earlier."""
    schema = "print bigint, h1 bigint, h2 bigint, doc_id bigint, _th bigint, at int, lo int, hi int"
    windows = materialize(docs.select(*doc_key(), "text").mapInArrow(_windows(least), schema), "windows")
    spot = F.xxhash64("doc_id", "_th", "at")
    again = windows.groupBy("print").agg(F.min(spot).alias("a"), F.max(spot).alias("b")).filter("a <> b").select("print")
    found = materialize(windows.join(again, "print", "left_semi").select("h1", "h2", "doc_id", "_th", "lo", "hi"), "candidates")
    place = F.struct(F.col("doc_id").isNull().alias("last"), F.coalesce("doc_id", F.lit(0).cast("bigint")).alias("id"), "_th", "lo")
    first = found.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.max(place).alias("final")).filter("first < final")
    late = found.join(first.select("h1", "h2", "first"), ["h1", "h2"]).filter(place > F.col("first"))
    return late.select("doc_id", "_th", "lo", "hi").distinct()


def dedup_lines(docs: DataFrame, least: int = MIN_WORDS) -> DataFrame:
    """``docs`` as one struct ``_row`` with new_text, lines_deleted and words_deleted."""
    runs = repeated_runs(docs, least).groupBy("doc_id", "_th").agg(F.collect_list(F.struct("lo", "hi")).alias("runs"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    rows = rows.select("_row", F.col("_row.doc_id").alias("doc_id"), F.xxhash64("_row.text").alias("_th"))
    both = rows.alias("d").join(runs.alias("r"), _same("d", "r"), "left").select("_row", "runs")
    schema = StructType([both.schema["_row"], StructField("left", StringType()), StructField("lines_deleted", LongType()),
                         StructField("words_deleted", LongType())])
    out = both.mapInArrow(_cut, schema)
    text = F.when(F.col("lines_deleted") > 0, F.col("left")).otherwise(F.col("_row.text"))
    return out.select("_row", text.alias("new_text"), "lines_deleted", "words_deleted")


def without_repeats(docs: DataFrame, least: int = MIN_WORDS) -> DataFrame:
    """The rows of ``docs`` with repeated runs cut from their text (``n_chars``, where present,
    follows). A row goes when nothing with a word is left of a text that had one. All columns
    are kept."""
    out = dedup_lines(docs, least)
    changed, left = F.col("lines_deleted") > 0, F.regexp_like("new_text", F.lit(r"[^\x20\x09-\x0D]"))
    cols = []
    for c in docs.columns:
        old = F.col(f"_row.`{c}`")
        if c == "text":
            old = F.col("new_text")
        elif c == "n_chars":
            old = F.when(changed, F.length("new_text").cast(docs.schema[c].dataType)).otherwise(old)
        cols.append(old.alias(c))
    return out.filter(~changed | left).select(*cols)
