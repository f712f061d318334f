"""Passage dedup by winnowing over words: repeated runs of words, wherever in a line they start or end.

Texts are compared by their words (runs of anything but ASCII white space). A word goes if and only
if it lies in a run of at least MIN_WORDS words that occurs earlier in the corpus. Line breaks and
sentence ends play no part, so a passage pasted into the middle of a line is found and cut whole.

* *Fingerprints.* Of each window of MIN_WORDS words the smallest hash of its stretches of half that
  length is selected (the first of equal ones): about one position in a quarter of MIN_WORDS words.
  Equal windows select equal fingerprints, so no repeated window is missed.
* *Neighbourhoods.* The windows that select a position follow each other; the words from the first
  window's start to the last one's end are the position's neighbourhood. Each position is one row with
  the fingerprint and a 128-bit hash of the neighbourhood, which says where in it the position lies.
* *Extension.* Where a neighbourhood occurs earlier, all of it goes. Only where one fingerprint has
  different neighbourhoods, one of each kind is spelt out into its windows, and 128-bit hashes of
  these decide how far a match reaches. Overlapping windows chain up to the whole passage.
* *Deletion.* The first occurrence, by (doc_id, text hash, word), stays; later ones are cut word for word.

What occurs earlier is told by rank, over narrow rows sorted by hash and place; no pairs of positions are
made. Hashes with more rows than half a task's share (estimated from a sample of the rows, which only decides
how they are dealt out) are ranked in parts, then the firsts of the parts, so a passage in a third of
all documents is spread over the tasks.

Cases: null and wordless texts stay as they are; a null doc_id orders last; rows that repeat doc_id
and text are the same document, get the same text and do not delete each other (different ids with
equal texts do); a run that overlaps its own earlier occurrence is deleted from its second start on;
other columns are kept; an empty table gives an empty result; long texts are processed whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from driftline.llm.line_dedup import MIN_WORDS, Lines
from driftline.llm.text import SPACE_BYTES, _powers, doc_key, mix, text_chunks, word_hashes
from driftline.session import materialize, scratch, work_dir

_SEEDS = (0x51ED270B, 0x2C1B3C6D)
SAMPLE = 1 / 64  # rows counted to find the frequent hashes
FREQUENT = 32  # rows of the sample that a frequent hash has at least


def _prefix(h: np.ndarray, seed: int) -> np.ndarray:
    p = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(mix(h ^ np.uint64(seed)) * _powers(len(h) + 1)[0][:len(h)], out=p[1:])
    return p


def _span_hash(p: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Hash of words [lo, hi) from the prefix sums of their hashes."""
    return mix((p[hi] - p[lo]) * _powers(len(p))[1][lo] ^ (hi - lo).astype(np.uint64))


def fingerprints(h: np.ndarray, first: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(print, at, lo, hi) of every selected position ``at``: windows [lo, lo + least) to
    [hi - least, hi) select it. Words of text i are [first[i], first[i + 1])."""
    k = (least + 1) // 2
    span = least - k + 1  # stretches per window
    n = len(h)
    if n < least:
        return np.zeros(0, np.uint64), *(np.zeros(0, np.int64) for _ in range(3))
    start = np.arange(n - k + 1)
    g = _span_hash(_prefix(h, 0x7F4A7C15), start, start + k)
    # first smallest stretch of each window, by a table of minima over powers of two
    best, reach = start, 1
    while 2 * reach <= span:
        a, b = best[:len(best) - reach], best[reach:]
        best, reach = np.where(g[b] < g[a], b, a), 2 * reach
    a, b = best[:n - least + 1], best[span - reach:][:n - least + 1]
    best = np.where(g[b] < g[a], b, a)
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    window = np.flatnonzero(owner[:n - least + 1] == owner[least - 1:])
    at = best[window]
    new = np.ones(len(at), bool)  # windows of one position follow each other
    new[1:] = at[1:] != at[:-1]
    head = np.flatnonzero(new)
    last = np.append(head[1:], len(at)) - 1 if len(at) else head
    return g[at[head]], at[head], window[head], window[last] + least


def _positions(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row, _, data, off in text_chunks(b.column("text")):
                h, first = word_hashes(data, off, lower=False)
                mark, at, lo, hi = fingerprints(h, first, least)
                if len(at):
                    owner = np.searchsorted(first, at, "right") - 1
                    where = mix((at - lo).astype(np.uint64))
                    c = [(_span_hash(_prefix(h, s), lo, hi) ^ where).view(np.int64) for s in _SEEDS]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(mark.view(np.int64)), *map(pa.array, c), *(b.column(x).take(pa.array(owner + row)) for x in ("doc_id", "_th")),
                         *(pa.array((v - first[owner]).astype(np.int32)) for v in (lo, hi))],
                        names=["print", "c1", "c2", "doc_id", "_th", "lo", "hi"])
    return run


def _new(t: pa.RecordBatch | pa.Table, *more: str) -> np.ndarray:
    """Rows whose document (or a further column) is not that of the row before."""
    new = np.zeros(t.num_rows, bool)
    new[:1] = True
    for v in (t["doc_id"].is_null(), t["doc_id"].fill_null(0), *(t[c] for c in ("_th", *more))):
        v = np.asarray(v)
        new[1:] |= v[1:] != v[:-1]
    return new


def _spelt(least: int):
    """Windows of the neighbourhoods in ``spots`` (lo, hi)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            b = b.filter(pa.array(_new(b)))  # repeated rows of a document
            for row, end, data, off in text_chunks(b.column("text")):
                h, first = word_hashes(data, off, lower=False)
                p = [_prefix(h, s) for s in _SEEDS]
                spots = b.column("spots").slice(row, end - row)
                flat = spots.flatten()
                owner = np.repeat(np.arange(end - row), spots.value_lengths().to_numpy())
                lo, hi = (flat.field(c).to_numpy().astype(np.int64) for c in ("lo", "hi"))
                count = hi - lo - least + 1
                spot = np.repeat(np.arange(len(lo)), count)
                step = np.arange(len(spot)) - np.repeat(np.cumsum(count) - count, count)
                at = lo[spot] + step + first[owner[spot]]
                for s in range(0, len(spot), 1 << 16):
                    cut = slice(s, s + (1 << 16))
                    yield pa.RecordBatch.from_arrays(
                        [*(pa.array(_span_hash(x, at[cut], at[cut] + least).view(np.int64)) for x in p),
                         *(b.column(x).take(pa.array(owner[spot[cut]] + row)) for x in ("doc_id", "_th")),
                         pa.array((lo[spot[cut]] + step[cut]).astype(np.int32))],
                        names=["h1", "h2", "doc_id", "_th", "lo"])
    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hand rows on with the text that is left where words are deleted, null elsewhere."""
    for b in batches:
        runs = b.column("runs")
        texts, gone, lost = [None] * b.num_rows, np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows, np.int64)
        hit = np.flatnonzero(runs.is_valid().to_numpy(zero_copy_only=False))
        for row, end, data, off in text_chunks(b.column("_row").field("text").take(pa.array(hit))) if len(hit) else ():
            x = Lines(data, off)
            first = x.words[x.first]
            inside = SPACE_BYTES[data]
            begin = inside.copy()
            begin[1:] &= ~inside[:-1]
            glued = off[1:-1]
            glued = glued[(glued > 0) & (glued < len(data))]
            begin[glued] |= inside[glued]
            byte = np.flatnonzero(begin)
            byte[x.words[:-1]] = x.start[:len(x.words) - 1]  # what precedes a line's first word is the line's
            for i, r in enumerate(hit[row:end].tolist()):
                f, l = int(first[i]), int(first[i + 1])
                drop = np.zeros(l - f + 2, np.int64)
                spans = runs[r].values
                np.add.at(drop, spans.field("lo").to_numpy(), 1)
                np.add.at(drop, spans.field("hi").to_numpy(), -1)
                drop = np.cumsum(drop)[:l - f] > 0
                edges = np.append(byte[f:l], off[i + 1])
                edges[0] = off[i]
                turn = np.flatnonzero(np.diff(np.concatenate([[True], drop, [True]])))  # words kept lie between turns
                texts[r] = b"".join(data[edges[s]:edges[e]].tobytes() for s, e in zip(turn[::2], turn[1::2], strict=True)).decode("utf-8", "replace")
                mine = x.words[x.first[i]:x.first[i + 1] + 1] - f
                before = np.concatenate([[0], np.cumsum(drop)])
                gone[r], lost[r] = (np.diff(before[mine]) == np.diff(mine)).sum(), drop.sum()
        yield pa.RecordBatch.from_arrays([b.column("_row"), pa.array(texts, pa.string()), pa.array(gone), pa.array(lost)],
                                         names=["_row", "left", "lines_deleted", "words_deleted"])


def _same(a: str, b: str):
    return F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")) & (F.col(f"{a}._th") == F.col(f"{b}._th"))


def _rank_in(*kind: str) -> Window:
    """Rows of one kind in the order of the corpus: (doc_id, text hash, word); a null doc_id is last."""
    return Window.partitionBy(*kind).orderBy(F.col("doc_id").asc_nulls_last(), "_th", "lo")


def _tasks(rows: DataFrame) -> int:
    return int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _frequent(rows: DataFrame, key: str) -> list[int]:
    """Hashes with more rows than half of a task's share: about two per task at most."""
    least = max(FREQUENT, rows.count() * SAMPLE / (2 * _tasks(rows)))
    counts = rows.select(key).sample(SAMPLE, seed=1).groupBy(key).count()
    return [r[0] for r in counts.filter(F.col("count") >= least).select(key).collect()]


def _late_in_parts(rows: DataFrame, *kind: str) -> DataFrame:
    """``rows`` with ``late`` (not at the first place of their kind): ranked in parts, then the first ones of all parts."""
    part = F.pmod(F.xxhash64("doc_id", "_th"), F.lit(_tasks(rows)))
    cut = rows.withColumn("part", part)
    cut = cut.withColumn("rank", F.rank().over(_rank_in(*kind, "part")))
    cut = cut.withColumn("part", F.when(F.col("rank") == 1, -1).otherwise(F.col("part")))
    return cut.withColumn("late", (F.col("rank") > 1) | (F.rank().over(_rank_in(*kind, "part")) > 1)).drop("part", "rank")


def _lists(owner: np.ndarray, docs: int, lo: np.ndarray, hi: np.ndarray) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=docs))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays([pa.array(v.astype(np.int32)) for v in (lo, hi)], names=["lo", "hi"]))


def _gathered(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    t = pa.Table.from_batches(parts).combine_chunks()
    new = _new(t)
    doc, head, late = np.cumsum(new) - 1, np.flatnonzero(new), np.asarray(t["late"])
    lo, hi = (np.asarray(t[c]).astype(np.int64) for c in ("lo", "hi"))
    d, s, e = doc[late], lo[late], hi[late]
    reach = np.maximum.accumulate((d << 32) + e) if len(d) else d
    first = np.ones(len(d), bool)
    first[1:] = (d[1:] << 32) + s[1:] > reach[:-1]
    final = np.append(first[1:], True)[:len(d)]  # a stretch's last row
    key = [t[c].combine_chunks().take(pa.array(head)) for c in ("doc_id", "_th")]
    lists = _lists(d[first], len(head), s[first], reach[final] & 0xFFFFFFFF), _lists(doc[~late], len(head), lo[~late], hi[~late])
    return pa.RecordBatch.from_arrays([*key, *lists], names=["doc_id", "_th", "runs", "spots"])


def _by_document(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, _th, lo, hi, late), ordered by document and lo -> one row per document: ``runs`` are its
    late stretches, put together where they meet, ``spots`` its others."""
    held: list[pa.RecordBatch] = []  # rows of a document that may go on in the next batch
    for b in batches:
        if b.num_rows:
            b = b.filter(pa.array(_new(b, "lo")))  # repeated rows of a document
            edge = np.flatnonzero(_new(b))[-1]
            if held and (edge or _new(pa.Table.from_batches([held[-1].slice(held[-1].num_rows - 1), b.slice(0, 1)]))[1]):
                yield _gathered([*held, b.slice(0, edge)])
                held = []
            elif edge:
                yield _gathered([b.slice(0, edge)])
            held.append(b.slice(edge))
    if held:
        yield _gathered(held)


def _documents(spans: DataFrame) -> DataFrame:
    schema = "doc_id bigint, _th bigint, runs array<struct<lo:int,hi:int>>, spots array<struct<lo:int,hi:int>>"
    cols = ["doc_id", "_th", "lo", "hi", "late"]
    return spans.select(*cols).repartition("doc_id", "_th").sortWithinPartitions("doc_id", "_th", "lo").mapInArrow(_by_document, schema)


def repeated_passages(docs: DataFrame, least: int = MIN_WORDS) -> DataFrame:
    """(doc_id, _th, runs): per document with any, stretches [lo, hi) of words that lie in runs which occur earlier."""
    spark = docs.sparkSession
    schema = "print bigint, c1 bigint, c2 bigint, doc_id bigint, _th bigint, lo int, hi int"
    src = docs.select(*doc_key(), "text")
    repeats = work_dir(spark, "repeats")
    with scratch(spark):  # most positions occur once; their table goes as soon as the repeated ones are written
        every = materialize(src.mapInArrow(_positions(least), schema), "positions")
        hot = _frequent(every, "print")
        # one shuffle and one sort serve both windows: of a kind (whole neighbourhood) and of its fingerprint
        kind = _rank_in("print", "c1", "c2")
        again = (every.filter(~F.col("print").isin(hot)) if hot else every).repartition("print")
        again = again.select("*", F.rank().over(kind).alias("rank"), F.row_number().over(kind).alias("row"))
        kinds = F.count_if(F.col("row") == 1).over(Window.partitionBy("print"))
        again = again.select("doc_id", "_th", "lo", "hi", (F.col("rank") > 1).alias("late"), (kinds > 1).alias("many"))
        if hot:
            often = every.filter(F.col("print").isin(hot))
            differ = often.groupBy("print").agg(F.min("c1").alias("a"), F.max("c1").alias("b"), F.min("c2").alias("c"), F.max("c2").alias("d"))
            differ = [r[0] for r in differ.filter("a <> b OR c <> d").select("print").collect()]
            often = _late_in_parts(often, "print", "c1", "c2").withColumn("many", F.col("print").isin(differ))
            again = again.unionByName(often.select(*again.columns))
        # whole neighbourhoods, and one of each kind where a fingerprint has several
        again = materialize(again.filter("late OR many").drop("many"), "again")
        _documents(again).write.parquet(repeats)
    found = spark.read.parquet(repeats)
    # one of each kind, window by window
    spots = found.filter("size(spots) > 0").select("doc_id", "_th", "spots")
    texts = src.alias("d").join(spots.alias("s"), _same("d", "s")).select("d.doc_id", "d._th", "d.text", "s.spots")
    windows = materialize(texts.mapInArrow(_spelt(least), "h1 bigint, h2 bigint, doc_id bigint, _th bigint, lo int"), "kinds")
    hot = _frequent(windows, "h1")
    part = windows.filter(~F.col("h1").isin(hot)) if hot else windows
    part = part.withColumn("late", F.rank().over(_rank_in("h1", "h2")) > 1)
    if hot:
        part = part.unionByName(_late_in_parts(windows.filter(F.col("h1").isin(hot)), "h1", "h2"))
    part = _documents(part.filter("late").withColumn("hi", F.col("lo") + least))
    both = found.filter("size(runs) > 0").unionByName(part).groupBy("doc_id", "_th")
    return both.agg(F.flatten(F.collect_list("runs")).alias("runs"))


def dedup_passages(docs: DataFrame, least: int = MIN_WORDS) -> DataFrame:
    """``docs`` as one struct ``_row`` with new_text, lines_deleted (lines of which every word
    goes) and words_deleted."""
    runs = repeated_passages(docs, least)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    rows = rows.select("_row", F.col("_row.doc_id").alias("doc_id"), F.xxhash64("_row.text").alias("_th"))
    both = rows.alias("d").join(runs.alias("r"), _same("d", "r"), "left").select("_row", "runs")
    schema = StructType([both.schema["_row"], StructField("left", StringType()), StructField("lines_deleted", LongType()),
                         StructField("words_deleted", LongType())])
    out = both.mapInArrow(_cut, schema)
    text = F.when(F.col("words_deleted") > 0, F.col("left")).otherwise(F.col("_row.text"))
    return out.select("_row", text.alias("new_text"), "lines_deleted", "words_deleted")


def without_repeated_passages(docs: DataFrame, least: int = MIN_WORDS) -> DataFrame:
    """The rows of ``docs`` with repeated passages cut from their text (``n_chars``, where present,
    follows). A row goes when nothing with a word is left of a text that had one. All columns
    are kept."""
    out = dedup_passages(docs, least)
    changed, left = F.col("words_deleted") > 0, F.regexp_like("new_text", F.lit(r"[^\x20\x09-\x0D]"))
    new = {"text": F.col("new_text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(changed, F.length("new_text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("_row.n_chars"))
    return out.filter(~changed | left).select(*[new.get(c, F.col(f"_row.`{c}`")).alias(c) for c in docs.columns])
