"""N-gram Jaccard join by parity sketches.

Method. A document is the set of its distinct five-word shingles (64-bit hashes). Two sets of
sizes a and b with Jaccard similarity of at least 4/5 differ in at most D = (a + b) / 9 shingles.

* *Parity sketch.* Every shingle is XORed into one of m blocks. Two sketches differ in no more
  blocks (and the 256-bit parity sketch in no more bits) than the sets differ in shingles.
* *Pigeonhole per size band.* Sizes are cut into bands; a band uses m = D + 1 + t blocks, D taken
  for its largest sizes, so linked documents agree in at least t + 1 blocks. In any common order
  of (block, value) keys two such documents therefore share one of their first D + 1. Keys are
  ordered by how often they occur, empty blocks last: each document leaves out its t commonest
  keys, which takes away the blocks that only hold a passage many documents share, and no link. A
  document also shows its blocks in the next band if it may have larger partners there.
* *Join.* Remaining keys of two different sets give candidates. Equal sets are one vertex, so
  exact copies cost one row each.
* *Verify.* Candidates are not expanded to all pairs. Each key first pairs its members with the
  member that meets most candidates overall (the hub of a group of near copies); pairs that pass
  the size and Hamming bounds are verified on the sets and merged into components. Only pairs
  that are still in different components are then enumerated, filtered by the bounds inside the
  join, and verified. So every link between different components is tested.
* *Crowded sets.* A set whose keys would compare it with more than ``COMPARISONS`` others per shingle
  shares a passage with many sets without being linked by it. Such sets get keys of a second, finer
  layout: narrow bands and four times D spare blocks, counted among themselves. Linked sets agree in
  that many more blocks, so the D + 1 rarest still suffice, and the shared passage falls among the
  blocks left out: two sets meet only where what is their own agrees. Two crowded sets are compared
  through these keys only, all other pairs through the first ones, at a bounded cost per set.

Cases: null or wordless texts have the empty set and link with nothing (component_id is their own
doc_id); fewer than five words make one shingle; rows that repeat doc_id and text are the same
document and give one output row each; a null doc_id is never the smallest of a component with
other ids, and stays null alone; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftline.llm.graph import components
from driftline.llm.text import doc_key, mix, shingle_hashes, text_chunks, word_hashes
from driftline.session import materialize

SIMILARITY = Fraction(4, 5)
BAND_RATIO = Fraction(8, 5)  # upper by lower size of a band, less than 1 / similarity ** 2
WORDS = 5
FINE_RATIO = Fraction(11, 10)  # of the second layout: D follows the size closely
CHUNK_ITEMS = 1 << 16  # shingles of sets whose keys are made at once
COMPARISONS = 10  # with other sets, per shingle, beyond which the second layout is the cheaper way
PAST = 12  # keys looked back at to show a pair once
SKETCH_WORDS = 16  # 64-bit words of the parity sketch that filters pairs
SLOTS, FINE_SLOTS = 2, 8  # at least the bands that a set can show in
_SALT = np.uint64(0xA0761D6478BD642F)
_FINE_SALT = np.uint64(0xE7037ED1A0B428DB)


def max_difference(total: int, similarity: Fraction = SIMILARITY) -> int:
    """Largest symmetric difference of linked sets whose sizes sum to ``total``."""
    return int((1 - similarity) / (1 + similarity) * total)


def band_starts(upto: int, ratio: Fraction = BAND_RATIO) -> list[int]:
    """Smallest sizes of the bands up to the one that holds the largest partner of a set of ``upto``,
    and of the one after."""
    s, last = [1], int(upto / SIMILARITY)
    while s[-1] <= last:
        s.append(max(s[-1] + 1, -int(-(s[-1] * ratio) // 1)))
    return s + [max(s[-1] + 1, -int(-(s[-1] * ratio) // 1))]


def band_of(n: int, starts: list[int]) -> int:
    return int(np.searchsorted(starts, n, "right")) - 1


def layout(band: int, starts: list[int], fine: bool = False) -> tuple[int, int]:
    """(blocks, spare blocks t) of a band; (0, 0) where only equal sets can link."""
    d = max_difference(2 * (starts[band + 1] - 1))
    if d == 0:
        return 0, 0
    t = 4 * d if fine else 2 + d // 6
    return d + 1 + t, t


def block_keys(shingles: np.ndarray, starts: list[int], fine: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Join keys of a set, for its band and those after that may hold a partner; the lowest bit marks an
    empty block. With each key, the number of keys of its band that the set may leave out times
    SLOTS, plus the band's distance from the set's own. Empty blocks come only where so many are
    empty that the others are D keys or fewer."""
    n, keys, spare, slots = len(shingles), [], [], FINE_SLOTS if fine else SLOTS
    own = band_of(n, starts) if n else 0
    for offset in range(slots) if n else ():
        band = own + offset
        if offset and n < SIMILARITY * starts[band]:
            break  # no partner of that band is small enough
        m, t = layout(band, starts, fine)
        if m == 0:
            continue
        block = (mix(shingles ^ (_FINE_SALT if fine else _SALT)) % np.uint64(m)).astype(np.int64)
        order = np.argsort(block, kind="stable")
        used, first = np.unique(block[order], return_index=True)
        value = np.bitwise_xor.reduceat(shingles[order], first)
        void = np.zeros(len(used), np.uint64)
        if m - len(used) > t:
            full, void = np.zeros(m, np.uint64), np.ones(m, np.uint64)
            full[used], void[used] = value, 0
            used, value = np.arange(m), full
        keys.append(mix(value ^ mix(used.astype(np.uint64) + np.uint64(band << 32))) & ~np.uint64(1) | void)
        spare.append(np.full(len(used), slots * (len(used) - (m - t)) + offset, np.int32))
    return (np.concatenate(keys), np.concatenate(spare)) if keys else (np.zeros(0, np.uint64), np.zeros(0, np.int32))


def parity_bits(shingles: np.ndarray) -> np.ndarray:
    """Parity sketch of fixed length: each shingle flips one bit."""
    flips = np.bincount((mix(shingles) & np.uint64(64 * SKETCH_WORDS - 1)).astype(np.int64),
                        minlength=64 * SKETCH_WORDS) & 1
    return np.packbits(flips.astype(np.uint8)).view(np.int64)


def wide_bits(shingles: np.ndarray) -> np.ndarray:
    """Parity sketch whose length follows the set: the power of two bits of at least twice its
    size. A longer sketch folds to a shorter one by XOR of its halves."""
    size = 64
    while size < 2 * len(shingles):
        size *= 2
    flips = np.bincount((mix(shingles ^ _SALT) & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(flips.astype(np.uint8)).view(np.int64)


def set_hash(shingles: np.ndarray) -> int:
    """64-bit hash of a whole set; 0 is kept for the empty set."""
    if len(shingles) == 0:
        return 0
    total = np.add.reduce(mix(shingles + _SALT), dtype=np.uint64, keepdims=True)
    return int(mix(total ^ np.uint64(len(shingles))).view(np.int64)[0]) or 1


def _sets(batch: pa.RecordBatch) -> Iterator[tuple[int, list[np.ndarray]]]:
    for lo, _, data, off in text_chunks(batch.column("text")):
        yield lo, shingle_hashes(*word_hashes(data, off), WORDS)


def _facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "_th", "n_shingles", "vertex", *(f"s{i}" for i in range(SKETCH_WORDS))]
    for b in batches:
        for lo, sets in _sets(b):
            bits = np.stack([parity_bits(s) for s in sets])
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").slice(lo, len(sets)), b.column("_th").slice(lo, len(sets)),
                 pa.array([len(s) for s in sets], pa.int64()), pa.array([set_hash(s) for s in sets], pa.int64()),
                 *(pa.array(bits[:, i]) for i in range(SKETCH_WORDS))], names=names)


def _key_batch(sets: list[np.ndarray], fine: bool) -> pa.RecordBatch:
    starts = band_starts(max(map(len, sets), default=1), FINE_RATIO if fine else BAND_RATIO)
    keys = [block_keys(s, starts, fine) for s in sets]
    vertex = np.repeat(np.array([set_hash(s) for s in sets], np.int64), [len(k) for k, _ in keys])
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate([k for k, _ in keys]).view(np.int64)), pa.array(vertex),
                                       pa.array(np.concatenate([s for _, s in keys]))], names=["key", "vertex", "spare"])


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for _, sets in _sets(b):
            yield _key_batch(sets, False)


def _fine_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        items = b.column("items")
        off, flat = items.offsets.to_numpy(), items.values.to_numpy().view(np.uint64)
        lo = 0
        while lo < b.num_rows:  # about CHUNK_ITEMS shingles at a time
            hi = max(lo + 1, int(np.searchsorted(off, off[lo] + CHUNK_ITEMS, "right")) - 1)
            yield _key_batch([flat[x:y] for x, y in zip(off[lo:hi].tolist(), off[lo + 1:hi + 1].tolist(), strict=True)], True)
            lo = hi


def _whole_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for lo, sets in _sets(b):
            yield pa.RecordBatch.from_arrays(
                [b.column("vertex").slice(lo, len(sets)),
                 pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                 pa.array([wide_bits(s) for s in sets], pa.list_(pa.int64()))], names=["vertex", "items", "wide"])


def _similar(a: str, b: str) -> str:
    """Size and Hamming bounds of a pair, as SQL over two sides that carry n and s0.."""
    bits = " + ".join(f"bit_count({a}.s{i} ^ {b}.s{i})" for i in range(SKETCH_WORDS))
    num, den = SIMILARITY.numerator, SIMILARITY.denominator
    return (f"{den} * least({a}.n, {b}.n) >= {num} * greatest({a}.n, {b}.n) AND "
            f"{den + num} * ({bits}) <= {den - num} * ({a}.n + {b}.n)")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (u, v) whose sets reach the similarity. Sketches of a thirtieth of the sets' size
    go first; most pairs of large sets that only share a passage end there."""
    one = sets.select(F.col("vertex").alias("u"), F.col("wide").alias("wa"), F.size("items").alias("na"))
    two = sets.select(F.col("vertex").alias("v"), F.col("wide").alias("wb"), F.size("items").alias("nb"))
    short = F.least(F.size("wa"), F.size("wb"))

    def folded(w: str) -> Column:  # linked sets differ by less than the factor two in size
        return F.when(F.size(w) > short, F.zip_with(F.slice(w, F.lit(1), short), F.slice(w, short + 1, short),
                                                    lambda x, y: x.bitwiseXOR(y))).otherwise(F.col(w))

    bits = F.aggregate(F.zip_with(folded("wa"), folded("wb"), lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    num, den = SIMILARITY.numerator, SIMILARITY.denominator
    close = (den + num) * bits <= (den - num) * (F.col("na") + F.col("nb"))
    pairs = materialize(pairs.join(one, "u").join(two, "v").filter(close).select("u", "v"), "pairs")
    left = sets.select(F.col("vertex").alias("u"), F.col("items").alias("a"))
    right = sets.select(F.col("vertex").alias("v"), F.col("items").alias("b"))
    both = F.size(F.array_intersect("a", "b"))
    near = SIMILARITY.denominator * both >= SIMILARITY.numerator * (F.size("a") + F.size("b") - both)
    return pairs.join(left, "u").join(right, "v").filter(near).select("u", "v")


def chosen_keys(rows: DataFrame, slots: int = SLOTS) -> DataFrame:
    """(key, vertex, g) from (key, vertex, spare): keys of two or more different sets after each set
    leaves out its commonest ones; ``g`` is the number of rows that meet in a key. Empty blocks
    are left out first, so they take part in the choice even where no other set shows them."""
    of_key = Window.partitionBy("key")
    rows = rows.withColumns({"lo": F.min("vertex").over(of_key), "hi": F.max("vertex").over(of_key), "g": F.count("*").over(of_key)})
    rows = rows.filter("lo <> hi OR key % 2 <> 0").groupBy("key", "vertex").agg(F.max("g").alias("g"), F.max("spare").alias("spare"))
    # each set leaves out its commonest keys; what is then alone goes as well
    common = Window.partitionBy("vertex", F.col("spare") % slots).orderBy((F.col("key") % 2 == 0), F.col("g").desc(), "key")
    rows = rows.withColumn("r", F.row_number().over(common)).filter(f"r > spare div {slots}").select("key", "vertex", "g")
    hits = rows.withColumns({"lo": F.min("vertex").over(of_key), "hi": F.max("vertex").over(of_key)})
    return hits.filter("lo <> hi").select("key", "vertex", "g")


def _open_keys(hits: DataFrame, comp: DataFrame) -> DataFrame:
    """(key, vertex, c, main, left): rows of the keys that still hold several components; ``main`` is a key's
    largest one, ``left`` its number of rows."""
    of_key = Window.partitionBy("key")
    part = hits.select("key", "vertex").join(comp, "vertex", "left").withColumn("c", F.coalesce("c", "vertex"))
    part = part.withColumns({"lo": F.min("c").over(of_key), "hi": F.max("c").over(of_key), "left": F.count("*").over(of_key)}).filter("lo <> hi")
    part = part.withColumn("k", F.count("*").over(Window.partitionBy("key", "c")))
    return part.withColumn("main", F.max(F.struct("k", "c")).over(of_key)["c"]).select("key", "vertex", "c", "main", "left")


def _joined(rows: DataFrame, vertices: DataFrame, side: str, once: str) -> DataFrame:
    """Pairs (u, v) of different components that meet in a key, pass the bounds and fulfil ``once``; ``side``
    holds for the rows of u's side."""
    # a pair that meets in many keys shows in few of them: not where one of the PAST open keys
    # before, in key order, is common as well
    past = Window.partitionBy("vertex").orderBy("key").rowsBetween(-PAST, -1)
    rows = rows.withColumn("past", F.collect_list("key").over(past))
    rows = materialize(rows.join(vertices.drop("doc_id"), "vertex"), "open")
    return (rows.filter(side).alias("a").join(rows.alias("b"), F.expr(f"a.key = b.key AND a.c <> b.c AND ({once}) AND "
                                                                      + _similar("a", "b") + " AND NOT arrays_overlap(a.past, b.past)"))
            .select(F.least("a.vertex", "b.vertex").alias("u"), F.greatest("a.vertex", "b.vertex").alias("v")))


def open_pairs(hits: DataFrame, comp: DataFrame, vertices: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs that the hubs have not joined: those of two crowded sets through keys of the second layout,
    all others through the first."""
    open_ = materialize(_open_keys(hits, comp), "open_keys")
    load = open_.groupBy("vertex").agg(F.sum("left").alias("load")).join(vertices.select("vertex", "n"), "vertex")
    crowded = materialize(load.filter(F.col("load") > COMPARISONS * F.col("n")).select("vertex", F.lit(True).alias("crowded")), "crowded")
    marked = open_.join(crowded, "vertex", "left").withColumn("crowded", F.coalesce("crowded", F.lit(False)))
    first = _joined(marked.select("key", "vertex", "c", "crowded"), vertices, "NOT crowded", "b.crowded OR a.vertex < b.vertex")
    fine = sets.select("vertex", "items").join(crowded, "vertex", "left_semi")
    fine = materialize(chosen_keys(fine.mapInArrow(_fine_keys, "key bigint, vertex bigint, spare int"), FINE_SLOTS), "fine")
    # the largest component of a key is only the other side, so a group that the hub has joined makes no pairs
    second = _joined(_open_keys(fine, comp).select("key", "vertex", "c", "main"), vertices, "c <> main", "b.c = b.main OR a.vertex < b.vertex")
    return first.union(second).distinct()


def jaccard_groups(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (needs doc_id, text): doc_id, _th (text hash), n_shingles,
    vertex (hash of the set) and component_id. See the module docstring."""
    src = docs.select(*doc_key(), "text")
    th = "doc_id bigint, _th bigint"
    facts = materialize(src.mapInArrow(_facts, f"{th}, n_shingles bigint, vertex bigint, "
                                       + ", ".join(f"s{i} bigint" for i in range(SKETCH_WORDS))), "facts")
    vertices = (facts.filter("n_shingles > 0").groupBy("vertex")
                .agg(F.min("doc_id").alias("doc_id"), F.min(F.col("n_shingles")).alias("n"),
                     *(F.min(f"s{i}").alias(f"s{i}") for i in range(SKETCH_WORDS))))

    # keys of two or more different sets, with the number of rows that meet in each
    hits = materialize(chosen_keys(src.select("text").mapInArrow(_keys, "key bigint, vertex bigint, spare int")), "hits")
    of_key = Window.partitionBy("key")

    # texts of the sets that take part, once per set
    reps = facts.join(hits.select("vertex").distinct(), "vertex", "left_semi")
    reps = reps.groupBy("vertex").agg(F.min(F.struct("doc_id", "_th")).alias("r")).select("vertex", "r.*")
    same = F.col("d.doc_id").eqNullSafe(F.col("r.doc_id")) & (F.col("d._th") == F.col("r._th"))
    texts = src.alias("d").join(reps.alias("r"), same).select("r.vertex", "d.text")
    sets = materialize(texts.mapInArrow(_whole_sets, "vertex bigint, items array<bigint>, wide array<bigint>")
                       .dropDuplicates(["vertex"]), "sets")

    # 1. every member of a key with the key's hub
    met = hits.groupBy("vertex").agg(F.sum("g").alias("met"))
    hub = F.max(F.struct("met", "vertex")).over(of_key)
    near_hub = (hits.select("key", "vertex").join(met, "vertex").select(F.col("vertex").alias("u"), hub["vertex"].alias("v"))
                .filter("u <> v").distinct())
    links = materialize(_verified(near_hub, sets), "links")
    comp = components(links).withColumnRenamed("v", "vertex")

    # 2. pairs of one key that are still in different components
    rest = open_pairs(hits, comp, vertices, sets)
    more = materialize(_verified(rest, sets), "links")
    joined = components(links.union(more)).withColumnRenamed("v", "vertex")

    lowest = (joined.join(vertices.select("vertex", "doc_id"), "vertex").groupBy("c")
              .agg(F.min("doc_id").alias("component_id")))
    linked = joined.join(lowest, "c").select("vertex", "component_id")
    label = vertices.join(linked, "vertex", "left").select("vertex", F.coalesce("component_id", "doc_id").alias("component_id"))
    return (facts.select("doc_id", "_th", "n_shingles", "vertex").join(label, "vertex", "left")
            .select("doc_id", "_th", "n_shingles", "vertex",
                    F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")))


def keep_one_per_group(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that survive near-duplicate removal, all columns kept: of each
    component the document with its smallest doc_id, of several rows with that id the one with
    the smallest text hash, once. Documents without words are all kept."""
    groups = jaccard_groups(docs)
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "_th")
    best = (groups.filter("n_shingles > 0").groupBy("component_id", F.when(F.col("component_id").isNull(), F.col("vertex")).alias("_v"))
            .agg(F.min(order).alias("k")).select("k.doc_id", "k._th"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    rows = rows.select("_row", F.col("_row.doc_id").alias("doc_id"), F.xxhash64("_row.text").alias("_th"))
    empty = F.regexp_like(F.coalesce(F.col("_row.text"), F.lit("")), F.lit(r"[^\x20\x09-\x0D]"))
    same = F.col("r.doc_id").eqNullSafe(F.col("k.doc_id")) & (F.col("r._th") == F.col("k._th"))
    kept = rows.filter(empty).alias("r").join(best.alias("k"), same, "left_semi")
    kept = kept.dropDuplicates(["doc_id", "_th"])
    return kept.select("_row.*").unionByName(rows.filter(~empty).select("_row.*"))
