"""Trie of conversation prefixes with subtree totals.

Method. A conversation is the sequence of its turns' ids, a turn id the 64-bit hash of role and text.

* *Range shards.* Conversations are range-partitioned and sorted by their sequences, so equal
  prefixes are neighbours. A shard is worked off in chunks of bounded size.
* *Matrices.* A chunk is a padded turn-id matrix: ``lexsort`` orders its rows, and where a column
  changes from one row to the next, OR-accumulated along the row, a node starts at that depth.
  ``reduceat`` over all columns then aggregates the nodes of every depth at once, and totals go up
  from the deepest nodes to the root.
* *Boundaries.* Only the nodes on a chunk's first and last row can go on in a neighbour. They stay
  open: the two rows are handed on as weighted paths (per depth: members, smallest id, and what
  closed children brought), which are rows of the next matrix. So a chunk is folded into its shard,
  and the shards' paths, two each, into the root. A node is closed, and complete, as soon as it
  leaves both boundary rows.
* *Ends.* The ids that end at a closed node of a chunk are hashed there; those of open nodes are
  sorted by node and streamed through the hash.

Cases: turns go by ``turn`` (null first), ties by turn id; a null role or text is empty; rows without
conv_id take no part; repeated rows are repeated turns; a conversation without turns of its own
left, and without a base, is a member of the root only; other columns are ignored; an empty table
gives an empty result. Two turns are equal when their hashes are. The turn ids of one conversation
(16 bytes a turn) are held by one task; otherwise memory is bounded by ``CELLS``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftline.llm.text import SPACE_WORD, mix
from driftline.session import materialize

BASE_EVERY = 20  # conversations that share the opening turns of their base
MAX_SHARED = 4  # fewer than so many turns come from the base
CELLS = 1 << 18  # cells of a chunk's matrix
FOLD_ROWS = 64  # boundary rows folded at once at the end
PAD = np.iinfo(np.int64).min  # no turn has this id
NONE = np.iinfo(np.int64).max
NO_ENDS = hashlib.sha256(b"").hexdigest()

_TOTALS = ("n", "low", "kids", "leaves", "saved")  # per depth of a path, from 0
_OUT = ("kind int, key bigint, parent_key bigint, conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, "
        "n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string, shard bigint, pos int, "
        "ids array<bigint>, words array<bigint>, " + ", ".join(f"{c} array<bigint>" for c in _TOTALS))
CLOSED, JOINED, END, PATH = range(4)  # kinds of rows: a node of a chunk, a node of a fold, an id that ends at an open node, a path


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string(), "array<bigint>": pa.list_(pa.int64())}
    return pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in ddl.split(", ")])


_SCHEMA = _arrow(_OUT)


@dataclass
class Path:
    """A boundary row: turn ids and words, and per depth the totals of its node so far."""
    ids: np.ndarray
    words: np.ndarray
    totals: list[np.ndarray]


@dataclass
class Nodes:
    """Closed nodes of one matrix, as columns; ``parent_key`` where the parent is still open."""
    columns: dict[str, np.ndarray]
    ends: list[str] | None


def _keys(ids: np.ndarray) -> np.ndarray:
    """Hash of every row's prefix of every length (one more column than ``ids``)."""
    powers = np.multiply.accumulate(np.full(ids.shape[1] + 1, 0xD6E8FEB86659FD93 | 1, np.uint64))
    run = np.cumsum(mix(ids.view(np.uint64)) * powers[1:], axis=1, dtype=np.uint64)
    run = np.concatenate([np.zeros((len(ids), 1), np.uint64), run], axis=1)
    return mix(run ^ mix(np.arange(ids.shape[1] + 1, dtype=np.uint64))).view(np.int64)


def close(ids: np.ndarray, length: np.ndarray, words: np.ndarray, totals: list[np.ndarray], tie: np.ndarray,
          conv: np.ndarray | None = None, whole: bool = False) -> tuple[Nodes, list[Path], tuple[np.ndarray, np.ndarray]]:
    """Nodes of a padded matrix that are complete, the paths that stay open, and (key, conv_id) of
    the conversations that end at an open node. ``conv`` names the rows where they are
    conversations; with ``whole`` no node stays open."""
    order = np.lexsort((tie, *ids.T[::-1]))
    ids, length, words = ids[order], length[order], words[order]
    totals = [t[order] for t in totals]
    rows, depth = ids.shape
    change = np.ones((rows, depth + 1), bool)
    change[1:, 0] = False  # the root is one node
    change[1:, 1:] = np.logical_or.accumulate(ids[1:] != ids[:-1], axis=1)
    flat = change.T.ravel()
    start = np.flatnonzero(flat)
    node = (np.cumsum(flat) - 1).reshape(depth + 1, rows)
    at, row = start // rows, start % rows
    real = at <= length[row]
    n, low, kids, leaves, saved = (f.reduceat(t.T.ravel(), start) for f, t in
                                   zip((np.add, np.minimum, np.add, np.add, np.add), totals, strict=True))
    is_open = np.zeros(len(start), bool)
    sides = [] if whole else [node[:length[r] + 1, r] for r in (0, rows - 1)]
    for side in sides:
        is_open[side] = True
    parent = np.full(len(start), -1)
    parent[at > 0] = node[at[at > 0] - 1, row[at > 0]]
    own = np.where(at > 0, words[row, np.maximum(at, 1) - 1] if depth else 0, 0)
    cut = np.searchsorted(at, np.arange(depth + 2))
    for d in range(depth, -1, -1):
        i = slice(cut[d], cut[d + 1])
        done = real[i] & ~is_open[i]
        leaves[i] = np.where(done & (kids[i] == 0), 1, leaves[i])
        saved[i] += np.where(done, (n[i] - 1) * own[i], 0)
        if d:
            up = parent[i][done]
            np.add.at(kids, up, 1)
            np.add.at(leaves, up, leaves[i][done])
            np.add.at(saved, up, saved[i][done])
    key = _keys(ids)
    done = np.flatnonzero(real & ~is_open)
    up = parent[done]
    waits = (up >= 0) & is_open[up]
    nodes = {"conv_id": low[done], "depth": at[done], "n_convs": n[done], "n_children": kids[done], "n_leaves": leaves[done],
             "saved_tokens": saved[done], "key": key[row[done], at[done]],
             "parent_conv_id": np.ma.array(low[up], mask=(up < 0) | waits),
             "parent_key": np.ma.array(key[row[done], np.maximum(at[done], 1) - 1], mask=~waits)}
    ends, later = None, (np.zeros(0, np.int64),) * 2
    if conv is not None:
        last, conv = node[length, np.arange(rows)], conv[order]
        stay = is_open[last]
        later = key[np.flatnonzero(stay), length[stay]], conv[stay]
        ids_of: dict[int, list[str]] = {}
        for i, c in zip(last[~stay].tolist(), conv[~stay].tolist(), strict=True):
            ids_of.setdefault(i, []).append(str(c))
        ends = [hashlib.sha256(",".join(ids_of[i]).encode()).hexdigest() if i in ids_of else NO_ENDS for i in done.tolist()]
    paths = []
    for k, side in enumerate(sides):
        r = (0, rows - 1)[k]
        fresh = ~np.isin(side, sides[0]) if k else np.ones(len(side), bool)
        if fresh.any():  # what both rows share goes with the first
            mine = [np.where(fresh, t[side], empty) for t, empty in zip((n, low, kids, leaves, saved), (0, NONE, 0, 0, 0), strict=True)]
            paths.append(Path(ids[r, :length[r]], words[r, :length[r]], mine))
    return Nodes(nodes, ends), paths, later


def fold(paths: list[Path], whole: bool = False) -> tuple[Nodes, list[Path]]:
    """Join paths of neighbours, in any order: nodes that are then complete, and the outer paths."""
    length = np.array([len(p.ids) for p in paths])
    depth = int(length.max(initial=0))
    ids, words = np.full((len(paths), depth), PAD), np.zeros((len(paths), depth), np.int64)
    totals = [np.full((len(paths), depth + 1), empty) for empty in (0, NONE, 0, 0, 0)]
    for r, p in enumerate(paths):
        ids[r, :length[r]], words[r, :length[r]] = p.ids, p.words
        for t, mine in zip(totals, p.totals, strict=True):
            t[r, :length[r] + 1] = mine
    nodes, paths, _ = close(ids, length, words, totals, np.arange(len(paths)), whole=whole)
    return nodes, paths


# ---------------------------------------------------------------- passes over partitions

def _rows(size: int, /, **columns: object) -> pa.RecordBatch:
    def column(x: object, kind: pa.DataType) -> pa.Array:
        if isinstance(x, np.ma.MaskedArray):
            return pa.array(x.data, kind, mask=np.ma.getmaskarray(x))
        return pa.array(x, kind)

    return pa.RecordBatch.from_arrays([column(columns[f.name], f.type) if f.name in columns else pa.nulls(size, f.type)
                                       for f in _SCHEMA], schema=_SCHEMA)


def _node_rows(nodes: Nodes, kind: int) -> Iterator[pa.RecordBatch]:
    n = len(nodes.columns["depth"])
    if n:
        yield _rows(n, kind=np.full(n, kind), **nodes.columns, **({"ends_sha256": nodes.ends} if nodes.ends else {}))


def _matrices(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, ...]]:
    """(conv_id, length, ids, words) of consecutive rows, padded, up to CELLS cells at a time."""
    conv = batch.column("conv_id").to_numpy()
    ids, words = batch.column("ids"), batch.column("words")
    flat, flat_words = ids.flatten().to_numpy(), words.flatten().to_numpy()
    length = ids.value_lengths().to_numpy().astype(np.int64)
    off = np.concatenate([[0], np.cumsum(length)])
    lo = 0
    while lo < len(conv):
        cells = np.maximum.accumulate(length[lo:lo + CELLS] + 1) * np.arange(1, min(CELLS, len(conv) - lo) + 1)
        hi = lo + max(1, int(np.searchsorted(cells, CELLS, "right")))
        n = length[lo:hi]
        inside = np.arange(int(n.max(initial=0))) < n[:, None]
        m, w = np.full(inside.shape, PAD), np.zeros(inside.shape, np.int64)
        m[inside], w[inside] = flat[off[lo]:off[hi]], flat_words[off[lo]:off[hi]]
        yield conv[lo:hi], n, m, w
        lo = hi


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shard, paths = TaskContext.get().partitionId(), []
    for batch in batches:
        for conv, length, ids, words in _matrices(batch):
            member = np.arange(ids.shape[1] + 1) <= length[:, None]
            zero = np.zeros(member.shape, np.int64)
            totals = [member.astype(np.int64), np.where(member, conv[:, None], NONE), zero, zero, zero]
            nodes, more, (key, late) = close(ids, length, words, totals, conv, conv)
            yield from _node_rows(nodes, CLOSED)
            if len(key):
                yield _rows(len(key), kind=np.full(len(key), END), key=key, conv_id=late)
            if paths:
                nodes, paths = fold(paths + more)
                yield from _node_rows(nodes, JOINED)
            else:
                paths = more
    for pos, p in enumerate(paths):
        yield _rows(1, kind=[PATH], shard=[shard], pos=[pos], ids=[p.ids], words=[p.words],
                    **{c: [t] for c, t in zip(_TOTALS, p.totals, strict=True)})


def _join_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    paths: list[Path] = []
    for b in batches:
        for i in range(b.num_rows):
            ids, words, *totals = (b.column(c)[i].values.to_numpy() for c in ("ids", "words", *_TOTALS))
            paths.append(Path(ids, words, totals))
            if len(paths) >= FOLD_ROWS:
                nodes, paths = fold(paths)
                yield from _node_rows(nodes, JOINED)
    if paths:
        yield from _node_rows(fold(paths, whole=True)[0], JOINED)


def _hash_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, conv_id) sorted: one digest per key, whatever the number of its ids."""
    at, digest = None, None

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([digest.hexdigest()])], names=["key", "ends"])

    for b in batches:
        keys, conv = b.column("key").to_numpy(), b.column("conv_id").to_numpy()
        cut = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for lo, hi in zip(cut[:-1], cut[1:], strict=True):
            if lo == hi:
                continue
            more = ",".join(map(str, conv[lo:hi].tolist())).encode()
            if at is not None and keys[lo] == at:
                digest.update(b"," + more)
                continue
            if at is not None:
                yield row()
            at, digest = int(keys[lo]), hashlib.sha256(more)
    if at is not None:
        yield row()


# ---------------------------------------------------------------- operators

def sequences(turns: DataFrame) -> DataFrame:
    """(conv_id, ids, words): every conversation's turns in order, as turn ids and word counts."""
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    turn = F.struct(F.col("turn").isNotNull().alias("given"), "turn", F.greatest(F.xxhash64(role, text), F.lit(int(PAD) + 1)).alias("id"),
                    F.regexp_count(text, F.lit(SPACE_WORD)).cast("bigint").alias("words"))
    rows = turns.filter("conv_id IS NOT NULL").select(F.col("conv_id").cast("bigint").alias("conv_id"), turn.alias("t"))
    whole = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return whole.select("conv_id", F.col("t.id").alias("ids"), F.col("t.words").alias("words"))


def rebuilt(conversations: DataFrame) -> DataFrame:
    """:func:`sequences` whose first h turns are those of the base conversation, the next lower id
    that ``BASE_EVERY`` divides, with h = crc32 of the decimal id modulo ``MAX_SHARED``."""
    seq = materialize(sequences(conversations), "sequences")
    base = F.col("conv_id") - F.col("conv_id") % BASE_EVERY
    first = [F.slice(c, 1, MAX_SHARED - 1).alias(f"base_{c}") for c in ("ids", "words")]
    bases = seq.filter(F.col("conv_id") % BASE_EVERY == 0).select(F.col("conv_id").alias("base"), *first)
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % MAX_SHARED).cast("int")
    joined = seq.withColumns({"base": base, "h": h}).join(bases, "base", "left")

    def spliced(c: str):
        none = F.array().cast("array<bigint>")
        shared = F.slice(F.coalesce(f"base_{c}", none), F.lit(1), F.col("h"))
        return F.concat(shared, F.slice(c, F.col("h") + 1, F.greatest(F.size(c) - F.col("h"), F.lit(0)))).alias(c)

    return joined.select("conv_id", spliced("ids"), spliced("words"))


def trie(seq: DataFrame) -> DataFrame:
    """Nodes of the trie over (conv_id, ids, words), one conversation a row: conv_id (smallest
    member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    seq = materialize(seq.select("conv_id", "ids", "words"), "sequences")
    cut = seq.repartitionByRange("ids", "conv_id").sortWithinPartitions("ids", "conv_id")
    found = materialize(cut.mapInArrow(_shards, _OUT), "trie")
    paths = found.filter(F.col("kind") == PATH).repartition(1).sortWithinPartitions("shard", "pos")  # two rows a shard
    top = paths.mapInArrow(_join_shards, _OUT)
    joined = materialize(found.filter(F.col("kind") == JOINED).unionByName(top), "boundary")

    ends = found.filter(F.col("kind") == END).select("key", "conv_id").repartition("key").sortWithinPartitions("key", "conv_id")
    ends = ends.mapInArrow(_hash_ends, "key bigint, ends string")
    named = joined.drop("ends_sha256").join(ends, "key", "left").withColumn("ends_sha256", F.coalesce("ends", F.lit(NO_ENDS)))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    nodes = found.filter(F.col("kind") == CLOSED).select("parent_key", *columns).unionByName(named.select("parent_key", *columns))
    above = joined.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("above"))
    waiting = nodes.filter("parent_key IS NOT NULL").join(above, "parent_key").withColumn("parent_conv_id", F.col("above"))
    return nodes.filter("parent_key IS NULL").select(*columns).unionByName(waiting.select(*columns))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations. See the module docstring."""
    return trie(rebuilt(conversations))
