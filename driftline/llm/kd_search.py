"""Exact top-k inner-product search over KD-trees, one per shard.

Method. Vectors become whole numbers, floor(scale * x), so scores are exact integers.

* *Shards.* Rows are dealt to shards of bounded size by a hash of their row number. Each shard is a
  KD-tree: median splits along the widest side, every node with the tight bounding box of its rows.
* *Best first.* A query walks a tree from the root, always on to the open node with the highest
  bound (the largest inner product that any point of the node's box can have), and stops where the
  bound is below its kth score. A leaf is scored at once for all queries of the block whose bound
  still reaches their kth score.
* *Propagated kth score.* A query is searched in its own shard first. Its k best go along with it:
  blocks of queries meet groups of shards in cells of bounded size, and within a cell the kth score
  is carried from tree to tree. What a cell finds beyond the first k is ranked at the end.

Row numbers follow the vector id (nulls last), so ties go to the smaller id, and a node is also left
out where its bound ties and all its rows come later.

Cases: vectors that are null or hold null or non-finite components take no part, nor do those with a
component that exceeds ``MAX_COMPONENT`` after scaling (a score might not fit a long). Vectors are
compared with those of their own length only. A null id is no query and comes last among ties. Rows
that repeat an id are separate rows: each is a query, and a candidate for the others. Fewer than k
candidates give fewer rows; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from driftline.session import materialize

K = 20
SCALE = 64
LEAF_ROWS = 64
SHARD_CELLS = 1 << 18  # components in a shard, about
MIN_SHARD_ROWS = 256
MAX_COMPONENT = 1 << 28
CELL_SHARDS, CELL_BLOCKS = 16, 64  # trees and query blocks that meet in one task
SPREAD = 8  # groups of trees and of blocks at least, where there are so many shards

_HIT = "qrid bigint, query_id bigint, score bigint, rid bigint, vec_id bigint"
_HITS = pa.schema([(c.split()[0], pa.int64()) for c in _HIT.split(", ")])


@dataclass
class Tree:
    """Rows in tree order and per node its rows [start, end), children, box and smallest row number."""
    points: np.ndarray
    rid: np.ndarray
    vec: np.ndarray
    start: np.ndarray
    end: np.ndarray
    left: np.ndarray
    right: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    least: np.ndarray


def build(points: np.ndarray, rid: np.ndarray, vec: np.ndarray) -> Tree:
    order, nodes = np.arange(len(rid)), []
    todo = [(0, len(rid), -1, 0)]
    while todo:
        start, end, parent, side = todo.pop()
        rows = order[start:end]
        box = points[rows]
        lo, hi = box.min(axis=0, initial=MAX_COMPONENT), box.max(axis=0, initial=-MAX_COMPONENT)
        me = len(nodes)
        nodes.append([start, end, -1, -1, lo, hi, rid[rows].min()])
        if parent >= 0:
            nodes[parent][2 + side] = me
        if end - start > LEAF_ROWS:
            widest = int(np.argmax(hi - lo)) if len(lo) else None
            key = points[rows, widest] if widest is not None else np.zeros(end - start, np.int64)
            order[start:end] = rows[np.lexsort((rid[rows], key))]
            middle = (start + end) // 2
            todo += [(middle, end, me, 1), (start, middle, me, 0)]
    cols = [np.array([n[i] for n in nodes], np.int64) for i in (0, 1, 2, 3)]
    boxes = [np.array([n[i] for n in nodes], np.int64).reshape(len(nodes), points.shape[1]) for i in (4, 5)]
    return Tree(points[order], rid[order], vec[order], *cols, *boxes, np.array([n[6] for n in nodes], np.int64))


@dataclass
class Block:
    """Queries with the best they have met: scores falling, row numbers rising among ties."""
    points: np.ndarray
    rid: np.ndarray
    vec: np.ndarray
    best: list[tuple[np.ndarray, np.ndarray, np.ndarray]]  # score, rid, vec

    @classmethod
    def fresh(cls, points: np.ndarray, rid: np.ndarray, vec: np.ndarray) -> Block:
        none = np.zeros(0, np.int64)
        return cls(points, rid, vec, [(none, none, none)] * len(rid))


def _exact_type(left: np.ndarray, right: np.ndarray) -> type:
    """A type in which the inner products of both come out exactly."""
    most = int(np.abs(left).max(initial=0)) * int(np.abs(right).max(initial=0)) * max(left.shape[1], 1)
    return np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else np.int64


def search(tree: Tree, block: Block, k: int) -> None:
    """Best-first search of ``tree`` for every query; ``block.best`` is brought up to date."""
    kind = _exact_type(tree.points, block.points)
    q, points = block.points.astype(kind), tree.points.astype(kind)
    up, down = np.maximum(q, 0), np.minimum(q, 0)
    bound = (up @ tree.hi.astype(kind).T + down @ tree.lo.astype(kind).T).astype(np.int64)
    least = np.iinfo(np.int64).min
    kth = np.array([s[k - 1] if len(s) >= k else least for s, _, _ in block.best], np.int64)
    scored: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    left, right, first = tree.left.tolist(), tree.right.tolist(), tree.least.tolist()
    for i, own in enumerate(block.rid.tolist()):
        bounds = bound[i].tolist()
        best = block.best[i]
        worst, last = int(kth[i]), int(best[1][k - 1]) if len(best[1]) >= k else -1
        heap = [(-bounds[0], 0)]
        while heap:
            b, node = heapq.heappop(heap)
            if -b < worst:
                break
            if -b == worst and first[node] > last >= 0:
                continue
            if left[node] >= 0:
                for child in (left[node], right[node]):
                    if bounds[child] >= worst:
                        heapq.heappush(heap, (-bounds[child], child))
                continue
            rows = slice(tree.start[node], tree.end[node])
            if node not in scored:  # for all queries that this leaf may still serve
                live = bound[:, node] >= kth
                live[:i] = False
                scored[node] = np.cumsum(live) - 1, (q[live] @ points[rows].T).astype(np.int64)
            at, scores = scored[node]
            score, rid = scores[at[i]], tree.rid[rows]
            take = ((score > worst) | ((score == worst) & (rid < last)) if last >= 0 else np.ones(len(rid), bool)) & (rid != own)
            if take.any():
                s, r, v = (np.concatenate(x) for x in zip(best, (score[take], rid[take], tree.vec[rows][take]), strict=True))
                order = np.lexsort((r, -s))[:k]
                best = s[order], r[order], v[order]
                if len(order) == k:
                    worst, last = int(best[0][-1]), int(best[1][-1])
        block.best[i] = best
        kth[i] = worst


# ---------------------------------------------------------------- rows of bytes

def _narrow(x: np.ndarray) -> tuple[bytes, str]:
    most = int(np.abs(x).max(initial=0))
    kind = "<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<i8"
    return x.astype(kind).tobytes(), kind


def _dump(arrays: list[np.ndarray]) -> bytes:
    """Arrays of whole numbers, each as its type, shape and bytes."""
    out = []
    for x in arrays:
        raw, kind = _narrow(x)
        out.append(f"{kind} {' '.join(map(str, x.shape))}\n".encode() + raw)
    return b"".join(out)


def _load(raw: bytes) -> list[np.ndarray]:
    out, at = [], 0
    while at < len(raw):
        end = raw.index(b"\n", at)
        kind, *shape = raw[at:end].decode().split()
        n = math.prod(map(int, shape))
        out.append(np.frombuffer(raw, kind, n, end + 1).reshape(*map(int, shape)).astype(np.int64))
        at = end + 1 + n * int(kind[-1])
    return out


def _dump_block(b: Block) -> bytes:
    sizes = np.array([len(s) for s, _, _ in b.best], np.int64)
    joined = [np.concatenate([x[i] for x in b.best]) if len(b.best) else np.zeros(0, np.int64) for i in range(3)]
    return _dump([b.points, b.rid, b.vec, sizes, *joined])


def _load_block(raw: bytes) -> Block:
    points, rid, vec, sizes, *joined = _load(raw)
    cut = np.cumsum(sizes)[:-1]
    return Block(points, rid, vec, list(zip(*(np.split(x, cut) for x in joined), strict=True)) if len(rid) else [])


def _hits(block: Block, known: list[set] | None = None) -> pa.Table:
    """The best of every query, without what was ``known`` before."""
    rows = []
    for i, (score, rid, vec) in enumerate(block.best):
        new = np.array([r not in known[i] for r in rid.tolist()], bool) if known else np.ones(len(rid), bool)
        if new.any():
            rows.append((np.full(new.sum(), block.rid[i]), np.full(new.sum(), block.vec[i]), score[new], rid[new], vec[new]))
    cols = [np.concatenate(c) for c in zip(*rows, strict=True)] if rows else [np.zeros(0, np.int64)] * 5
    return pa.table([pa.array(c, pa.int64()) for c in cols], schema=_HITS)


def _shard(k: int):
    """Build a shard's tree and search it for the shard's own queries: one row with both, and the hits."""
    names = ["dim", "shard", "tree", "block"]

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        dim, shard = (x.as_py() for x in key)
        points = rows.column("v").combine_chunks().flatten().to_numpy().reshape(len(rows), dim)
        rid, vec = rows.column("rid").to_numpy(), rows.column("vec_id").fill_null(0).to_numpy()
        tree = build(points, rid, vec)
        asks = rows.column("asks").to_numpy(zero_copy_only=False)
        block = Block.fresh(points[asks], rid[asks], vec[asks])
        search(tree, block, k)
        found = _hits(block)
        kept = _dump([getattr(tree, f) for f in Tree.__dataclass_fields__])
        row = {"dim": pa.array([dim], pa.int64()), "shard": pa.array([shard], pa.int64()), "tree": pa.array([kept], pa.binary()),
               "block": pa.array([_dump_block(block) if len(block.rid) else None], pa.binary())}
        n = found.num_rows
        hits = {c: pa.chunked_array([pa.nulls(1, pa.int64()), *found.column(c).chunks]) for c in _HITS.names}
        return pa.table({c: pa.chunked_array([row[c], pa.nulls(n, row[c].type)]) for c in names} | hits)
    return run


def _cell(k: int):
    """Blocks of queries against a group of trees; a block's own shard has been searched."""
    def run(blocks: pa.Table, trees: pa.Table) -> pa.Table:
        asked = [(s.as_py(), _load_block(b.as_buffer().to_pybytes())) for s, b in zip(blocks.column("shard"), blocks.column("block"), strict=True)]
        known = [[set(r.tolist()) for _, r, _ in b.best] for _, b in asked]
        for shard, raw in zip(trees.column("shard"), trees.column("tree"), strict=True):
            tree = Tree(*_load(raw.as_buffer().to_pybytes()))
            for own, block in asked:
                if own != shard.as_py():
                    search(tree, block, k)
        found = [_hits(b, seen) for (_, b), seen in zip(asked, known, strict=True)]
        return pa.concat_tables([_HITS.empty_table(), *found])
    return run


def top_k(vectors: DataFrame, asks: Column, k: int = K, scale: float = SCALE, id_col: str = "vec_id",
          vector_col: str = "embedding") -> DataFrame:
    """The ``k`` rows of highest inner product for each row where ``asks`` holds: query_id, rank,
    vec_id, score. See the module docstring."""
    x = F.transform(F.col(vector_col), lambda v: F.lit(float(scale)) * v.cast("double"))
    rows = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), x.alias("x"), F.coalesce(asks, F.lit(False)).alias("asks"),
                          F.monotonically_increasing_id().alias("_at"))
    fits = F.forall("x", lambda v: F.coalesce(F.abs(v) <= MAX_COMPONENT, F.lit(False)))
    rows = rows.filter(F.col("x").isNotNull() & fits).withColumns(
        {"v": F.transform("x", lambda v: F.floor(v).cast("bigint")), "last": F.col("vec_id").isNull()})
    rows = rows.repartitionByRange("last", "vec_id", "_at").sortWithinPartitions("last", "vec_id", "_at")
    rows = materialize(rows.select(F.monotonically_increasing_id().alias("rid"), "vec_id", "asks", "v"), "vectors")
    n, null_from = rows.agg(F.count("*"), F.min(F.when(F.col("vec_id").isNull(), F.col("rid")))).first()

    dim = F.size("v").cast("bigint")
    size = F.greatest(F.lit(MIN_SHARD_ROWS), F.floor(F.lit(SHARD_CELLS) / F.greatest(dim, F.lit(1))))
    dealt = rows.select("rid", "vec_id", "asks", "v", dim.alias("dim"),
                        F.pmod(F.xxhash64("rid"), F.ceil(F.lit(max(n, 1)) / size)).alias("shard"))
    built = materialize(dealt.groupBy("dim", "shard").applyInArrow(_shard(k), f"dim bigint, shard bigint, tree binary, block binary, {_HIT}"),
                        "trees")

    shards = max(1, built.filter("shard IS NOT NULL").count())
    tree_groups = max(math.ceil(shards / CELL_SHARDS), min(shards, SPREAD))
    block_groups = max(math.ceil(shards / CELL_BLOCKS), min(shards, SPREAD))

    def every(groups: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))

    blocks = built.filter("block IS NOT NULL").select("dim", F.expr(f"shard % {block_groups}").cast("int").alias("bg"),
                                                      every(tree_groups).alias("tg"), "shard", "block")
    trees = built.filter("tree IS NOT NULL").select("dim", every(block_groups).alias("bg"),
                                                    F.expr(f"shard % {tree_groups}").cast("int").alias("tg"), "shard", "tree")
    cell = ["dim", "bg", "tg"]
    more = blocks.groupBy(*cell).cogroup(trees.groupBy(*cell)).applyInArrow(_cell(k), _HIT)
    hits = built.filter("qrid IS NOT NULL").select(*_HITS.names).unionByName(more)
    best = Window.partitionBy("qrid").orderBy(F.desc("score"), "rid")
    ranked = hits.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    vec = F.col("vec_id") if null_from is None else F.when(F.col("rid") < null_from, F.col("vec_id"))
    return ranked.select("query_id", "rank", vec.alias("vec_id"), "score")
