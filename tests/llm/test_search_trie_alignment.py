"""KD search, prefix trie and token alignment against brute force, on rows with nulls, ties, repeats,
hot groups and clashing columns."""

import hashlib
import json
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from driftline.llm import kd_search as kd
from driftline.llm import prefix_trie as pt
from driftline.llm import token_alignment as ta

SPACE_WORD = re.compile("[^\x20\x09-\x0D]+")

# ---------------------------------------------------------------- exact top-k

VECTORS = "vec_id bigint, embedding array<float>, rank int, score string, shard int, dim string"


def vector_frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", 2, "x") for i, v in rows], VECTORS)


def brute_top(rows, k=20, every=20):
    ok = [(at, i, [math.floor(64 * np.float64(np.float32(x))) for x in v]) for at, (i, v) in enumerate(rows)
          if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    ok = [r for r in ok if all(abs(x) <= kd.MAX_COMPONENT for x in r[2])]
    out = []
    for at, q, x in ok:
        if q is None or q % every:
            continue
        found = [(-sum(a * b for a, b in zip(x, y)), j is None, j, other) for other, j, y in ok if other != at and len(y) == len(x)]
        found.sort(key=lambda f: (f[0], f[1], f[2] or 0))
        out += [(q, n + 1, f[2], -f[0]) for n, f in enumerate(found[:k])]
    return Counter(out)


def got_top(df):
    return Counter(tuple(r) for r in df.select("query_id", "rank", "vec_id", "score").collect())


@pytest.fixture(scope="module")
def mixed_vectors():
    rng = random.Random(5)
    point = lambda n: [rng.gauss(0, 0.3) for _ in range(n)]
    hot = point(6)
    rows = [(i, point(6)) for i in range(900)] + [(i, hot) for i in range(900, 1400)]
    rows += [(40, point(6)), (40, hot), (None, hot), (None, point(6)), (-20, point(6)), (2000, point(3)), (2001, point(3)), (2020, []), (2040, [])]
    rows += [(2060, None), (2080, [0.1, None, 0.2]), (2100, [float("nan")] * 6), (2120, [float("inf")] + [0.0] * 5), (2140, [1e30] * 6),
             (2160, [-0.001] * 6), (2180, [4000.5] * 6)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("parts", [1, 7])
def test_top_k_equals_brute_force(spark, mixed_vectors, parts):
    got = got_top(kd.top_k(vector_frame(spark, mixed_vectors).repartition(parts), F.col("vec_id") % 20 == 0))
    assert got == brute_top(mixed_vectors)


def test_top_k_fewer_rows_than_k(spark):
    rows = [(0, [1.0, 2.0]), (1, [0.5, -0.5]), (20, [-1.0, 0.0])]
    assert got_top(kd.top_k(vector_frame(spark, rows), F.col("vec_id") % 20 == 0)) == brute_top(rows)
    assert got_top(kd.top_k(vector_frame(spark, []), F.col("vec_id") % 20 == 0)) == Counter()


def test_bounds_leave_out_nodes_but_no_neighbour():
    rng = np.random.default_rng(1)
    points = rng.integers(-100, 100, (4000, 3))
    rid = rng.permutation(4000).astype(np.int64)
    tree = kd.build(points, rid, rid)
    assert (tree.end - tree.start)[tree.left < 0].max() <= kd.LEAF_ROWS
    for node in range(len(tree.start)):
        inside = tree.points[tree.start[node]:tree.end[node]]
        assert (inside.min(axis=0) == tree.lo[node]).all() and (inside.max(axis=0) == tree.hi[node]).all()
    scored = []

    class Watched(np.ndarray):
        def __getitem__(self, rows):
            if isinstance(rows, slice):
                scored.append(rows)
            return super().__getitem__(rows)

    block = kd.Block.fresh(points[:1], rid[:1], rid[:1])
    tree.rid = tree.rid.view(Watched)
    kd.search(tree, block, 5)
    want = sorted((-int(points[0] @ p), int(r)) for p, r in zip(points, rid) if r != rid[0])[:5]
    assert [(-int(s), int(r)) for s, r in zip(block.best[0][0], block.best[0][1])] == want
    assert len(scored) < (tree.left < 0).sum() / 4  # most leaves are never scored


def test_large_components_stay_exact():
    points = np.array([[kd.MAX_COMPONENT, kd.MAX_COMPONENT - 1], [kd.MAX_COMPONENT - 3, 5], [-kd.MAX_COMPONENT, 7]], np.int64)
    rid = np.arange(3)
    block = kd.Block.fresh(points, rid, rid)
    kd.search(kd.build(points, rid, rid), block, 2)
    for i, (score, other, _) in enumerate(block.best):
        want = sorted(((-int(points[i].astype(object) @ points[j].astype(object)), j) for j in range(3) if j != i))
        assert list(zip((-score).tolist(), other.tolist())) == want


# ---------------------------------------------------------------- prefix trie

TURNS = "conv_id bigint, turn bigint, role string, text string, key string, n int, ids string, words int"


def turn_frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "x", 2) for r in rows], TURNS)


def brute_trie(rows):
    """Nodes by definition; rows of one conversation have distinct turns (ties go by a hash)."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [t[1:] for t in sorted(ts)] for c, ts in own.items()}
    seq = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        seq[c] = tuple(own.get(c - int(math.fmod(c, 20)), [])[:h] + ts[h:])
    members, ends = defaultdict(list), defaultdict(list)
    for c, s in sorted(seq.items()):
        ends[s].append(c)
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
    kids = defaultdict(set)
    for s in members:
        if s:
            kids[s[:-1]].add(s)
    leaves, saved = Counter(), Counter()
    for s, cs in members.items():
        words = len(SPACE_WORD.findall(s[-1][1])) if s else 0
        for d in range(len(s) + 1):
            leaves[s[:d]] += not kids[s]
            saved[s[:d]] += (len(cs) - 1) * words
    return Counter((cs[0], len(s), members[s[:-1]][0] if s else None, len(cs), len(kids[s]), leaves[s], saved[s],
                    hashlib.sha256(",".join(map(str, ends.get(s, []))).encode()).hexdigest()) for s, cs in members.items())


def got_trie(df):
    return Counter(tuple(r) for r in df.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                                               "saved_tokens", "ends_sha256").collect())


@pytest.fixture(scope="module")
def mixed_turns():
    rng = random.Random(3)
    texts = ["", None, "one", "two words", "three whole words", "tab\tand\nline", "x" * 5000]
    rows = []
    for c in [*range(400), -7, -20, -41, 10**12]:
        if c == 60:
            continue  # 61..79 have no base
        for t in range(rng.choice([1, 1, 2, 3, 5, 9])):
            rows.append((c, t if t else None, rng.choice(["user", "assistant", None]), rng.choice(texts)))
    for c in range(1000, 1300):  # one conversation, many times
        rows += [(c, t, "user", f"same {t}") for t in range(6)]
    rows += [(2000, t, "user", f"long {t}") for t in range(300)] + [(2021, t, "user", f"long {t}") for t in range(310)]
    rows += [(None, 1, "user", "no conversation"), (3000, None, None, None)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("cells,parts", [(1 << 18, 8), (1, 3), (64, 40)])
def test_trie_equals_brute_force(spark, mixed_turns, cells, parts, monkeypatch):
    """Also where every conversation is a chunk of its own, and with more shards than cores."""
    def shards(batches, run=pt._shards, cells=cells):
        pt.CELLS = cells
        return run(batches)

    monkeypatch.setattr(pt, "_shards", shards)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert got_trie(pt.conversation_trie(turn_frame(spark, mixed_turns))) == brute_trie(mixed_turns)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_trie_of_empty_and_single(spark):
    assert got_trie(pt.conversation_trie(turn_frame(spark, []))) == Counter()
    assert got_trie(pt.conversation_trie(turn_frame(spark, [(None, 0, "user", "a")]))) == Counter()
    rows = [(3, 0, "user", "a b")]
    assert got_trie(pt.conversation_trie(turn_frame(spark, rows))) == brute_trie(rows)
    alike = [(c, t, None, "same words here") for c in (20, 21, 22, 23, 24, 39) for t in (0, 1)]
    assert got_trie(pt.conversation_trie(turn_frame(spark, alike))) == brute_trie(alike)


def test_tied_turns_do_not_depend_on_the_partitions(spark):
    rows = [(c, 0, "user", f"t{i}") for c in (0, 20, 40) for i in range(5)] * 2
    one, two = (got_trie(pt.conversation_trie(turn_frame(spark, rows).repartition(n))) for n in (1, 9))
    assert one == two


# ---------------------------------------------------------------- token alignment

DOCS = "doc_id bigint, text string, chunk int, tkey string, pair bigint, copies int"
BASE = "The quick brown fox — naïve façade; 東京 and 12345 + tokens, tokens everywhere."


def brute_alignment(rows):
    from tokenizers import Tokenizer
    import sentencepiece

    tok = Tokenizer.from_file(f"{ta.TOKENIZER_DIR}/{ta.BYTE_BPE}")
    tok.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=f"{ta.TOKENIZER_DIR}/{ta.PIECE_BPE}")
    alphabet = ta.byte_alphabet()

    def spans(parts):
        at, out = 0, []
        for i, raw in parts:
            out.append((i, at, at + len(raw)))
            at += len(raw)
        return out

    docs, held = [], Counter()
    for doc, text in rows:
        a = b = []
        if text:
            ids = tok.encode(" " + text, add_special_tokens=False).ids
            pa_ = [(i, bytes(alphabet[c] for c in tok.id_to_token(i))) for i in ids]
            pb = [(i, bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode())
                  for i in sp.encode(text)]
            want = (" " + text).encode()
            if b"".join(x for _, x in pa_) == want == b"".join(x for _, x in pb):
                a, b = spans(pa_), spans(pb)
        links = [(i, j) for i, s, e in a for j, s2, e2 in b if s < e2 and s2 < e]
        both = {e for _, _, e in a} & {e for _, _, e in b}
        groups, lo = [], 0
        for hi in sorted(both):
            groups.append(",".join(str(i) for i, _, e in a if lo < e <= hi) + "|" + ",".join(str(i) for i, _, e in b if lo < e <= hi))
            lo = hi
        docs.append((doc, len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""))
        held.update(set(links))
    top = Counter()
    for (i, _), n in held.items():
        top[i] = max(top[i], n)
    return Counter((doc, na, nb, ng, len(links), sum(held[x] == top[x[0]] for x in links), sum(held[x] for x in links), sha)
                   for doc, na, nb, ng, links, sha in docs), held


@pytest.fixture(scope="module")
def mixed_docs():
    rng = random.Random(2)
    words = "alpha beta naïve 東京 data🙂 tokenizer <|endoftext|> <s> <0x41> \n\n x9 ++ don't ÀÉ the a of".split(" ")
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 60))) for _ in range(60)]
    texts += [None, "", " ", "\n", "a", "two  spaces", "trailing ", "▁", "ﬁ ligature ①", "\u0000nul", "x" * 3000, "\t", "é", BASE, "é combining"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(1000 + i, BASE) for i in range(200)]
    return rows + [(7, texts[7]), (7, "another"), (None, BASE), (None, None)]


@pytest.mark.parametrize("chunk", [1 << 21, 200])
def test_alignment_equals_brute_force(spark, mixed_docs, chunk, monkeypatch):
    def chunks(batches, run=ta._chunks, chunk=chunk):
        ta.CHUNK_BYTES = chunk
        return run(batches)

    monkeypatch.setattr(ta, "_chunks", chunks)
    want, held = brute_alignment(mixed_docs)
    out = ta.align_corpus(spark.createDataFrame([(i, t, 1, "x", 2, 3) for i, t in mixed_docs], DOCS))
    got = Counter(tuple(r) for r in out.measures.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                                                        "groups_sha256").collect())
    assert got == want
    pairs = {(r.a_id, r.b_id): (r.docs, r.best) for r in out.pairs.collect()}
    assert {k: n for k, (n, _) in pairs.items()} == dict(held)


def test_both_encoders_of_a_byte_level_file_agree():
    """On every character in a few surroundings, on long runs, and on a file that is not plain."""
    from tokenizers import Tokenizer

    with open(f"{ta.TOKENIZER_DIR}/{ta.BYTE_BPE}", "rb") as f:
        raw = f.read()
    tok = Tokenizer.from_file(f"{ta.TOKENIZER_DIR}/{ta.BYTE_BPE}")
    tok.encode_special_tokens = True
    fast = ta.byte_level(raw)
    chars = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for lo in range(0, len(chars), 1 << 16):
        texts = ["".join(f"a{c}1{c} {c}  {c}.\n" for c in chars[i:i + 64]) for i in range(lo, min(lo + (1 << 16), len(chars)), 64)]
        assert fast.encode(texts) == [e.ids for e in tok.encode_batch([" " + t for t in texts], add_special_tokens=False)]
    long = [" " * 2_000_000, "ab" * 50_000, "x" + "\n" * 30_000 + "y", "<|endoftext|>" * 3]
    assert fast.encode(long) == [tok.encode(" " + t, add_special_tokens=False).ids for t in long]
    spec = json.loads(raw)
    entries = fast.entries
    assert ta._plain_encoder(spec, entries) is not None
    spec["model"]["merges"] = spec["model"]["merges"][::-1]
    assert ta._plain_encoder(spec, entries) is None


def test_alignment_of_no_tokens(spark):
    empty = spark.createDataFrame([], DOCS)
    assert ta.align_corpus(empty).measures.count() == 0
    none = ta.align_corpus(spark.createDataFrame([(1, None, 1, "x", 2, 3), (2, "", 1, "x", 2, 3)], DOCS)).measures
    assert sorted(tuple(r) for r in none.collect()) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]
