"""N-gram Jaccard join and line dedup against brute force."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from driftline.llm import jaccard_join as jj
from driftline.llm import line_dedup as ld
from driftline.llm.text import text_chunks

SPACE_WORD = re.compile("[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, vertex string, key int, n_shingles string"


def rows(pairs):
    return [(i, t, "en", "s", len(t or ""), "clash", 7, "clash") for i, t in pairs]


def shingles(text):
    w = SPACE_WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()


def brute_components(pairs):
    sets = [(i, shingles(t)) for i, t in pairs]
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                parent[find(a)] = find(b)
    out = []
    for k, (i, s) in enumerate(sets):
        ids = [j for m, (j, t) in enumerate(sets) if t and find(m) == find(k) and j is not None]
        out.append((i, len(s), (min(ids) if ids else None) if s else i))
    return sorted(out, key=str)


def family(rng, words, n, edits):
    base = [rng.choice(words) for _ in range(n)]
    out = [" ".join(base)]
    for _ in range(6):
        w = list(base)
        for _ in range(edits):
            w[rng.randrange(n)] = rng.choice(words)
        out.append(" ".join(w))
    return out


@pytest.fixture(scope="module")
def documents():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    texts = []
    for n, edits in ((5, 1), (9, 1), (30, 1), (60, 2), (120, 3), (400, 9), (900, 18), (900, 30)):
        texts += family(rng, words, n, edits)
    passage = " ".join(rng.choice(words) for _ in range(60))
    texts += [passage + " " + " ".join(rng.choice(words) for _ in range(12 + i)) for i in range(12)]
    texts += ["a b c d", "A  b\tc\nd", "a b c", "x", "X", "", " \n", None, "É b c d e f", "é b c d e f"]
    texts += [" ".join(f"t{i}" for i in range(3000))] * 2 + ["la " * 500, "la " * 400]
    pairs = [(i * 3 % 1009, t) for i, t in enumerate(texts)]
    return pairs + [pairs[20], pairs[20], (None, pairs[8][1]), (None, "only here and null"), (pairs[0][0], "same id other text")]


def test_jaccard_matches_brute_force(spark, documents):
    got = jj.jaccard_groups(spark.createDataFrame(rows(documents), SCHEMA)).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_components(documents)


def test_one_document_of_each_group_stays(spark, documents):
    kept = jj.keep_one_per_group(spark.createDataFrame(rows(documents), SCHEMA))
    assert kept.columns == [c.split()[0] for c in SCHEMA.split(", ")]
    kept = kept.collect()
    expected = brute_components(documents)
    assert sum(1 for r in kept if shingles(r.text)) == len({(c, n if c is None else 0) for _, n, c in expected if n})
    assert sum(1 for r in kept if not shingles(r.text)) == sum(1 for _, n, _ in expected if not n)
    empty = spark.createDataFrame([], SCHEMA)
    assert jj.keep_one_per_group(empty).count() == 0


def test_blocks_meet_for_every_linked_pair():
    """Pigeonhole: sets at the limit share a key, whatever their sizes and bands."""
    rng = np.random.default_rng(1)
    for n in [*range(1, 40), 57, 63, 64, 65, 101, 256, 411, 1000]:
        for _ in range(6):
            pool = rng.integers(0, 2**63, 3 * n + 9, dtype=np.int64).astype(np.uint64)
            a = np.unique(pool[:n])
            gone = rng.integers(0, n // 5 + 1)
            b = np.unique(np.concatenate([a[gone:], pool[n:n + rng.integers(0, n // 4 + 1)]]))
            both = len(np.intersect1d(a, b))
            if 100 * both >= 80 * (len(a) + len(b) - both) and len(a) != both or len(b) != both and 100 * both >= 80 * (len(a) + len(b) - both):
                starts = jj.band_starts(max(len(a), len(b)))
                (ka, sa), (kb, sb) = jj.block_keys(a, starts), jj.block_keys(b, starts)
                for seed in (1, 2):  # whatever the order of the keys, with empty blocks last, a first one is common
                    def first(keys, spare, seed=seed):
                        out = set()
                        for slot in (0, 1):
                            k = sorted(keys[spare % 2 == slot].tolist(), key=lambda x: (x % 2, hash((x, seed))))
                            out |= set(k[:len(k) - int(spare[spare % 2 == slot][0]) // 2] if k else [])
                        return out
                    assert first(ka, sa) & first(kb, sb)
                ham = int(np.bitwise_count((jj.parity_bits(a) ^ jj.parity_bits(b)).view(np.uint64)).sum())
                assert ham <= jj.max_difference(len(a) + len(b))


# ---------------------------------------------------------------- line dedup

def brute_lines(text):
    parts = re.split(r"(?<=\n)|(?<=[.!?] )", text or "")
    out = []
    for p in parts:
        if SPACE_WORD.search(p) or not out:
            out.append(p)
        else:
            out[-1] += p
    if len(out) > 1 and not SPACE_WORD.search(out[0]):
        out[:2] = [out[0] + out[1]]
    return out if out and SPACE_WORD.search(out[0]) else []


def brute_dedup(pairs, least):
    """Text of each document after cutting every line that lies in an earlier run of ``least`` words."""
    docs = sorted({(i is None, i or 0, t) for i, t in pairs if t is not None}, key=lambda d: d[:2])
    lines = [brute_lines(t) for *_, t in docs]
    words = [[tuple(SPACE_WORD.findall(u)) for u in u_] for u_ in lines]
    seen, drop = {}, [set() for _ in docs]
    for d, ws in enumerate(words):
        for a in range(len(ws)):
            for b in range(a + 1, len(ws) + 1):
                if sum(map(len, ws[a:b])) >= least:
                    if (first := seen.setdefault(tuple(ws[a:b]), (d, a))) < (d, a):
                        drop[d].update(range(a, b))
    return {(None if n else i, t): "".join(u for k, u in enumerate(us) if k not in g) if us else t
            for (n, i, t), us, g in zip(docs, lines, drop, strict=True)}


def test_line_dedup_matches_brute_force(spark):
    rng = random.Random(2)
    pool = [" ".join(rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(rng.randint(1, 9))) + rng.choice([". ", "\n", "! ", " \n\n"])
            for _ in range(40)]
    pairs = [(i, "".join(rng.choice(pool) for _ in range(rng.randint(1, 25)))) for i in range(60)]
    run = "".join(pool[:9])
    pairs += [(100 + i, f"own start number {i}.\n{run}own end {i} too.") for i in range(5)]
    pairs += [(200, run), (200, run), (201, "é. " + run.strip()), (202, ""), (203, None), (204, " \n "), (None, run), (205, (pool[3] + "\n") * 30)]
    docs = spark.createDataFrame(rows(pairs), SCHEMA)
    got = ld.dedup_lines(docs, 12).select("_row.doc_id", "_row.text", "new_text").collect()
    expected = brute_dedup(pairs, 12)
    assert len(got) == len(pairs)
    for r in got:
        assert r.new_text == (expected[r.doc_id, r.text] if r.text is not None else None), r.doc_id
    kept = ld.without_repeats(docs, 12)
    assert kept.columns == docs.columns
    kept = {(r.doc_id, r.text) for r in kept.collect()}
    assert (203, None) in kept and (202, "") in kept and not any(i == 101 and "own end 1" not in t for i, t in kept if t)
    assert 200 not in {i for i, _ in kept} and ld.dedup_lines(spark.createDataFrame([], SCHEMA)).count() == 0


def test_windows_and_fingerprints():
    rng = random.Random(3)
    texts = [" ".join(rng.choice(["a", "b.", "c!", "d\n", "é.", "\n\n", "f?"]) for _ in range(rng.randint(0, 40))) for _ in range(120)]
    texts += [None, "", " ", "\n", "x"]
    for lo, hi, data, off in text_chunks(pa.array(texts)):
        x = ld.Lines(data, off)
        for i in range(hi - lo):
            expected = brute_lines(texts[lo + i])
            assert x.first[i + 1] - x.first[i] == len(expected)
        start, end, at = x.windows(7)
        for a, b, m in zip(start, end, at, strict=True):
            assert x.words[b] - x.words[a] >= 7 and x.a[m] == x.a[a:b].min() and x.owner[a] == x.owner[b - 1]
