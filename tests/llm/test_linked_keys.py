"""Linked sets keep a common key when no other set shows their keys."""

import numpy as np
import pyarrow as pa
import pytest

from driftline.llm import jaccard_join as jj


def test_pairs_alone_in_their_band_keep_a_common_key(spark):
    rng = np.random.default_rng(7)
    keys, vertices, spares, pairs = [], [], [], 0
    for small, large in ((4, 5), (6, 7), (12, 15), (16, 20)):
        for _ in range(500):
            big = np.unique(rng.integers(0, 2**63, large, dtype=np.int64).astype(np.uint64))
            starts = jj.band_starts(large)
            alone = np.uint64(int(rng.integers(1, 2**62)) << 1)  # moves the keys of this pair away from all others
            for side, s in enumerate((big, np.sort(rng.permutation(big)[:small]))):
                k, spare = jj.block_keys(s, starts)
                keys.append(k ^ alone)
                vertices.append(np.full(len(k), 2 * pairs + side))
                spares.append(spare)
            pairs += 1
    rows = pa.table({"key": np.concatenate(keys).view(np.int64), "vertex": np.concatenate(vertices), "spare": np.concatenate(spares)})
    chosen = jj.chosen_keys(spark.createDataFrame(rows)).selectExpr("vertex div 2 AS pair").distinct()
    assert chosen.count() == pairs


def test_linked_sets_share_a_key_of_the_second_layout(spark):
    """Pairs at the limit of similarity, each alone, so that only the pigeonhole can help them."""
    rng = np.random.default_rng(11)
    keys, vertices, spares, pairs = [], [], [], 0
    for small, large in ((4, 5), (8, 10), (40, 50), (52, 60), (96, 120), (300, 360)):
        for _ in range(60):
            union = np.unique(rng.integers(0, 2**63, 4 * large, dtype=np.int64).astype(np.uint64))
            both = -(-4 * (large + small) // 9)  # the fewest shared items that link these sizes
            a, b = union[:large], np.concatenate([union[:min(both, small)], union[large:large + small - min(both, small)]])
            assert 5 * len(np.intersect1d(a, b)) >= 4 * len(np.union1d(a, b))
            starts = jj.band_starts(large, jj.FINE_RATIO)
            alone = np.uint64(int(rng.integers(1, 2**62)) << 1)
            for side, s in enumerate((a, np.sort(b))):
                k, spare = jj.block_keys(np.sort(s), starts, fine=True)
                keys.append(k ^ alone)
                vertices.append(np.full(len(k), 2 * pairs + side))
                spares.append(spare)
            pairs += 1
    rows = pa.table({"key": np.concatenate(keys).view(np.int64), "vertex": np.concatenate(vertices), "spare": np.concatenate(spares)})
    assert jj.chosen_keys(spark.createDataFrame(rows), jj.FINE_SLOTS).selectExpr("vertex div 2 AS pair").distinct().count() == pairs


def _template_group(k, seed=0, own=250, shared=600):
    rng = np.random.default_rng(seed)
    word = lambda n: [f"w{x}" for x in rng.integers(0, 10**9, n)]
    template = word(shared)
    return [(i, " ".join(template + word(own))) for i in range(k)]


def _candidates(spark, docs, monkeypatch):
    """Pairs that are enumerated for these documents, and their groups."""
    seen = []
    monkeypatch.setattr(jj, "open_pairs", lambda *a, f=jj_open_pairs: (seen.append(f(*a).cache()), seen[-1])[1])
    groups = {r["doc_id"]: r["component_id"] for r in jj.jaccard_groups(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    return seen[0].count(), groups


jj_open_pairs = jj.open_pairs


def test_a_shared_template_does_not_make_all_pairs(spark, monkeypatch):
    counts = {}
    for k in (100, 200, 400):
        n, groups = _candidates(spark, _template_group(k), monkeypatch)
        assert all(groups[i] == i for i in range(k))
        counts[k] = n
    assert counts[400] <= 400 and counts[400] <= 5 * max(counts[200], 20), counts


@pytest.mark.parametrize("comparisons", [jj.COMPARISONS, 1, 0])
def test_links_inside_a_crowd_are_found(spark, monkeypatch, comparisons):
    """Among 120 documents of one template, some are near copies of each other: brute force beside it,
    whether few or all sets count as crowded."""
    monkeypatch.setattr(jj, "COMPARISONS", comparisons)
    rng = np.random.default_rng(4)
    docs = _template_group(120, 3, own=300)
    for i in range(0, 60, 2):  # every second one is followed by an edited copy
        words = docs[i][1].split(" ")
        for at in rng.choice(len(words), int(rng.integers(2, 22)), replace=False):
            words[at] = f"edit{i}_{at}"
        docs[i + 1] = (i + 1, " ".join(words))
    sets = {}
    for i, t in docs:
        w = t.split(" ")
        sets[i] = {tuple(w[j:j + 5]) for j in range(len(w) - 4)}
    low = {i: i for i in sets}
    links = [(i, j) for i in sets for j in sets if i < j and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])]
    for i, j in links:
        root = min(low[i], low[j])
        low = {x: root if r in (low[i], low[j]) else r for x, r in low.items()}
    n, groups = _candidates(spark, docs, monkeypatch)
    assert groups == low and 10 < len(links) < 60 and n < 1000
