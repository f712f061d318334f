"""Mixing, archives, quality model and language id on small fixtures."""

import zlib

import numpy as np
import pytest

from driftline.llm import language_id as li
from driftline.llm import mixing as mx
from driftline.llm import quality_model as qm
from driftline.llm import warc

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, k string, size string, copies int, taken int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, len(t or ""), "x", "x", 5, 6) for i, t, lang, s in rows], DOCS)


# ---------------------------------------------------------------- mixing

def brute_targets(sizes):
    """Share 150 % by weight, cap at twice the size, share the excess again until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    total, capped = 1.5 * sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in capped]
        rest = total - sum(2 * sizes[s] for s in capped)
        share = rest / sum(weight[s] for s in free) if free else 0
        over = {s for s in free if share * weight[s] > 2 * sizes[s]}
        if not over:
            return {s: 2.0 * sizes[s] if s in capped else share * weight[s] for s in names}
        capped |= over


def test_mix_meets_targets(spark):
    rng = np.random.default_rng(4)
    rows = [(i, " ".join(["w"] * int(n)), "en", f"s{i % 7}") for i, n in enumerate(rng.integers(0, 60, 2000))]
    rows += [(5000 + i, "same text here", "en", "s1") for i in range(900)] + [(6000, None, "en", "empty"), (6001, "", "en", None), (6002, "a b c", "en", None)]
    rows += [rows[10], rows[10], (None, "no id at all", "en", "é"), (7000, " ".join(["v"] * 50), "en", "Z")]
    plan = mx.mix_plan(frame(spark, rows))
    got = plan.collect()
    assert len(got) == len(rows)
    sizes, taken, target = {}, {}, {}
    source = {(i, len((t or "").split())): s for i, t, _, s in rows}
    for r in got:
        s = source[r.doc_id, r.size]
        sizes[s], taken[s], target[s] = sizes.get(s, 0) + r.size, taken.get(s, 0) + r.taken, r.target
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 2 and (r.size > 0 or r.copies == 0)
    expected = brute_targets(sizes)
    for s in sizes:
        assert target[s] == pytest.approx(expected[s]) and abs(taken[s] - target[s]) <= 60
    assert sorted(map(str, got)) == sorted(map(str, mx.mix_plan(frame(spark, rows)).collect()))
    assert mx.mix_plan(frame(spark, [])).count() == 0
    out = mx.mix(frame(spark, rows))
    assert out.columns == [*frame(spark, []).columns, "_copies", "_taken", "target"]  # copies and taken of the caller stay
    assert all(r.text for r in out.collect())


# ---------------------------------------------------------------- archives

PAGES = [(1, "http://a/", "short"), (2, "http://b/", "short"), (3, "http://c/\r\nx", "é" * 60), (4, None, "é" * 60), (5, "u", None), (6, "u", ""),
         (7, "u", "<p>WARC/1.1\r\n\r\nContent-Length: 5\r\n\r\n" * 40), (8, "u", "long text " * 9000), (2, "u", "long text " * 9000), (9, "u", "long text " * 9000),
         (9, "u", "long text " * 9000), (None, "u", "z" * 200), (10, "u", "z" * 200), (11, "u", "0\r\n\r\n" * 3000)]


def test_archives_round_trip(spark, tmp_path):
    pages = spark.createDataFrame([(i, u, h, "x") for i, u, h in PAGES], "page_id bigint, url string, html string, digest string")
    got = warc.roundtrip(pages).collect()
    import hashlib
    expected = []
    for i, _, h in PAGES:
        body = (h or "").encode()
        same = [j for j, _, g in PAGES if (g or "") == (h or "") and j is not None]
        again = len(body) >= 100 and bool(same) and (i is None or min(same) < i)
        expected.append((i, len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response", min(same) if again else None, True))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, expected))
    assert warc.roundtrip(pages.limit(0)).count() == 0
    path = str(tmp_path / "w")
    warc.write_archives(pages, path)
    records = {(r.page_id, r.record_type): r for r in warc.read_archives(spark, path).collect()}
    assert bytes(records[7, "response"].payload).decode() == PAGES[6][2] and records[3, "response"].url == "http://c/x"


def test_damaged_segments_are_not_complete(spark, tmp_path):
    import gzip
    parts = list(warc.page_records("urn:page:1", 1, "u", b"y" * 50_000, "d", None))
    assert len(parts) > 3
    folder = tmp_path / "bad"
    folder.mkdir()
    for name, kept in (("gap", parts[:1] + parts[2:]), ("order", parts[::-1])):
        with gzip.open(folder / f"{name}.txt.gz", "wb") as f:
            f.write(b"".join(p.replace(b"urn:page:1", b"urn:page:" + name.encode()) + b"\r\n\r\n" for p in kept))
    got = sorted((r.payload_bytes or -1) for r in warc.read_archives(spark, str(folder)).collect())
    assert got == [-1, 50_000]
    assert warc.dechunk(warc.chunked(b"abc" * 5000)) == b"abc" * 5000 and warc.dechunk(b"5\r\nab") is None


# ---------------------------------------------------------------- quality model

def test_quality_model_learns_and_ignores_the_held_out_fold(spark):
    rng = np.random.default_rng(7)
    rows, labels = [], []
    for i in range(900):
        good = i % 3 != 0
        words = rng.choice(["the", "house", "of", "river", "and", "stone", "light."], 40) if good else rng.choice(["x#$", "%%%", "AAA!!", "|"], 40)
        rows.append((i, " ".join(words), "en", "s"))
        held = zlib.crc32(str(i).encode()) % 5 == 0
        labels.append((i, int(good) if not held else int(not good), 0))  # held-out labels lie
    rows += [(2000, None, "en", "s"), (2001, "", "en", "s"), (None, "the house", "en", "s"), (0, "another text of doc 0", "en", "s")]
    table = spark.createDataFrame([*labels, (None, 1, 0), (1, None, 0), (99999, 0, 0)], "doc_id bigint, quality int, toxic int")
    got = qm.score_quality(frame(spark, rows), table).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    for r in got:
        if r.doc_id is not None:
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    score = {}
    for r in got:
        if r.doc_id is not None and 0 < r.doc_id < 900:
            score[r.doc_id] = r.score
    held = [i for i in score if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([(score[i] > 0.5) == (i % 3 != 0) for i in held]) > 0.95
    none = qm.score_quality(frame(spark, rows[:3]), table.limit(0)).collect()
    assert [r.score for r in none] == [0.5] * 3
    assert qm.score_quality(frame(spark, []), table).count() == 0


def test_trees_fit_a_known_function():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 4))
    y = ((x[:, 0] > 0.3) ^ (x[:, 2] < -0.2)).astype(float)
    trees = qm.fit(x, y)
    assert np.mean((trees.score(x) > 0.5) == y) > 0.97 and trees.feature.shape == (qm.TREES, 2 ** (qm.DEPTH + 1) - 1)


# ---------------------------------------------------------------- language id

def test_language_evidence(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    held = docs.filter("doc_id % 2 = 0 AND length(text) > 200").selectExpr(
        "doc_id AS page_id", "concat('http://www.', lang, '-site.example.', if(lang = 'de', 'org', 'net'), '/x') AS url",
        "concat('<html lang=\"', if(doc_id % 4 = 0, lang, 'xx'), '\"><script>var the = 1</script><p>', text, '</p>') AS html", "lang AS truth")
    train = docs.filter("doc_id % 2 <> 0")
    got = li.identify(held, train).join(held.select("page_id", "truth"), "page_id").collect()
    assert np.mean([r.language == r.truth for r in got]) > 0.95
    # a page without text follows its host and its declaration
    extra = spark.createDataFrame([(-1, "http://www.de-site.example.org/y", "", "de"), (-2, None, None, None), (-3, "http://new.example.net", "<html lang=fr>", "fr"),
                                   (-1, "http://www.de-site.example.org/y", "", "de")], "page_id bigint, url string, html string, truth string")
    got = li.identify(held.unionByName(extra), train).filter("page_id < 0").collect()
    by_id = {r.page_id: r for r in got}
    assert len(got) == 4 and by_id[-1].language == "de" and by_id[-3].language == "fr" and by_id[-1].n_grams == 0 and by_id[-1].text_language is None
    assert li.identify(held.limit(0), train).count() == 0
    assert {r.language for r in li.identify(extra, train.limit(0)).collect()} == {None}
