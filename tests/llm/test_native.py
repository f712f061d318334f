"""Native operators on a fixture with nulls, empty and long texts, ties, repeated rows and clashing columns."""

import hashlib
import re
from collections import Counter

import pytest

from driftline.llm import decontamination as dc
from driftline.llm import license_scan as ls
from driftline.llm import quality_rules as qr
from driftline.llm import url_filter as uf

SPACE_WORD = re.compile("[^\x20\x09-\x0D]+")
ALNUM_WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, h string, n_words string, kept string, w int"


def frame(spark, texts, langs=None):
    return spark.createDataFrame([(i, t, (langs or {}).get(i, "en"), "s", len(t or ""), "x", "x", "x", 1) for i, t in texts], SCHEMA)


# ---------------------------------------------------------------- decontamination

ITEMS = [(1, " ".join(f"q{i}" for i in range(20))), (2, "Short item, ÉTÉ one!"), (3, "Q3 q4 q5 Q6 q7 q8 q9 q10 q11 q12 q13 q14 q15 other tail"),
         (4, ""), (5, None), (None, "nobody lists this"), (10, "short item été one"), (2, "second row of two")]
TEXTS = [(0, "lead " + " ".join(f"Q{i}," for i in range(2, 17)) + " tail"), (1, "a short ITEM: ÉTÉ one short item été one b"), (2, None), (3, ""),
         (4, " ".join(f"q{i}" for i in range(12))), (5, "x " * 3000 + " ".join(f"q{i}" for i in range(20)) + " y" * 3000), (6, "nobody lists this"),
         (6, "nobody lists this"), (7, "short item étÉ one"), (7, "another text"), (None, "second row of two"), (8, "short item Été one")]


def brute_contamination(texts, items):
    windows = {}
    for item, t in items:
        w = ALNUM_WORD.findall((t or "").translate(LOWER))
        n = min(13, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[i:i + n]), set()).add(item)
    out = []
    for doc, t in texts:
        w, hit, found = ALNUM_WORD.findall((t or "").translate(LOWER)), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if ids := windows.get(tuple(w[i:i + n])):
                    hit |= set(range(i, i + n))
                    found |= ids
        out.append((doc, len(w), len(hit), len(found), sorted(str(i) for i in found if i is not None), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(i, t, "x") for i, t in ITEMS], "item_id bigint, text string, len string")


def test_contamination_matches_brute_force(spark, items):
    got = dc.contamination(frame(spark, TEXTS), items)
    got = got.select("doc_id", "n_words", "n_hit", "n_items", "items", "contaminated").collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_contamination(TEXTS, ITEMS)


def test_contaminated_documents_and_spans_go(spark, items):
    docs = frame(spark, TEXTS)
    bad = {(d, n) for d, n, *_, c in brute_contamination(TEXTS, ITEMS) if c}
    kept = dc.drop_contaminated(docs, items)
    assert kept.columns == docs.columns
    assert len(kept.collect()) == sum((d, len(ALNUM_WORD.findall(t or ""))) not in bad for d, t in TEXTS)
    cut = {(r.doc_id, r.text) for r in dc.remove_spans(docs, items).collect()}
    assert (1, "a b") in cut and (2, None) in cut and (7, "another text") in cut
    assert dc.drop_contaminated(docs, items.limit(0)).count() == len(TEXTS)
    assert dc.drop_contaminated(docs.limit(0), items).count() == 0


def test_repeated_rows_gather_their_hits_once(spark, items):
    once = sorted(map(str, dc.find_hits(frame(spark, TEXTS[:2]), items).collect()))
    assert once and sorted(map(str, dc.find_hits(frame(spark, TEXTS[:2] * 5), items).collect())) == once


# ---------------------------------------------------------------- quality rules

def brute_quality(text):
    t = text or ""
    w = SPACE_WORD.findall(t)
    tri = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    hit = {j for i in range(len(w) - 2) if tri[tuple(w[i:i + 3])] > 1 for j in range(i, i + 3)}
    lines = [x for x in t.split("\n") if SPACE_WORD.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(hit),
            len(w) < 50 or 100 * len(hit) > 50 * len(w))


def test_quality_counts_and_verdicts(spark):
    clean = " ".join(f"the word{i % 97} of letters{i} and more{i % 13} to it{i}." for i in range(60))
    texts = [(i, f"start {i} " + clean) for i in range(30)]
    texts += [(100, None), (101, ""), (102, " \n "), (103, "a b c " * 40), (104, "x\n\ny\nx\n x\n"), (105, " ".join(f"#{i}|$$%&*" for i in range(300))),
              (106, "É\x0bé\x0cè " * 30), (107, "word " * 60), (108, " ".join(f"of thing{i} and the part{i} to page{i}." for i in range(4000))), (0, texts[0][1]), (None, texts[1][1])]
    docs = frame(spark, texts, {100: None, 105: "xx", 106: None})
    got = qr.judge(docs).select("_row.doc_id", "_row.text", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept").collect()
    assert len(got) == len(texts)
    for r in got:
        assert tuple(r)[2:8] == brute_quality(r.text), r.doc_id
    kept = {r.doc_id for r in got if r.kept}
    assert set(range(30)) <= kept and not kept & {100, 101, 102, 103, 104, 105, 107}
    out = qr.filter_quality(docs)
    assert out.columns == docs.columns and {r.doc_id for r in out.collect()} == kept
    assert qr.filter_quality(docs.limit(0)).count() == 0


# ---------------------------------------------------------------- licenses

def test_licenses_base_and_suppression(spark):
    texts = [(0, "Released under the MIT License."), (1, "Licensed under the Apache License, Version 2.0 and the MIT license; mit LICENSE"),
             (2, "x " * 400 + "GNU General Public License, version 3 " + "y " * 400), (3, None), (4, ""), (5, "license " * 50), (6, "Licensed under CC BY-NC 4.0."),
             (7, "general public\nlicense"), (7, "general public\nlicense"), (None, "mit_license apache  license"), (8, "no such thing here"),
             (9, "GNU Lesser General Public License"), (10, "All rights reserved")]
    got = ls.scan_licenses(frame(spark, texts)).collect()
    assert len(got) == len(texts)
    phrases = [("mit license".split(), "mit"), ("apache license".split(), "apache"), ("general public license".split(), "gpl")]
    by_id = dict(texts)
    for r in got:
        w = ALNUM_WORD.findall((by_id[r.doc_id] or "").translate(LOWER))
        at = [(i, label) for p, label in phrases for i in range(len(w)) if w[i:i + len(p)] == p]
        starts = [i for i, _ in at]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (len(w), len(at), min(starts, default=None), max(starts, default=None)), r
        assert r.base_labels == ",".join(sorted({x for _, x in at})) and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        assert 0 <= r.score <= 1
    labels = {r.doc_id: r.labels for r in got}
    assert labels[6] == "cc-by-nc" and labels[8] == "" and labels[9] == "gpl,lgpl" and labels[10] == "all-rights-reserved"
    kept = {(r.doc_id, r.rule): r.kept for r in ls.detections(frame(spark, texts)).collect() if r.doc_id == 0}
    assert sorted(kept.values()) == [False, True, True]  # "mit license" inside "released under the mit license"; the base phrase stays
    assert len(ls.signature_rules()) > 300 and ls.scan_licenses(frame(spark, texts).limit(0)).count() == 0


def spellings(regex):
    """Every text that a names regex can match (literals, alternatives, optional groups, classes)."""
    def walk(items):
        out = [""]
        for op, arg in items:
            if str(op) == "LITERAL":
                more = [chr(arg)]
            elif str(op) == "IN":
                more = [chr(c) for kind, v in arg for c in (range(v[0], v[1] + 1) if str(kind) == "RANGE" else [v])]
            elif str(op) == "SUBPATTERN":
                more = walk(arg[-1])
            elif str(op) == "BRANCH":
                more = [t for branch in arg[1] for t in walk(branch)]
            else:
                assert str(op) == "MAX_REPEAT" and arg[:2] == (0, 1), op
                more = ["", *walk(arg[2])]
            out = [x + y for x in out for y in more]
        return out
    return walk(re._parser.parse(regex))


def test_every_spelling_passes_the_gate(spark):
    """Each spelling of each family, in each template, is found by the rule it belongs to."""
    lead = {"spdx": "spdx license identifier {}", "license": "{} license", "licence": "{} licence", "licenses": "the {} licenses", "terms": "terms of the {}"}
    texts, expected = [], []
    for label, family in ls.FAMILIES:
        for _, names in family:
            for name in spellings(names):
                for anchor in ("spdx", "licensed", "released", "distributed", "available", "license", "licence", "licenses", "terms"):
                    expected.append((label, name, anchor))
                    texts.append((len(texts), lead.get(anchor, anchor + " under the {}").format(name)))
    found = {}
    for r in ls.detections(frame(spark, texts)).collect():
        found.setdefault(r.doc_id, set()).add((r.label, r["first"], r["last"]))
    for i, t in texts:
        n = len(t.split())
        assert any(label == expected[i][0] and last - first >= len(expected[i][1].split()) + 1 and last == n for label, first, last in found.get(i, ())), t
    plain = {"Licensed under GPLv3": "gpl", "LGPLv2 license": "lgpl", "released under AGPLv3": "agpl",
             "Licensed under the Creative Commons Attribution-Share Alike 3.0 license": "cc-by-sa",
             "Licensed under a Creative Commons Attribution-Non Commercial license": "cc-by-nc", "Creative Commons Attribution-Share Alike license": "cc-by-sa"}
    got = {r.doc_id: r for r in ls.scan_licenses(frame(spark, list(enumerate(plain)))).collect()}
    assert [got[i].labels for i in range(len(plain))] == list(plain.values()) and all(r.score > 0 for r in got.values())


# ---------------------------------------------------------------- urls

def test_url_rules_and_reputation(spark):
    urls = ["http://Example.ORG/es/a", "http://sub.example.org/en/1x?q", "http://example.org/en/2", "http://notexample.org/es/", "http://a.org", None, "", "no scheme",
            "ftp://x.com/fr/#f", "http://x.com/de/1", "http://x.com?de", "http://B.com/xx#y", "http://a://b/c"]
    urls += ["http://bad.com/de/%d" % i for i in range(40)] + ["http://good.com/fr/%d" % i for i in range(40)]
    urls += ["http://bad.com/q", "http://good.com/q", "http://new.com/q"]
    pages = spark.createDataFrame([(i, u, "x", "x") for i, u in enumerate(urls)] + [(0, urls[0], "x", "x"), (None, "http://bad.com/q", "x", "x")],
                                  "page_id bigint, url string, host string, rate string")
    got = uf.judge_urls(pages).collect()
    assert len(got) == len(urls) + 2
    r = {x.page_id: x for x in got}
    assert (r[0].host, r[0].path, r[0].rule, r[0].verdict) == ("example.org", "/es/a", "example.org/es/", "block")
    assert (r[1].rule, r[2].rule, r[3].rule, r[4].rule) == ("example.org/en/1", "org/", "org/", None)
    assert all((r[i].host, r[i].path, r[i].rule) == ("", "", None) for i in (5, 6, 7))
    assert (r[8].rule, r[9].verdict, r[10].path, r[12].host) == ("com/fr/", "block", "", "a:")
    n = len(urls)
    assert (r[n - 3].verdict, r[n - 2].verdict, r[n - 1].verdict, r[None].verdict) == ("block", "allow", "allow", "block")
    assert r[n - 2].rate < r[n - 1].rate < r[n - 3].rate and r[n - 3].low < r[n - 3].rate
    assert uf.judge_urls(pages.limit(0)).count() == 0
    assert {x.verdict for x in uf.judge_urls(pages, [("block", "nowhere", "/")]).collect()} == {"allow"}
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0")
