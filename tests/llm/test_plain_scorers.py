"""Language posteriors, quality statistics and tree scores against plain Python, value by value."""

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from driftline.llm import language_id as li
from driftline.llm import quality_model as qm

SPACE = re.compile(rb"[ \t\n\x0b\x0c\r]+")


# ---------------------------------------------------------------- language

def plain_grams(text):
    raw = bytes(b + 32 if 65 <= b < 91 else b if 97 <= b < 123 or b >= 128 else 32 for b in (text or "").encode())
    letters = re.sub(rb" +", b" ", raw)
    return [((letters[i] << 16 | letters[i + 1] << 8 | letters[i + 2]) * 2654435761 % 2**32) >> 20 for i in range(len(letters) - 2)]


def plain_identify(pages, docs):
    """(text language, language, posterior) per page by the formulas."""
    langs = sorted({lang for lang, t in docs if lang is not None and t is not None})
    table = {lang: Counter(g for x, t in docs if x == lang and t is not None for g in plain_grams(t)) for lang in langs}
    logs = {lang: {g: math.log((c[g] + 0.5) / (sum(c.values()) + 0.5 * li.BUCKETS)) for g in range(li.BUCKETS)} for lang, c in table.items()}
    facts = []
    for _, url, html in pages:
        grams = plain_grams(li.visible_text(html))
        score = [sum(logs[lang][g] for g in grams) * min(len(grams), li.EFFECTIVE_GRAMS) / max(len(grams), 1) for lang in langs]
        vote = score.index(max(score)) if grams else -1
        found = re.search("://([^/?#]*)", url or "")
        host = found[1].lower() if found else ""
        parts = host.split(".")
        said = li.declared_language(html)
        facts.append((score, vote, host, ".".join(parts[-2:]), parts[-1], said if said in langs else ""))
    k = len(langs)

    def shrunk(count, prior, strength):
        return [(c + strength * p) / (sum(count) + strength) for c, p in zip(count, prior)]

    out = []
    for me, (score, vote, host, domain, suffix, said) in enumerate(facts):
        def votes(at, value):
            return [sum(f[1] == i for j, f in enumerate(facts) if j != me and (at is None or f[at] == value)) for i in range(k)]

        p0 = shrunk(votes(None, None), [1 / k] * k, 1.0)
        ph = shrunk(votes(2, host), shrunk(votes(3, domain), shrunk(votes(4, suffix), p0, li.PRIOR), li.PRIOR), li.PRIOR)
        pw = [a / b for a, b in zip(shrunk(votes(5, said), p0, li.DECLARED_PRIOR), p0)]
        total = [s + math.log(h) + math.log(w) for s, h, w in zip(score, ph, pw)]
        odds = [math.exp(x - max(total)) for x in total]
        out.append((langs[vote] if vote >= 0 else None, langs[total.index(max(total))], 1 / sum(odds)))
    return out


def test_posteriors_equal_the_formulas(spark):
    words = {"aa": "lorem ipsum dolor sit", "bb": "quick brown fox jumps", "cc": "größe straße über schön", "dd": "x"}
    docs = [(lang, f"{w} {w} {w[::-1]}") for lang, w in words.items()] * 2 + [("aa", None), (None, "text"), ("bb", "")]
    pages = []
    for i in range(24):
        lang = ["aa", "bb", "cc", "dd"][i % 4]
        text = " ".join(words[lang].split()[:1 + i % 3]) if i % 5 else ""
        said = ["", ' lang="aa"', " lang=zz", f' lang="{lang}"'][i % 4 if i < 12 else (i // 4) % 4]
        url = [f"http://h{i % 3}.one.org/{i}", f"https://H{i % 2}.two.com?x", "http://one.org", None, "no scheme"][i % 5]
        pages.append((i, url, f"<html{said}><style>body the</style><!-- note --><p>{text}</p>"))
    pages += [(100, "http://h0.one.org", None), (100, "http://h0.one.org", None), (101, "http://a.b.two.com", "<p>quick &amp; gr&ouml;&szlig;e</p>")]
    want = plain_identify(pages, docs)
    got = li.identify(spark.createDataFrame(pages, "page_id bigint, url string, html string").coalesce(1),
                      spark.createDataFrame(docs, "lang string, text string")).collect()
    key = lambda page, text, language, p: (page, text or "", language, round(p, 9))
    assert sorted(key(r.page_id, r.text_language, r.language, r.posterior) for r in got) == sorted(
        key(page[0], *w) for page, w in zip(pages, want, strict=True))


# ---------------------------------------------------------------- quality

def plain_statistics(text):
    raw = (text or "").encode()
    words = [w for w in SPACE.split(raw) if w]
    low = [bytes(b + 32 if 65 <= b < 91 else b for b in w) for w in words]
    n, size, spaces = len(words), len(raw), sum(b in b" \t\n\x0b\x0c\r" for b in raw)
    share = lambda cls: sum(cls(b) for b in raw) / max(size, 1)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    pairs = list(zip(low, low[1:]))
    listed = {w.encode() for w in qm.COMMON}
    return [math.log1p(n), math.log1p(size), (size - spaces) / max(n, 1), max(map(len, words), default=0), share(lambda b: 65 <= b < 91),
            share(lambda b: 48 <= b < 58), share(lambda b: b in b"#*$%&|<>@^~_=+{}[]\\/"), share(lambda b: b in b".,;:"), share(lambda b: b in b"!?"),
            share(lambda b: b >= 128), spaces / max(size, 1), raw.count(b"\n") / max(n, 1), 1 - len(set(lines)) / len(lines) if n else 0,
            len(set(low)) / n if n else 0, sum(w in listed for w in low) / max(n, 1), max(Counter(low).values(), default=0) / max(n, 1),
            1 - len(set(pairs)) / len(pairs) if pairs else 0, sum(len(w) <= 3 for w in words) / n if n else 0]


def test_statistics_equal_plain_counts():
    texts = ["The the THE end.\nThe end.\nThe end.\n\n", "", None, "one", " \n\t ", "Größe und STRASSE! ¿qué? #tag $5 <b>|x|</b>", "a b a b a b", "x" * 5000,
             "Mixed\r\nlines \x0b here\x0cand there 123 456\n" * 50, "é", "the of and to in is was for"]
    got = qm.statistics(pa.array(texts))
    for t, row in zip(texts, got, strict=True):
        np.testing.assert_allclose(row, plain_statistics(t), rtol=1e-12, atol=1e-12, err_msg=repr(t)[:40])


@pytest.mark.parametrize("seed", [0, 1])
def test_tree_scores_equal_a_walk_from_the_root(seed):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(400, 5)), 1)  # values that equal thresholds occur
    trees = qm.fit(x, ((x[:, 0] + x[:, 1] * x[:, 3]) > 0.2).astype(float))

    def walk(row):
        total = trees.base
        for f, t, v in zip(trees.feature, trees.threshold, trees.value):
            node = 0
            while 2 * node + 2 < len(v):
                node = 2 * node + (2 if row[f[node]] > t[node] else 1)
            total += v[node]
        return 1 / (1 + math.exp(-total))

    np.testing.assert_allclose(trees.score(x), [walk(r) for r in x], rtol=1e-12)
    used = trees.threshold[np.isfinite(trees.threshold)]
    assert len(used) > 50 and np.isin(used, x).mean() > 0.5
