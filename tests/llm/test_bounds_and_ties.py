"""No caps, defined ties: archives of many members, any number of languages and rules, repeated ids."""

import gzip
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from driftline.llm import decontamination as dc
from driftline.llm import language_id as li
from driftline.llm import mixing, quality_model, warc
from driftline.llm import url_filter as uf
from driftline.llm.hosts import host_levels, host_suffixes


# ---------------------------------------------------------------- archives

def foreign_record(i, body, kind="response"):
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n" + body
    head = f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:x:{i}>\r\nWARC-Target-URI: http://h/{i}\r\nX-Page-ID: {i}\r\nContent-Length: {len(http)}\r\n\r\n"
    return head.encode() + http + b"\r\n\r\n"


@pytest.mark.parametrize("layout", ["member per record", "one member", "plain", "padded", "several records a member"])
def test_foreign_archives_are_read_whole(spark, tmp_path, layout):
    rng = random.Random(1)
    bodies = [rng.randbytes(n) for n in (0, 1, 70_000, 300_000, 5, 66_000)] + [b"WARC/1.0 inside \r\n\r\n a body" * 3000]
    info = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    records = [info] + [foreign_record(i, b) for i, b in enumerate(bodies)]
    raw = {"member per record": b"".join(map(gzip.compress, records)), "one member": gzip.compress(b"".join(records)), "plain": b"".join(records),
           "padded": b"\0\0\0".join(map(gzip.compress, records)),
           "several records a member": gzip.compress(b"".join(records[:3])) + gzip.compress(b"".join(records[3:]))}[layout]
    (tmp_path / "a.warc.gz").write_bytes(raw)
    got = {r["page_id"]: bytes(r["payload"]) for r in warc.read_archives(spark, str(tmp_path)).collect()}
    assert got == dict(enumerate(bodies))


def test_archives_are_inflated_in_pieces():
    whole = b"".join(foreign_record(i, b"x" * 1000) for i in range(2000))
    pieces = list(warc.inflated(gzip.compress(whole)))
    assert b"".join(pieces) == whole and max(map(len, pieces)) <= 2 * warc.PIECE_BYTES and len(pieces) > 10
    for cut in (1, 7, 64):
        parts = [whole[i:i + cut] for i in range(0, 5000, cut)] + [whole[-(-5000 // cut) * cut:]]
        assert len(list(warc.parse_records(iter(parts)))) == 2000
    assert list(warc.inflated(b"")) == [] and list(warc.parse_records(b"no record here")) == []


def test_damaged_member_costs_itself_alone():
    records = [foreign_record(i, bytes([65 + i]) * 50_000) for i in range(3)]
    members = [gzip.compress(r) for r in records]
    broken = bytearray(members[1])
    broken[12:20] = b"\xff" * 8
    found = [h["x-page-id"] for h, _ in warc.parse_records(warc.inflated(members[0] + bytes(broken) + members[2]))]
    assert found[0] == "0" and found[-1] == "2"


def test_pages_without_an_id_refer_to_one_with(spark):
    long = "same words " * 30
    rows = [(None, "u", long), (5, "u", long), (3, "u", long), (None, "v", "other " * 40), (None, "w", "short"), (9, "x", "short")]
    got = sorted(((r["page_id"], r["record_type"], r["refers_to"]) for r in warc.roundtrip(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()), key=str)
    assert got == sorted([(None, "revisit", 3), (5, "revisit", 3), (3, "response", None), (None, "response", None), (None, "response", None), (9, "response", None)], key=str)


# ---------------------------------------------------------------- languages

def test_seventy_languages_are_all_learnt(spark):
    rng = random.Random(3)
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = {f"l{i:02}": ["".join(rng.choice(letters) for _ in range(5)) for _ in range(30)] for i in range(70)}
    text = lambda lang, n: " ".join(rng.choice(words[lang]) for _ in range(n))
    docs = spark.createDataFrame([(lang, text(lang, 200)) for i, lang in enumerate(words) for _ in range(1 + (i < 60))], "lang string, text string")
    pages = spark.createDataFrame([(i, f"http://h{i}.org/", f"<html><body>{text(lang, 60)}</body></html>") for i, lang in enumerate(words)],
                                  "page_id bigint, url string, html string")
    got = {r["page_id"]: r["text_language"] for r in li.identify(pages, docs).collect()}
    assert got == dict(enumerate(words))


def test_too_many_languages_are_refused(spark):
    docs = spark.createDataFrame([(f"l{i}", "some text") for i in range(12)], "lang string, text string")
    with pytest.raises(ValueError, match="languages"):
        li.train_text_model(docs, max_languages=10)


# ---------------------------------------------------------------- urls

def test_any_number_of_rules(spark):
    rng = random.Random(4)
    hosts = [".".join(rng.choice(["a", "b", "cc", "news", "x1"]) for _ in range(rng.randint(1, 4))) + rng.choice([".org", ".com", ".co.uk", ""]) for _ in range(300)]
    path = lambda: "/" + "/".join(rng.choice(["en", "es", "fr", "p1", "p12", ""]) for _ in range(rng.randint(0, 3)))
    rules = [(rng.choice(["allow", "block"]), rng.choice(hosts), path()[:rng.randint(0, 9)]) for _ in range(3000)]
    rules += [("block", "org", ""), ("allow", "org", ""), ("block", "", "/")]
    urls = [f"http://{rng.choice(hosts)}{path()}?q" for _ in range(1500)] + [None, "no scheme", "http://", "http:///en"]
    got = uf.judge_urls(spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string"), rules).collect()
    assert len(got) == len(urls)
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2], r[0]))
    for r in got:
        fit = next(((v, h, p) for v, h, p in ordered if (r["host"] == h or r["host"].endswith("." + h)) and r["path"].startswith(p)), None)
        assert r["rule"] == (fit and fit[1] + fit[2]), (r, fit)
        assert fit is None or r["verdict"] == fit[0]


def test_registered_domains(spark):
    hosts = ["a.b.co.uk", "b.co.uk", "co.uk", "uk", "x.y.example.org", "example.org", "org", "", "www.com.au", "a..b"]
    d, s = host_levels(F.col("h"))
    got = {r["h"]: (r["d"], r["s"], r["all"]) for r in spark.createDataFrame([(h,) for h in hosts], "h string").select("h", d.alias("d"), s.alias("s"), host_suffixes(F.col("h")).alias("all")).collect()}
    assert {h: v[:2] for h, v in got.items()} == {
        "a.b.co.uk": ("b.co.uk", "co.uk"), "b.co.uk": ("b.co.uk", "co.uk"), "co.uk": ("co.uk", "co.uk"), "uk": ("uk", "uk"),
        "x.y.example.org": ("example.org", "org"), "example.org": ("example.org", "org"), "org": ("org", "org"), "": ("", ""),
        "www.com.au": ("www.com.au", "com.au"), "a..b": (".b", "b")}
    assert got["a.b.co.uk"][2] == ["a.b.co.uk", "b.co.uk", "co.uk", "uk"]


# ---------------------------------------------------------------- ties

def test_an_item_without_an_id_counts(spark):
    items = spark.createDataFrame([(None, "alpha beta gamma"), (1, "beta gamma delta"), (None, "other words here")], "item_id bigint, text string")
    docs = spark.createDataFrame([(1, "alpha beta gamma delta"), (2, "x alpha beta gamma"), (3, "beta gamma delta"), (4, "nothing")], "doc_id bigint, text string")
    got = {r["doc_id"]: (r["n_items"], r["items"]) for r in dc.contamination(docs, items).collect()}
    assert got == {1: (2, ["1"]), 2: (1, []), 3: (1, ["1"]), 4: (0, [])}


def test_scores_do_not_depend_on_the_partitions(spark):
    rng = np.random.default_rng(6)
    rows = [(int(i // 2), " ".join(f"w{x}" for x in rng.integers(0, 50 if i % 3 else 5, int(rng.integers(5, 80))))) for i in range(400)]
    labels = [(i, int(rng.integers(0, 2))) for i in range(200)] + [(i, int(rng.integers(0, 2))) for i in range(0, 200, 3)]
    scores = []
    for n in (1, 7):
        docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(n)
        lab = spark.createDataFrame(labels, "doc_id bigint, quality int").repartition(n + 2)
        scores.append(sorted((r["doc_id"], r["score"]) for r in quality_model.score_quality(docs, lab).collect()))
    assert scores[0] == scores[1]


def test_copies_come_under_a_free_name(spark):
    docs = spark.createDataFrame([(i, "w " * (5 + i), f"s{i % 2}", 99, "t") for i in range(20)], "doc_id bigint, text string, source string, copies int, _copies string")
    out = mixing.mix(docs)
    assert out.columns == [*docs.columns, "__copies", "taken", "target"]
    plan = {r["doc_id"]: r["copies"] for r in mixing.mix_plan(docs).collect()}
    assert {r["doc_id"]: r["__copies"] for r in out.collect()} == {k: v for k, v in plan.items() if v}
