"""Passage dedup against brute force over all windows of words, passages pasted mid-line included."""

import os
import random
import re

import pyarrow as pa

from driftline.llm import passage_dedup as pd
from driftline.llm.queries import QUERIES
from test_pairs_and_lines import SCHEMA, SPACE_WORD, brute_lines, rows


def brute_passages(pairs, least):
    """(text, lines, words deleted) of each document after cutting every word of a run of ``least`` words that occurs earlier."""
    seen, out = set(), {}
    for n, i, t in sorted({(i is None, i or 0, t) for i, t in pairs if t is not None}, key=lambda d: d[:2]):
        lines = brute_lines(t)
        words = [w for u in lines for w in SPACE_WORD.findall(u)]
        gone = set()
        for p in range(len(words) - least + 1):
            if (window := tuple(words[p:p + least])) in seen:
                gone |= set(range(p, p + least))
            seen.add(window)
        left, k, whole = "", 0, 0
        for u in lines:
            begin = [m.start() for m in SPACE_WORD.finditer(u)]
            edge = [0, *begin[1:], len(u)]
            left += "".join(u[edge[j]:edge[j + 1]] for j in range(len(begin)) if k + j not in gone)
            whole += all(k + j in gone for j in range(len(begin)))
            k += len(begin)
        out[None if n else i, t] = (left if gone else t, whole, len(gone))
    return out


def check(spark, pairs, least):
    docs = spark.createDataFrame(rows(pairs), SCHEMA)
    got = pd.dedup_passages(docs, least).select("_row.doc_id", "_row.text", "new_text", "lines_deleted", "words_deleted").collect()
    expected = brute_passages(pairs, least)
    assert len(got) == len(pairs)
    for r in got:
        assert tuple(r)[2:] == (expected[r.doc_id, r.text] if r.text is not None else (None, 0, 0)), r.doc_id
    return expected


def test_passages_match_brute_force(spark):
    rng = random.Random(2)
    pool = [" ".join(rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(rng.randint(1, 9))) + rng.choice([". ", "\n", "! ", " \n\n"])
            for _ in range(40)]
    pairs = [(i, "".join(rng.choice(pool) for _ in range(rng.randint(1, 25)))) for i in range(60)]
    run = "".join(pool[:9])
    pairs += [(100 + i, f"own start number {i}.\n{run}own end {i} too.") for i in range(5)]
    pairs += [(200, run), (200, run), (201, "é. " + run.strip()), (202, ""), (203, None), (204, " \n "), (None, run), (205, (pool[3] + "\n") * 30)]
    pairs += [(206, "la " * 40), (207, "la " * 11), (208, "x la la la " * 9)]
    own = iter(range(10**6))
    text = lambda n: " ".join(f"w{next(own)}" for _ in range(n))
    for i in range(40):  # passages of a shared text start and end anywhere, some re-wrapped, some a word short of the limit
        if i % 8 == 0:
            base = text(80).split()
        a, n = rng.randint(0, 12), rng.choice([11, 12, 13, 20, 40])
        pairs.append((300 + i, text(rng.randint(0, 9)) + " " + rng.choice([" ", ". ", "\n"]).join(base[a:a + n]) + " " + text(rng.randint(0, 9)) + "."))
    expected = check(spark, pairs, 12)
    assert sum(1 for (i, _), (*_, n) in expected.items() if i and i >= 300 and n) > 15
    assert pd.dedup_passages(spark.createDataFrame([], SCHEMA)).count() == 0


def test_odd_limits_and_edited_copies(spark):
    rng = random.Random(4)
    base = [f"v{rng.randrange(400)}" for _ in range(160)]
    pairs = [(0, " ".join(base))]
    for i in range(1, 60):
        w = list(base)
        for _ in range(rng.randint(0, 6)):
            w[rng.randrange(len(w))] = f"e{i}"
        pairs.append((i * 7 % 61, " ".join(w[rng.randint(0, 30):]) + rng.choice(["", ".", "\n"])))
    for least in (1, 2, 7, 13):
        check(spark, pairs, least)


def test_query_cuts_a_passage_pasted_mid_line(spark, tmp_uri):
    words = [f"p{i}" for i in range(51)]
    words[8], words[43] = "p8.", "p43."  # 35 words in whole lines
    passage = " ".join(words)
    texts = [(1, f"First text starts {passage} and goes on. It ends."), (2, f"Another one | edge {passage} | other tail."),
             (3, f"one word short {' '.join(words[:49])} of the limit"), (4, "plain words without any end " + re.sub("[.]", ",", passage))]
    texts.append((5, "no sentence " + texts[3][1][10:] + " either"))
    spark.createDataFrame(rows(texts), SCHEMA).write.parquet(f"{tmp_uri}/documents.parquet")
    got = {r.doc_id: r for r in QUERIES["op2_line_dedup"](spark, tmp_uri).collect()}
    assert {i: r.words_deleted for i, r in got.items()} == {1: 0, 2: 51, 3: 0, 4: 0, 5: 54}
    assert got[2].n_chars == len("Another one | edge | other tail.") and got[2].lines_deleted == 1


def test_table_of_all_positions_goes_before_the_result_is_read(spark, monkeypatch):
    made = []
    monkeypatch.setattr(pd, "materialize", lambda df, name="table", f=pd.materialize: made.append(f(df, name)) or made[-1])
    run = " ".join(f"z{i}" for i in range(30))
    pairs = [(1, f"a start {run}"), (2, f"{run} an end"), (3, " ".join(f"y{i}" for i in range(300)))]
    check(spark, pairs, 12)
    folders = {path.rsplit("/", 2)[-2].rsplit("-", 1)[0]: path.rsplit("/", 1)[0] for t in made for path in t.inputFiles()}
    there = {name for name, path in folders.items() if os.path.exists(path.removeprefix("file:").replace("///", "/"))}
    assert {"positions", "again", "kinds"} <= folders.keys() and "kinds" in there
    assert not there & {"positions", "again"}


def test_repeats_are_told_by_one_shuffle_of_the_positions(spark, monkeypatch):
    made = []
    monkeypatch.setattr(pd, "materialize", lambda df, name="table", f=pd.materialize: made.append((name, df)) or f(df, name))
    run = " ".join(f"z{i}" for i in range(30))
    docs = spark.createDataFrame(rows([(1, f"a start {run}"), (2, f"{run} an end")]), SCHEMA)
    plan = pd.dedup_passages(docs, 12)._jdf.queryExecution().optimizedPlan().toString()
    assert [name for name, _ in made] == ["positions", "again", "kinds"]  # before: also the first windows, and repeats joined to every position
    again = dict(made)["again"]._jdf.queryExecution().executedPlan().toString()
    assert again.count("Exchange") == 1 and "Join" not in again and "Aggregate" not in again
    assert plan.count("Join ") == 1  # texts with their runs


def test_frequent_passages_are_ranked_in_parts(spark, monkeypatch):
    monkeypatch.setattr(pd, "SAMPLE", 1.0)
    monkeypatch.setattr(pd, "FREQUENT", 3)
    monkeypatch.setattr(pd, "_tasks", lambda rows: 1000)  # 3 rows make a hash frequent
    cut = []
    monkeypatch.setattr(pd, "_late_in_parts", lambda df, *kind, f=pd._late_in_parts: cut.append(kind) or f(df, *kind))
    rng = random.Random(6)
    own = iter(range(10**6))
    text = lambda n: " ".join(f"w{next(own)}" for _ in range(n))
    passage = text(40)
    pairs = [(i, f"{text(rng.randint(0, 30))} {passage} {text(rng.randint(0, 30))}") for i in range(40)]
    pairs += [(100 + i, pairs[0][1]) for i in range(20)] + pairs[:3] * 2 + [(None, pairs[5][1]), (None, pairs[5][1]), (60, f"{passage} {passage}")]
    pairs += [(200 + i, text(60)) for i in range(10)]
    check(spark, pairs, 12)
    assert cut == [("print", "c1", "c2"), ("h1", "h2")]


def test_spans_are_gathered_over_batches():
    def row(i, th, lo, hi, late):
        return {"doc_id": i, "_th": th, "lo": lo, "hi": hi, "late": late}

    spans = [row(None, 1, 0, 9, True), row(None, 1, 0, 9, True), row(None, 1, 5, 12, True), row(None, 1, 13, 20, True), row(0, 1, 3, 8, False),
             row(0, 1, 6, 30, True), row(0, 1, 8, 12, True), row(0, 1, 20, 31, True), row(0, 2, 1, 4, False), row(7, 2, 2, 3, True)]
    schema = pa.schema([("doc_id", pa.int64()), ("_th", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32()), ("late", pa.bool_())])
    want = [(None, 1, [(0, 12), (13, 20)], []), (0, 1, [(6, 31)], [(3, 8)]), (0, 2, [], [(1, 4)]), (7, 2, [(2, 3)], [])]
    for size in (1, 2, 3, 4, 20):
        parts = [pa.RecordBatch.from_pylist(spans[i:i + size], schema) for i in range(0, len(spans), size)]
        got = [r for b in pd._by_document(iter(parts)) for r in b.to_pylist()]
        assert [(r["doc_id"], r["_th"], *([(x["lo"], x["hi"]) for x in r[c]] for c in ("runs", "spots"))) for r in got] == want, size
    assert not list(pd._by_document(iter([])))
