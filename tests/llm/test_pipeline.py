"""Every pipeline stage on its own input against brute force, and the whole run."""

import corpus_pipeline
from test_native import brute_contamination, brute_quality
from test_pairs_and_lines import brute_components, shingles
from test_passages import brute_passages

from driftline.session import materialize

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_duplicates", "decontamination", "mixing"]
    stage = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = [(-1, None, None, None, None), (-2, "", "en", "src0", 0), (None, "no id " * 30, "en", None, 180)]
    donor = next(r.text.split() for r in docs.orderBy("doc_id").collect() if len(r.text.split()) > 400)
    host = next(r for r in docs.orderBy("doc_id").collect() if len(r.text.split()) > 300 and donor[0] not in r.text)
    pasted = " ".join(host.text.split()[:120] + donor[200:260] + host.text.split()[120:])  # 60 words in the middle of a line
    extra.append((10**6, pasted, host.lang, host.source, len(pasted)))
    extra = spark.createDataFrame(extra, docs.schema)
    docs = materialize(docs.unionByName(extra).unionByName(docs.limit(3)), "fixture")

    def step(name, before):
        after = materialize(stage[name](spark, before, SF), name)
        return after, [tuple(r) for r in before.collect()], [tuple(r) for r in after.collect()]

    kept, old, new = step("quality_rules", docs)
    assert kept.columns == docs.columns and set(new) <= set(old)
    assert not any(brute_quality(r[1])[-1] for r in new)
    good = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").filter("quality = 1").collect()}
    assert all(r in new for r in old if r[0] in good and not brute_quality(r[1])[-1])

    kept, old, new = step("line_dedup", kept)
    expected = {k: text for k, (text, *_) in brute_passages([(r[0], r[1]) for r in old], 50).items()}
    assert kept.columns == docs.columns
    assert sorted(str((r[0], r[1])) for r in new) == sorted(
        str((r[0], expected[r[0], r[1]])) for r in old if expected[r[0], r[1]].strip() or not r[1].strip())
    assert all(r[4] == len(r[1]) for r in new)

    kept, old, new = step("near_duplicates", materialize(kept.unionByName(docs), "more"))
    groups = brute_components([(r[0], r[1]) for r in old])
    assert sum(bool(shingles(r[1])) for r in new) == len({c for _, n, c in groups if n}) and set(new) <= set(old)
    assert sum(not shingles(r[1]) for r in new) == sum(not n for _, n, _ in groups)

    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    kept, old, new = step("decontamination", kept)
    bad = [c for *_, c in map(lambda r: brute_contamination([(r[0], r[1])], items)[0], old)]
    assert sorted(map(str, new)) == sorted(str(r) for r, b in zip(old, bad, strict=True) if not b) and any(bad)

    mixed, old, new = step("mixing", kept)
    assert mixed.columns == [*docs.columns, "copies", "taken", "target"]
    assert {r[:5] for r in new} <= set(old) and all(r[5] in (1, 2) and r[6] == r[5] * len(r[1].split()) for r in new)


def test_run_and_empty_input(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.count() > 50 and "copies" in out.columns
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF), name)
        assert docs.count() == 0
