"""Every stage of the corpus pipeline against a plain version, and the whole of it."""

import corpus_pipeline
from nextbest.llm import decontam, weak_rules
from tests.conftest import SF_SMALL
from tests.llm.test_rules_and_mix import plain_targets
from tests.llm.test_simhash import plain_components, plain_fingerprint
from tests.llm.test_tokens import plain_rows


def test_stages_equal_plain_versions(spark, tmp_path):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality rules", "simhash dedup", "benchmark decontamination", "source mix",
                     "token output"]
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, rows = docs.columns, {0: docs.collect()}
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF_SMALL)
        out.write.parquet(f"{tmp_path}/{n}")
        docs = spark.read.parquet(f"{tmp_path}/{n}")
        rows[n + 1] = docs.collect()
        assert n == 4 or docs.columns == columns

    verdict = {r.doc_id: r.kept for r in weak_rules.weak_quality(
        spark.read.parquet(f"{SF_SMALL}/documents.parquet"), keep=["doc_id"]).collect()}
    assert {r.doc_id for r in rows[1]} == {d for d, k in verdict.items() if k}

    before = sorted(rows[1], key=lambda r: r.doc_id)
    roots = plain_components([plain_fingerprint(r.text) for r in before])
    assert sorted(r.doc_id for r in rows[2]) == sorted({before[c].doc_id for c in roots})

    shingles = lambda t: decontam.shingles(decontam.content_words(t), 5)
    items = [shingles(r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    clean = [r for r in rows[2]
             if not any(len(i & shingles(r.text)) / len(i) >= 0.8 for i in items if i)]
    assert sorted(map(tuple, clean)) == sorted(map(tuple, rows[3]))
    assert len(rows[3]) < len(rows[2]) < len(rows[1]) < len(rows[0])

    size = lambda r: len(r.text.split())
    sizes, taken = {}, {}
    for r in rows[3]:
        sizes[r.source] = sizes.get(r.source, 0) + size(r)
    for r in rows[4]:
        taken[r.source] = taken.get(r.source, 0) + size(r)
    for source, target in plain_targets(sizes).items():
        # what rounding leaves is less than one document; a source has but a few of them here
        assert abs(taken.get(source, 0) - target) <= max(
            size(r) for r in rows[3] if r.source == source)
    assert max(sum(r == x for x in rows[4]) for r in rows[3]) <= 3

    want = plain_rows([(r.doc_id, r.text) for r in rows[4]])
    assert sorted(map(tuple, rows[5]), key=lambda r: r[1]) == want


def test_run_returns_the_last_stage(spark):
    out = corpus_pipeline.run(spark, SF_SMALL)
    assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and out.count() > 0
    assert corpus_pipeline.ORACLE_SQL is None


def test_stages_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF_SMALL).collect() == []
