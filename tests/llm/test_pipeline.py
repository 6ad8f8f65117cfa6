"""The pipeline against brute force, stage by stage and as a whole."""

import brute
import cases
import corpus_pipeline
from cases import few_partitions  # noqa: F401 - applies to this module
from conftest import SMALL
from landfall.llm import quality_rules, queries


def brute_run(rows):
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of (doc_id, text, source)."""
    rows = [r for r, (_, _, kept) in zip(rows, brute.quality([t for _, t, _ in rows], quality_rules), strict=True) if kept]
    rows.sort(key=lambda r: r[0])
    rows = [r for i, (r, (_, low)) in enumerate(zip(rows, brute.jaccard_groups([t for _, t, _ in rows]), strict=True))
            if i == low]
    rows = [(i, kept.decode("utf-8", "ignore") if removed else t, s)
            for (i, t, s), (kept, removed, _) in zip(rows, brute.repeated([t for _, t, _ in rows]), strict=True)]
    rows = [r for r, (_, n, _, _, taken) in zip(rows, brute.mix(rows), strict=True) if n for _ in range(taken // n)]
    enc = brute.tokenizer(*queries.bpe_files())
    return [(i, *brute.tokens(enc, t)) for i, t, _ in rows]


def test_pipeline_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "source").collect()
    got = corpus_pipeline.run(spark, SMALL).collect()
    assert cases.multiset(got) == cases.multiset(brute_run([tuple(r) for r in docs]))


def test_stages_keep_the_columns(spark, tmp_path):
    docs = cases.frame(spark)
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        columns = docs.columns
        out = stage(spark, docs, SMALL)
        path = str(tmp_path / str(i))
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        if i < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
    assert docs.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_empty_corpus(spark):
    docs = cases.frame(spark).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
    assert docs.collect() == []
