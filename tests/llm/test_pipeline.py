"""The pipeline's stages on a small fixture against plain decisions, and its registration."""

from conftest import SF_SMALL
from llm_data import awkward, prose
from test_duplicates import groups, marked

import __spark_entry__ as entry
import corpus_pipeline as pipeline


def test_registered():
    names = list(entry.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
    assert [n for n, _ in pipeline.STAGES] == ["language_id", "toxicity", "near_duplicates", "decontamination", "packing"]


def test_stages_and_run(spark, tmp_path):
    sf = SF_SMALL
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    for name, stage in pipeline.STAGES:
        out = stage(spark, docs, sf)
        out.write.parquet(str(tmp_path / name))
        new = spark.read.parquet(str(tmp_path / name))
        if name != "packing":
            assert new.columns == columns
        before = [(r.doc_id, r.text) for r in docs.collect()]
        kept = {r.doc_id for r in new.collect()}
        if name == "near_duplicates":
            want = {int(c) for _, c, _ in groups([(k, i, t) for k, (i, t) in enumerate(before)])}
            assert kept == want
        elif name == "decontamination":
            items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
            assert kept == {int(i) for i, _, _, _, _, bad in marked(before, items) if not bad}
        elif name == "packing":
            assert kept == {i for i, _ in before}
        docs = new
    got = pipeline.run(spark, sf)
    key = lambda df: sorted((r.doc_id, r.start) for r in df.collect())
    assert {i for i, _ in key(got)} == {i for i, _ in key(docs)}


def test_awkward_documents(spark, tmp_path):
    docs = awkward(spark).select("doc_id", "text", "lang", "source", "n_chars").unionByName(spark.createDataFrame([(77, prose(1, 60), None, None, None)], "doc_id long, text string, lang string, source string, n_chars long"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, prose(3, 12000)[:300])], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    out = {r.doc_id for r in pipeline.run(spark, str(tmp_path)).collect()}
    assert 8 not in out and 2 not in out and 77 not in out and 4 not in out and 1 in out
