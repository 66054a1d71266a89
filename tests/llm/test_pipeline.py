import pytest

import corpus_pipeline
from pulselake.llm.substrings import remove_repeats
from tests.llm.rows import awkward_docs, no_docs

SF_DIR = "/root/testdata/sf0.001"


def test_the_stages_are_those_asked_for():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "simhash_dedup", "substring_dedup", "source_mixing", "best_fit_packing"]


@pytest.mark.parametrize("make", [awkward_docs, no_docs])
def test_stages_on_awkward_rows(spark, make):
    docs = make(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = corpus_pipeline.settle(stage(spark, docs, SF_DIR))
        assert out.columns == docs.columns
        docs = out
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR)
    assert packed.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()


def test_whole_run(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    kept = docs
    for _, stage in corpus_pipeline.STAGES[:3]:
        before, kept = kept, corpus_pipeline.settle(stage(spark, kept, SF_DIR))
        assert kept.join(before, "doc_id", "left_anti").count() == 0
    assert remove_repeats(kept).where("n_removed > 0").count() <= remove_repeats(docs).where("n_removed > 0").count()
    rows = corpus_pipeline.run(spark, SF_DIR)
    assert {r.doc_id for r in rows.select("doc_id").collect()} <= {r.doc_id for r in kept.select("doc_id").collect()}
    again = corpus_pipeline.run(spark, SF_DIR)
    assert sorted(map(str, rows.collect())) == sorted(map(str, again.collect()))


def test_substring_stage_keeps_white_space(spark):
    passage = "\n".join(f"p{i}" for i in range(25))
    texts = ["\tclean  text\n\n  indented\n", None, passage, f" Größe\n\n{passage}\n\n  after  it\n", f"start\n  {passage}\n"]
    docs = spark.createDataFrame([(i, t, None if t is None else len(t)) for i, t in enumerate(texts)], "doc_id long, text string, n_chars int")
    out = {r.doc_id: r for r in corpus_pipeline.substring_dedup(spark, docs, SF_DIR).collect()}
    assert [out[i].text for i in range(5)] == [*texts[:3], " Größe\n\nafter  it\n", "start\n  \n"]
    assert all(r.text is None or r.n_chars == len(r.text) for r in out.values())
