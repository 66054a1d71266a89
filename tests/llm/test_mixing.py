import hashlib
import math

import pytest
from pyspark.sql import functions as F

from pulselake.llm import mixing
from pulselake.llm.mixing import mix, sampled, targets
from tests.llm.compare import SF_DIR
from tests.llm.rows import awkward_docs, no_docs, words_of


def filled(sizes, weights, share=1.5, most=2.0):
    """Targets by repeated resharing of the excess."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    budget, fixed = share * sum(sizes.values()), {}
    while True:
        open_ = [s for s in names if s not in fixed]
        left = budget - sum(fixed.values())
        aim = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_} if open_ else {}
        over = {s: most * sizes[s] for s in open_ if aim[s] > most * sizes[s]}
        if not over:
            return fixed | aim
        fixed |= over


@pytest.mark.parametrize("sizes", [
    {"a": 10, "b": 10, "c": 10, None: 10}, {"a": 1000, "b": 1, "c": 0}, {"x": 5}, {"a": 0, "b": 0}, {f"s{i}": (i * 37) % 11 for i in range(25)},
])
def test_targets(spark, sizes):
    found = targets(spark.createDataFrame([*sizes.items()], "source string, source_size long")).collect()
    expected = filled(sizes, mixing.WEIGHTS)
    assert {r.source: r.target for r in found} == pytest.approx(expected)
    assert sum(r.target for r in found) == pytest.approx(1.5 * sum(sizes.values()))


def draw(ident, seed=7):
    return -math.log((int(hashlib.md5(f"{seed}:{ident}".encode()).hexdigest()[:13], 16) + 0.5) / 16**13)


@pytest.mark.parametrize("range_rows", [20_000, 5])
def test_whole_table_against_brute_force(spark, monkeypatch, range_rows):
    monkeypatch.setattr(mixing, "_RANGE_ROWS", range_rows)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    quality = docs.where("doc_id % 3 = 0").select("doc_id", F.lit(4.0).alias("w"))
    found = {r.doc_id: r for r in mix(docs, quality=quality).collect()}
    rows = [(r.doc_id, r.source, len(words_of(r.text))) for r in docs.collect()]
    sizes = {}
    for _, source, size in rows:
        sizes[source] = sizes.get(source, 0) + size
    aims = filled(sizes, mixing.WEIGHTS)
    for source, total in sizes.items():
        own = sorted((draw(i) / (4.0 if i % 3 == 0 else 1.0), i, n) for i, s, n in rows if s == source)
        epochs, ahead = math.floor(aims[source] / total), 0
        for _, ident, size in own:
            more = size > 0 and ahead + size / 2 <= aims[source] - epochs * total
            ahead += size
            assert (found[ident].copies, found[ident].taken, found[ident].size) == (epochs + more, (epochs + more) * size, size)
        taken = sum(found[i].taken for _, i, _ in own)
        assert abs(taken - aims[source]) <= max(n for *_, n in own) / 2 + 1e-6


def test_better_documents_come_first(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("a b c d e").alias("text"), F.lit("s").alias("source"))
    quality = docs.where("doc_id < 2000").select("doc_id", F.lit(9.0).alias("w"))
    rows = mix(docs, quality=quality, share=0.25).groupBy((F.col("doc_id") < 2000).alias("good")).agg(F.sum("copies").alias("n")).collect()
    taken = {r.good: r.n for r in rows}
    assert taken[True] + taken[False] == 1000 and taken[True] > 4 * taken[False]


def test_reruns_agree_and_awkward_rows(spark):
    docs = awkward_docs(spark)
    runs = [sorted(map(str, mix(d).collect())) for d in (docs, docs.repartition(5))]
    assert runs[0] == runs[1] and len(runs[0]) == docs.count()
    assert mix(no_docs(spark)).count() == 0
    assert mix(docs.where("text IS NULL")).where("taken <> 0 OR target <> 0").count() == 0


def test_unusable_weights_count_as_one(spark):
    docs = awkward_docs(spark)
    odd = spark.createDataFrame([(1, None), (4, 0.0), (5, -1.0), (6, float("inf")), (7, float("nan"))], "doc_id long, w double")
    assert sorted(map(str, mix(docs).collect())) == sorted(map(str, mix(docs, quality=odd.where("NOT isnan(w) OR w IS NULL")).collect()))


def test_rows_as_often_as_taken(spark):
    docs = awkward_docs(spark)
    out = sampled(docs)
    assert out.columns == docs.columns
    taken = {}
    for r in mix(docs).collect():
        taken[r.doc_id] = taken.get(r.doc_id, 0) + r.copies
    got = {}
    for r in out.collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + 1
    assert got == {k: v for k, v in taken.items() if v}
