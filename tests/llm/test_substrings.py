import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pulselake.llm import substrings
from pulselake.llm.substrings import packed, remove_repeats, unpacked
from tests.llm.compare import SF_DIR
from tests.llm.rows import LONG, awkward_docs, no_docs, words_of


def brute_force(rows, width):
    """``{(id, text): [(n_words, n_removed, kept)]}``; rows of one id are one document."""
    rows = sorted(rows, key=lambda r: (r[0], r[1] is not None, (r[1] or "").encode()))
    seen, out = set(), {}
    for ident, text in rows:
        words = words_of(text)
        gone = [False] * len(words)
        for i in range(len(words) - width + 1):
            run = tuple(words[i : i + width])
            if run in seen:
                gone[i : i + width] = [True] * width
            seen.add(run)
        kept = b" ".join(w for w, g in zip(words, gone, strict=True) if not g).decode()
        out.setdefault(ident, []).append((len(words), sum(gone), kept))
    return {k: sorted(v) for k, v in out.items()}


def found(frame):
    out = {}
    for r in frame.collect():
        out.setdefault(r.doc_id, []).append((r.n_words, r.n_removed, r.kept_text))
    return {k: sorted(v) for k, v in out.items()}


@given(st.lists(st.integers(0, 2**28 - 1), max_size=50))
@settings(max_examples=100, deadline=None)
def test_packing_is_a_round_trip(values):
    values = np.array(sorted(values), np.int64)
    assert unpacked(packed(values)).tolist() == values.tolist()


@pytest.mark.parametrize("width", [1, 3, 20])
def test_whole_table_against_brute_force(spark, width):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    assert found(remove_repeats(docs, width=width)) == brute_force(rows, width)


def test_awkward_rows(spark):
    docs = awkward_docs(spark)
    named = docs.where("doc_id IS NOT NULL")
    expected = brute_force([(r.doc_id, r.text) for r in named.collect()], 20)
    assert found(remove_repeats(named)) == expected
    every = found(remove_repeats(docs))
    assert {k: v for k, v in every.items() if k is not None} == expected
    # Rows without an id come last: their passage is a repetition of a named one.
    assert sorted((n, r) for n, r, _ in every[None]) == [(0, 0), (47, 45), (47, 47)]


def in_process(rows, width, buckets, shards):
    """The steps of the operator on Arrow tables, without Spark."""
    group = lambda table, key: [table.filter(pc.equal(table[key], k)) for k in sorted(set(table[key].to_pylist()))]
    ids = [r[0] for r in rows]
    docs = pa.table({
        "doc_id": pa.array(ids, pa.int64()), "text": pa.array([r[1] for r in rows], pa.string()), "order_id": pa.array(ids, pa.int64()),
        "tie": pa.array([0] * len(rows), pa.int64()), "bucket": pa.array([i % buckets for i in ids], pa.int64()),
    })
    dealt = group(docs, "bucket")
    key = lambda table: (table["bucket"][0],)
    pieces = pa.concat_tables([substrings._sketch_pieces(width, shards)(key(t), t) for t in dealt])
    estimates = pa.concat_tables([substrings._merged(t) for t in group(pieces, "shard")])
    pick = lambda table, t: table.filter(pc.equal(table["bucket"], t["bucket"][0]))
    candidates = pa.concat_tables([substrings._candidates(width, shards)(key(t), t, pick(estimates, t)) for t in dealt])
    answers = pa.concat_tables([substrings._winners(t) for t in group(candidates, "shard")])
    schema = pa.schema([("doc_id", pa.int64()), ("kept_text", pa.string()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("removed_spans", pa.list_(pa.int32()))])
    result = pa.concat_tables([substrings._removal(width, schema)(t, pick(answers, t)) for t in dealt]).to_pylist()
    suspects = sum(len(unpacked(x)) for x in candidates["suspects"].to_pylist() if x)
    return {r["doc_id"]: [(r["n_words"], r["n_removed"], r["kept_text"])] for r in result}, suspects


def test_false_suspects_lose_nothing(monkeypatch):
    texts = duckdb.sql(f"SELECT doc_id, text FROM '{SF_DIR}/documents.parquet'").fetchall()
    expected = brute_force(texts, 20)
    result, few = in_process(texts, 20, buckets=7, shards=3)
    assert result == expected
    monkeypatch.setattr(substrings, "_KEY_BITS", 9)  # most windows now collide with others
    result, many = in_process(texts, 20, buckets=7, shards=3)
    assert result == expected
    assert many > 2 * few


def test_the_sketch_never_underestimates():
    rng = np.random.default_rng(5)
    parts = [rng.integers(0, 3000, 800) for _ in range(4)]
    rows = []
    for bucket, keys in enumerate(parts):
        names, counts = np.unique(keys, return_counts=True)
        rows.append({"bucket": bucket, "shard": 0, "once": packed(names[counts == 1]), "often": packed(names[counts > 1])})
    merged = substrings._merged(pa.Table.from_pylist(rows))
    names, counts = np.unique(np.concatenate(parts), return_counts=True)
    repeated = set(names[counts > 1].tolist())
    for bucket, data in zip(merged["bucket"].to_pylist(), merged["data"].to_pylist(), strict=True):
        assert repeated & set(parts[bucket].tolist()) <= set(unpacked(data).tolist())


def test_spans_and_carried_columns(spark):
    docs = awkward_docs(spark)
    rows = remove_repeats(docs, carry=("bucket", "rest", "n_chars")).collect()
    assert sorted(r["rest"]["bucket"] for r in rows) == list(range(docs.count()))
    row = next(r for r in rows if r.doc_id == 7)
    assert row.removed_spans == [2, 47] or row.n_removed == 0 or sum(b - a for a, b in zip(row.removed_spans[::2], row.removed_spans[1::2], strict=True)) == row.n_removed
    assert next(r for r in rows if r.doc_id == 5).kept_text == LONG


def test_empty_table(spark):
    assert remove_repeats(no_docs(spark)).count() == 0


def test_plan_shuffles_the_texts_once(spark):
    frame = remove_repeats(spark.read.parquet(f"{SF_DIR}/documents.parquet"))
    frame.write.format("noop").mode("overwrite").save()
    plan = frame._jdf.queryExecution().executedPlan().toString()
    frame.select(F.count("*")).collect()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan
