import hashlib
import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from pulselake.llm import fingerprints
from pulselake.llm.fingerprints import _tables, edited_pairs, neighbour_counts
from tests.llm.compare import SF_DIR
from tests.llm.rows import awkward, awkward_docs, no_docs, words_of
from tests.llm.test_simhash import close_values


def hashes(spark, texts):
    """Plain fingerprints: term hashes from Spark, votes counted here."""
    terms = {}
    for text in texts:
        words = [w.decode() for w in words_of(text)]
        terms[text] = [tuple(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    distinct = sorted({t for own in terms.values() for t in own})
    rows = spark.createDataFrame([(*t, *[None] * (3 - len(t))) for t in distinct], "a string, b string, c string")
    known = {tuple(x for x in (r.a, r.b, r.c) if x is not None): r.h % (1 << 64) for r in rows.select("*", F.xxhash64("a", "b", "c").alias("h")).collect()} if distinct else {}
    out = {}
    for text, own in terms.items():
        weights = [(known[t], sum(map(len, t))) for t in own]
        total = sum(w for _, w in weights)
        out[text] = sum(1 << b for b in range(64) if 2 * sum(w for h, w in weights if h >> b & 1) > total)
    return out


def test_whole_table(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    order = sorted(docs)
    following = dict(zip(order, order[1:] + order[:1], strict=True))
    cut = {i: docs[i][: len(docs[i]) - len(docs[i]) // 4] + docs[following[i]][: len(docs[i]) // 4] for i in order}
    prints = hashes(spark, [*docs.values(), *cut.values()])
    rows = edited_pairs(spark.read.parquet(f"{SF_DIR}/documents.parquet")).collect()
    assert len(rows) == len(docs)
    alike = lambda a, b: 1 - (a ^ b).bit_count() / 64
    for r in rows:
        own, edit, after = prints[docs[r.doc_id]], prints[cut[r.doc_id]], prints[docs[following[r.doc_id]]]
        near = sum(1 for i in order if i != r.doc_id and (prints[docs[i]] ^ own).bit_count() <= 3)
        assert r.asDict() == {
            "doc_id": r.doc_id, "n_chars": len(docs[r.doc_id]), "edited_sha256": hashlib.sha256(cut[r.doc_id].encode()).hexdigest(),
            "fingerprint": f"{own:016x}", "edited_fingerprint": f"{edit:016x}", "near_edited": alike(own, edit), "near_next": alike(own, after),
            "n_near": near,
        }


def test_awkward_rows(spark):
    rows = edited_pairs(awkward_docs(spark)).collect()
    assert sorted(((r.doc_id, r.n_chars) for r in rows), key=str) == sorted(((d, len(t or "")) for d, t, *_ in awkward()), key=str)
    by_text = {}
    texts = {d: t for d, t, *_ in awkward() if d is not None}
    for r in rows:
        if r.doc_id is not None:
            by_text.setdefault(texts[r.doc_id] or "", set()).add(r.fingerprint)
    assert all(len(v) == 1 for v in by_text.values())
    assert {r.fingerprint for r in rows if r.n_chars == 0} == {"0" * 16}
    assert edited_pairs(no_docs(spark)).count() == 0


def test_one_document_follows_itself(spark):
    row = edited_pairs(spark.createDataFrame([(5, "abcdefgh")], "doc_id long, text string")).first()
    assert row.edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest() and row.near_next == 1.0


@pytest.mark.parametrize("slice_rows", [4096, 7])
def test_neighbours_against_all_pairs(spark, monkeypatch, slice_rows):
    monkeypatch.setattr(fingerprints, "_SLICE", slice_rows)
    values = close_values(300, seed=9)
    random.seed(1)
    rows = [v - (1 << 64) if v >> 63 else v for v in values for _ in range(random.randint(1, 3))]
    expected = {v: sum(1 for w in rows if w != v and ((w ^ v) & (2**64 - 1)).bit_count() <= 3) for v in set(rows)}
    found = {r.fp: r.n for r in neighbour_counts(spark.createDataFrame([(v,) for v in rows], "fp long")).collect()}
    assert found == {v: n for v, n in expected.items() if n}


def test_some_table_has_every_close_pair():
    masks = _tables(3, 5)
    assert len(masks) == 10
    for bits in combinations(range(0, 64, 5), 3):
        apart = sum(1 << b for b in bits)
        assert any(apart & m == 0 for m in (x % (1 << 64) for x in masks))


def test_main_path_is_native(spark):
    plan = edited_pairs(spark.read.parquet(f"{SF_DIR}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
