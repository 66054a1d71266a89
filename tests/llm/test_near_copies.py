import random
from itertools import combinations

import numpy as np
import pytest

import corpus_pipeline
from pulselake.llm.near_copies import _thinned, left_out, marks_of, shingle_hashes, similarity
from tests.llm.rows import awkward_docs, no_docs
from tests.llm.test_simhash import plain_components

BINS = (0.8, 0.85, 0.9, 0.95)


def shingles(text):
    words = text.lower().split()
    return {" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def jaccard(a, b):
    return len(a & b) / len(a | b)


def edited(rng, words, edits):
    words = list(words)
    for at in rng.sample(range(len(words)), edits):
        words[at] = f"new{rng.getrandbits(30)}"
    return " ".join(words)


def pairs_of_texts(per_bin=60, seed=3):
    """Pairs of every band of similarity, a pair's texts being like no others."""
    rng, out = random.Random(seed), {low: [] for low in BINS}
    while any(len(v) < per_bin for v in out.values()):
        words = [f"w{rng.randrange(4000)}" for _ in range(rng.randint(60, 400))]
        a, b = " ".join(words), edited(rng, words, rng.randint(1, max(1, len(words) // 40)))
        s = jaccard(shingles(a), shingles(b))
        low = max((x for x in BINS if x <= s), default=None)
        if low is not None and len(out[low]) < per_bin:
            out[low].append((a, b))
    return out


def test_stage_recall_from_0_8(spark):
    bins, rows = pairs_of_texts(), []
    for pairs in bins.values():
        for a, b in pairs:
            rows += [(len(rows), a), (len(rows) + 1, b)]
    kept = {r.doc_id for r in corpus_pipeline.simhash_dedup(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect()}
    assert all(i in kept for i in range(0, len(rows), 2))
    at = 1
    for low, pairs in bins.items():
        gone = sum(i not in kept for i in range(at, at + 2 * len(pairs), 2))
        at += 2 * len(pairs)
        print(f"recall from {low}: {gone}/{len(pairs)}")
        assert gone >= 0.95 * len(pairs)


def test_stage_against_brute_force(spark):
    """Large groups of copies of one text, not all alike, and texts just below the similarity."""
    rng, texts = random.Random(8), []
    for size in (300, 40, 6):
        words = [f"w{rng.randrange(4000)}" for _ in range(200)]
        texts += [edited(rng, words, rng.randint(0, 7)) for _ in range(size)]
    sets = [shingles(t) for t in texts]
    linked = [(a, b) for a, b in combinations(range(len(texts)), 2) if jaccard(sets[a], sets[b]) >= 0.8]
    expected = set(plain_components(range(len(texts)), linked).values())
    docs = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")
    kept = {r.doc_id for r in corpus_pipeline.simhash_dedup(spark, docs, "").collect()}
    assert kept >= expected  # what is not alike stays
    print(f"components: {len(expected)}, kept: {len(kept)}")
    assert len(kept - expected) <= 0.02 * len(texts)


def template_texts(texts=500, pairs=100, seed=5):
    """Texts that share a template, most just not alike, and copies of some."""
    rng = random.Random(seed)
    template = [f"t{i}" for i in range(200)]
    own = [edited(rng, template, 3).split() for _ in range(texts)]
    return [" ".join(words) for words in own] + [edited(rng, words, 5) for words in own[:pairs]]


def test_links_among_many_texts_of_a_template(spark):
    """Each text is near to hundreds that are not alike: the links left out by the trees' tasks are verified too."""
    texts = template_texts()
    sets = [shingles(t) for t in texts]
    linked = [(a, b) for a, b in combinations(range(len(texts)), 2) if jaccard(sets[a], sets[b]) >= 0.8]
    expected = set(plain_components(range(len(texts)), linked).values())
    kept = {r.doc_id for r in corpus_pipeline.simhash_dedup(spark, spark.createDataFrame([*enumerate(texts)], "doc_id long, text string"), "").collect()}
    print(f"components: {len(expected)}, kept: {len(kept)}, links: {len(linked)}")
    assert kept == expected


@pytest.mark.parametrize("least", [0.5, 0.8])
def test_pairs_left_out_against_brute_force(spark, least):
    """All alike pairs of texts of different roots, however short the texts and common the shingles."""
    rng = random.Random(4)
    base = [[f"w{rng.randrange(30)}" for _ in range(n)] for n in (3, 6, 9, 14, 30, 60)]
    texts = sorted({edited(rng, words, rng.randint(0, len(words) // 6 + 1)) for words in base for _ in range(25)})
    sets = [np.unique(shingle_hashes(t)) for t in texts]
    expected = {(a, b) for a, b in combinations(range(len(texts)), 2) if a % 3 != b % 3 and similarity(sets[a], sets[b]) >= least}
    rows = spark.createDataFrame([(i, i % 3, t) for i, t in enumerate(texts)], "node long, root long, text string")
    found = {(r.a, r.b) for r in left_out(rows, least, 5).collect()}
    assert expected and found >= expected and all(a % 3 != b % 3 for a, b in found)


def test_every_component_keeps_a_row(spark):
    docs = spark.createDataFrame([(1, "a b c d"), (1, "a b c d"), (1, "other text"), (None, "e f g h"), (None, "e f g h"), (None, "a b c d")], "doc_id long, text string")
    kept = corpus_pipeline.simhash_dedup(spark, docs, "").collect()
    assert sorted((tuple(r) for r in kept), key=str) == [(1, "a b c d"), (1, "other text"), (None, "e f g h")]


@pytest.mark.parametrize("make", [awkward_docs, no_docs])
def test_awkward_rows(spark, make):
    docs = make(spark)
    kept = corpus_pipeline.simhash_dedup(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == ([1, 4, 5, 6, 9, 12, 13, 2**62] if docs.count() else [])


def test_similarity_and_marks():
    a, b = (np.unique(shingle_hashes(t)) for t in ("a b c d e f g", "A b c d e  f h"))
    assert similarity(a, b) == 0.5 and similarity(a[:0], b[:0]) == 1.0 and similarity(a, b[:0]) == 0.0
    assert marks_of(None) == marks_of(" ") and marks_of("x Y") == marks_of("X y")


def test_a_thinned_group_stays_connected():
    rng = np.random.default_rng(1)
    left, right = rng.integers(0, 90, (2, 400))
    a, b, _ = _thinned(left, right, rng.integers(0, 9, 400), 90)
    whole, thin = (plain_components(range(90), zip(x.tolist(), y.tolist(), strict=True)) for x, y in ((left, right), (a, b)))
    assert whole == thin
