import random
import re
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from pulselake.llm import simhash_trees
from pulselake.llm.components import components
from pulselake.llm.simhash_trees import Forest, near_duplicates, near_links, one_of_each, spanning, text_fingerprint
from tests.llm.rows import awkward, awkward_docs, no_docs


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(nodes, linked):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def close_values(count, seed=1):
    """Values in clusters of near ones, with distances about the radius."""
    rng = random.Random(seed)
    out = {0}
    while len(out) < count:
        value = rng.choice([*out]) if rng.random() < 0.7 else rng.getrandbits(64)
        for bit in rng.sample(range(64), rng.randint(1, 3)):
            value ^= 1 << bit
        out.add(value)
    return sorted(out)


@pytest.mark.parametrize("text", [None, "", " \t", "a", "a B", "É A É", "x y z", *(t for _, t, *_ in awkward() if t and len(t) < 2000)])
def test_fingerprint(text):
    assert text_fingerprint(text) == plain_fingerprint(text)


def test_a_tree_finds_all_within_the_radius():
    values = np.array(close_values(400), np.uint64)
    groups = np.arange(len(values)) % 3
    forest = Forest(groups, values)
    found = {(int(values[q]), int(forest.values[n])) for a in forest.links(groups, values, 2) for q, n in zip(*a, strict=True)}
    by_group = {g: values[groups == g].tolist() for g in range(3)}
    assert found == {(a, b) for own in by_group.values() for a in own for b in own if (a ^ b).bit_count() <= 2}


def test_spanning_labels():
    rng = np.random.default_rng(2)
    left, right = rng.integers(0, 200, 150), rng.integers(0, 200, 150)
    expected = plain_components(range(200), zip(left.tolist(), right.tolist(), strict=True))
    assert spanning(left, right, np.arange(200)).tolist() == [expected[i] for i in range(200)]


def test_spanning_goes_on_from_earlier_labels():
    label = spanning(np.array([3, 4]), np.array([2, 2]), np.arange(5))
    assert spanning(np.array([3, 4]), np.array([0, 1]), label).tolist() == [0] * 5
    rng = np.random.default_rng(5)
    for size in (20, 300):
        label, pairs = np.arange(size), []
        for _ in range(8):
            left, right = rng.integers(0, size, (2, size // 10))
            pairs += zip(left.tolist(), right.tolist(), strict=True)
            label = spanning(left, right, label)
            expected = plain_components(range(size), pairs)
            assert label.tolist() == [expected[i] for i in range(size)]


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(400, 460)] + [(7, 7), (500, 3), (3, 500)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "x long, y long")).collect()}
    nodes = {n for a, b in edges if a != b for n in (a, b)}
    assert found == plain_components(nodes, [e for e in edges if e[0] != e[1]])
    assert components(spark.createDataFrame([], "x long, y long")).count() == 0


@pytest.mark.parametrize("crowd", [20_000, 40])
def test_links_connect_what_is_near(spark, monkeypatch, crowd):
    monkeypatch.setattr(simhash_trees, "_CROWD", crowd)
    values = [v - (1 << 64) if v >> 63 else v for v in close_values(500)] + [i << 40 for i in range(1, 200)]
    values = sorted(set(values))
    edges = near_links(spark.createDataFrame([(v,) for v in values], "fp long")).collect()
    near = [(a, b) for a, b in combinations(values, 2) if ((a ^ b) & (2**64 - 1)).bit_count() <= 2]
    got = plain_components(values, [(r.a, r.b) for r in edges])
    assert got == plain_components(values, near)


def expected_components(rows):
    prints = [(d, text_fingerprint(t)) for d, t, *_ in rows]
    values = sorted({f for _, f in prints})
    root = plain_components(values, [(a, b) for a, b in combinations(values, 2) if (a ^ b).bit_count() <= 2])
    least = {}
    for d, f in prints:
        if d is not None:
            least[root[f]] = min(d, least.get(root[f], d))
    return sorted(((d, f"{f:016x}", least.get(root[f])) for d, f in prints), key=str)


def test_awkward_rows(spark):
    found = near_duplicates(awkward_docs(spark)).select("doc_id", simhash_trees.fingerprint_text(F.col("fp")), "component_id").collect()
    assert sorted((tuple(r) for r in found), key=str) == expected_components(awkward())


def test_one_of_each(spark):
    docs = awkward_docs(spark)
    kept = one_of_each(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    components_ = {c for *_, c in expected_components(awkward())}
    assert sorted(r.doc_id for r in rows if r.doc_id is not None) == sorted(c for c in components_ if c is not None)
    assert not [r for r in rows if r.doc_id is None]  # theirs have named rows, too


def test_one_of_each_without_ids(spark):
    docs = spark.createDataFrame([(None, "a b c d"), (None, "a b c d"), (None, "e f g h"), (1, "i j k l"), (1, "i j k l"), (1, "other text")], "doc_id long, text string")
    assert sorted((tuple(r) for r in one_of_each(docs).collect()), key=str)[1:] == [(None, "a b c d"), (None, "e f g h")]
    assert one_of_each(docs).where("doc_id = 1").count() == 1


def test_empty_table(spark):
    assert near_duplicates(no_docs(spark)).count() == 0
    assert one_of_each(no_docs(spark)).count() == 0
