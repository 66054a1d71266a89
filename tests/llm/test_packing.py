import random
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pulselake.llm import packing
from pulselake.llm.packing import FIXED, LENGTHS, best_fit, pack
from tests.llm.compare import SF_DIR
from tests.llm.rows import awkward, awkward_docs, no_docs, words_of


def cheapest(total, lengths, fixed):
    """Least cost of bins of at least ``total`` tokens, in whole units of the smallest length."""
    units = -(-total // min(lengths))
    best = {0: 0}
    for u in range(1, units + 1):
        best[u] = min(fixed + c + best[max(0, u - c // min(lengths))] for c in lengths)
    return best[units]


def plain_pack(sizes, lengths, fixed):
    """The rule, by looking through all open bins."""
    bins, where, left = [], [], sum(sizes)
    for size in sizes:
        left -= size
        fits = [(room - size, i) for i, (room, _) in enumerate(bins) if room >= size]
        if fits:
            _, at = min(fits)
        else:
            length = min((c for c in lengths if c >= size), key=lambda c: (fixed + c + cheapest(max(0, size + left - c), lengths, fixed), c))
            bins.append((length, 0))
            at = len(bins) - 1
        where.append((at, bins[at][1]))
        bins[at] = (bins[at][0] - size, bins[at][1] + size)
    return where, [min(c for c in lengths if c >= used) for _, used in bins]


@given(st.lists(st.integers(1, 40), max_size=60))
@settings(max_examples=200, deadline=None)
def test_the_rule(sizes):
    sizes = sorted(sizes, reverse=True)
    bins, offsets, lengths = pack(sizes, (8, 16, 40), 3)
    where, expected = plain_pack(sizes, (8, 16, 40), 3)
    assert [*zip(bins, offsets, strict=True)] == where and lengths == expected


def best_cost(sizes, lengths, fixed):
    """Least cost over all partitions of a few items."""
    best = float("inf")

    def go(i, loads):
        nonlocal best
        if i == len(sizes):
            best = min(best, sum(fixed + min(c for c in lengths if c >= n) for n in loads))
            return
        for k in range(len(loads)):
            if loads[k] + sizes[i] <= max(lengths):
                go(i + 1, [*loads[:k], loads[k] + sizes[i], *loads[k + 1 :]])
        go(i + 1, [*loads, sizes[i]])

    go(0, [])
    return best


def test_near_the_least_cost():
    rng = random.Random(8)
    cost = optimum = 0
    for _ in range(60):
        sizes = sorted((rng.randint(1, 16) for _ in range(7)), reverse=True)
        cost += sum(1 + c for c in pack(sizes, (4, 8, 16), 1)[2])
        optimum += best_cost(sizes, (4, 8, 16), 1)
    assert optimum <= cost <= 1.1 * optimum


def checked(rows, sizes):
    """Every token once, no bin too full, none longer than its contents need."""
    pieces, bins = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        bins[r.shard, r.bin].append(r)
    for ident, expected in sizes.items():
        own = pieces[ident]
        assert sorted(r.piece_start + i for r in own for i in (0, r.n_tokens)) == sorted(x for n in expected for s in range(0, max(n, 1), max(LENGTHS)) for x in (s, min(n, s + max(LENGTHS))))
    for own in bins.values():
        own.sort(key=lambda r: (r.bin_offset, r.n_tokens))
        used = 0
        for r in own:
            assert r.bin_offset == used
            used += r.n_tokens
        assert own[0].bin_length == min(c for c in LENGTHS if c >= used)
        assert len({r.bin_length for r in own}) == 1


@pytest.mark.parametrize("shard_tokens", [packing._SHARD_TOKENS, 5000])
def test_whole_table(spark, monkeypatch, shard_tokens):
    monkeypatch.setattr(packing, "_SHARD_TOKENS", shard_tokens)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = best_fit(docs).collect()
    checked(rows, {r.doc_id: [len(words_of(r.text))] for r in docs.collect()})
    filled = sum(r.n_tokens for r in rows) / sum({(r.shard, r.bin): r.bin_length for r in rows}.values())
    assert filled > 0.85


def test_awkward_rows(spark):
    sizes = defaultdict(list)
    for ident, text, *_ in awkward():
        sizes[ident].append(len(words_of(text)))
    checked(best_fit(awkward_docs(spark)).collect(), sizes)
    assert best_fit(no_docs(spark)).count() == 0


def test_given_sizes(spark):
    docs = awkward_docs(spark)
    rows = best_fit(docs, tokens=F.when(F.col("doc_id") == 1, 20_000).when(F.col("doc_id") == 2, -5)).collect()
    checked(rows, {1: [20_000], 2: [0], 3: [0]})


def test_cost_decides_the_length():
    # A long bin is worth it only if enough is to come.
    assert pack([600], LENGTHS, FIXED)[2] == [1024]
    assert pack([600] + [400] * 18, LENGTHS, FIXED)[2] == [8192]


def test_empty_texts_are_dealt_over_shards(spark):
    docs = spark.range(120_000).select(F.when(F.col("id") % 3 > 0, F.col("id") % 7).alias("doc_id"), F.lit("").alias("text"))
    found = best_fit(docs).groupBy("shard").count().collect()
    assert len(found) == 3 and max(r["count"] for r in found) < 60_000
