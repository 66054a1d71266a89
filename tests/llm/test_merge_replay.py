import base64
import hashlib
import random

import numpy as np
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pulselake.llm import merge_replay
from pulselake.llm.edit_counts import PATTERN
from pulselake.llm.merge_replay import Replay, decode, encode, rank_file
from pulselake.llm.queries import op13_merge_replay, tokenizer_path
from tests.llm.compare import SF_DIR
from tests.llm.rows import awkward, awkward_docs, no_docs

PATH = tokenizer_path("byte_bpe_50k.tiktoken")
VOCABULARY = rank_file(PATH)
LIBRARY = tiktoken.Encoding("given", pat_str=PATTERN, mergeable_ranks=VOCABULARY.ranks, special_tokens={})
TEXT = st.text(st.sampled_from("abcdefghinrst    \n\t'12é\xa0　हि́!?.,\x1c​\U0001f600"), max_size=60)


def replayed(words):
    return [x.tolist() for x in Replay(VOCABULARY, [w.encode() for w in words]).ids()]


@given(st.lists(TEXT, max_size=8))
@settings(max_examples=300, deadline=None)
def test_words_as_the_library_encodes_texts(texts):
    for text in texts:
        words = VOCABULARY.cut(text)
        ids = [i for own in (replayed(words) if words else []) for i in own]
        assert ids == LIBRARY.encode_ordinary(text)
        assert bytes(VOCABULARY.decoded(np.array(ids, np.int64))) == text.encode()


def test_many_words_at_once():
    rng = random.Random(4)
    words = list({"".join(rng.choice("abeinorst ") for _ in range(rng.randint(1, 14))).strip() or "a" for _ in range(4000)}) + ["a" * 1001, "ab" * 500]
    assert replayed(words) == [LIBRARY.encode_ordinary(w) for w in words]


def tiny(folder, merges):
    """A vocabulary of all bytes and the given tokens, in the order of their ranks."""
    path = f"{folder}/tiny.tiktoken"
    tokens = [bytes([b]) for b in range(256)] + merges
    with open(path, "wb") as out:
        out.writelines(base64.b64encode(t) + b" %d\n" % i for i, t in enumerate(tokens))
    return rank_file(path)


def test_a_pair_of_lower_rank_that_comes_up_late(folder):
    # "abc" ranks below "bc", but only "a" + "bc" makes it.
    late = tiny(folder, [b"abc", b"bc", b"bca", b"abcbc"])
    library = tiktoken.Encoding("late", pat_str=PATTERN, mergeable_ranks=late.ranks, special_tokens={})
    words = ["abcbc", "bcabcbcabc", "abc", "bcbca", "a", "aabcbcbca"]
    replay = Replay(late, [w.encode() for w in words])
    assert [x.tolist() for x in replay.ids()] == [library.encode_ordinary(w) for w in words]
    assert replay.odd


def expected(text):
    ids = LIBRARY.encode_ordinary(text or "")
    return ids, (text or "").encode()


def test_awkward_rows(spark):
    rows = awkward() + [(21, "<|endoftext|> plain \x00 text", "en", "a", 1, 1, "x", "y", "z"), (22, "x" * 30_000, "en", "a", 1, 1, "x", "y", "z")]
    docs = spark.createDataFrame(rows, awkward_docs(spark).schema)
    found = encode(docs, PATH, decoded=True).collect()
    assert sorted(bytes(r.decoded) for r in decode(encode(docs, PATH), PATH).collect()) == sorted(bytes(r.decoded) for r in found)
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    assert sorted(((r.doc_id, list(r.ids), bytes(r.decoded)) for r in found), key=key) == sorted(((r[0], *expected(r[1])) for r in rows), key=key)


def test_no_rows(spark):
    assert decode(encode(no_docs(spark), PATH), PATH).collect() == []


def test_ids_outside_the_vocabulary_and_null_ids(spark):
    rows = spark.createDataFrame([(1, [64, None, 65]), (2, None), (3, [])], "n int, ids array<int>")
    assert [bytes(r.decoded) for r in decode(rows, PATH).sort("n").collect()] == [VOCABULARY.tokens[64] + VOCABULARY.tokens[65], b"", b""]
    with pytest.raises(Exception, match="vocabulary"):
        decode(spark.createDataFrame([(1, [50_256])], "n int, ids array<int>"), PATH).collect()


def test_small_buckets_and_shards(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    whole = {r.doc_id: list(r.ids) for r in encode(docs, PATH).collect()}
    monkeypatch.setattr(merge_replay, "_BUCKET_BYTES", 4_000)
    monkeypatch.setattr(merge_replay, "_SHARD_BYTES", 10_000)
    assert {r.doc_id: list(r.ids) for r in encode(docs.repartition(5), PATH).collect()} == whole


def test_registered_query_as_the_library(spark):
    rows = op13_merge_replay(spark, SF_DIR).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", F.col("text")).collect()}
    assert len(rows) == len(texts)
    for r in rows:
        ids, data = expected(texts[r.doc_id])
        sha = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha, hashlib.sha256(data).hexdigest())
