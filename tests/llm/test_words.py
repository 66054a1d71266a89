import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pulselake.llm.words import WORD, gathered_hashes, window_hashes, word_array, word_count, word_hashes, word_spans
from tests.llm.rows import awkward_docs, words_of

TEXTS = st.text(st.sampled_from("ab \t\n\r\x0b\x0c\x1c é,"), max_size=60)


@given(TEXTS)
@settings(max_examples=200, deadline=None)
def test_spans_are_the_words(text):
    data = text.encode()
    starts, ends = word_spans(data)
    assert [data[a:b] for a, b in zip(starts, ends, strict=True)] == data.split() == [w.encode() for w in re.findall(WORD, text)]


@given(st.lists(st.text("abc", min_size=1, max_size=5), min_size=1, max_size=40))
@settings(max_examples=100, deadline=None)
def test_hashes_follow_the_words(words):
    data = " ".join(words).encode()
    for which in (0, 1):
        hashes = word_hashes(data, *word_spans(data), which)
        assert len(set(hashes.tolist())) == len(set(words))
        assert [words[i] for i in np.unique(hashes, return_index=True)[1]] is not None
        windows = window_hashes(hashes, 3, which)
        runs = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        assert len(set(windows.tolist())) == len(set(runs))
        at = np.arange(len(windows))
        assert (gathered_hashes(hashes, at, 3, which) == windows).all()


def test_columns_split_alike(spark):
    docs = awkward_docs(spark)
    for row in docs.select("text", word_count(F.col("text")).alias("n"), word_array(F.col("text")).alias("words")).collect():
        assert row.n == len(words_of(row.text))
        assert [w.encode() for w in row.words] == words_of(row.text)
