import random
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from pulselake.llm import token_files, tokens
from pulselake.llm.queries import op8_token_files, tokenizer_path
from tests.llm.compare import SF_DIR
from tests.llm.rows import awkward, awkward_docs, no_docs

PATH = tokenizer_path("word_bpe_49k.json")
PLAIN = Tokenizer.from_file(PATH)


def ids_of(text):
    return PLAIN.encode(text or "", add_special_tokens=False).ids


@given(st.text(max_size=40) | st.text(st.sampled_from("aAzé ÉßİŉǅŸ.,'!s1٣一 \t\x1c\x85\xa0<|endoftext|>́"), max_size=40))
@settings(max_examples=400, deadline=None)
def test_words_give_the_ids_of_the_text(text):
    assert tokens.word_tokenizer(PATH).ids(text.encode()).tolist() == ids_of(text)


def test_every_letter_by_the_merges_is_as_encoded():
    tokenizer = tokens.WordTokenizer(PATH)
    for code in range(0x21, 0x260):
        for text in (chr(code), f"a{chr(code)}b", f"{chr(code)},"):
            assert tokenizer.ids(text.encode()).tolist() == ids_of(text), hex(code)


def test_a_full_memo_changes_nothing(monkeypatch):
    monkeypatch.setattr(tokens, "_KEPT", 3)
    tokenizer = tokens.WordTokenizer(PATH)
    random.seed(1)
    text = " ".join(random.choice(["one", "Two,", "drei", "größe", "x1", "!!", "end."]) for _ in range(200))
    assert tokenizer.ids(text.encode()).tolist() == ids_of(text)
    assert len(tokenizer.words) <= 3 >= len(tokenizer.words.older)


def expected(rows, end):
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    start, out = 0, []
    for ident, text in order:
        ids = np.array([*ids_of(text), end], "<u4")
        out.append((ident, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_query_on_the_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(tuple(r) for r in op8_token_files(spark, SF_DIR).collect()) == expected(rows, 2)


@pytest.mark.parametrize("encoding", ["dictionary", "delta"])
def test_awkward_rows(spark, folder, encoding):
    out = f"{folder}/tokens"
    token_files.write_tokens(awkward_docs(spark), out, PATH, end=7, encoding=encoding)
    rows = [(d, t) for d, t, *_ in awkward()]
    named = [r for r in rows if r[0] is not None]
    found = sorted((tuple(r) for r in token_files.digests(spark, out).collect()), key=lambda r: r[1])
    assert sorted(r for r in found if r[0] is not None) == sorted(expected(named, 7))
    assert sorted(r[2:] for r in found if r[0] is None) == sorted(r[2:] for r in expected([r for r in rows if r[0] is None], 7))
    # The documents tile the sequence of all ids.
    ends = [s + n for _, s, n, _ in found]
    assert [s for _, s, _, _ in found] == [0, *ends[:-1]]


def test_file_format_and_selective_reads(spark, folder):
    out = f"{folder}/tokens"
    docs = spark.createDataFrame([(i, f"word{i % 7} " * (i % 50)) for i in range(3000)], "doc_id long, text string").repartition(5)
    token_files.write_tokens(docs, out, PATH, end=2, page_rows=100)
    low = token_files.read_tokens(spark, out, 1500, 1503).collect()
    assert sorted((r.doc_id, r.ids) for r in low) == [(i, [*ids_of(f"word{i % 7} " * (i % 50)), 2]) for i in range(1500, 1504)]
    schema = token_files.read_metadata(spark, out)._jdf.queryExecution().executedPlan().toString()
    assert "ids" not in schema.split("ReadSchema:")[1]
    import glob

    for name in glob.glob(f"{out}/*.parquet"):
        column = pq.ParquetFile(name).metadata.row_group(0)
        ids = next(column.column(i) for i in range(column.num_columns) if column.column(i).path_in_schema.startswith("ids"))
        assert ids.has_offset_index and ids.has_column_index
        assert any("DICTIONARY" in e for e in ids.encodings)


def test_empty_table(spark, folder):
    token_files.write_tokens(no_docs(spark), f"{folder}/none", PATH, end=2)
    assert token_files.digests(spark, f"{folder}/none").count() == 0


def test_unknown_encoding(spark, folder):
    with pytest.raises(ValueError):
        token_files.write_tokens(no_docs(spark), f"{folder}/bad", PATH, end=2, encoding="zip")
