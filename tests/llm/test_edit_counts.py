import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pulselake.llm import edit_counts
from pulselake.llm.edit_counts import PretokenCounter, SegmentTree, build_trees, count_edits, update_trees
from pulselake.llm.queries import op7_edit_token_counts, tokenizer_path
from tests.llm.compare import SF_DIR
from tests.llm.rows import awkward, awkward_docs, no_docs

PATH = tokenizer_path("byte_bpe_50k.tiktoken")
COUNTER = PretokenCounter(PATH)
TEXT = st.text(st.sampled_from("abC 's'll12 \t\n  é,!?\x1c\xa0"), max_size=30)


def whole(text):
    return len(COUNTER.encoding.encode_ordinary(text))


def edited(text, start, length, insert):
    start = min(max(start, 0), len(text))
    return text[:start] + insert + text[start + max(length, 0) :]


@given(TEXT.map(lambda t: t * 3), st.lists(st.tuples(st.integers(-2, 95), st.integers(-1, 30), TEXT), max_size=6), st.integers(1, 4))
@settings(max_examples=400, deadline=None)
def test_edits_count_as_the_whole_text(text, edits, leaf):
    before, edit_counts._LEAF = edit_counts._LEAF, leaf
    try:
        tree = SegmentTree(COUNTER, text)
        assert tree.total == whole(text)
        for start, length, insert in edits:
            tree.replace(start, length, insert)
            text = edited(text, start, length, insert)
            assert tree.text() == text
            assert tree.total == whole(text)
            assert [p for own in tree.leaves for p in own] == COUNTER.cut(text)
            assert tree.chars[1] == len(text)
    finally:
        edit_counts._LEAF = before


def test_only_the_touched_region_is_encoded_again():
    random.seed(2)
    text = " ".join(random.choice(["alpha", "beta", "gamma's", "42"]) for _ in range(20_000))
    tree = SegmentTree(COUNTER, text)
    for _ in range(50):
        at = random.randrange(len(text))
        tree.replace(at, 5, "new words")
        text = edited(text, at, 5, "new words")
    assert tree.total == whole(text)
    assert tree.encoded_chars < 50 * 80
    assert max(map(len, tree.leaves)) <= 8 * edit_counts._LEAF


def test_a_grown_leaf_is_evened_out():
    tree = SegmentTree(COUNTER, "start end")
    for i in range(1200):
        tree.replace(6, 0, f"word{i} ")
    assert max(map(len, tree.leaves)) <= 8 * edit_counts._LEAF
    assert tree.total == whole(tree.text())


def test_query_on_the_whole_table(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = op7_edit_token_counts(spark, SF_DIR).collect()
    assert len(rows) == len(docs)
    for r in rows:
        text = docs[r.doc_id].text or ""
        half, start = len(text) // 2, text[:24]
        after = edited(text, len(text) // 4, 24, start)
        after = edited(after, half, 0, f" {docs[r.doc_id].source or ''} {r.doc_id}") + ", the end."
        assert (r.n_tokens, r.n_edited, r.n_chars_edited) == (whole(text), whole(after), len(after))


def test_awkward_rows(spark):
    one = F.array(F.struct(F.lit(1).alias("start"), F.lit(None).cast("long").alias("length"), F.lit("né w").alias("insert")))
    rows = count_edits(awkward_docs(spark), F.when(F.coalesce(F.col("doc_id"), F.lit(0)) % 2 == 0, one), PATH).collect()
    expected = [(d, whole(t or ""), whole(edited(t or "", 1, 0, "né w")) if (d or 0) % 2 == 0 else whole(t or "")) for d, t, *_ in awkward()]
    assert sorted(((r.doc_id, r.n_tokens, r.n_edited) for r in rows), key=str) == sorted(expected, key=str)
    assert count_edits(no_docs(spark), one, PATH).count() == 0


def test_kept_trees_follow_later_edits(spark, folder):
    docs = awkward_docs(spark).where("doc_id IS NOT NULL AND doc_id <> 8")
    build_trees(docs, PATH).write.parquet(f"{folder}/trees")
    trees = spark.read.parquet(f"{folder}/trees")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    assert {r.doc_id: r.n_tokens for r in trees.collect()} == {d: whole(t) for d, t in texts.items()}
    edits = [(5, 2, 10, 4, "again "), (5, 1, 1000, 0, " first"), (1, 1, 0, 0, "was null"), (2, 1, 3, 3, None), (99, 1, 0, 0, "no such")]
    table = spark.createDataFrame(edits, "doc_id long, seq int, start long, length long, insert string")
    changed = update_trees(trees, table, PATH)
    found = {r.doc_id: r for r in changed.collect()}
    expected = {5: edited(edited(texts[5], 1000, 0, " first"), 10, 4, "again "), 1: "was null", 2: ""}
    assert {d: r.text for d, r in found.items()} == expected
    assert {d: r.n_tokens for d, r in found.items()} == {d: whole(t) for d, t in expected.items()}
    assert found[5].n_encoded_again < 200
    # Updated rows are trees again.
    more = update_trees(changed.drop("n_encoded_again"), table.where("doc_id = 1"), PATH).first()
    assert (more.text, more.n_tokens) == ("was nullwas null", whole("was nullwas null"))


def test_repeated_rows_and_rows_without_an_id(spark):
    docs = spark.createDataFrame([(1, "one two"), (1, "one two"), (1, "other"), (None, "no id"), (2, None)], "doc_id long, text string")
    kept = build_trees(docs, PATH)
    assert sorted((r.doc_id is None, r.n_tokens) for r in kept.collect()) == [(False, 0), (False, 1), (False, 2), (False, 2), (True, 2)]
    edits = spark.createDataFrame([(1, 1, 0, 0, "b "), (1, 0, 0, 0, "a "), (None, 0, 0, 0, "x"), (2, 0, 0, 0, "y"), (3, 0, 0, 0, "z")],
                                  "doc_id long, seq int, start long, length long, insert string")
    found = sorted((r.doc_id, r.text, r.n_tokens) for r in update_trees(kept, edits, PATH).collect())
    assert found == [(1, "b a one two", 4), (1, "b a one two", 4), (1, "b a other", 3), (2, "y", 1)]
    assert all(n == whole(t) for _, t, n in found)
