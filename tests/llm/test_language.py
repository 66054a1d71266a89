import random

import pytest
from pyspark.sql import functions as F

from pulselake.llm import language
from tests.llm.compare import SF_DIR
from tests.llm.rows import awkward_docs, no_docs

ENGLISH = "the cat sat on the mat and then it went out of the house with another cat".split()
GERMAN = "die Katze liegt auf der Matte und geht dann aus dem Haus mit einer anderen Katze".split()


@pytest.fixture(scope="module")
def model(spark):
    random.seed(3)
    rows = [(i, " ".join(random.choices(ENGLISH if i % 2 else GERMAN, k=12)), "en" if i % 2 else "de") for i in range(40)]
    return language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))


def test_known_words_and_backing_off(model):
    assert model.languages == ["de", "en"]
    assert model.score("the house")[0] == "en"
    assert model.score("KATZE, Matte!")[0] == "de"
    # Not a word of the sample, but its n-grams are.
    assert "katzenhaus" not in model.words
    assert model.score("Katzenhaus")[0] == "de"
    assert 0 < model.score("xyz")[1] <= 1


def test_longest_known_grams_decide(model):
    word = "hausmatte"
    marked = f"<{word}>"
    longest = [g for g in (marked[i : i + 5] for i in range(len(marked) - 4)) if g in model.grams[4]]
    assert longest
    expected = model.table[[model.grams[4][g] for g in longest]].mean(axis=0)
    assert model.backed_off(word) == pytest.approx(expected)


def test_no_letters_is_undetermined(model):
    for text in (None, "", " ", "123 456 !?", "\n"):
        assert model.score(text) == ("und", 0.0)


def test_every_row_is_predicted(spark, model):
    docs = awkward_docs(spark)
    found = language.identify(docs, model)
    assert found.columns == ["doc_id", "lang_pred", "score"]
    rows = found.collect()
    assert len(rows) == docs.count()
    assert {r.lang_pred for r in rows} <= {"und", "de", "en"}
    assert all(0 <= r.score <= 1 for r in rows)


def test_empty_tables_and_no_labels(spark):
    empty = language.fit(no_docs(spark))
    assert empty.languages == [] and empty.score("some text") == ("und", 0.0)
    unlabelled = language.fit(awkward_docs(spark).withColumn("lang", F.lit(None).cast("string")))
    assert unlabelled.languages == []
    assert language.identify(no_docs(spark), empty).count() == 0


def test_labels_are_no_input_of_a_prediction(spark, model):
    docs = awkward_docs(spark)
    other = docs.withColumn("lang", F.lit("zz")).withColumn("source", F.lit("zz"))
    key = lambda frame: sorted((str(r.doc_id), r.lang_pred, r.score) for r in language.identify(frame, model).collect())
    assert key(docs) == key(other)


def test_memo_bound_changes_nothing(model, monkeypatch):
    text = " ".join(f"{a}{b}atze" for a in "abcdefgh" for b in "aeiou") * 3
    expected = model.score(text)
    monkeypatch.setattr(language, "_KEPT", 8)
    monkeypatch.setattr(language, "_CHUNK", 5)
    model.memo.clear()
    assert model.score(text)[0] == expected[0] and model.score(text)[1] == pytest.approx(expected[1])
    model.memo.clear()
    model.extra = model.extra[:0]


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    fold = F.crc32(F.col("doc_id").cast("string")) % 5
    found = language.identify(docs.where(fold == 0), language.fit(docs.where(fold != 0)))
    right = found.join(docs.select("doc_id", "lang"), "doc_id").where("lang IS NOT NULL").select(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right >= 0.95


def recounted(rows, texts):
    """Languages and scores by plain counting over all labelled rows."""
    import math
    import unicodedata
    from collections import Counter, defaultdict

    def words(text):
        out, own = [], ""
        for c in (text or "").lower() + " ":
            kind = unicodedata.category(c)[0]
            if kind == "L" or kind == "M" and own:
                own += c
            else:
                out += [own] if own else []
                own = ""
        return out

    def grams(word):
        marked = f"<{word}>"
        return [(k, marked[i : i + k]) for k in range(1, 6) for i in range(len(marked) - k + 1)]

    counts = defaultdict(Counter)
    for _, text, label in rows:
        for word in words(text):
            counts[label][0, word] += 1
            counts[label].update(grams(word))
    names = sorted({label for _, _, label in rows})
    kinds = {item for own in counts.values() for item in own}
    size = Counter(k for k, _ in kinds)
    total = {(name, k): sum(n for (kind, _), n in counts[name].items() if kind == k) for name in names for k in range(6)}
    value = lambda name, item: math.log((counts[name][item] + 0.5) / (total[name, item[0]] + 0.5 * size[item[0]] + 1))
    out = []
    for text in texts:
        found = words(text)
        if not found:
            out.append(("und", 0.0))
            continue
        means = []
        for name in names:
            scores = []
            for word in found:
                known = [(0, word)] if (0, word) in kinds else []
                for k in range(5, 0, -1):
                    known = known or [g for g in grams(word) if g[0] == k and g in kinds]
                scores.append(sum(value(name, g) for g in known) / len(known) if known else 0.0)
            means.append(sum(scores) / len(scores))
        best = max(range(len(names)), key=lambda i: (means[i], -i))
        out.append((names[best], 1 / sum(math.exp((m - means[best]) * min(len(found), 20)) for m in means)))
    return out


def test_a_whole_table_recounted(spark):
    rng = random.Random(6)
    hindi = "हिन्दी में यह एक वाक्य है और किताब पढ़ना अच्छा है".split()
    pools = {"en": ENGLISH, "de": GERMAN, "hi": hindi, "rare": ["ʼn", "œuvre", "Ångström", "ﬁn"]}
    rows = [(i, " ".join(rng.choices(pools[name], k=rng.randint(0, 9))) + rng.choice(["", " ²", " 12½!", "\n"]), name)
            for i, name in enumerate(rng.choices(list(pools), weights=[5, 3, 3, 1], k=120))]
    texts = [t for _, t, _ in rows] + ["² ½", "Ⅷ Ⅸ", "हि", "\u0301", "katzenhaus Größe", "किताबें", "zzz the", None, ""]
    model = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(docs, model).collect()}
    for i, (name, score) in enumerate(recounted(rows, texts)):
        assert found[i][0] == name and found[i][1] == pytest.approx(score)
    assert "हिन्दी" in model.words and found[120] == found[121] == ("und", 0.0)


def test_seventy_labels(spark):
    rng = random.Random(1)
    words = {f"l{n:02d}": ["".join(rng.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(5)] for n in range(70)}
    rows = [(i, " ".join(rng.choices(words[name], k=12)), name) for i, name in enumerate([*words] * 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = {r.doc_id: r.lang_pred for r in language.identify(docs, language.fit(docs)).collect()}
    assert all(found[i] == name for i, _, name in rows)


def test_ties_go_to_the_first_label(spark):
    docs = spark.createDataFrame([(1, "same words", "b"), (2, "same words", "a")], "doc_id long, text string, lang string")
    assert language.fit(docs).score("same")[0] == "a"
