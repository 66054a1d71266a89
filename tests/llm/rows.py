"""Hand-made documents with the awkward cases: nulls, blanks, ties, repeats, clashing names."""

from __future__ import annotations

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, bucket int, fp string, size string, rest string"
LONG = " ".join(f"w{i % 977}x{i}" for i in range(60_000))
PASSAGE = " ".join(f"p{i}" for i in range(45))


def awkward() -> list[tuple]:
    """Texts: null, empty, blank, one word, one huge, shared passages, repeated rows, rows without an id."""
    texts = [
        (1, None), (2, ""), (3, " \t\n\r\x0b\x0c "), (4, "one"), (5, LONG), (6, f"Before it {PASSAGE} after it"),
        (7, f"another start\n{PASSAGE} end"), (8, PASSAGE), (8, PASSAGE), (9, "same text of five words"),
        (10, "same text of five words"), (11, "SAME Text of five words"), (12, "the the the the " * 30), (13, "Größe, übel! naïve café."),
        (None, "nameless row " + PASSAGE), (None, "nameless row " + PASSAGE), (None, None), (2**62, "last id " + "ab " * 50),
    ]
    kinds = [("en", "a"), (None, None), ("fr", "b")]
    return [(d, t, *kinds[i % 3], None if t is None else len(t), i, "x", "y", "z") for i, (d, t) in enumerate(texts)]


def awkward_docs(spark):
    return spark.createDataFrame(awkward(), SCHEMA)


def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().split()
