"""Language identification by words, backing off to shorter character n-grams.

A word known to the model scores by its log frequency in each language. An
unseen word is cut into character n-grams of the greatest length; if the model
knows none of them, into the next shorter, and so on. The language with the
best mean over the words wins.

The model is fitted on a bounded sample: at most ``rows`` labelled documents of
each label and at most about ``most_rows`` of all, chosen by a hash of the id.
It knows every word and n-gram of the sample in every label, however rare. It
is stored sparse, one number per word and language that has it, built in one
task and handed to the workers as compressed bytes, so it grows with the text
of the sample and not with words times languages; the driver never unpacks it.

A word is a letter and the letters and marks after it. The score is the share
of the best language in the evidence of the words, of which at most
``_EVIDENCE`` count, so that it does not saturate on long texts.

Defined results: null texts and texts without letters give ``und`` and score
0; so does every text if nothing is labelled. Ties go to the label that comes
first by code point. Rows without an id or a label are not learned from.
Repeated rows are scored alike; other columns are never looked at.
"""

from __future__ import annotations

import pickle
import re
from collections import Counter
from dataclasses import dataclass, field
from functools import cached_property
from itertools import chain, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulselake.llm.text_units import Numbering, stretches

UNKNOWN = "und"
_LETTERS = regex.compile(r"\p{L}[\p{L}\p{M}]*")
# The letters below U+0250, where there are no marks.
_COMMON_LETTERS = re.compile("[A-Za-zªµºÀ-ÖØ-öø-ɏ]+")
_LONGEST = 5
_EVIDENCE = 20
_KEPT = 200_000  # memory bound of a worker's memo of unseen words
_CELLS = 4_000_000
_CHUNK = 100_000
_DRAWS = 1 << 30


def words_of(text: str | None) -> list[str]:
    """The words of a text, in lower case."""
    text = (text or "").lower()
    return (_COMMON_LETTERS if text.isascii() or max(text) < "\u0250" else _LETTERS).findall(text)


@dataclass(frozen=True)
class Weights:
    """Log frequencies of words or n-grams: ``base`` holds for all, ``extra`` is added per language that has one."""

    rows: dict[str, int]
    base: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    columns: np.ndarray
    extra: np.ndarray

    @classmethod
    def counted(cls, items: list[str], columns: np.ndarray, counts: np.ndarray, languages: int) -> Weights:
        """From one count per item and language, in the order of the items."""
        new = [a != b for a, b in zip(items, [None, *items[:-1]], strict=True)]
        rows = {w: n for n, w in enumerate(w for w, first in zip(items, new, strict=True) if first)}
        totals = np.bincount(columns, counts, languages)
        starts = np.flatnonzero(new)
        return cls(rows, np.log(0.5 / (totals + 0.5 * len(rows) + 1)), starts, np.append(starts[1:], len(items)), columns, np.log(2 * counts + 1))

    def means(self, lists: list[list[int]]) -> np.ndarray:
        """Mean over the items of each list, by language; no list is empty."""
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        items = np.fromiter(chain.from_iterable(lists), np.int64, int(sizes.sum()))
        lengths = self.ends[items] - self.starts[items]
        at = stretches(self.starts[items], lengths)
        out = np.zeros((len(lists), len(self.base)))
        np.add.at(out, (np.repeat(np.repeat(np.arange(len(lists)), sizes), lengths), self.columns[at]), self.extra[at])
        return self.base + out / sizes[:, None]


@dataclass
class LanguageModel:
    """Weights of words and of n-grams by length, packed; unpacked where they are first used."""

    languages: list[str]
    data: bytes
    memo: dict[str, int] = field(default_factory=dict, repr=False)
    extra: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)), repr=False)

    @classmethod
    def packed(cls, languages: list[str], weights: list[Weights]) -> LanguageModel:
        return cls(languages, zstandard.compress(pickle.dumps(weights), 3))

    def __getstate__(self):
        return {"languages": self.languages, "data": self.data, "memo": {}, "extra": np.zeros((0, 0))}

    @cached_property
    def weights(self) -> list[Weights]:
        """Of words, then of n-grams of one character, two, and so on."""
        return pickle.loads(zstandard.decompress(self.data)) if self.data else []

    @property
    def words(self) -> dict[str, int]:
        return self.weights[0].rows

    @property
    def grams(self) -> list[dict[str, int]]:
        """N-grams by length; their numbers are rows of ``table``."""
        firsts = np.cumsum([len(w.rows) for w in self.weights])
        return [{g: int(first) + n for g, n in w.rows.items()} for first, w in zip(firsts, self.weights[1:], strict=False)]

    @property
    def table(self) -> np.ndarray:
        """All weights as one dense table, for inspection of small models."""
        return np.concatenate([w.means([[n] for n in range(len(w.rows))]) for w in self.weights if w.rows])

    def backed_off(self, word: str) -> np.ndarray:
        """Scores of an unseen word: the mean of its longest known n-grams."""
        return self._backed_off([word])[0]

    def _backed_off(self, words: list[str]) -> np.ndarray:
        found: list[tuple[list[int], list[list[int]]]] = [([], []) for _ in range(_LONGEST + 1)]
        for place, word in enumerate(words):
            marked = f"<{word}>"
            for length in range(min(_LONGEST, len(marked)), 0, -1):
                known = self.weights[length].rows
                rows = [known[g] for g in [marked[i : i + length] for i in range(len(marked) - length + 1)] if g in known]
                if rows:
                    found[length][0].append(place)
                    found[length][1].append(rows)
                    break
        out = np.zeros((len(words), len(self.languages)))
        for length, (places, lists) in enumerate(found):
            if places:
                out[places] = self.weights[length].means(lists)
        return out

    def rows_of(self, words: list[str]) -> np.ndarray:
        """Scores of distinct words, a row each."""
        known = self.weights[0]
        places = np.fromiter(map(known.rows.get, words, repeat(-1)), np.int64, len(words))
        seen, new = np.flatnonzero(places >= 0), np.flatnonzero(places < 0)
        out = np.empty((len(words), len(self.languages)))
        out[seen] = known.base
        starts = known.starts[places[seen]]
        lengths = known.ends[places[seen]] - starts
        at = stretches(starts, lengths)
        out[np.repeat(seen, lengths), known.columns[at]] += known.extra[at]
        kept = max(1, min(_KEPT, _CELLS // len(self.languages)))
        for first in range(0, len(new), kept):
            own = new[first : first + kept]
            out[own] = self._unseen([words[i] for i in own.tolist()], kept)
        return out

    def _unseen(self, new: list[str], kept: int) -> np.ndarray:
        if not len(self.extra):
            self.extra = np.empty((kept, len(self.languages)))
        missing = set(new).difference(self.memo)
        if len(self.memo) + len(missing) > len(self.extra):
            self.memo.clear()
            missing = set(new)
        learned = sorted(missing)
        self.extra[len(self.memo) : len(self.memo) + len(learned)] = self._backed_off(learned)
        self.memo.update(zip(learned, range(len(self.memo), len(self.memo) + len(learned))))
        return self.extra[[*map(self.memo.__getitem__, new)]]

    def scores(self, texts) -> list[tuple[str, float]]:
        """The best language of each text and its share of the evidence, 0 to 1.

        Words of many texts are looked up together, each distinct one once.
        """
        if not self.languages:
            return [(UNKNOWN, 0.0) for _ in texts]
        most = max(1, min(_CHUNK, _CELLS // len(self.languages)))
        sums, counts, number, parts, held = [], [], Numbering(), [], 0

        def add_up():
            table = self.rows_of([*number])
            for i, own in parts:
                sums[i] += table[own].sum(axis=0)
            number.clear()
            parts.clear()

        for i, text in enumerate(texts):
            words = words_of(text)
            sums.append(np.zeros(len(self.languages)))
            counts.append(len(words))
            for first in range(0, len(words), most):
                parts.append((i, number.of(words[first : first + most])))
                held += len(parts[-1][1])
                if held >= 8 * most or len(number) >= most:
                    add_up()
                    held = 0
        add_up()
        return [self._judged(total / n, n) if n else (UNKNOWN, 0.0) for total, n in zip(sums, counts, strict=True)]

    def _judged(self, mean: np.ndarray, words: int) -> tuple[str, float]:
        best = int(np.argmax(mean))
        weight = np.exp((mean - mean[best]) * min(words, _EVIDENCE))
        return self.languages[best], float(1 / weight.sum())

    def score(self, text: str | None) -> tuple[str, float]:
        """``scores`` of one text."""
        return self.scores([text])[0]


def _word_counts(batches):
    """Counts of the words of each batch, by language."""
    for batch in batches:
        counts: dict[str, Counter] = {}
        for label, text in zip(batch["label"], batch["text"], strict=True):
            if text:
                counts.setdefault(label, Counter()).update(words_of(text))
        yield pd.DataFrame(
            [(label, word, n) for label, found in counts.items() for word, n in found.items()],
            columns=["label", "word", "n"],
        )


def _gram_counts(batches):
    """Counts of the n-grams of counted words, by language and length."""
    for batch in batches:
        counts: Counter = Counter()
        for label, word, n in zip(batch["label"], batch["word"], batch["n"], strict=True):
            marked = f"<{word}>"
            for length in range(1, min(_LONGEST, len(marked)) + 1):
                for i in range(len(marked) - length + 1):
                    counts[label, length, marked[i : i + length]] += n
        yield pd.DataFrame([(*key, n) for key, n in counts.items()], columns=["label", "length", "gram", "n"])


def _model(names: list[str]):
    """Put all counts together; rows come by length (0 for words) and item."""

    def build(batches):
        columns = {name: i for i, name in enumerate(names)}
        kept = [([], [], []) for _ in range(_LONGEST + 1)]
        for batch in batches:
            for label, length, item, n in zip(*(batch[c].to_pylist() for c in ("label", "length", "item", "n")), strict=True):
                items, places, counts = kept[length]
                items.append(item)
                places.append(columns[label])
                counts.append(n)
        weights = [Weights.counted(items, np.array(places, np.int64), np.array(counts, np.int64), len(names)) for items, places, counts in kept]
        yield pa.RecordBatch.from_pylist([{"model": LanguageModel.packed(names, weights).data}], pa.schema([("model", pa.binary())]))

    return build


def fit(
    labelled: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "lang",
    rows: int = 3000,
    most_rows: int = 200_000,
) -> LanguageModel:
    """Fit a model on the labelled rows; the docstring of the module states the bounds."""
    keyed = labelled.select(
        F.col(id_column).alias("id"), F.col(text_column).alias("text"), F.col(label_column).alias("label")
    ).where("id IS NOT NULL AND label IS NOT NULL")
    counts = {r["label"]: r["count"] for r in keyed.groupBy("label").count().collect()}  # one row per label
    names = sorted(counts)
    if not names:
        return LanguageModel([], b"")
    rows = max(1, min(rows, most_rows // len(names)))
    # Hashes below a bound that leaves somewhat more than enough of each label, so
    # that the ranking gets as few rows of a frequent label as of any other.
    draw = F.pmod(F.xxhash64("id"), F.lit(_DRAWS))
    bounds = labelled.sparkSession.createDataFrame(
        [(name, int(_DRAWS * min(1.0, (1.5 * rows + 500) / n))) for name, n in counts.items()], "label string, bound long"
    )
    order = Window.partitionBy("label").orderBy("draw", "id")
    chosen = (
        keyed.select("label", "id", draw.alias("draw")).join(F.broadcast(bounds), "label").where("draw <= bound")
        .withColumn("place", F.row_number().over(order)).where(F.col("place") <= rows).select("label", "id").distinct()
    )
    # At most about most_rows ids: a size fixed by the parameters.
    sample = keyed.join(F.broadcast(chosen), ["label", "id"], "left_semi")
    counted = sample.select("label", "text").mapInPandas(_word_counts, "label string, word string, n long")
    counted = counted.groupBy("label", "word").agg(F.sum("n").alias("n"))
    pieces = counted.mapInPandas(_gram_counts, "label string, length int, gram string, n long")
    pieces = pieces.groupBy("label", "length", "gram").agg(F.sum("n").alias("n"))
    both = counted.select("label", F.lit(0).alias("length"), F.col("word").alias("item"), "n").union(pieces.select("label", "length", "gram", "n"))
    ordered = both.repartition(1).sortWithinPartitions("length", "item", "label")
    return LanguageModel(names, bytes(ordered.mapInArrow(_model(names), "model binary").first()["model"]))


def prediction(docs: DataFrame, model: LanguageModel, text_column: str = "text") -> Column:
    """A column ``struct<lang, score>`` predicted from the text alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        known = shared.value
        return pd.DataFrame(known.scores(texts), columns=["lang", "score"])

    return predict(F.col(text_column))


def identify(docs: DataFrame, model: LanguageModel, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``(id, lang_pred, score)`` for every row."""
    predicted = docs.select(F.col(id_column), prediction(docs, model, text_column).alias("p"))
    return predicted.select(F.col(id_column), F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"))
