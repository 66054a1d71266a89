"""Texts cut where byte-level tokenizers always cut, and dealt into buckets.

A unit begins at the start of a text, and at each space or line feed behind a
character that is no white space. No token of a tokenizer that allows white
space only ahead of other characters spans such a place, and what follows is
encoded as if the text began there, so units can be encoded one by one.
"""

from __future__ import annotations

import re

import numpy as np
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# White space other than a space or line feed does not begin a unit, but holds it together.
_UNIT = re.compile(r"\s*\S+(?:[^\S \n]\s*\S*)*|\s+")


def units(text: str) -> list[str]:
    """The units of a text; they join to the text."""
    return _UNIT.findall(text)


def ends_unit(left: str, right: str) -> bool:
    """Whether a unit ends between two neighbouring pieces of a text."""
    return bool(left and right) and right[0] in " \n" and not left[-1].isspace()


def text_bytes(docs: DataFrame, text_column: str = "text") -> int:
    """Size of all texts."""
    return docs.agg(F.sum(F.octet_length(text_column))).first()[0] or 0


def dealt(docs: DataFrame, buckets: int, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, row, text, bucket``; equal rows are spread like any others.

    ``row`` tells rows apart. It follows from a row's place in its input
    partition, so a task that is run again gives the same.
    """
    rows = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.monotonically_increasing_id().alias("row"), F.col(text_column).alias("text"))
    return rows.withColumn("bucket", F.pmod(F.xxhash64("row"), F.lit(buckets)))


class Numbering(dict):
    """Words with numbers in the order of their first appearance."""

    def __missing__(self, word) -> int:
        self[word] = number = len(self)
        return number

    def of(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int32, len(words))


def stretches(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers of all given stretches, one stretch after another."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)


# Packed arrays are dense and compressed, since they pass through shuffles and shared storage.
def pack(values: np.ndarray) -> bytes:
    return zstandard.compress(values.tobytes(), 3)


def unpack(data: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data), kind)


def least_kind(top: int):
    """The smallest unsigned type for numbers up to ``top``."""
    return np.min_scalar_type(top)


def pack_words(words: list[str]) -> tuple[bytes, bytes]:
    """Words as two packed columns: their text, and its cuts."""
    data = [w.encode() for w in words]
    return zstandard.compress(b"".join(data), 3), pack(np.array([len(d) for d in data], np.uint32))


def unpack_words(text: bytes, lengths: bytes) -> list[str]:
    data, ends = zstandard.decompress(text), np.cumsum(unpack(lengths, np.uint32), dtype=np.int64).tolist()
    return [data[a:b].decode() for a, b in zip([0, *ends], ends, strict=False)]
