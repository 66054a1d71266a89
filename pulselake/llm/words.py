"""Words and their hashes, as arrays, and the same split as SQL columns.

A word is a maximal run of bytes other than ``\\x20`` and ``\\x09-\\x0D``, which
is what ``bytes.split()`` returns.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
_GAPS = "\x20\x09\x0a\x0b\x0c\x0d"

_U = np.uint64
_RANDOM = np.random.default_rng(20240607)
_IS_GAP = np.zeros(256, bool)
_IS_GAP[[0x20, 9, 10, 11, 12, 13]] = True
# Two independent byte tables and odd bases make a 128-bit polynomial hash.
_BYTES = _RANDOM.integers(1, 2**63, size=(2, 256), dtype=np.uint64) * _U(2) + _U(1)
_BYTES[:, _IS_GAP] = 0
_BASES = tuple(int(x) | 1 for x in _RANDOM.integers(2**40, 2**62, size=2, dtype=np.uint64))
_STEPS = tuple(int(x) | 1 for x in _RANDOM.integers(2**40, 2**62, size=2, dtype=np.uint64))
_SLICE = 1 << 20


def word_count(text: Column) -> Column:
    """Number of words; null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def word_array(text: Column) -> Column:
    """The words of a text; null and empty texts have none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(_GAPS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits."""
    values = (values ^ (values >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> _U(27))) * _U(0x94D049BB133111EB)
    return values ^ (values >> _U(31))


def _powers(base: int, count: int) -> np.ndarray:
    factors = np.full(count, base, np.uint64)
    factors[0] = 1
    return np.cumprod(factors, dtype=np.uint64)


def word_spans(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and end offsets of the words of ``data``."""
    if not data:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    gap = np.ones(len(data) + 2, np.int8)
    gap[1:-1] = _IS_GAP[np.frombuffer(data, np.uint8)]
    edges = np.flatnonzero(np.diff(gap))
    return edges[::2], edges[1::2]


def word_hashes(data: bytes, starts: np.ndarray, ends: np.ndarray, which: int) -> np.ndarray:
    """One 64-bit hash per word, by the byte table and base ``which``."""
    buffer = np.frombuffer(data, np.uint8)
    out = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        last = max(first + 1, int(np.searchsorted(starts, starts[first] + _SLICE)))
        low, high = starts[first], ends[last - 1]
        local = starts[first:last] - low
        lengths = np.diff(np.append(local, high - low))
        place = np.arange(high - low) - np.repeat(local, lengths)
        powers = _powers(_BASES[which], int(lengths.max()))
        out[first:last] = np.add.reduceat(_BYTES[which][buffer[low:high]] * powers[place], local)
        first = last
    return mixed(out + (ends - starts).astype(np.uint64))


def window_hashes(words: np.ndarray, width: int, which: int) -> np.ndarray:
    """Hash of every run of ``width`` word hashes, in order."""
    count = len(words) - width + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(count, np.uint64)
    for offset, power in enumerate(_powers(_STEPS[which], width)):
        out += words[offset : offset + count] * power
    return mixed(out)


def gathered_hashes(words: np.ndarray, at: np.ndarray, width: int, which: int) -> np.ndarray:
    """``window_hashes`` for the windows that start at ``at`` only."""
    out = np.zeros(len(at), np.uint64)
    for offset, power in enumerate(_powers(_STEPS[which], width)):
        out += words[at + offset] * power
    return mixed(out)
