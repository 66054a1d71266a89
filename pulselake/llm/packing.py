"""Variable-capacity best-fit packing of documents into training sequences.

Several sequence lengths are permitted and each costs ``fixed + length``. Items
are placed in descending order of size: into the open bin with the least room
that is enough, or else into a new bin, of the length that makes the whole rest
cheapest: its own cost and the least cost of any bins that hold what would
remain, which weighs all lengths jointly. At the end every bin is cut down to
the least permitted length that holds its contents.

Documents longer than the largest length are cut into pieces of that length and
a rest; every token is placed exactly once. Items are dealt by hash into shards
of a set number of tokens, which are packed independently, so a task's memory
is bounded and only the last bins of a shard can be poorly filled.

Defined results: documents of no tokens, and null texts, get one item of size
0 that costs no room; rows without an id are dealt by their text; repeated
rows are packed each for itself. Ties go by id, then piece.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulselake.llm.words import word_count
from pulselake.sources.workspace import settle

LENGTHS = (512, 1024, 2048, 4096, 8192)
FIXED = 64
_SHARD_TOKENS = 8_000_000
_SHARD_ROWS = 50_000


def least_costs(total: int, lengths: tuple[int, ...], fixed: int) -> list[int]:
    """Cost of the cheapest bins for ``u`` times the smallest length, by ``u``."""
    unit = min(lengths)
    costs = [0]
    for u in range(1, -(-total // unit) + 1):
        costs.append(min(fixed + c + costs[max(0, u - c // unit)] for c in lengths))
    return costs


def pack(sizes: list[int], lengths: tuple[int, ...] = LENGTHS, fixed: int = FIXED) -> tuple[list[int], list[int], list[int]]:
    """Bin and offset of every item, and the length of every bin.

    ``sizes`` is descending and nothing in it exceeds the largest length.
    """
    lengths = tuple(sorted(lengths))
    to_come, unit = sum(sizes), lengths[0]
    rest = least_costs(to_come, lengths, fixed)
    bins: list[int] = []  # bin of each item
    offsets: list[int] = []
    used: list[int] = []
    room: list[tuple[int, int]] = []  # (room, bin), ascending
    for size in sizes:
        to_come -= size
        at = bisect_left(room, (size, -1))
        if at < len(room):
            left, chosen = room.pop(at)
        else:
            fitting = lengths[bisect_left(lengths, size) :]
            left = min(fitting, key=lambda c: (fixed + c + rest[-(-max(0, size + to_come - c) // unit)], c))
            chosen = len(used)
            used.append(0)
        bins.append(chosen)
        offsets.append(used[chosen])
        used[chosen] += size
        if left > size or size == 0:
            insort(room, (left - size, chosen))
    return bins, offsets, [lengths[bisect_left(lengths, n)] for n in used]


def _packer(lengths: tuple[int, ...], fixed: int):
    def run(items: pd.DataFrame) -> pd.DataFrame:
        items = items.sort_values(["n_tokens", "doc_id", "tie", "piece"], ascending=[False, True, True, True], kind="stable")
        bins, offsets, sizes = pack(items["n_tokens"].tolist(), lengths, fixed)
        bins = np.array(bins, np.int64)
        return items.assign(bin=bins, bin_length=np.array(sizes, np.int64)[bins], bin_offset=np.array(offsets, np.int64))[
            ["doc_id", "piece", "piece_start", "n_tokens", "shard", "bin", "bin_length", "bin_offset"]
        ]

    return run


def best_fit(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    tokens: Column | None = None,
    lengths: tuple[int, ...] = LENGTHS,
    fixed: int = FIXED,
) -> DataFrame:
    """One row per piece: doc_id, piece, piece_start, n_tokens, shard, bin, bin_length, bin_offset.

    ``tokens`` is a column with the size of each document; without it the words
    of the text count. ``(shard, bin)`` names a sequence.
    """
    text, largest = F.col(text_column), max(lengths)
    size = F.greatest(F.coalesce((word_count(text) if tokens is None else tokens).cast("bigint"), F.lit(0)), F.lit(0))
    # Written once: the number of shards needs the total, and texts are read once only.
    sized = settle(docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.xxhash64(text).alias("tie"), size.alias("size"), F.monotonically_increasing_id().alias("row")))
    total, rows = sized.agg(F.sum("size"), F.count(F.lit(1))).first()
    # By rows too: a shard of empty or very short documents has few tokens.
    shards = max(1, -(-int(total or 0) // _SHARD_TOKENS), -(-rows // _SHARD_ROWS))
    last = F.greatest(F.ceil(F.col("size") / F.lit(largest)) - 1, F.lit(0).cast("bigint"))
    pieces = sized.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("bigint"), last))).withColumn("piece_start", F.col("piece") * largest)
    # Numbered as they were written, so that repeated rows spread too.
    items = pieces.select(
        "doc_id", "tie", "piece", "piece_start", F.least(F.col("size") - F.col("piece_start"), F.lit(largest)).alias("n_tokens"),
        F.pmod(F.xxhash64("doc_id", "tie", "piece", "row"), F.lit(shards)).alias("shard"),
    )
    schema = "doc_id long, piece long, piece_start long, n_tokens long, shard long, bin long, bin_length long, bin_offset long"
    return items.groupBy("shard").applyInPandas(_packer(lengths, fixed), schema)
