"""SimHash near-duplicates found with BK-trees.

Fingerprints within the radius agree in at least one of ``radius + 1`` bit
blocks. So each distinct fingerprint joins, for every block, the shard of its
block value; within a shard every block value has a BK-tree, whose children are
keyed by their integer Hamming distance to the parent. A query starts at the
root of its own block value and follows only the edges whose key differs from
its distance to the parent by no more than the radius.

Where one block value holds more than ``_CROWD`` fingerprints, its tree is
split, and each part is sent to all query slices of that value, and to no
other. Trees travel by the shuffle, not through the driver, which never sees
the fingerprints of all documents. A task hands on a spanning forest of the
links it found, not the links, so groups of copies stay linear.

Defined results: null and empty texts have fingerprint zero, as have texts of
white space; rows without an id get a fingerprint and the component of the rows
they are linked to, which is null if none of them has an id. Repeated rows link
like any others. Other columns are never looked at.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulselake.llm.components import components
from pulselake.llm.words import word_spans
from pulselake.sources.workspace import settle

_SEED = 42
_PART = 1 << 16
_CROWD = 20_000
_SHARD_ROWS = 50_000
_UPPER = re.compile(rb"[A-Z]+")


def _lower(text: bytes) -> bytes:
    return _UPPER.sub(lambda m: m[0].lower(), text) if not text.isascii() else text.lower()


def text_fingerprint(text: str | bytes | None, width: int = 3) -> int:
    """64-bit SimHash of the word shingles of a text, repeats included."""
    data = _lower(text.encode() if isinstance(text, str) else text or b"")
    words = data.split()
    if not words:
        return 0
    joined = b" ".join(words)
    starts, ends = word_spans(joined)
    width = min(width, len(words))
    starts, ends = starts[: len(starts) - width + 1], ends[width - 1 :]
    votes, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for first in range(0, len(starts), _PART):
        own = zip(starts[first : first + _PART].tolist(), ends[first : first + _PART].tolist(), strict=True)
        hashes = np.array([digest(joined[a:b], _SEED) for a, b in own], "<u8")
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(votes * 2 > len(starts), bitorder="little").view("<u8")[0])


def fingerprint(text: Column, width: int = 3) -> Column:
    """The fingerprint as a bigint column."""

    @F.pandas_udf("bigint")
    def compute(texts: pd.Series) -> pd.Series:
        found = np.array([text_fingerprint(t, width) for t in texts], np.uint64)
        return pd.Series(found.view(np.int64))

    return compute(text)


def fingerprint_text(value: Column) -> Column:
    """16 lowercase hex digits."""
    return F.lpad(F.lower(F.hex(value)), 16, "0")


class Forest:
    """BK-trees of several groups, built level by level on whole arrays."""

    def __init__(self, groups: np.ndarray, values: np.ndarray):
        order = np.lexsort((values, groups))
        self.groups, self.values = groups[order], values[order]
        count = len(order)
        parent = np.full(count, -1, np.int64)
        key = np.zeros(count, np.int64)
        new = np.ones(count, bool)
        new[1:] = self.groups[1:] != self.groups[:-1]
        self.roots = np.flatnonzero(new)
        at = self.roots[np.cumsum(new) - 1]  # the node each unplaced element stands at
        left = np.flatnonzero(~new)
        while len(left):
            here = at[left]
            distance = np.bitwise_count(self.values[left] ^ self.values[here]).astype(np.int64)
            by = np.lexsort((left, distance, here))
            left, here, distance = left[by], here[by], distance[by]
            first = np.ones(len(left), bool)
            first[1:] = (here[1:] != here[:-1]) | (distance[1:] != distance[:-1])
            placed = left[first]
            parent[placed], key[placed] = here[first], distance[first]
            at[left] = placed[np.cumsum(first) - 1]
            left = left[~first]
        children = np.lexsort((key, parent))
        children = children[parent[children] >= 0]
        self.children, self.edge_keys = children, key[children]
        self.rank = parent[children] * 128 + self.edge_keys  # ascending
        self.group_names = self.groups[self.roots]

    def links(self, groups: np.ndarray, values: np.ndarray, radius: int):
        """Yield (query, node) index arrays of all pairs within the radius."""
        at = np.searchsorted(self.group_names, groups)
        at = np.minimum(at, max(len(self.group_names) - 1, 0))
        query = np.flatnonzero(self.group_names[at] == groups) if len(self.group_names) else np.zeros(0, np.int64)
        node = self.roots[at[query]]
        waiting = [(query[i : i + _PART], node[i : i + _PART]) for i in range(0, len(query), _PART)]
        while waiting:
            query, node = waiting.pop()
            distance = np.bitwise_count(values[query] ^ self.values[node]).astype(np.int64)
            near = distance <= radius
            if near.any():
                yield query[near], node[near]
            low = np.searchsorted(self.rank, node * 128 + np.maximum(distance - radius, 0))
            high = np.searchsorted(self.rank, node * 128 + distance + radius, side="right")
            counts = high - low
            total = int(counts.sum())
            if total:
                begin = np.repeat(low - np.concatenate(([0], np.cumsum(counts)[:-1])), counts)
                query, node = np.repeat(query, counts), self.children[begin + np.arange(total)]
                waiting.extend((query[i : i + _PART], node[i : i + _PART]) for i in range(0, total, _PART))


def spanning(left: np.ndarray, right: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Labels after joining the pairs: the least label of each connected set.

    ``label`` is the identity or the result of an earlier call, whose links stay.
    """
    label = label.copy()
    while True:
        # Roots are joined, not members, so whatever hangs on a root comes along.
        a, b = label[left], label[right]
        differ = a != b
        if not differ.any():
            return label
        left, right, a, b = left[differ], right[differ], a[differ], b[differ]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        # Follow the labels, which are positions of members themselves.
        while not np.array_equal(step := label[label], label):
            label = step


def _linked(radius: int):
    """Edges (fingerprint, representative) of a spanning forest of a shard's links."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def find(table):
        groups = table["tree"].to_numpy()
        values = table["fp"].to_numpy().view(np.uint64)
        member, asks = (table[c].to_numpy(zero_copy_only=False) for c in ("member", "query"))
        forest = Forest(groups[member], values[member])
        groups, values = groups[asks], values[asks]
        names, place = np.unique(np.concatenate([values, forest.values]), return_inverse=True)
        ours, theirs = place[: len(values)], place[len(values) :]
        label = np.arange(len(names))
        for query, node in forest.links(groups, values, radius):
            other = ours[query] != theirs[node]
            if other.any():
                label = spanning(ours[query[other]], theirs[node[other]], label)
        moved = np.flatnonzero(label != np.arange(len(names)))
        return pa.table([pa.array(names[moved].view(np.int64)), pa.array(names[label[moved]].view(np.int64))], schema=schema)

    return find


def near_links(distinct: DataFrame, radius: int = 2) -> DataFrame:
    """Edges ``(a, b)`` that connect all distinct fingerprints ``fp`` within the radius."""
    spark = distinct.sparkSession
    blocks = radius + 1
    edges = [64 * i // blocks for i in range(blocks + 1)]
    rows = distinct.count() * blocks
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), rows // _SHARD_ROWS)
    values = F.array(*(
        F.struct(
            F.lit(i).alias("block"),
            F.shiftrightunsigned("fp", edges[i]).bitwiseAND((1 << (edges[i + 1] - edges[i])) - 1).alias("value"),
        )
        for i in range(blocks)
    ))
    placed = distinct.select("fp", F.explode(values).alias("v")).select("fp", "v.block", "v.value")
    # A group is alone with its value unless others share it; only shared values can link.
    sizes = placed.groupBy("block", "value").count().where("count > 1")
    placed = placed.join(sizes, ["block", "value"])
    parts = F.ceil(F.col("count") / F.lit(_CROWD)).cast("int")
    placed = placed.withColumn("parts", parts).withColumn("own", F.pmod(F.xxhash64("fp"), "parts").cast("int"))
    value = [F.col("block"), F.col("value")]

    def row(member: bool, query: bool, tree: Column, shard: Column) -> list[Column]:
        return [F.col("fp"), F.lit(member).alias("member"), F.lit(query).alias("query"), tree.alias("tree"), shard.alias("shard")]

    plain = placed.where("parts = 1").select(row(True, True, F.xxhash64(*value), F.pmod(F.xxhash64(*value), F.lit(shards))))
    crowded = placed.where("parts > 1").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    own, other = F.col("own"), F.col("other")
    # The tree of each part goes to every slice of its value; each slice meets every part.
    trees = crowded.select(row(True, False, F.xxhash64(*value, own), F.xxhash64(*value, own, other)))
    slices = crowded.select(row(False, True, F.xxhash64(*value, other), F.xxhash64(*value, other, own)))
    return plain.union(trees).union(slices).groupBy("shard").applyInArrow(_linked(radius), "a long, b long")


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", radius: int = 2, width: int = 3
) -> DataFrame:
    """``(doc_id, tie, fp, root, component_id)`` per row.

    ``root`` names the component by its least fingerprint (signed), whether its
    rows have ids or not; ``component_id`` is the smallest id in it; ``tie`` is
    a hash of the text where there is no id.
    """
    ident, text = F.col(id_column).cast("bigint"), F.col(text_column)
    prints = settle(docs.select(
        ident.alias("doc_id"), F.when(ident.isNull(), F.xxhash64(text)).alias("tie"), fingerprint(text, width).alias("fp")
    ))
    classes = settle(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    found = components(near_links(classes.select("fp"), radius))
    rooted = classes.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return prints.join(rooted.select("fp", "root").join(least, "root"), "fp")


def one_of_each(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", radius: int = 2, width: int = 3) -> DataFrame:
    """The rows of ``docs``, all columns, that stand for their component.

    That is the row with the component's id; of rows without ids, if there is
    nothing else, the one whose text has the least hash. Of repeated rows one
    stays, by a hash of its text.
    """
    found = near_duplicates(docs, id_column, text_column, radius, width)
    kept = found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("root").agg(
        F.coalesce(F.min("doc_id"), F.min("tie")).alias("kept_key"), F.min("doc_id").isNull().alias("kept_nameless")
    ).drop("root")
    ident, text = F.col(id_column).cast("bigint"), F.col(text_column)
    rows = docs.select(F.struct("*").alias("row"), F.coalesce(ident, F.xxhash64(text)).alias("key"), ident.isNull().alias("nameless"), F.xxhash64(text).alias("order"))
    rows = rows.join(kept, (F.col("key") == F.col("kept_key")) & (F.col("nameless") == F.col("kept_nameless")), "left_semi")
    first = Window.partitionBy("key", "nameless").orderBy("order")
    return rows.withColumn("place", F.row_number().over(first)).where("place = 1").select("row.*")
