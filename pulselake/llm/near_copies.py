"""Near copies by shingle similarity, for corpora; op3's fingerprints with a wider reach.

Texts that share 0.8 of their shingles differ in about 10 of 64 bits, and some
in 18. Bit blocks for that radius would have three bits, which is no sharding
at all. So the BK-trees are sharded by bands of minima of the shingle hashes:
two texts of similarity s share one of ``_BANDS`` bands of ``_ROWS`` minima with
probability 1 - (1 - s^_ROWS)^_BANDS, which is 0.998 at 0.8. Within a band's
value a BK-tree finds the fingerprints within the radius.

A task hands on a spanning forest of its shortest links, the ``_NEAREST`` links
of each text and as many to the texts that are near to most others, such as the
original of edited copies, so groups of copies stay linear. Each of these links is
verified by the similarity of the whole shingle sets, and only verified links
make components. Trees of more than ``_CROWD`` texts are split as in
``simhash_trees``.

No link is lost by that: a task also names the texts whose links it did not
hand on in full, with their group of linked texts. A link left out inside a
component adds nothing. Where the texts of a group are in several components,
``left_out`` finds all pairs of them from different components that are alike,
by an exact join of the rarest shingles of each text: sets of similarity ``s``
share at least the part ``s`` of each, so they share one of the n - s n + 1
shingles of each that come first in one order of all.

Defined results: null and empty texts and texts of white space have no shingles
and are one component. Texts shorter than a shingle are one shingle. Repeated
rows are one text. Each component keeps one row, also where rows share an id.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulselake.llm.components import components
from pulselake.llm.simhash_trees import _CROWD, _PART, _SEED, _SHARD_ROWS, Forest, _lower, spanning
from pulselake.llm.words import word_spans
from pulselake.sources.workspace import settle

WIDTH = 5
SIMILARITY = 0.8
RADIUS = 18
_BANDS = 16
_ROWS = 5
_NEAREST = 4
_HELD = 1 << 20
_MIX = np.random.default_rng(_SEED).integers(0, 1 << 63, (2, _BANDS * _ROWS, 1), np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_hashes(text: str | bytes | None, width: int = WIDTH) -> np.ndarray:
    """Hashes of the word shingles of a text, repeats included."""
    words = _lower(text.encode() if isinstance(text, str) else text or b"").split()
    if not words:
        return np.zeros(0, np.uint64)
    joined, width = b" ".join(words), min(width, len(words))
    starts, ends = word_spans(joined)
    own = zip(starts[: len(starts) - width + 1].tolist(), ends[width - 1 :].tolist(), strict=True)
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], _SEED) for a, b in own], np.uint64)


def similarity(left: np.ndarray, right: np.ndarray) -> float:
    """Jaccard similarity of two sorted sets; two empty sets are alike."""
    shared = len(np.intersect1d(left, right, assume_unique=True))
    return shared / (len(left) + len(right) - shared) if len(left) or len(right) else 1.0


def marks_of(text: str | None, width: int = WIDTH) -> tuple[int, list[int]]:
    """SimHash and band values, as signed numbers."""
    hashes = shingle_hashes(text, width)
    votes, least = np.zeros(64, np.int64), np.full(len(_MIX[0]), 2**64 - 1, np.uint64)
    for first in range(0, len(hashes), 4096):
        own = hashes[first : first + 4096]
        votes += np.unpackbits(own.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        least = np.minimum(least, ((own ^ _MIX[0]) * _MIX[1]).min(axis=1))
    fp = int(np.packbits(votes * 2 > len(hashes), bitorder="little").view("<i8")[0])
    bands = [xxhash.xxh64_intdigest(b.tobytes(), i) for i, b in enumerate(least.reshape(_BANDS, _ROWS))]
    return fp, np.array(bands, np.uint64).view(np.int64).tolist()


def _marks(text: Column, width: int) -> Column:
    @F.pandas_udf("fp bigint, bands array<bigint>")
    def compute(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([marks_of(t, width) for t in texts], columns=["fp", "bands"])

    return compute(text)


def _thinned(left: np.ndarray, right: np.ndarray, distance: np.ndarray, size: int):
    """The spanning forest of least weight of the links, and the lightest of each left end."""
    order = np.lexsort((np.maximum(left, right), np.minimum(left, right), distance))
    left, right, distance = left[order], right[order], distance[order]
    stays, label, rank = np.zeros(len(left), bool), np.arange(size), np.arange(len(left))
    while True:
        a, b = label[left[rank]], label[right[rank]]
        rank, a, b = rank[a != b], a[a != b], b[a != b]
        if not len(rank):
            break
        best = np.full(size, len(left))
        np.minimum.at(best, a, rank)
        np.minimum.at(best, b, rank)
        chosen = np.unique(best[best < len(left)])
        stays[chosen] = True
        label = spanning(left[chosen], right[chosen], label)
    by = np.argsort(left, kind="stable")
    new = np.ones(len(by), bool)
    new[1:] = left[by][1:] != left[by][:-1]
    place = np.arange(len(by)) - np.maximum.accumulate(np.where(new, np.arange(len(by)), 0))
    stays[by[place < _NEAREST]] = True
    return left[stays], right[stays], distance[stays]


def _linked(radius: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("link", pa.bool_())])

    def find(table):
        trees, texts = table["tree"].to_numpy(), table["node"].to_numpy()
        values = table["fp"].to_numpy().view(np.uint64)
        member, asks = (table[c].to_numpy(zero_copy_only=False) for c in ("member", "query"))
        names, place = np.unique(texts, return_inverse=True)
        same = [(np.zeros(0, np.int64),) * 3]

        def alone(which):
            """One row of each fingerprint of a tree; the others are linked to it and in a row."""
            rows = np.flatnonzero(which)
            rows = rows[np.lexsort((texts[rows], values[rows], trees[rows]))]
            new = np.ones(len(rows), bool)
            new[1:] = (trees[rows][1:] != trees[rows][:-1]) | (values[rows][1:] != values[rows][:-1])
            first = rows[new][np.cumsum(new) - 1] if len(rows) else rows
            again = np.flatnonzero(~new)
            for other in (first[again], rows[again - 1]):
                same.append((place[rows[again]], place[other], np.zeros(len(again), np.int64)))
            return rows[new]

        own, askers = alone(member), alone(asks)
        forest = Forest(trees[own], values[own])  # its order is that of ``own``

        def chosen(weight):
            kept, held = list(same), 0
            for query, node in forest.links(trees[askers], values[askers], radius):
                left, right = askers[query], own[node]
                other = texts[left] != texts[right]
                left, right = left[other], right[other]
                distance = np.bitwise_count(values[left] ^ values[right]).astype(np.int64)
                kept.append((place[left], place[right], weight(place[right], distance)))
                held += len(left)
                if held > _HELD:
                    kept, held = [_thinned(*map(np.concatenate, zip(*kept, strict=True)), len(names))], 0
            return _thinned(*map(np.concatenate, zip(*kept, strict=True)), len(names))[:2]

        closeness = np.zeros(len(names), np.int64)

        def short(right, distance):
            np.add.at(closeness, right, radius + 1 - distance)
            return distance

        near = chosen(short)
        # An original is near to all of its copies: its links come first the second time.
        hub = np.empty(len(names), np.int64)
        hub[np.lexsort((names, -closeness))] = np.arange(len(names))
        left, right = map(np.concatenate, zip(near, chosen(lambda right, distance: hub[right]), strict=True))
        ends = np.unique(np.stack([np.minimum(left, right), np.maximum(left, right)], axis=1), axis=0)
        # Only a text that is linked to all others of its group has had no link left out.
        label = spanning(ends[:, 0], ends[:, 1], np.arange(len(names)))
        degree = np.bincount(ends.ravel(), minlength=len(names))
        short_of = np.flatnonzero(degree < np.bincount(label, minlength=len(names))[label] - 1)
        first = np.concatenate([names[ends[:, 0]], names[short_of]])
        second = np.concatenate([names[ends[:, 1]], names[label[short_of]]])
        return pa.table([pa.array(first), pa.array(second), pa.array(np.arange(len(first)) < len(ends))], schema=schema)

    return find


def candidates(texts: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links to verify, from rows ``(node, fp, bands)`` of distinct texts, and the texts that lack some.

    Distinct rows ``(a, b, link)``: a link of ``a`` and ``b``, or, where
    ``link`` is false, a text ``a`` not all of whose links to other texts of
    the group ``b`` are among the links.
    """
    spark = texts.sparkSession
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), texts.count() * _BANDS // _SHARD_ROWS)
    placed = texts.select("node", "fp", F.posexplode("bands").alias("band", "value"))
    # Only values that several texts share can link.
    sizes = placed.groupBy("band", "value").count().where("count > 1")
    placed = placed.join(sizes, ["band", "value"]).withColumn("parts", F.ceil(F.col("count") / F.lit(_CROWD)).cast("int"))
    placed = placed.withColumn("own", F.pmod(F.xxhash64("node"), "parts").cast("int"))
    value, own, other = [F.col("band"), F.col("value")], F.col("own"), F.col("other")

    def row(member: bool, query: bool, tree: Column, shard: Column) -> list[Column]:
        return [F.col("node"), F.col("fp"), F.lit(member).alias("member"), F.lit(query).alias("query"), tree.alias("tree"), shard.alias("shard")]

    plain = placed.where("parts = 1").select(row(True, True, F.xxhash64(*value), F.pmod(F.xxhash64(*value), F.lit(shards))))
    crowded = placed.where("parts > 1").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    trees = crowded.select(row(True, False, F.xxhash64(*value, own), F.xxhash64(*value, own, other)))
    slices = crowded.select(row(False, True, F.xxhash64(*value, other), F.xxhash64(*value, other, own)))
    return plain.union(trees).union(slices).groupBy("shard").applyInArrow(_linked(radius), "a long, b long, link boolean").distinct()


def verified(links: DataFrame, texts: DataFrame, least: float, width: int) -> DataFrame:
    """The links whose texts, rows ``(node, text)``, are alike by their whole shingle sets."""

    @F.pandas_udf("double")
    def alike(left: pd.Series, right: pd.Series) -> pd.Series:
        shingles = lru_cache(256)(lambda text: np.unique(shingle_hashes(text, width)))
        return pd.Series([similarity(shingles(a), shingles(b)) for a, b in zip(left, right, strict=True)], dtype=float)

    first, second = texts.toDF("a", "left"), texts.toDF("b", "right")
    return links.join(first, "a").join(second, "b").where(alike("left", "right") >= least).select("a", "b")


def left_out(texts: DataFrame, least: float, width: int) -> DataFrame:
    """All pairs ``(a, b)`` of texts, rows ``(node, root, text)``, of different roots that may be alike, none that is missing.

    Shingles are ordered by the number of texts that hold them, so those of a
    common template come last. A pair shares one of the first shingles of each;
    at the first that it shares, what follows must suffice for the similarity.
    """

    schema = pa.schema([("node", pa.int64()), ("root", pa.int64()), ("size", pa.int32()), ("shingle", pa.int64())])

    def shingles(batches):
        for batch in batches:
            for node, root, text in zip(*(batch[c] for c in ("node", "root", "text")), strict=True):
                found = np.unique(shingle_hashes(text.as_py(), width)).view(np.int64)
                same = [np.full(len(found), v) for v in (node.as_py(), root.as_py(), len(found))]
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip([*same, found], schema.types, strict=True)], schema=schema)

    own = settle(texts.select("node", "root", "text").mapInArrow(shingles, "node long, root long, size int, shingle long"))
    shared = own.groupBy("shingle").agg(F.count(F.lit(1)).alias("held")).where("held > 1")
    order = Window.partitionBy("node").orderBy(F.coalesce("held", F.lit(1)), "shingle")
    ranked = own.join(shared, "shingle", "left").withColumn("place", F.row_number().over(order))
    # A hair more than needed, so that rounding loses nothing.
    first = settle(ranked.where((F.col("place") <= F.col("size") - F.ceil(F.col("size") * least - 1e-6) + 1) & (F.col("held") > 1)))
    left = first.select("shingle", F.col("node").alias("a"), F.col("root").alias("root_a"), F.col("size").alias("size_a"), F.col("place").alias("place_a"))
    right = first.select("shingle", F.col("node").alias("b"), F.col("root").alias("root_b"), F.col("size").alias("size_b"), F.col("place").alias("place_b"))
    follows = 1 + F.least(F.col("size_a") - F.col("place_a"), F.col("size_b") - F.col("place_b"))
    enough = follows >= (F.col("size_a") + F.col("size_b")) * (least / (1 + least)) - 1e-6
    return left.join(right, "shingle").where((F.col("a") < F.col("b")) & (F.col("root_a") != F.col("root_b")) & enough).select("a", "b").distinct()


def roots(found: DataFrame, bodies: DataFrame, least: float, width: int) -> DataFrame:
    """``(node, root)`` of every text with a verified link, from ``candidates`` and the texts of its nodes, rows ``(node, text)``."""
    links = found.where("link").select("a", "b")
    rooted = components(verified(links, bodies, least, width))
    held = found.where("NOT link").select(F.col("a").alias("node"), F.col("b").alias("group")).join(rooted, "node", "left").withColumn("root", F.coalesce("root", "node"))
    split = held.groupBy("group").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
    rest = settle(held.join(split, "group", "left_semi").select("node", "root").distinct())
    if rest.isEmpty():
        return rooted
    pairs = left_out(rest.join(bodies, "node"), least, width).join(links, ["a", "b"], "left_anti")
    more = verified(pairs, bodies, least, width)
    ends = [rest.select(F.col("node").alias(c), F.col("root").alias(f"root_{c}")) for c in ("a", "b")]
    joined = components(more.join(ends[0], "a").join(ends[1], "b").select("root_a", "root_b")).toDF("root", "least_root")
    every = rooted.union(rest).distinct().join(joined, "root", "left")
    return every.select("node", F.coalesce("least_root", "root").alias("root"))


def one_of_each(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", least: float = SIMILARITY, radius: int = RADIUS, width: int = WIDTH
) -> DataFrame:
    """The rows of ``docs``, all columns, with the smallest id of each component of near copies.

    Of rows without ids, if there is nothing else, the one whose text has the
    least hash stays; of repeated rows one.
    """
    ident, text = F.col(id_column).cast("bigint"), F.col(text_column)
    node = F.xxhash64(F.coalesce(text, F.lit("")))
    marks = settle(docs.select(ident.alias("doc_id"), node.alias("node"), _marks(text, width).alias("m")).select("doc_id", "node", "m.*"))
    texts = marks.groupBy("node").agg(F.first("fp").alias("fp"), F.first("bands").alias("bands"))
    links = settle(candidates(texts, radius))
    ends = links.where("link").select(F.explode(F.array("a", "b")).alias("node")).distinct()
    bodies = docs.select(node.alias("node"), text.alias("text")).join(ends, "node", "left_semi").groupBy("node").agg(F.first("text").alias("text"))
    found = roots(links, settle(bodies), least, width)
    rooted = marks.select("doc_id", "node").join(found, "node", "left").withColumn("root", F.coalesce("root", "node"))
    kept = rooted.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "node")).alias("k"))
    kept = kept.select(F.col("k.doc_id").alias("kept_id"), F.col("k.node").alias("kept_node"))
    rows = docs.select(F.struct("*").alias("row"), ident.alias("key"), node.alias("node"))
    rows = rows.join(kept, (F.col("node") == F.col("kept_node")) & F.col("key").eqNullSafe(F.col("kept_id")), "left_semi")
    same = Window.partitionBy("key", "node").orderBy(F.xxhash64("row"))
    return rows.withColumn("place", F.row_number().over(same)).where("place = 1").select("row.*")
