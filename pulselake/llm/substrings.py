"""Removal of repeated word windows, with a count-min prefilter.

Documents are dealt into buckets by id. First pass: every bucket hands over its
own sketch of its windows in sparse form (the window keys it saw, split into
seen once and seen more often), one piece per shard of the key space. A shard
merges the pieces into the rows of a count-min sketch, whose estimates are
never below the true counts, and sends each bucket those of its keys that are
estimated repeated. Second pass: only windows with such keys are grouped, by a
128-bit hash of their word sequence; the earliest occurrence of each group is
reported back and every other occurrence is removed. No repeated window can
fall through, since a sketch does not underestimate.

The sketch is sharded, so its size follows the input: each shard covers a fixed
amount of text and has ``_CELLS`` cells per window and row.

Order: smaller id first, then earlier start. Defined results: rows without an
id come last, ordered by a hash of their text; rows that share an id count as
one document, ordered by text, without windows across the seam; null and empty
texts have no words; texts shorter than a window lose nothing. Other columns
travel in the struct column ``rest``, so their names cannot clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulselake.llm.words import gathered_hashes, window_hashes, word_hashes, word_spans

_U = np.uint64
_KEY_BITS = 28
_SKIP = 0xFFFF
_CELLS = 4
_SEEDS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_BUCKET_BYTES = 6_000_000
_SHARD_BYTES = 16_000_000


# Sorted numbers as 16-bit gaps; _SKIP means "add _SKIP and go on".
def packed(values: np.ndarray) -> bytes:
    """Ascending unsigned numbers as bytes."""
    gaps = np.diff(values.astype(np.int64), prepend=0)
    skips = gaps // _SKIP
    out = np.full(len(gaps) + int(skips.sum()), _SKIP, np.uint16)
    out[np.cumsum(skips + 1) - 1] = gaps % _SKIP
    return out.tobytes()


def unpacked(data: bytes) -> np.ndarray:
    """The numbers of ``packed``."""
    gaps = np.frombuffer(data, np.uint16)
    return np.cumsum(gaps.astype(np.int64))[gaps != _SKIP]


class Bucket:
    """The documents of a bucket in their fixed order, as one run of words."""

    def __init__(self, table: pa.Table):
        self.rows = table.sort_by([("order_id", "ascending"), ("tie", "ascending"), ("text", "ascending")])
        texts = [t.as_buffer().to_pybytes() if t.is_valid else b"" for t in self.rows["text"].combine_chunks().cast(pa.binary())]
        self.data = b" ".join(texts)
        self.starts, self.ends = word_spans(self.data)
        offsets = np.cumsum([0, *(len(t) + 1 for t in texts)])
        self.offsets = offsets
        self.first = np.searchsorted(self.starts, offsets)  # of each row, and the end
        self.first[-1] = len(self.starts)
        self.row_of = np.repeat(np.arange(len(texts)), np.diff(self.first))

    def without(self, row: int, spans: list[int]) -> bytes | None:
        """The text of a row, white space and all, less the spans of words and the white space after each."""
        if not self.rows["text"][row].is_valid:
            return None
        pieces, at, end, low = [], self.offsets[row], self.offsets[row + 1] - 1, self.first[row]
        for begin, stop in zip(spans[::2], spans[1::2], strict=True):
            pieces.append(self.data[at : self.starts[low + begin]])
            at = self.starts[low + stop] if low + stop < self.first[row + 1] else self.ends[low + stop - 1]
        return b"".join([*pieces, self.data[at:end]])


class Windows(Bucket):
    """A bucket with its windows and their keys: the shard number, then 28 bits."""

    def __init__(self, table: pa.Table, width: int, shards: int):
        super().__init__(table)
        self.width = width
        self.hashes = word_hashes(self.data, self.starts, self.ends, 0)
        windows = window_hashes(self.hashes, width, 0)
        whole = self.row_of[: len(windows)] == self.row_of[width - 1 :] if len(windows) else np.zeros(0, bool)
        self.at = np.flatnonzero(whole)
        windows = windows[self.at]
        shard = ((windows >> _U(40)) * _U(shards)) >> _U(24)
        self.keys = ((shard << _U(_KEY_BITS)) | (windows & _U((1 << _KEY_BITS) - 1))).astype(np.int64)

    def order(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Id, tie and offset within the document of every word."""
        ids = self.rows["order_id"].to_numpy()
        ties = self.rows["tie"].to_numpy()
        new = np.ones(len(ids), bool)
        new[1:] = (ids[1:] != ids[:-1]) | (ties[1:] != ties[:-1])
        begin = self.first[:-1][np.maximum.accumulate(np.where(new, np.arange(len(ids)), 0))]
        return ids[self.row_of], ties[self.row_of], np.arange(len(self.row_of)) - begin[self.row_of]

    def suspects(self, replies: pa.Table) -> np.ndarray:
        """Start words of the windows that the sketch estimates as repeated."""
        found = [np.zeros(0, np.int64)]
        for shard, data in zip(replies["shard"].to_pylist(), replies["data"].to_pylist(), strict=True):
            found.append((shard << _KEY_BITS) + unpacked(data))
        return self.at[np.isin(self.keys, np.concatenate(found))]

    def digests(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """128-bit hashes of the windows that start at ``at``."""
        second = word_hashes(self.data, self.starts, self.ends, 1)
        return gathered_hashes(self.hashes, at, self.width, 0), gathered_hashes(second, at, self.width, 1)


def _split(shards: np.ndarray, count: int) -> np.ndarray:
    return np.searchsorted(shards, np.arange(count + 1))


def _sketch_pieces(width: int, shards: int):
    schema = pa.schema([("bucket", pa.int64()), ("shard", pa.int64()), ("once", pa.binary()), ("often", pa.binary())])

    def make(key, table):
        keys, counts = np.unique(Windows(table, width, shards).keys, return_counts=True)
        cuts = _split(keys >> _KEY_BITS, shards)
        rows = []
        for shard in np.flatnonzero(np.diff(cuts)).tolist():
            own = slice(cuts[shard], cuts[shard + 1])
            cells, many = keys[own] & ((1 << _KEY_BITS) - 1), counts[own] > 1
            rows.append({"bucket": key[0].as_py(), "shard": shard, "once": packed(cells[~many]), "often": packed(cells[many])})
        return pa.Table.from_pylist(rows, schema)

    return make


def _merged(table):
    """Merge the pieces of a shard; answer each bucket with its repeated keys."""
    pieces = [(b, unpacked(x), unpacked(y)) for b, x, y in zip(*(table[c].to_pylist() for c in ("bucket", "once", "often")), strict=True)]
    total = sum(len(x) + len(y) for _, x, y in pieces)
    bits = max(10, int(np.ceil(np.log2(_CELLS * max(total, 1)))))
    rows = [np.zeros(1 << bits, np.uint8) for _ in _SEEDS]

    def cells(keys: np.ndarray, seed: int) -> np.ndarray:
        return ((keys.astype(np.uint64) + _U(1)) * _U(seed) >> _U(64 - bits)).astype(np.int64)

    for _, once, often in pieces:
        for row, seed in zip(rows, _SEEDS, strict=True):
            # Saturating addition: two is as good as more.
            for keys, n in ((once, 1), (often, 2)):
                at = cells(keys, seed)
                hit, counts = np.unique(at, return_counts=True)
                row[hit] = np.minimum(2, row[hit] + np.minimum(2, counts * n))
    out = []
    for bucket, once, often in pieces:
        estimate = np.minimum.reduce([row[cells(once, seed)] for row, seed in zip(rows, _SEEDS, strict=True)])
        out.append({"bucket": bucket, "shard": table["shard"][0].as_py(), "data": packed(np.sort(np.concatenate([once[estimate > 1], often])))})
    return pa.Table.from_pylist(out, pa.schema([("bucket", pa.int64()), ("shard", pa.int64()), ("data", pa.binary())]))


_ENTRY = np.dtype([("low", "<u8"), ("high", "<u8"), ("id", "<i8"), ("tie", "<i8"), ("offset", "<u4"), ("word", "<u4")])


def _candidates(width: int, shards: int):
    schema = pa.schema([("bucket", pa.int64()), ("shard", pa.int64()), ("entries", pa.binary()), ("suspects", pa.binary())])

    def make(key, docs, replies):
        if not len(docs) or not len(replies):
            return schema.empty_table()
        bucket = Windows(docs, width, shards)
        at = bucket.suspects(replies)
        low, high = bucket.digests(at)
        order = np.lexsort((at, high, low))
        new = np.ones(len(at), bool)
        new[1:] = (low[order][1:] != low[order][:-1]) | (high[order][1:] != high[order][:-1])
        firsts = np.sort(order[new])  # the first of each sequence in this bucket
        ids, ties, offsets = bucket.order()
        entries = np.empty(len(firsts), _ENTRY)
        word = at[firsts]
        for name, values in zip(_ENTRY.names, (low[firsts], high[firsts], ids[word], ties[word], offsets[word], word), strict=True):
            entries[name] = values
        shard = ((entries["low"] >> _U(40)) * _U(shards)) >> _U(24)
        entries, shard = entries[np.argsort(shard, kind="stable")], np.sort(shard)
        cuts = _split(shard, shards)
        # The suspects come along to the bucket's last step.
        rows = [{"bucket": key[0].as_py(), "shard": key[0].as_py() % shards, "suspects": packed(at)}]
        for s in np.flatnonzero(np.diff(cuts)).tolist():
            # Column after column, which compresses better than row after row.
            own = entries[cuts[s] : cuts[s + 1]]
            rows.append({"bucket": key[0].as_py(), "shard": s, "entries": b"".join(own[n].tobytes() for n in _ENTRY.names)})
        return pa.Table.from_pylist(rows, schema)

    return make


def _entries(data: bytes) -> np.ndarray:
    count, at = len(data) // _ENTRY.itemsize, 0
    out = np.empty(count, _ENTRY)
    for name in _ENTRY.names:
        out[name] = np.frombuffer(data, _ENTRY[name], count, at)
        at += count * _ENTRY[name].itemsize
    return out


def _winners(table):
    """Group candidate windows exactly; answer with the earliest of each group."""
    schema = pa.schema([("bucket", pa.int64()), ("suspects", pa.binary()), ("kept", pa.binary())])
    owners, entries, suspects = (table[c].to_pylist() for c in ("bucket", "entries", "suspects"))
    rows = [{"bucket": b, "suspects": x} for b, x in zip(owners, suspects, strict=True) if x is not None]
    parts = [(b, _entries(x)) for b, x in zip(owners, entries, strict=True) if x is not None]
    if parts:
        owner = np.repeat(np.array([b for b, _ in parts], np.int64), [len(p) for _, p in parts])
        entry = np.concatenate([p for _, p in parts])
        order = np.lexsort((entry["offset"], entry["tie"], entry["id"], entry["high"], entry["low"]))
        low, high = entry["low"][order], entry["high"][order]
        new = np.ones(len(order), bool)
        new[1:] = (low[1:] != low[:-1]) | (high[1:] != high[:-1])
        first = order[new]
        first = first[np.lexsort((entry["word"][first], owner[first]))]
        buckets, cuts = np.unique(owner[first], return_index=True)
        cuts = np.append(cuts, len(first))
        rows += [{"bucket": b, "kept": packed(entry["word"][first[cuts[i] : cuts[i + 1]]])} for i, b in enumerate(buckets.tolist())]
    return pa.Table.from_pylist(rows, schema)


def _removal(width: int, schema: pa.Schema):
    def make(docs, answers):
        if not len(docs):
            return schema.empty_table()
        bucket = Bucket(docs)
        none = np.zeros(0, np.int64)
        suspects, kept = (np.concatenate([none, *(unpacked(x) for x in answers[c].to_pylist() if x)]) for c in ("suspects", "kept"))
        removed = np.setdiff1d(suspects, kept, assume_unique=True)
        edges = np.zeros(len(bucket.starts) + 1, np.int32)
        np.add.at(edges, removed, 1)
        np.add.at(edges, np.minimum(removed + width, len(bucket.starts)), -1)
        stays = np.cumsum(edges[:-1]) == 0
        texts, spans, cut = [], [], []
        for row in range(len(bucket.rows)):
            low, high = bucket.first[row], bucket.first[row + 1]
            own = stays[low:high]
            words = bucket.data[bucket.starts[low] : bucket.ends[high - 1]].split() if high > low else []
            if not own.all():
                words = [w for w, k in zip(words, own.tolist(), strict=True) if k]
            texts.append(b" ".join(words))
            change = np.flatnonzero(np.diff(np.concatenate(([1], own, [1])).astype(np.int8)))
            spans.append(change.tolist())
            if "cut_text" in schema.names:
                cut.append(bucket.without(row, spans[-1]))
        lengths = np.diff(bucket.first)
        gone = lengths - np.add.reduceat(np.append(stays, 0).astype(np.int64), bucket.first[:-1]) * (lengths > 0)
        out = {
            "doc_id": bucket.rows["doc_id"],
            "kept_text": pa.array(texts, pa.binary()).view(pa.string()),
            "n_words": pa.array(lengths, pa.int64()),
            "n_removed": pa.array(gone, pa.int64()),
            "removed_spans": pa.array(spans, pa.list_(pa.int32())),
        }
        if "cut_text" in schema.names:
            out["cut_text"] = pa.array(cut, pa.binary()).view(pa.string())
        if "rest" in schema.names:
            out["rest"] = bucket.rows["rest"]
        return pa.table([pa.chunked_array([c]) if isinstance(c, pa.Array) else c for c in out.values()], schema=schema)

    return make


def remove_repeats(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", width: int = 20, carry: tuple[str, ...] = (), cut: bool = False
) -> DataFrame:
    """Per row: doc_id, kept_text, n_words, n_removed, removed_spans and, with ``cut`` and ``carry``, cut_text and rest.

    ``removed_spans`` lists the word offsets at which removal begins and ends,
    in turn; ``cut_text`` is the text without them, its other white space as it
    was; ``rest`` is a struct of the columns named in ``carry``.
    """
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length(text_column))).first()[0] or 0
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(2 * partitions, -(-size // _BUCKET_BYTES))
    shards = max(partitions, -(-size // _SHARD_BYTES))

    ident, text = F.col(id_column).cast("bigint"), F.col(text_column)
    tie = F.when(ident.isNull(), F.xxhash64(text)).otherwise(F.lit(0).cast("bigint"))
    rest = [F.struct(*(F.col(c) for c in carry)).alias("rest")] if carry else []
    dealt = docs.select(
        ident.alias("doc_id"), text.alias("text"), F.coalesce(ident, F.lit(2**63 - 1)).alias("order_id"), tie.alias("tie"), *rest,
        F.pmod(F.xxhash64(ident, tie), F.lit(buckets)).alias("bucket"),
    )
    pieces = dealt.groupBy("bucket").applyInArrow(_sketch_pieces(width, shards), "bucket long, shard long, once binary, often binary")
    estimates = pieces.groupBy("shard").applyInArrow(_merged, "bucket long, shard long, data binary")
    found = dealt.groupBy("bucket").cogroup(estimates.groupBy("bucket")).applyInArrow(
        _candidates(width, shards), "bucket long, shard long, entries binary, suspects binary"
    )
    answers = found.groupBy("shard").applyInArrow(_winners, "bucket long, suspects binary, kept binary")
    kinds = [("doc_id", "bigint"), ("kept_text", "string"), ("n_words", "bigint"), ("n_removed", "bigint"), ("removed_spans", "array<int>")]
    if cut:
        kinds.append(("cut_text", "string"))
    if carry:
        kinds.append(("rest", dealt.schema["rest"].dataType.simpleString()))
    result = ", ".join(f"{name} {kind}" for name, kind in kinds)
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(result))
    return dealt.groupBy("bucket").cogroup(answers.groupBy("bucket")).applyInArrow(_removal(width, arrow), result)
