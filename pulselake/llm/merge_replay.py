"""Byte-level BPE over a corpus: every merge is applied once per shard of distinct words.

Texts are dealt into buckets. A bucket cuts them into words by the tokenizer's
pattern and asks for the ids of its distinct words, split by a hash over
shards. A shard joins the questions of all buckets and lays its distinct words
out as one run of symbols, each linked to its neighbours. An inverted index
leads from a token pair, named by the rank it merges to, to the positions where
it stands. Ranks are taken in ascending order; each merges at all its
positions, from left to right where they overlap, and only the pairs with the
touched neighbours are looked up again and entered in the index. Every bucket
gets the ids of its words back, in the order of its question, and puts its
texts together.

A merge can in principle bring up a pair of lower rank, which a word encoded by
itself would merge before other occurrences of the present one. Words to which
that happens are encoded again one by one, so the ids always are those of
merging the least rank first, leftmost first.

Defined results: null and empty texts have no ids; repeated rows each have
theirs; rows without an id keep a null id; other columns are never looked at.
ids of long texts are put together from those of their words and cost no more
per character; a word of any length is encoded in one task. ``decode`` returns bytes, since ids need not end at character borders;
ids that are not in the vocabulary stop the job, null ids are no bytes.
"""

from __future__ import annotations

import base64
import heapq

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame

from pulselake.llm.edit_counts import PATTERN
from pulselake.llm.text_units import Numbering, dealt, least_kind, pack, pack_words, stretches, text_bytes, unpack, unpack_words

_BUCKET_BYTES = 12_000_000
_SHARD_BYTES = 64_000_000
_NONE = np.iinfo(np.int32).max  # rank of a pair that does not merge


class RankFile:
    """A vocabulary of byte strings with ranks, and the pairs that merge."""

    def __init__(self, path: str, pattern: str = PATTERN):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        # White space by its Unicode property, on which libraries agree.
        self.cut = regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")).findall
        self.of_byte = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        self.width = max(self.tokens) + 1
        pairs = [
            (self.ranks[token[:i]] * self.width + self.ranks[token[i:]], rank)
            for token, rank in self.ranks.items() for i in range(1, len(token)) if token[:i] in self.ranks and token[i:] in self.ranks
        ]
        pairs.sort()
        self.pair_keys = np.array([k for k, _ in pairs] or [-1], np.int64)
        self.pair_ranks = np.array([r for _, r in pairs] or [_NONE], np.int64)
        lengths = np.array([len(self.tokens.get(i, b"")) for i in range(self.width)], np.int64)
        self.ends = np.cumsum(lengths)
        self.starts = self.ends - lengths
        self.flat = np.frombuffer(b"".join(self.tokens.get(i, b"") for i in range(self.width)), np.uint8)
        self.known = lengths > 0

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank that each pair merges to; no right neighbour is -1."""
        keys = left * self.width + right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where((self.pair_keys[at] == keys) & (right >= 0), self.pair_ranks[at], _NONE)

    def alone(self, piece: bytes) -> list[int]:
        """Ids of one word: the least rank first, leftmost first."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            rank, at = min((self.ranks.get(parts[i] + parts[i + 1], _NONE), i) for i in range(len(parts) - 1))
            if rank == _NONE:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def decoded(self, ids: np.ndarray) -> np.ndarray:
        """Bytes of ids, as numbers."""
        if len(ids) and (ids.min() < 0 or ids.max() >= self.width or not self.known[ids].all()):
            raise ValueError("ids outside the vocabulary")
        return self.flat[stretches(self.starts[ids], self.ends[ids] - self.starts[ids])]


class Replay:
    """Symbols of many words, with the index of their pairs."""

    def __init__(self, vocabulary: RankFile, pieces: list[bytes]):
        self.vocabulary, self.pieces = vocabulary, pieces
        lengths = np.array([len(p) for p in pieces], np.int64)
        ends = np.cumsum(lengths)
        self.starts = ends - lengths
        count = int(ends[-1]) if len(ends) else 0
        self.end = count  # stands for "no neighbour"
        self.symbols = np.append(vocabulary.of_byte[np.frombuffer(b"".join(pieces), np.uint8)], -1)
        self.next, self.before = np.arange(1, count + 2), np.arange(-1, count)
        self.next[ends - 1], self.before[self.starts] = count, count
        self.alive = np.ones(count, bool)
        self.rank = np.full(count + 1, _NONE, np.int64)  # of the pair that begins here
        self.index: dict[int, list[np.ndarray]] = {}
        self.waiting: list[int] = []
        self.odd: list[np.ndarray] = []
        self._enter(np.arange(count))

    def _enter(self, at: np.ndarray) -> np.ndarray:
        """Look up the pairs at these positions and put them in the index."""
        found = self.vocabulary.merged(self.symbols[at], self.symbols[self.next[at]])
        self.rank[at] = found
        at, found = at[found < _NONE], found[found < _NONE]
        order = np.argsort(found, kind="stable")
        at, found = at[order], found[order]
        cuts = np.flatnonzero(found[1:] != found[:-1]) + 1
        for rank, own in zip(found[np.append(0, cuts)].tolist() if len(at) else [], np.split(at, cuts), strict=False):
            if rank not in self.index:
                self.index[rank] = []
                heapq.heappush(self.waiting, rank)
            self.index[rank].append(own)
        return found

    def run(self) -> None:
        while self.waiting:
            rank = heapq.heappop(self.waiting)
            lists = self.index.pop(rank)
            at = np.sort(np.concatenate(lists)) if len(lists) > 1 else lists[0]
            at = at[self.rank[at] == rank]
            if not len(at):
                continue
            chained = self.next[at[:-1]] == at[1:]
            if chained.any():  # overlapping occurrences: every other one from the left
                place = np.arange(len(at))
                begin = np.maximum.accumulate(np.where(np.append(False, chained), 0, place))
                at = at[(place - begin) % 2 == 0]
            gone = self.next[at]
            beyond = self.next[gone]
            self.symbols[at], self.next[at], self.before[beyond] = rank, beyond, at
            self.alive[gone], self.rank[gone] = False, _NONE
            left = self.before[at]
            touched = np.unique(np.concatenate([at, left[left != self.end]]))
            found = self._enter(touched)
            if len(found) and found[0] < rank:
                again = touched[self.rank[touched] < rank]
                self.odd.append(np.searchsorted(self.starts, again, "right") - 1)

    def ids(self) -> list[np.ndarray]:
        """Ids of each word."""
        self.run()
        kept = np.flatnonzero(self.alive)
        out = np.split(self.symbols[kept].astype(np.int32), np.searchsorted(kept, self.starts[1:]))
        for piece in np.unique(np.concatenate(self.odd)).tolist() if self.odd else ():
            out[piece] = np.array(self.vocabulary.alone(self.pieces[piece]), np.int32)
        return out


_LOADED: dict[tuple[str, str], RankFile] = {}


def rank_file(path: str, pattern: str = PATTERN) -> RankFile:
    """The vocabulary of ``path``, loaded once per worker."""
    if (path, pattern) not in _LOADED:
        _LOADED[path, pattern] = RankFile(path, pattern)
    return _LOADED[path, pattern]


def _asked(words, shards: int) -> list[tuple[int, list[str]]]:
    """A bucket's question to each shard, in an order that does not depend on the order of its rows."""
    own: dict[int, list[str]] = {}
    for word in sorted(words):
        own.setdefault(xxhash.xxh3_64_intdigest(word) % shards, []).append(word)
    return sorted(own.items())


def _texts(table: pa.Table):
    for text in table["text"]:
        yield text.as_py() or ""


def _questions(path: str, pattern: str, shards: int):
    schema = pa.schema([("bucket", pa.int64()), ("shard", pa.int64()), ("words", pa.binary()), ("lengths", pa.binary())])

    def ask(key, table):
        cut, words = rank_file(path, pattern).cut, set()
        for text in _texts(table):
            words.update(cut(text))
        rows = [(key[0].as_py(), shard, *pack_words(own)) for shard, own in _asked(words, shards)]
        return pa.Table.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows], schema)

    return ask


def _answers(path: str, pattern: str):
    schema = pa.schema([("bucket", pa.int64()), ("shard", pa.int64()), ("counts", pa.binary()), ("ids", pa.binary())])

    def answer(key, table):
        vocabulary = rank_file(path, pattern)
        number = Numbering()
        asked = [number.of(unpack_words(*q)) for q in zip(table["words"].to_pylist(), table["lengths"].to_pylist(), strict=True)]
        ids = Replay(vocabulary, [w.encode() for w in number]).ids()
        counts = np.array([len(x) for x in ids], np.int64)
        starts, flat = np.cumsum(counts) - counts, np.concatenate(ids).astype(least_kind(vocabulary.width))
        rows = []
        for bucket, own in zip(table["bucket"].to_pylist(), asked, strict=True):
            answer = {"bucket": bucket, "shard": key[0].as_py(), "counts": pack(counts[own].astype(np.uint32))}
            rows.append(answer | {"ids": pack(flat[stretches(starts[own], counts[own])])})
        return pa.Table.from_pylist(rows, schema)

    return answer


def _assembled(path: str, pattern: str, shards: int, decoded: bool):
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), *([("decoded", pa.binary())] if decoded else [])])

    def assemble(docs, answers):
        if not len(docs):
            return schema.empty_table()
        vocabulary, number = rank_file(path, pattern), Numbering()
        texts = [number.of(vocabulary.cut(text)) for text in _texts(docs)]
        packed = {s: (c, i) for s, c, i in zip(*(answers[c].to_pylist() for c in ("shard", "counts", "ids")), strict=True)}
        counts, starts, flat, size = np.zeros(len(number), np.int64), np.zeros(len(number), np.int64), [], 0
        for shard, words in _asked(number, shards):
            own, given = number.of(words), unpack(packed[shard][0], np.uint32).astype(np.int64)
            counts[own], starts[own] = given, np.cumsum(given) - given + size
            flat.append(unpack(packed[shard][1], least_kind(vocabulary.width)))
            size += len(flat[-1])
        known = np.concatenate([*flat, np.zeros(0, np.int32)]).astype(np.int32)
        sizes = [int(counts[own].sum()) for own in texts]
        ends = np.cumsum([0, *sizes])
        ids = np.empty(ends[-1], np.int32)
        for own, first, end in zip(texts, ends[:-1].tolist(), ends[1:].tolist(), strict=True):
            ids[first:end] = known[stretches(starts[own], counts[own])]
        columns = [docs["doc_id"].combine_chunks(), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids))]
        if decoded:
            columns.append(pa.array((vocabulary.decoded(ids[a:b]).tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)), pa.binary()))
        return pa.Table.from_arrays(columns, schema=schema)

    return assemble


def encode(
    docs: DataFrame, ranks_path: str, pattern: str = PATTERN, id_column: str = "doc_id", text_column: str = "text", decoded: bool = False
) -> DataFrame:
    """``doc_id, ids`` of every row, without special tokens; with ``decoded`` also the bytes that these ids stand for."""
    size = text_bytes(docs, text_column)
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets, shards = max(partitions, -(-size // _BUCKET_BYTES)), max(8, -(-size // _SHARD_BYTES))
    rows = dealt(docs, buckets, id_column, text_column).drop("row")
    questions = rows.groupBy("bucket").applyInArrow(_questions(ranks_path, pattern, shards), "bucket long, shard long, words binary, lengths binary")
    answers = questions.groupBy("shard").applyInArrow(_answers(ranks_path, pattern), "bucket long, shard long, counts binary, ids binary")
    texts, replies = rows.groupBy("bucket"), answers.groupBy("bucket")
    result = "doc_id long, ids array<int>" + ", decoded binary" * decoded
    return texts.cogroup(replies).applyInArrow(_assembled(ranks_path, pattern, shards, decoded), result)


def _decoded(path: str, place: int):
    def decode_batches(batches):
        vocabulary = rank_file(path)
        for batch in batches:
            ids = batch.column(place)
            flat = ids.flatten()
            offsets = ids.offsets.to_numpy().astype(np.int64)
            offsets -= offsets[0]
            lengths = np.where(flat.is_valid().to_numpy(zero_copy_only=False), 1, 0)
            own = flat.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            kept = np.append(0, np.cumsum(lengths))[offsets]
            own = own[lengths.astype(bool)]
            data = vocabulary.decoded(own)
            ends = np.append(0, np.cumsum(vocabulary.ends[own] - vocabulary.starts[own]))[kept]
            column = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(batch), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data)])
            yield pa.RecordBatch.from_arrays([*batch.columns, column.cast(pa.binary())], names=[*batch.schema.names, "decoded"])

    return decode_batches


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """Adds the column ``decoded``, the bytes of the column ``ids``."""
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    return encoded.mapInArrow(_decoded(ranks_path, encoded.columns.index("ids")), f"{kinds}, decoded binary")
