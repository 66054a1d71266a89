"""Alignment of the tokens of two tokenizers over the same bytes.

Offsets where tokens of both end cut the two token sequences of a text into
groups; inside a group every pair of tokens whose bytes overlap is a link.

A text is a product of fragments. A fragment of a byte range has an open
prefix, which may continue the range before it, closed groups, which no
neighbour can change, and an open suffix; a range in which nothing closes is
open as a whole. Fragments are joined by ``joined``, which is associative, so
those of a long text are composed as a tree over Spark tasks, a few neighbours
at a time. What is closed stays where it is: only the open ends travel, and
what becomes whole at a seam is handed out there. Closed stretches consist of
units (see ``text_units``), at whose borders tokens of both sides end.

Texts of up to ``_CHUNK`` characters are one closed stretch. All stretches are
dealt into buckets. A bucket encodes each of its distinct units once and counts
its pairs of linked ids; shards of the pairs, split by the second tokenizer's
id, add up the counts of all buckets and mark the pairs with the highest count
of their id; each bucket gets back the sums of its own pairs, and adds them up
per stretch. No table of pairs is collected or broadcast.

Byte-level ids stand for the bytes their symbols spell; the second tokenizer's
pieces for their UTF-8 with U+2581 as a space, and ``<0xHH>`` for a byte. A text
is taken with a space ahead, which the second tokenizer adds by itself. Texts
that are null or empty, or that either tokenizer does not give back byte for
byte, have no tokens and their links are not counted. Repeated rows each count;
rows without an id keep a null id; other columns are never looked at. A unit
without a cut inside, however long, is encoded in one task.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections import namedtuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulselake.llm.text_units import Numbering, dealt, ends_unit, pack, stretches, text_bytes, units, unpack
from pulselake.llm.tokens import _BYTE_SYMBOLS, rank_encoding
from pulselake.sources.workspace import settle

_CHUNK = 32_768
_FAN_IN = 16
_BUCKET_BYTES = 12_000_000
_SHARD_BYTES = 64_000_000
_LAST = 2**62
_AT_ONCE = 4096  # words handed to a library in one call
_COMMON = "\u0250"  # characters below are letters or not in any version of Unicode
_TOGETHER = {"a": 1 << 18, "b": 1 << 13}  # bytes of words encoded as one text


Ids = namedtuple("Ids", "counts flat")


def _joins(word: str) -> bool:
    """Whether a unit is encoded alike between other units."""
    return word[0] in " \n" and not word[-1].isspace()


class TokenizerPair:
    """A byte-level BPE of the tokenizers library and a sentencepiece model, with the bytes of their ids."""

    def __init__(self, path_a: str, path_b: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        ahead = self.a.pre_tokenizer
        # Known to cut by the usual pattern and to change nothing, so words can be put together from their pre-tokens.
        self.plain = self.a.normalizer is None and repr(ahead) == repr(ByteLevel(add_prefix_space=False))
        self.ranks = rank_encoding(self.a) if self.plain else None
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        byte_of = {chr(symbol): byte for byte, symbol in _BYTE_SYMBOLS.items()}
        entries = {i: token for token, i in self.a.get_vocab(with_added_tokens=False).items()}
        bytes_a = [bytes(byte_of.get(c, ord(c) & 255) for c in entries.get(i, "")) for i in range(max(entries) + 1)]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        # The units are cut where no piece may reach across, and a line feed ahead keeps what follows apart.
        if any(re.search("[^▁]▁|\n", p) for p in pieces):
            raise ValueError("pieces that reach across a space or line feed are not supported")
        self.ahead = len(self.b.encode("\n"))
        # Each byte has a symbol of its own, so nothing can be lost on this side.
        self.lossless = self.plain and set(byte_of) | {chr(b) for b in range(256) if b not in _BYTE_SYMBOLS} <= set(entries.values())
        bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.width = len(bytes_b)
        self.bytes = {}
        for side, known in (("a", bytes_a), ("b", bytes_b)):
            ends = np.cumsum([len(x) for x in known])
            self.bytes[side] = (ends - [len(x) for x in known], np.diff(ends, prepend=0), np.frombuffer(b"".join(known), np.uint8))
        names = lambda n, mark: np.array([b"%d%s" % (i, mark) for i in range(n)], object)
        self.names = {(side, mark): names(n, mark) for side, n, marks in (("a", len(bytes_a), b",|"), ("b", self.width, b",;")) for mark in (marks[:1], marks[1:])}

    def ids_a(self, words: list[str]) -> Ids:
        """Ids by the byte-level BPE; common words together by rank, others by the library as they are."""

        def alone(own: list[str]) -> list[list[int]]:
            return [e.ids for e in self.a.encode_batch(own, add_special_tokens=False)]

        def together(text: str) -> list[int]:
            return self.ranks.encode_ordinary(text)

        common = [self.ranks is not None and _joins(w) and (w.isascii() or max(w) < _COMMON) for w in words]
        return self._ids("a", words, common, together, alone)

    def ids_b(self, words: list[str]) -> Ids:
        """Ids by the pieces; a line feed ahead keeps the first word apart from the start of a text."""

        def alone(own: list[str]) -> list[list[int]]:
            return [ids[self.ahead :] for ids in self.b.encode(["\n" + w for w in own], num_threads=1)]

        def together(text: str) -> list[int]:
            return self.b.encode("\n" + text)[self.ahead :]

        return self._ids("b", words, [_joins(w) and "▁" not in w for w in words], together, alone)

    def _ids(self, side: str, words: list[str], common: list[bool], together, alone) -> Ids:
        """Encode runs of common words as one text, which is cut by the bytes of its ids; the others one by one."""
        sizes = np.fromiter((len(w.encode()) for w in words), np.int64, len(words))
        counts, starts, pool, filled = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64), [], 0
        which = np.array(common, bool)
        runs, others = np.flatnonzero(which), [np.flatnonzero(~which)]
        for own in np.split(runs, np.flatnonzero(np.diff(np.cumsum(sizes[runs]) // _TOGETHER[side])) + 1) if len(runs) else []:
            ids = np.array(together("".join([words[i] for i in own.tolist()])), np.int64)
            ends, borders = np.append(0, np.cumsum(self.bytes[side][1][ids])), np.append(0, np.cumsum(sizes[own]))
            at = np.searchsorted(ends, borders)
            if at[-1] >= len(ends) or (ends[at] != borders).any():
                others.append(own)
                continue
            counts[own], starts[own] = np.diff(at), at[:-1] + filled
            pool.append(ids)
            filled += len(ids)
        rest = np.concatenate(others)
        for first in range(0, len(rest), _AT_ONCE):
            own = rest[first : first + _AT_ONCE]
            lists = alone([words[i] for i in own.tolist()])
            counts[own] = [*map(len, lists)]
            starts[own] = np.cumsum(counts[own]) - counts[own] + filled
            pool.append(np.fromiter((i for ids in lists for i in ids), np.int64, int(counts[own].sum())))
            filled += len(pool[-1])
        return Ids(counts, np.concatenate([*pool, np.zeros(0, np.int64)])[stretches(starts, counts)])

    def spelled(self, side: str, ids: np.ndarray) -> np.ndarray:
        starts, lengths, flat = self.bytes[side]
        return flat[stretches(starts[ids], lengths[ids])]


_LOADED: dict[tuple[str, str], TokenizerPair] = {}


def tokenizer_pair(path_a: str, path_b: str) -> TokenizerPair:
    """Both tokenizers, loaded once per worker."""
    if (path_a, path_b) not in _LOADED:
        _LOADED[path_a, path_b] = TokenizerPair(path_a, path_b)
    return _LOADED[path_a, path_b]


def _differs(pair: TokenizerPair, side: str, ids: Ids, words: list[str]) -> np.ndarray:
    """Which words are not the bytes of their ids."""
    data = [w.encode() for w in words]
    wanted = np.array([len(d) for d in data], np.int64)
    token_ends = np.append(0, np.cumsum(pair.bytes[side][1][ids.flat]))
    borders = np.append(0, np.cumsum(ids.counts))
    got = np.diff(token_ends[borders])
    differs = got != wanted
    if not differs.all():
        same = np.flatnonzero(~differs)
        spelled = pair.spelled(side, ids.flat)[stretches(token_ends[borders[same]], got[same])]
        own = np.frombuffer(b"".join([data[i] for i in same]), np.uint8)
        wrong = np.append(0, np.cumsum(spelled != own))
        ends = np.append(0, np.cumsum(wanted[same]))
        differs[same] = np.diff(wrong[ends]) > 0
    return differs


class Groups:
    """Groups and links of many units, unit after unit."""

    def __init__(self, pair: TokenizerPair, a: Ids, b: Ids, bad: np.ndarray):
        self.pair, self.bad = pair, bad
        self.good = np.flatnonzero(~self.bad)
        starts = [np.cumsum(x.counts) - x.counts for x in (a, b)]
        self.a, self.b = (x.flat[stretches(s[self.good], x.counts[self.good])] for x, s in zip((a, b), starts, strict=True))
        self.n_a, self.n_b = np.where(self.bad, 0, a.counts), np.where(self.bad, 0, b.counts)
        self.ends_a, self.ends_b = (np.cumsum(pair.bytes[side][1][ids]) for side, ids in (("a", self.a), ("b", self.b)))
        self.cuts = np.intersect1d(self.ends_a, self.ends_b, assume_unique=True)
        unit_ends = np.append(0, self.ends_a)[np.cumsum(self.n_a[self.good])]
        self.n_groups = np.zeros(len(bad), np.int64)
        self.n_groups[self.good] = np.diff(np.searchsorted(self.cuts, unit_ends, "right"), prepend=0)
        # Between two neighbouring ends lies one token of each side, and no two such stretches have the same two tokens.
        self.n_links = self.n_a + self.n_b - self.n_groups
        ends = np.union1d(self.ends_a, self.ends_b)
        self.links = self.a[np.searchsorted(self.ends_a, ends)] * pair.width + self.b[np.searchsorted(self.ends_b, ends)]

    def per_unit(self, values: np.ndarray) -> np.ndarray:
        """Sums of values of links over each unit."""
        borders = np.append(0, np.cumsum(self.n_links))
        return np.diff(np.append(0, np.cumsum(values))[borders])

    def spelled(self) -> list[bytes]:
        """The groups of each unit as ``a1,a2|b1;a3|b2,b3;``."""
        group_a, group_b = np.searchsorted(self.cuts, self.ends_a), np.searchsorted(self.cuts, self.ends_b)
        last_a, last_b = (np.append(g[1:] != g[:-1], True)[: len(g)] for g in (group_a, group_b))
        names = self.pair.names
        items = np.concatenate([
            np.where(last_a, names["a", b"|"][self.a], names["a", b","][self.a]), np.where(last_b, names["b", b";"][self.b], names["b", b","][self.b])
        ])
        order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        items = items[order].tolist()
        ends = np.cumsum(self.n_a + self.n_b).tolist()
        return [b"".join(items[x:y]) for x, y in zip([0, *ends], ends, strict=False)]


Fragment = namedtuple("Fragment", "head tail cut bad")


def joined(left: Fragment, right: Fragment) -> tuple[Fragment, str]:
    """Two neighbouring fragments as one, and the text that became whole between them."""
    bad = left.bad or right.bad
    ended = ends_unit(left.tail if left.cut else left.head, right.head)
    if left.cut and right.cut:
        return Fragment(left.head, right.tail, True, bad), left.tail + right.head
    if left.cut:
        return (Fragment(left.head, right.head, True, bad), left.tail) if ended else (Fragment(left.head, left.tail + right.head, True, bad), "")
    if right.cut:
        return (Fragment(left.head, right.tail, True, bad), right.head) if ended else (Fragment(left.head + right.head, right.tail, True, bad), "")
    return (Fragment(left.head, right.head, True, bad) if ended else Fragment(left.head + right.head, "", False, bad)), ""


def opened(text: str) -> tuple[Fragment, str]:
    """A stretch of text as a fragment that is not judged yet, and what is closed in it."""
    own = units(text)
    if len(own) == 1:
        return Fragment(text, "", False, False), ""
    return Fragment(own[0], own[-1], True, False), "".join(own[1:-1])


def _encoded(pair: TokenizerPair, words: list[str]) -> tuple[Ids, Ids, np.ndarray]:
    """Ids of both sides, and which words either side does not give back; these have no ids on the second."""
    a, b = pair.ids_a(words), pair.ids_b(words)
    bad = _differs(pair, "b", b, words)
    if not pair.lossless:
        bad |= _differs(pair, "a", a, words)
    kept = np.where(bad, 0, b.counts)
    return a, Ids(kept, b.flat[stretches(np.cumsum(b.counts) - b.counts, kept)]), bad


def _unlike(pair: TokenizerPair, text: str) -> bool:
    """Whether a tokenizer does not give a closed text back."""
    words = list(set(units(text)))
    sides = [("b", pair.ids_b)] if pair.lossless else [("a", pair.ids_a), ("b", pair.ids_b)]
    return any(_differs(pair, side, ids(words), words).any() for side, ids in sides) if words else False


def _chunks(batches):
    schema = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("seq", pa.int64()), ("text", pa.string())])
    for batch in batches:
        for doc, row, text in zip(batch["doc_id"], batch["row"], batch["text"], strict=True):
            text = " " + text.as_py()
            # A stretch at a time, so that nothing of a long text is held twice.
            for seq, at in enumerate(range(0, len(text), _CHUNK)):
                yield pa.RecordBatch.from_pylist([{"doc_id": doc.as_py(), "row": row.as_py(), "seq": seq, "text": text[at : at + _CHUNK]}], schema)


_FRAGMENT = "doc_id long, row long, seq long, head string, tail string, cut boolean, bad boolean, closed array<struct<pos:long,text:string>>"
_CLOSED = pa.list_(pa.struct([("pos", pa.int64()), ("text", pa.string())]))
_FRAGMENTS = pa.schema(
    [("doc_id", pa.int64()), ("row", pa.int64()), ("seq", pa.int64()), ("head", pa.string()), ("tail", pa.string()), ("cut", pa.bool_()), ("bad", pa.bool_())]
    + [("closed", _CLOSED)]
)


def _first_fragments(path_a: str, path_b: str):
    def cut(batches):
        pair = tokenizer_pair(path_a, path_b)
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                fragment, closed = opened(row.pop("text"))
                fragment = fragment._replace(bad=_unlike(pair, closed))
                rows.append(row | fragment._asdict() | {"closed": [{"pos": 2 * row["seq"], "text": closed}] if closed else []})
            yield pa.RecordBatch.from_pylist(rows, _FRAGMENTS)

    return cut


def _composed(path_a: str, path_b: str, span: int):
    """Compose neighbours; ``span`` is the number of first chunks in each of them."""

    def compose(key, table):
        pair, whole, out = tokenizer_pair(path_a, path_b), None, []
        for row in table.sort_by("seq").to_pylist():
            part = Fragment(row["head"], row["tail"], row["cut"], row["bad"])
            if whole is None:
                whole = part
            else:
                whole, closed = joined(whole, part)
                if closed:
                    whole = whole._replace(bad=whole.bad or _unlike(pair, closed))
                    out.append({"pos": 2 * row["seq"] * span - 1, "text": closed})
            out += row["closed"]
        row = {"doc_id": row["doc_id"], "row": row["row"], "seq": key[1].as_py(), "closed": out}
        return pa.Table.from_pylist([row | whole._asdict()], _FRAGMENTS)

    return compose


def _finished(path_a: str, path_b: str):
    """Close the ends of whole texts: nothing can join them any more."""

    def finish(batches):
        pair = tokenizer_pair(path_a, path_b)
        for batch in batches:
            rows = batch.to_pylist()
            for row in rows:
                ends = [{"pos": -1, "text": row["head"]}] + [{"pos": _LAST, "text": row["tail"]}] * row["cut"]
                row["bad"] = row["bad"] or any(_unlike(pair, e["text"]) for e in ends)
                row["closed"] = row["closed"] + ends
            yield pa.RecordBatch.from_pylist(rows, _FRAGMENTS)

    return finish


def _long_texts(docs: DataFrame, path_a: str, path_b: str) -> tuple[DataFrame, DataFrame]:
    """Closed stretches ``doc_id, row, pos, text`` of long texts, and ``doc_id, row, bad`` of each of them."""
    chunks = docs.mapInArrow(_chunks, "doc_id long, row long, seq long, text string").repartition("row", "seq")
    first = settle(chunks.mapInArrow(_first_fragments(path_a, path_b), _FRAGMENT))
    most, span = first.agg(F.max("seq")).first()[0], 1
    parts = first.withColumn("closed", F.array().cast("array<struct<pos:long,text:string>>"))
    while most:
        parts = parts.groupBy("row", F.floor(F.col("seq") / _FAN_IN)).applyInArrow(_composed(path_a, path_b, span), _FRAGMENT)
        most, span = most // _FAN_IN, span * _FAN_IN
    whole = settle(parts.mapInArrow(_finished(path_a, path_b), _FRAGMENT))
    bad = whole.where("bad").select("row")
    seams = whole.where("NOT bad").select("doc_id", "row", F.explode("closed").alias("closed"))
    inside = first.select("doc_id", "row", F.explode("closed").alias("closed")).join(bad, "row", "left_anti")
    return seams.unionByName(inside).select("doc_id", "row", "closed.pos", "closed.text"), whole.select("doc_id", "row", "bad")


def _numbered(table: pa.Table) -> tuple[list[str], list[np.ndarray]]:
    """Distinct units in an order of their own, and those of each text by number."""
    number = Numbering()
    texts = [number.of(units(text.as_py())) for text in table["text"]]
    words = sorted(number)
    place = np.empty(len(words), np.int32)
    place[number.of(words)] = np.arange(len(words), dtype=np.int32)
    return words, [place[own] for own in texts]


_ANSWERS = pa.schema([("bucket", pa.int64()), ("shard", pa.int64()), *((c, pa.binary()) for c in "wxyz")])
_ANSWER = "bucket long, shard long, w binary, x binary, y binary, z binary"


def _questions(path_a: str, path_b: str, shards: int):
    """The ids of a bucket's units (shard -1), and the pairs it has for each shard with their counts."""

    def ask(key, table):
        pair, bucket = tokenizer_pair(path_a, path_b), key[0].as_py()
        words, texts = _numbered(table)
        a, b, bad = _encoded(pair, words)
        groups = Groups(pair, a, b, bad)
        good = [own for own in texts if not groups.bad[own].any()]
        times = np.bincount(np.concatenate([*good, np.zeros(0, np.int32)]), minlength=len(words))
        links, place = np.unique(groups.links, return_inverse=True)
        counts = np.bincount(place, np.repeat(times, groups.n_links), len(links)).astype(np.int64)
        shard = links % pair.width % shards
        rows = [dict(zip(_ANSWERS.names, (bucket, -1, *(pack(v.astype(np.uint32)) for v in (*a, *b))), strict=True))]
        for s in np.unique(shard).tolist():
            own = shard == s
            rows.append({"bucket": bucket, "shard": s, "w": pack(np.diff(links[own], prepend=0)), "x": pack(counts[own])})
        return pa.Table.from_pylist(rows, _ANSWERS)

    return ask


def _sums(path_a: str, path_b: str):
    """Counts of pairs over all buckets, and which are the highest of their second id."""

    def add(key, table):
        width = tokenizer_pair(path_a, path_b).width
        asked = [np.cumsum(unpack(w, np.int64)) for w in table["w"].to_pylist()]
        links, place = np.unique(np.concatenate(asked), return_inverse=True)
        counts = np.concatenate([unpack(x, np.int64) for x in table["x"].to_pylist()])
        totals = np.zeros(len(links), np.int64)
        np.add.at(totals, place, counts)
        highest = np.zeros(width, np.int64)
        np.maximum.at(highest, links % width, totals)
        best = (totals == highest[links % width]).astype(np.uint8)
        rows = []
        for bucket, own in zip(table["bucket"].to_pylist(), asked, strict=True):
            at = np.searchsorted(links, own)
            rows.append({"bucket": bucket, "shard": key[0].as_py(), "w": pack(totals[at]), "x": pack(best[at])})
        return pa.Table.from_pylist(rows, _ANSWERS)

    return add


_NUMBERS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
_RESULTS = pa.schema(
    [("doc_id", pa.int64()), ("row", pa.int64()), ("pos", pa.int64()), *((n, pa.int64()) for n in _NUMBERS)]
    + [("groups", pa.binary()), ("groups_sha256", pa.string())]
)
_RESULT = "doc_id long, row long, pos long, " + ", ".join(f"{n} long" for n in _NUMBERS) + ", groups binary, groups_sha256 string"


def _results(path_a: str, path_b: str, shards: int, keep: bool):
    def put_together(texts, answers):
        if not len(texts):
            return _RESULTS.empty_table()
        pair = tokenizer_pair(path_a, path_b)
        words, numbers = _numbered(texts)
        packed = {row.pop("shard"): row for row in answers.to_pylist()}
        ids = [unpack(packed[-1][c], np.uint32).astype(np.int64) for c in "wxyz"]
        groups = Groups(pair, Ids(*ids[:2]), Ids(*ids[2:]), ids[2] == 0)
        links, place = np.unique(groups.links, return_inverse=True)
        shard = links % pair.width % shards
        totals, best = np.zeros(len(links), np.int64), np.zeros(len(links), np.int64)
        for s in np.unique(shard).tolist():
            own = shard == s
            totals[own], best[own] = unpack(packed[s]["w"], np.int64), unpack(packed[s]["x"], np.uint8)
        columns = (groups.n_a, groups.n_b, groups.n_groups, groups.n_links, groups.per_unit(best[place]), groups.per_unit(totals[place]))
        spelled = np.array([*groups.spelled(), b""], object)[:-1]
        rows = []
        for doc, row, pos, own in zip(*(texts[c].to_pylist() for c in ("doc_id", "row", "pos")), numbers, strict=True):
            own = own if not groups.bad[own].any() else own[:0]
            text = b"".join(spelled[own].tolist())[:-1]
            kept = zstandard.compress(text, 1) if text and (keep or pos is not None) else None
            digest = None if pos is not None else hashlib.sha256(text).hexdigest() if text else ""
            rows.append((doc, row, pos, *(int(c[own].sum()) for c in columns), kept, digest))
        return pa.Table.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*rows, strict=True), _RESULTS, strict=True)], schema=_RESULTS)

    return put_together


def aligned(
    docs: DataFrame, path_a: str, path_b: str, id_column: str = "doc_id", text_column: str = "text", keep: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Closed stretches of all texts, aligned; and the rows of long texts.

    Stretches: doc_id, row, pos (null for texts of one stretch), n_a, n_b,
    n_groups, n_links, n_best, count_sum and groups, the ids of their groups as
    ``a1,a2|b1;a3|b2,b3`` packed by zstd (null without tokens), and for texts of
    one stretch groups_sha256, the digest of these groups (empty without
    tokens). Without ``keep``, only stretches of long texts have their groups.
    Long texts: doc_id, row, bad; their stretches follow each other by ``pos``.
    """
    size = text_bytes(docs, text_column)
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets, shards = max(partitions, -(-size // _BUCKET_BYTES)), max(8, -(-size // _SHARD_BYTES))
    rows = dealt(docs, buckets, id_column, text_column)
    lengthy = F.coalesce(F.char_length("text"), F.lit(0)) >= _CHUNK
    nothing = F.coalesce("text", F.lit("")) == ""
    text = F.when(nothing, "").otherwise(F.concat(F.lit(" "), "text"))
    stretches_, long = _long_texts(rows.where(lengthy).select("doc_id", "row", "text"), path_a, path_b)
    short = rows.where(~lengthy).select("doc_id", "row", F.lit(None).cast("bigint").alias("pos"), text.alias("text"), "bucket")
    parts = stretches_.withColumn("bucket", F.pmod(F.xxhash64("row", "pos"), F.lit(buckets))).select(*short.columns)
    own = short.union(parts)
    asked = settle(own.groupBy("bucket").applyInArrow(_questions(path_a, path_b, shards), _ANSWER))
    sums = asked.where("shard >= 0").groupBy("shard").applyInArrow(_sums(path_a, path_b), _ANSWER)
    answers = asked.where("shard < 0").union(sums)
    found = own.groupBy("bucket").cogroup(answers.groupBy("bucket")).applyInArrow(_results(path_a, path_b, shards, keep), _RESULT)
    return found, long


def _streamed_digests(batches):
    schema = pa.schema([("row", pa.int64()), ("groups_sha256", pa.string())])
    row, hashed = None, None

    def ended():
        return pa.RecordBatch.from_pylist([{"row": row, "groups_sha256": hashed.hexdigest()}], schema)

    for batch in batches:
        for own, groups in zip(batch["row"].to_pylist(), batch["groups"].to_pylist(), strict=True):
            if own != row:
                if hashed is not None:
                    yield ended()
                row, hashed = own, hashlib.sha256()
            else:
                hashed.update(b";")
            hashed.update(zstandard.decompress(groups))
    if hashed is not None:
        yield ended()


def summaries(docs: DataFrame, path_a: str, path_b: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    found, long = aligned(docs, path_a, path_b, id_column, text_column, keep=False)
    found = settle(found)
    short = found.where("pos IS NULL").select("doc_id", *_NUMBERS, "groups_sha256")
    parts = found.where("pos IS NOT NULL")
    sums = parts.groupBy("row").agg(*(F.sum(n).alias(n) for n in _NUMBERS))
    ordered = parts.select("row", "pos", "groups").repartition("row").sortWithinPartitions("row", "pos").select("row", "groups")
    digests = ordered.mapInArrow(_streamed_digests, "row long, groups_sha256 string")
    zero = [F.coalesce(n, F.lit(0)).alias(n) for n in _NUMBERS]
    rest = long.join(sums, "row", "left").join(digests, "row", "left").select("doc_id", *zero, F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))
    return short.union(rest)
