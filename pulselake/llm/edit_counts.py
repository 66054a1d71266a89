"""Token counts that follow edits without encoding the whole text again.

A text is cut into pre-tokens by the tokenizer's pattern, which encodes each of
them alone. The pre-tokens of a document lie in the leaves of a segment tree,
whose nodes hold the characters and tokens below them. An edit is found by its
character position on the way down; the text from the first pre-token that it
can affect is cut and encoded anew until a cut falls on an old one beyond the
edit, from where on nothing can differ. Sums are updated on the way to the root.

The pattern looks at most ``CONTEXT`` characters beyond a pre-token, and never
back, so pre-tokens that end so much earlier are unaffected.

Edits are ``struct<start, length, insert>`` in code points, applied in turn,
each to the text that the ones before left; positions beyond the end mean the
end, and null fields mean zero or nothing. Defined results: null texts count as
empty and can be edited. A null list of edits is an empty one. Repeated rows
each have their counts; rows without an id keep a null id and, as kept trees,
meet no later edits; edits of an id apply to every kept row of that id, and
edits of one ``seq`` in the order of their other fields. A tree of a very long
text is held by one task, in memory that grows with that text alone. Other
columns are never looked at.

``count_edits`` does all for documents that come with their edits.
``build_trees`` gives rows to keep, and ``update_trees`` takes kept rows and a
table of later edits, so that a text is encoded whole only once.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: how byte-level BPE cuts a text before its merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# The same with white space by its Unicode property, on which libraries agree.
_CUT = PATTERN.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")
CONTEXT = 2
_LEAF = 64
_KEPT = 400_000


class PretokenCounter:
    """Cuts texts into pre-tokens and counts the tokens of each, remembering them."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("given", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.pattern = regex.compile(_CUT)
        self.memo: dict[str, int] = {}

    def cut(self, text: str) -> list[str]:
        return self.pattern.findall(text)

    def count(self, piece: str) -> int:
        found = self.memo.get(piece)
        if found is None:
            found = len(self.encoding.encode_ordinary(piece))
            if len(piece) <= 48:
                if len(self.memo) >= _KEPT:
                    self.memo.clear()
                self.memo[piece] = found
        return found


class SegmentTree:
    """The pre-tokens of one document under sums of characters and tokens."""

    def __init__(self, counter: PretokenCounter, text: str):
        self.counter = counter
        self.encoded_chars = 0
        pieces = counter.cut(text)
        self._build([pieces[i : i + _LEAF] for i in range(0, len(pieces), _LEAF)] or [[]])

    @classmethod
    def stored(cls, counter: PretokenCounter, text: str, lengths: list[int], counts: list[int]) -> SegmentTree:
        """The tree of a text from its stored pre-tokens; nothing is cut or encoded."""
        tree = cls.__new__(cls)
        tree.counter, tree.encoded_chars = counter, 0
        ends = np.cumsum([0, *lengths]).tolist()
        pieces = [text[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
        cut = range(0, max(len(pieces), 1), _LEAF)
        tree._build([pieces[i : i + _LEAF] for i in cut], [counts[i : i + _LEAF] for i in cut])
        return tree

    def _build(self, leaves: list[list[str]], counts: list[list[int]] | None = None) -> None:
        self.leaves = leaves
        self.counts = [[*map(self.counter.count, leaf)] for leaf in leaves] if counts is None else counts
        self.width = 1 << max(0, len(leaves) - 1).bit_length()
        self.chars = [0] * (2 * self.width)
        self.tokens = [0] * (2 * self.width)
        for i, (leaf, own) in enumerate(zip(self.leaves, self.counts, strict=True)):
            self.chars[self.width + i], self.tokens[self.width + i] = sum(map(len, leaf)), sum(own)
        for node in range(self.width - 1, 0, -1):
            self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
            self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    @property
    def total(self) -> int:
        return self.tokens[1]

    def text(self) -> str:
        return "".join("".join(leaf) for leaf in self.leaves)

    def find(self, position: int) -> tuple[int, int]:
        """The leaf that holds the character at ``position`` and where the leaf begins."""
        node, begin = 1, 0
        while node < self.width:
            node *= 2
            if position - begin >= self.chars[node] and self.chars[node + 1]:
                begin += self.chars[node]
                node += 1
        return node - self.width, begin

    def _set(self, leaf: int, pieces: list[str], counts: list[int]) -> None:
        self.leaves[leaf], self.counts[leaf] = pieces, counts
        node = self.width + leaf
        self.chars[node], self.tokens[node] = sum(map(len, pieces)), sum(counts)
        while node > 1:
            node //= 2
            self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
            self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    def replace(self, start: int, length: int, insert: str) -> None:
        """Replace ``length`` characters from ``start`` on by ``insert``."""
        start = min(max(start, 0), self.chars[1])
        length = min(max(length, 0), self.chars[1] - start)
        if not length and not insert:
            return
        # Everything that ends CONTEXT characters before the edit stays.
        leaf, begin = self.find(max(start - CONTEXT, 0))
        pieces, kept, at = self.leaves[leaf], 0, begin
        while kept < len(pieces) and at + len(pieces[kept]) <= start - CONTEXT:
            at += len(pieces[kept])
            kept += 1
        stop = start + length
        last, place = leaf, begin + self.chars[self.width + leaf]
        old_cuts = self._cuts(leaf, begin)
        while place <= stop and last + 1 < len(self.leaves):
            last += 1
            old_cuts |= self._cuts(last, place)
            place += self.chars[self.width + last]
        old = "".join("".join(x) for x in self.leaves[leaf : last + 1])
        changed = old[at - begin : start - begin] + insert + old[stop - begin :]
        shift = len(insert) - length
        new: list[str] = []
        position = at
        while True:
            met = False
            # Old text beyond the loaded leaves can still change a cut near their end.
            limit = at + len(changed) - (CONTEXT if last + 1 < len(self.leaves) else 0)
            for match in self.counter.pattern.finditer(changed, position - at):
                if match.end() + at > limit and last + 1 < len(self.leaves):
                    break
                new.append(match[0])
                position = match.end() + at
                if position - shift >= stop and position - shift in old_cuts:
                    met = True
                    break
            if met or last + 1 >= len(self.leaves):
                break
            last += 1
            old_cuts |= self._cuts(last, place)
            place += self.chars[self.width + last]
            changed += "".join(self.leaves[last])
        # The old pre-tokens after the meeting point stay as they are.
        rest, rest_counts, here = [], [], begin
        for i in range(leaf, last + 1):
            for piece, n in zip(self.leaves[i], self.counts[i], strict=True):
                if here >= position - shift and here >= stop:
                    rest.append(piece)
                    rest_counts.append(n)
                here += len(piece)
        fresh = [*map(self.counter.count, new)]
        self.encoded_chars += sum(map(len, new))
        head, head_counts = self.leaves[leaf][:kept], self.counts[leaf][:kept]
        for i in range(leaf + 1, last + 1):
            self._set(i, [], [])
        self._set(leaf, head + new + rest, head_counts + fresh + rest_counts)
        if len(self.leaves[leaf]) > 8 * _LEAF:
            self._rebuild()

    def _cuts(self, leaf: int, begin: int) -> set[int]:
        """Old positions at which a pre-token of the leaf ends, and where it begins."""
        cuts = {begin}
        for piece in self.leaves[leaf]:
            begin += len(piece)
            cuts.add(begin)
        return cuts

    def _rebuild(self) -> None:
        """Even out the leaves; nothing is encoded again."""
        pieces = [p for leaf in self.leaves for p in leaf]
        counts = [n for own in self.counts for n in own]
        cut = range(0, max(len(pieces), 1), _LEAF)
        self._build([pieces[i : i + _LEAF] for i in cut], [counts[i : i + _LEAF] for i in cut])


_LOADED: dict[str, PretokenCounter] = {}


def _counter(path: str) -> PretokenCounter:
    if path not in _LOADED:
        _LOADED[path] = PretokenCounter(path)
    return _LOADED[path]


def _follow(path: str):
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_edited", pa.int64()), ("n_chars_edited", pa.int64()), ("n_encoded_again", pa.int64())])

    def run(batches):
        counter = _counter(path)
        for batch in batches:
            before, after, chars, again = [], [], [], []
            for text, edits in zip(batch["text"], batch["edits"].to_pylist(), strict=True):
                tree = SegmentTree(counter, text.as_py() or "")
                before.append(tree.total)
                for edit in edits or ():
                    tree.replace(edit["start"] or 0, edit["length"] or 0, edit["insert"] or "")
                after.append(tree.total)
                chars.append(tree.chars[1])
                again.append(tree.encoded_chars)
            columns = [batch["doc_id"], *(pa.array(np.array(x, np.int64)) for x in (before, after, chars, again))]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return run


def count_edits(docs: DataFrame, edits: Column, ranks_path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: doc_id, n_tokens, n_edited, n_chars_edited, n_encoded_again.

    ``edits`` is a column ``array<struct<start, length, insert>>`` of ``docs``;
    ``n_tokens`` counts before and ``n_edited`` after them, and
    ``n_encoded_again`` is how many characters the edits had encoded anew.
    """
    rows = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).alias("text"), edits.cast("array<struct<start:bigint,length:bigint,insert:string>>").alias("edits"))
    return rows.mapInArrow(_follow(ranks_path), "doc_id long, n_tokens long, n_edited long, n_chars_edited long, n_encoded_again long")


_TREE = "doc_id long, text string, piece_chars array<int>, piece_tokens array<int>, n_tokens long"


def _tree_rows(ids, trees: list[SegmentTree], again: list[int] | None = None) -> pa.RecordBatch:
    """Trees as rows: the text and the size and tokens of each pre-token."""
    ints = pa.list_(pa.int32())
    columns = [
        ids,
        pa.array([t.text() for t in trees], pa.string()),
        pa.array([[len(p) for leaf in t.leaves for p in leaf] for t in trees], ints),
        pa.array([[n for own in t.counts for n in own] for t in trees], ints),
        pa.array([t.total for t in trees], pa.int64()),
    ]
    names = ["doc_id", "text", "piece_chars", "piece_tokens", "n_tokens"]
    if again is not None:
        columns.append(pa.array(again, pa.int64()))
        names.append("n_encoded_again")
    return pa.RecordBatch.from_arrays(columns, names)


def build_trees(docs: DataFrame, ranks_path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document to keep: doc_id, text, piece_chars, piece_tokens, n_tokens.

    The rows hold the leaves of the segment tree; its sums follow from them.
    """

    def build(batches):
        counter = _counter(ranks_path)
        for batch in batches:
            yield _tree_rows(batch["doc_id"], [SegmentTree(counter, t.as_py() or "") for t in batch["text"]])

    return docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).alias("text")).mapInArrow(build, _TREE)


def update_trees(trees: DataFrame, edits: DataFrame, ranks_path: str) -> DataFrame:
    """The kept trees of the edited documents after their edits, with n_encoded_again.

    ``edits`` has ``doc_id, seq, start, length, insert``; those of a document
    apply in the order of ``seq``. Documents without edits are not returned:
    their rows stay as they are kept.
    """
    listed = edits.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("seq", "start", "length", "insert"))).alias("edits"))

    def update(batches):
        counter = _counter(ranks_path)
        for batch in batches:
            states = (batch[c].to_pylist() for c in ("text", "piece_chars", "piece_tokens", "edits"))
            made = []
            for text, chars, counts, changes in zip(*states, strict=True):
                tree = SegmentTree.stored(counter, text, chars, counts)
                for edit in changes:
                    tree.replace(edit["start"] or 0, edit["length"] or 0, edit["insert"] or "")
                made.append(tree)
            yield _tree_rows(batch["doc_id"], made, [t.encoded_chars for t in made])

    joined = trees.join(listed, "doc_id").select("doc_id", "text", "piece_chars", "piece_tokens", "edits")
    return joined.mapInArrow(update, f"{_TREE}, n_encoded_again long")
