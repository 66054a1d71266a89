"""Token ids by a given tokenizer, one string of bytes per word and remembered.

The word tokenizer drops white space, and no token spans it, so a text's ids
are those of its words one after another. Words repeat, so each worker keeps a
bounded memo of its words' ids. New words of a batch that are runs of common
letters are encoded together by ``LetterMerges``, others by the library one by
one.
"""

from __future__ import annotations

import json
import os
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from pulselake.llm.text_units import stretches

_KEPT = 500_000  # words in the newer half of a worker's memo; the older has as many
_LONGEST = 40  # longer words are encoded each time
_CLOSING = b".,;:!?"
_COMMON = "\u0250"  # characters below are letters or not, and composed, in any version of Unicode
_CLOSERS = pa.array([*_CLOSING.decode()])
# Letters below U+0250 that lower to one letter: all but U+0130.
_COMMON_RUN = "^[A-Za-zªµºÀ-ÖØ-öø-įı-ɏ]+$"
# Byte-level symbols: printable bytes stand for themselves, the others for the
# characters from U+0100 on, in order.
_PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTE_SYMBOLS = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}


def _listed(column: pa.Array) -> list:
    """The values of a column of texts or bytes; numpy makes them faster than one by one."""
    return column.to_numpy(zero_copy_only=False).tolist()


class Memo(dict):
    """The most recent entries: when the newer half is full, it replaces the older."""

    def __init__(self):
        self.older: dict = {}

    def __missing__(self, key):
        found = self.older.get(key)
        if found is not None:
            self.keep(key, found)
        return found

    def keep(self, key, value) -> None:
        if len(key) <= _LONGEST:
            if len(self) >= _KEPT:
                self.older = dict(self)
                self.clear()
            self[key] = value


def merge_pairs(model: dict) -> list[tuple[str, str]]:
    return [tuple(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]


def merges_alone(merges: list[tuple[str, str]], suffix: str = "") -> bool:
    """Whether the text of every merged token, by itself, merges to that token."""
    place = {pair: n for n, pair in enumerate(merges)}

    def alone(token: str) -> list[str]:
        ended = bool(suffix) and token.endswith(suffix)
        parts = [*(token.removesuffix(suffix) if ended else token)]
        parts[-1] += suffix if ended else ""
        while len(parts) > 1:
            found, at = min((place.get(p, len(merges)), i) for i, p in enumerate(zip(parts[:-1], parts[1:], strict=True)))
            if found == len(merges):
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    return all(alone(a + b) == [a + b] for a, b in merges)


def rank_encoding(tokenizer):
    """A byte-level BPE as a rank encoder with the same ids, for texts of common letters; None if it cannot be one.

    ``LetterMerges`` says why the two agree. Ids have to ascend with the merges.
    """
    import tiktoken

    from pulselake.llm.edit_counts import PATTERN

    model = json.loads(tokenizer.to_str())["model"]
    merges, vocabulary = merge_pairs(model), model["vocab"]
    bytes_of = {chr(_BYTE_SYMBOLS.get(b, b)): b for b in range(256)}
    if any(model.get(k) for k in ("end_of_word_suffix", "continuing_subword_prefix", "ignore_merges", "dropout")) or not set(bytes_of) <= set(vocabulary):
        return None
    ids = [vocabulary.get(a + b, -1) for a, b in merges]
    if any(x >= y for x, y in zip([-1, *ids], ids, strict=False)) or not merges_alone(merges):
        return None
    ranks = {bytes([b]): vocabulary[c] for c, b in bytes_of.items()} | {bytes(bytes_of[c] for c in a + b): vocabulary[a + b] for a, b in merges}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


class LetterMerges:
    """The merges of a word tokenizer as ranks over bytes, by which many runs of letters are encoded in one call.

    A space ends each word and merges first, into the last byte, which stands
    for the symbol with the word end. The rank encoder merges any two tokens
    that spell a token, the tokenizer only the two of its merge. Both do the
    same if every token's own text merges to that token: as long as nothing
    merged across the ends of a stretch, it has merged as it would alone, and
    just before it is one token it is the two of the merge. ``of`` checks this.
    """

    def __init__(self, encoding, ids: np.ndarray, ends: np.ndarray):
        self.encoding, self.ids, self.ends = encoding, ids, ends

    @classmethod
    def of(cls, tokenizer) -> LetterMerges | None:
        """The merges of a tokenizer of this kind; None if it is not of this kind."""
        model = json.loads(tokenizer.to_str())["model"]
        suffix = model.get("end_of_word_suffix")
        if not suffix or model.get("continuing_subword_prefix") or model.get("ignore_merges") or model.get("dropout"):
            return None
        bytes_of = {chr(_BYTE_SYMBOLS.get(b, b)): b for b in range(256)}
        vocabulary, merges = model["vocab"], merge_pairs(model)
        tokens = [*bytes_of, *(s + suffix for s in bytes_of), *(a + b for a, b in merges)]
        if not all(t in vocabulary for t in tokens) or len(set(tokens)) < len(tokens) or not merges_alone(merges, suffix):
            return None
        spelled = [bytes(bytes_of[c] for c in t.removesuffix(suffix)) + b" " * t.endswith(suffix) for t in tokens]
        # Single bytes come first, then those with the word end, then the merges; a space inside a word does not occur.
        ranks = {s: n for n, s in enumerate(spelled) if n < 256 or s.find(b" ") in (-1, len(s) - 1)}
        if len(ranks) < len(tokens) - 256:
            return None
        import tiktoken

        encoding = tiktoken.Encoding("letters", pat_str="[^ ]+ ", mergeable_ranks=ranks, special_tokens={})
        return cls(encoding, np.array([vocabulary[t] for t in tokens]), np.array([t.endswith(suffix) for t in tokens]))

    def encode(self, words: list[str], code: str) -> list[bytes]:
        """Ids of each word, packed."""
        found = np.array(self.encoding.encode_ordinary(" ".join(words) + " "), np.int64)
        ends = (np.flatnonzero(self.ends[found]) + 1) * array(code).itemsize
        data = self.ids[found].astype(f"={code}").tobytes()
        return [data[a:b] for a, b in zip([0, *ends.tolist()], ends.tolist(), strict=False)]


class WordTokenizer:
    """Ids of texts by a tokenizer file whose tokens never span white space."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merge = self.tokenizer.model.tokenize
        # Ids are kept in as few bytes as the vocabulary needs.
        self.code = "H" if self.tokenizer.get_vocab_size() <= 1 << 16 else "I"
        self.words, self.stems = Memo(), Memo()
        self.letters = LetterMerges.of(self.tokenizer)
        self.closing = {bytes([c]): self._whole(bytes([c])) for c in _CLOSING}

    def _whole(self, word: bytes) -> bytes:
        return array(self.code, self.tokenizer.encode(word.decode("utf-8", "replace"), add_special_tokens=False).ids).tobytes()

    def _stem(self, stem: str) -> bytes | None:
        """Ids of a run of letters by the merges directly; None if it is not one.

        Only letters up to U+024F, which any version of Unicode has as letters,
        in composed form, and lowers alike.
        """
        if not stem.isalpha():
            return None
        plain = stem.isascii()
        stem = stem.lower()
        ids = self.stems[stem]
        if ids is None:
            symbols = stem
            if not plain:
                if max(stem) >= _COMMON or not stem.isalpha():
                    return None
                symbols = stem.encode().decode("latin-1").translate(_BYTE_SYMBOLS)
            ids = array(self.code, [t.id for t in self.merge(symbols)]).tobytes()
            self.stems.keep(stem, ids)
        return ids

    def _new(self, word: bytes) -> bytes:
        """Ids of a word not remembered: a run of letters, perhaps with a closing mark, or anything else."""
        end = self.closing.get(word[-1:])
        found = self._stem((word if end is None else word[:-1]).decode("utf-8", "replace"))
        found = self._whole(word) if found is None else found if end is None else found + end
        self.words.keep(word, found)
        return found

    def _learn(self, words: pa.Array) -> None:
        """Remember the ids of new words that are runs of common letters, perhaps with a closing mark."""
        if self.letters is None:
            return
        words = words.filter(pc.less_equal(pc.binary_length(words), _LONGEST))
        last = pc.utf8_slice_codeunits(words, -1, 1 << 30)
        stems = pc.if_else(pc.is_in(last, value_set=_CLOSERS), pc.utf8_slice_codeunits(words, 0, -1), words)
        runs = pc.match_substring_regex(stems, _COMMON_RUN)
        words, last, stems = words.filter(runs), last.filter(runs), pc.utf8_lower(stems.filter(runs))
        if not len(words):
            return
        ends = [self.closing.get(c, b"") for c in _listed(last.cast(pa.binary()))]
        keep = self.words.keep
        for word, found, end in zip(_listed(words.cast(pa.binary())), self.letters.encode(_listed(stems), self.code), ends, strict=True):
            keep(word, found + end)

    def ids_of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts as unsigned 32-bit integers, one text after another, and where each ends; null is empty.

        Only the distinct words of the texts are looked up.
        """
        split = pc.ascii_split_whitespace(texts.fill_null(""))
        encoded = split.flatten().dictionary_encode()
        words = _listed(encoded.dictionary.cast(pa.binary()))
        found = [*map(self.words.get, words)]
        if None in found:
            remember = self.words.__getitem__
            found = [ids if ids is not None else remember(w) for ids, w in zip(found, words, strict=True)]
            self._learn(encoded.dictionary.filter(pa.array([ids is None for ids in found])))
            found = [ids if ids is not None else self.words.get(w) or remember(w) or self._new(w) for ids, w in zip(found, words, strict=True)]
        pool = np.frombuffer(b"".join(found), f"={self.code}").astype("<u4")
        counts = np.fromiter(map(len, found), np.int64, len(found)) // array(self.code).itemsize
        places = encoded.indices.to_numpy(zero_copy_only=False)
        sizes = counts[places]
        ends = np.append(0, np.cumsum(sizes))[split.offsets.to_numpy()[1:].astype(np.int64) - split.offsets[0].as_py()]
        return pool[stretches((np.cumsum(counts) - counts)[places], sizes)], ends

    def ids(self, text: bytes) -> np.ndarray:
        """Ids of one text."""
        return self.ids_of(pa.array([text], pa.binary()).cast(pa.string()))[0]


_LOADED: dict[str, WordTokenizer] = {}


def word_tokenizer(path: str) -> WordTokenizer:
    """The tokenizer of ``path``, loaded once per worker."""
    if path not in _LOADED:
        _LOADED[path] = WordTokenizer(path)
    return _LOADED[path]
