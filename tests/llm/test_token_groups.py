import hashlib
import re
from collections import Counter, defaultdict

import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st

from pulselake.llm import token_groups
from pulselake.llm.queries import op12_token_groups, tokenizer_path
from pulselake.llm.text_units import units
from pulselake.llm.token_groups import aligned, joined, opened, summaries, tokenizer_pair
from pulselake.llm.tokens import _BYTE_SYMBOLS
from tests.llm.compare import SF_DIR
from tests.llm.rows import awkward, awkward_docs, no_docs

PATHS = (tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))
PAIR = tokenizer_pair(*PATHS)
TEXT = st.text(st.sampled_from("abcdeinst;)'.   \n\t\r12é\xa0　हि́▁<>x0A\x1c\x00\U0001f600"), max_size=60)
SYMBOLS = {chr(s): b for b, s in _BYTE_SYMBOLS.items()}
COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def tokens(text):
    """(id, end) of both tokenizers over the whole text, or None where they have none."""
    if not text:
        return None
    a = PAIR.a.encode(" " + text, add_special_tokens=False)
    b = PAIR.b.encode(text)
    spelled_a = [bytes(SYMBOLS.get(c, ord(c) & 255) for c in t) for t in a.tokens]
    spelled_b = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode() for p in map(PAIR.b.id_to_piece, b)]
    if not b"".join(spelled_a) == b"".join(spelled_b) == (" " + text).encode():
        return None
    out = []
    for ids, spelled in ((a.ids, spelled_a), (b, spelled_b)):
        end, own = 0, []
        for i, data in zip(ids, spelled, strict=True):
            own.append((i, end, end + len(data)))
            end += len(data)
        out.append(own)
    return out


def by_hand(texts):
    """Results per text, by plain loops over whole texts."""
    all_tokens = [tokens(t) for t in texts]
    all_links = []
    for found in all_tokens:
        own = []
        if found:
            a, b = found
            first = 0
            for i, start, end in a:
                while b[first][2] <= start:
                    first += 1
                at = first
                while at < len(b) and b[at][1] < end:
                    own.append((i, b[at][0]))
                    at += 1
        all_links.append(own)
    count = Counter(x for own in all_links for x in own)
    best = defaultdict(int)
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    out = []
    for found, links in zip(all_tokens, all_links, strict=True):
        if not found:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        a, b = found
        cuts = sorted({e for _, _, e in a} & {e for _, _, e in b})
        groups, begin = [], 0
        for cut in cuts:
            groups.append("|".join(",".join(str(i) for i, s, e in side if begin < e <= cut) for side in (a, b)) if len(cuts) < 400 else None)
            begin = cut
        if len(cuts) >= 400:  # the same in one pass, for long texts
            place = {c: n for n, c in enumerate(cuts)}
            filled = [([], []) for _ in cuts]
            for side in (0, 1):
                n = 0
                for i, _, e in found[side]:
                    filled[n][side].append(str(i))
                    n += e == cuts[n] and place[e] == n
            groups = ["|".join(",".join(x) for x in g) for g in filled]
        sha = hashlib.sha256(";".join(groups).encode()).hexdigest()
        out.append((len(a), len(b), len(cuts), len(links), sum(count[x] == best[x[1]] for x in links), sum(count[x] for x in links), sha))
    return out


def compared(spark_rows, rows):
    expected = Counter((doc, *found) for (doc, _), found in zip(rows, by_hand([t for _, t in rows]), strict=True))
    assert Counter((r.doc_id, *(r[c] for c in COLUMNS)) for r in spark_rows) == expected


@given(TEXT)
@settings(max_examples=400, deadline=None)
def test_units_are_encoded_like_the_whole_text(text):
    words = units(" " + text)
    assert "".join(words) == " " + text
    if "▁" in text:  # stands for a space, so such texts are not given back, whole or in units
        assert tokens(text) is None and token_groups._unlike(PAIR, " " + text)
    elif text:
        assert PAIR.plain and PAIR.lossless
        assert PAIR.ids_a(words).flat.tolist() == PAIR.a.encode(" " + text, add_special_tokens=False).ids
        assert PAIR.ids_b(words).flat.tolist() == PAIR.b.encode(text)


@given(TEXT.map(lambda t: t * 2 + "x"), st.lists(st.integers(1, 110), max_size=9), st.data())
@settings(max_examples=300, deadline=None)
def test_fragments_compose_in_any_grouping(text, cuts, data):
    cuts = sorted({min(c, len(text)) for c in cuts} - {len(text)})
    found, parts = [], []
    for seq, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(text)], strict=True)):
        part, closed = opened(text[a:b])
        parts.append((seq, part))
        found.append((2 * seq, closed))
    while len(parts) > 1:
        at = data.draw(st.integers(0, len(parts) - 2))
        whole, closed = joined(parts[at][1], parts[at + 1][1])
        found.append((2 * parts[at + 1][0] - 1, closed))
        parts[at : at + 2] = [(parts[at][0], whole)]
    whole = parts[0][1]
    found += [(-1, whole.head), (2**62, whole.tail)]
    stretches = [t for _, t in sorted(found) if t]
    assert [u for t in stretches for u in units(t)] == units(text)


EXTRA = ["<s> </s> <unk> <|endoftext|> <0x41>", "a▁b", "▁", " ", "  two  spaces \n\n lines\r\n", "é\x00\x1c\xa0x", "=" * 300, "日本語の文章。" * 40, "don't stop;\r\n});"]


@pytest.mark.parametrize("chunk", [11, 32_768])
def test_awkward_rows(spark, monkeypatch, chunk):
    rows = [r if r[0] != 5 else (5, " ".join(f"w{i % 97}x{i}" for i in range(900)), *r[2:]) for r in awkward()]
    rows += [(50 + i, t, "en", "a", 1, 1, "x", "y", "z") for i, t in enumerate(EXTRA * 2)]
    monkeypatch.setattr(token_groups, "_CHUNK", chunk)
    docs = spark.createDataFrame(rows, awkward_docs(spark).schema)
    compared(summaries(docs, *PATHS).collect(), [r[:2] for r in rows])


def test_no_rows(spark):
    assert summaries(no_docs(spark), *PATHS).collect() == []


def test_many_fragments_buckets_and_shards(spark, monkeypatch):
    for name, value in (("_CHUNK", 300), ("_FAN_IN", 3), ("_BUCKET_BYTES", 9_000), ("_SHARD_BYTES", 20_000)):
        monkeypatch.setattr(token_groups, name, value)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    compared(summaries(docs.repartition(3), *PATHS).collect(), [tuple(r) for r in docs.collect()])


def test_groups_come_with_the_stretches(spark):
    docs = spark.createDataFrame([(1, "one two, three"), (2, None)], "doc_id long, text string")
    found, long = aligned(docs, *PATHS)
    groups = {r.doc_id: r.groups and zstandard.decompress(bytes(r.groups)).decode() for r in found.collect()}
    assert long.collect() == [] and groups[2] is None
    a, b = ([int(i) for g in groups[1].split(";") for i in g.split("|")[side].split(",")] for side in (0, 1))
    assert a == PAIR.a.encode(" one two, three", add_special_tokens=False).ids and b == PAIR.b.encode("one two, three")


def test_registered_query_by_hand(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    compared(op12_token_groups(spark, SF_DIR).collect(), rows)
