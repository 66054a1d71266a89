import hashlib
import heapq
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pulselake.llm import turn_repair
from pulselake.llm.queries import op11_turn_repair
from pulselake.llm.turn_repair import AUTOMATON, Fragment, RoleAutomaton, damaged, edited, joined, repair, repaired
from tests.llm.compare import SF_DIR

SCHEMA = "conv_id long, turn long, role string, text string, copies string, digest int, part int, audit string"
WHOLE = re.compile(r"(s?(ua)+)?\Z")
BEGUN = re.compile(r"s?(ua)*u?\Z")
BLANK = b" \t\n\x0b\x0c\r"
NAME = {"u": "user", "a": "assistant"}
LETTERS = st.text(st.sampled_from("suaoSUAOxua"), max_size=6)


def searched(rows):
    """Least (cost, audit, lines) over all edit sequences. Rows: (must go, truncated, role, text)."""
    heap, found = [(0, "", 0, "", ())], []
    while heap:
        cost, audit, i, roles, lines = heapq.heappop(heap)
        if found and cost > found[0][0]:
            break
        if i == len(rows) and WHOLE.match(roles):
            found.append((cost, audit, lines))
        steps = [(2, "I", i, g, (f"{NAME[g]}:",)) for g in "ua"]
        if i < len(rows):
            gone, late, role, text = rows[i]
            steps.append((3, "D", i + 1, "", ()))
            if not gone:
                steps.append((late, "K", i + 1, role[:1] or " ", (f"{role}:{text}",)))
                steps += [(2 + late, "R", i + 1, g, (f"{NAME[g]}:{text}",)) for g in "ua"]
        for price, mark, at, initial, more in steps:
            if BEGUN.match(roles + initial):
                heapq.heappush(heap, (cost + price, audit + mark, at, roles + initial, lines + more))
    return min(found)


def by_hand(table):
    """The result for rows (conv_id, turn, role, text), by plain loops and exhaustive search."""
    groups = defaultdict(list)
    for conv, turn, role, text in table:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        code = zlib.crc32(key.encode()) % 20
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        groups[conv] += [(turn, "user" if code == 4 else role, text)] * {0: 0, 3: 2}.get(code, 1)
    out = {}
    for conv, rows in groups.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
        seen, judged, count = set(), [], Counter()
        for _, role, text in rows:
            body = text.encode().strip(BLANK)
            late = bool(body) and body[-1:] not in (b".", b"!", b"?")
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if late else None
            seen.add((role, text))
            count[fault] += 1
            judged.append((fault in ("blank", "duplicate"), int(fault == "truncated"), role, text))
        initials = [r[2][:1] or " " for r in judged]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        turns = [r[0] for r in rows if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        cost, audit, lines = searched(judged)
        sha = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv] = (min(gaps, 2**63 - 1), count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit, sha)
    return out


def results(frame):
    rows = frame.collect()
    out = {r.conv_id: tuple(r[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")) for r in rows}
    assert len(out) == len(rows)
    return out


def fragment(letters, entries=None):
    entries = sorted(AUTOMATON.resting) if entries is None else entries
    return Fragment(None, None, None, None, 0, 0, 0, 0, 0, [(e, x, *w) for e in entries for x, w in AUTOMATON.across(letters, e).items()])


def least(whole):
    return min((cost, audit) for entry, leave, cost, audit in whole.paths if entry == 0 and leave in AUTOMATON.accepting())


@given(LETTERS)
@settings(max_examples=250, deadline=None)
def test_parse_is_the_cheapest_of_all_edits(letters):
    rows = [(c == "x", int(c.isupper()), c.lower(), "t") for c in letters]
    assert least(fragment(letters)) == searched(rows)[:2]


@given(st.text(st.sampled_from("suaoSUAOxuaua"), max_size=60), st.lists(st.integers(0, 60), max_size=5))
@settings(max_examples=200, deadline=None)
def test_fragments_compose_in_any_grouping(letters, cuts):
    cuts = sorted(min(c, len(letters)) for c in cuts)
    parts = [fragment(letters[a:b]) for a, b in zip([0, *cuts], [*cuts, len(letters)])]
    left = parts[0]
    for part in parts[1:]:
        left = joined(left, part)
    right = parts[-1]
    for part in parts[-2::-1]:
        right = joined(part, right)
    assert sorted(left.paths) == sorted(right.paths) == sorted(fragment(letters).paths)


def test_an_audit_tells_the_roles():
    assert list(edited("DKIRD", "xuaxx")) == [("D", None), ("K", None), ("I", "assistant"), ("R", "user"), ("D", None)]


def test_other_grammars():
    pairs = RoleAutomaton((("C", ""), ("C", "D"), ("D", "ua"), ("D", "Dua")), NAME)
    assert [min(pairs.across(x, 0)[s] for s in pairs.accepting()) for x in ("ua", "sua", "a")] == [(0, "KK"), (3, "DKK"), (2, "IK")]
    with pytest.raises(ValueError):  # after s, or at once, the same state begins a pair
        RoleAutomaton((("C", "D"), ("C", "sD"), ("D", "ua"), ("D", "Dua")), NAME)


def awkward():
    rng = random.Random(5)
    rows = []
    for conv in range(60):
        for turn in range(rng.randint(0, 5)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""])
            text = rng.choice([None, "", " \t", "Yes.", "Yes.", "no", "Done!  ", "What?\n", "a longer line", "é "])
            rows.append((conv, rng.choice([turn, turn, turn + 3, None, 0]), role, text))
    rows += [(None, 1, "user", "Who."), (None, None, None, None), (-5, -(2**62) - 9, "user", "Low."), (-5, 2**63 - 1, "assistant", "High.")]
    return rows


def test_awkward_rows_as_by_hand(spark):
    table = awkward()
    rng = random.Random(2)
    shuffled = [(*r, "c", 1, 2, "K") for r in rng.sample(table, len(table))]
    found = results(repair(damaged(spark.createDataFrame(shuffled, SCHEMA))))
    assert found == by_hand(table)
    assert None in found and found[-5][0] == 2**63 - 1


def test_no_rows(spark):
    assert repair(damaged(spark.createDataFrame([], SCHEMA))).collect() == []


def test_all_rows_dropped(spark):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    found = results(repair(damaged(spark.createDataFrame([(gone, 0, "user", "Hi.", *"c12K")][:1], SCHEMA.replace("int", "string")))))
    assert found == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())}


def test_a_long_conversation_in_many_fragments(spark, monkeypatch):
    monkeypatch.setattr(turn_repair, "_ROWS", 7)
    monkeypatch.setattr(turn_repair, "_FAN_IN", 3)
    rng = random.Random(8)
    table = [(c, t, rng.choice(["user", "assistant"]), f"{t} words." if t % 9 else "same") for c, n in ((1, 400), (2, 20), (3, 1)) for t in range(n)]
    table += [(1, 50, "user", "heap")] * 60 + [(4, None, "user", None)] * 30
    rows = spark.createDataFrame([(*r, "c", 1, 2, "K") for r in table], SCHEMA)
    found = results(repair(damaged(rows)))
    monkeypatch.setattr(turn_repair, "_ROWS", 100_000)
    assert found == results(repair(damaged(rows)))
    # One run of the parse over all rows of the conversation gives the same.
    assert set(found) == {1, 2, 3, 4} and len(found[1][6]) > 400


def test_repaired_rows_follow_the_grammar(spark):
    rows = damaged(spark.read.parquet(f"{SF_DIR}/conversations.parquet"))
    plans = turn_repair.audits(rows)
    lines = defaultdict(list)
    for r in repaired(rows, plans).collect():
        lines[r.conv_id].append((r.position, r.role, r.edit, r.text))
    for own in lines.values():
        own.sort()
        assert [o[0] for o in own] == list(range(len(own)))
        assert WHOLE.match("".join(o[1][0] for o in own))
        assert all(o[3] == "" for o in own if o[2] == "I")


def test_registered_query_as_by_hand(spark):
    table = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert results(op11_turn_repair(spark, SF_DIR)) == by_hand(table)
