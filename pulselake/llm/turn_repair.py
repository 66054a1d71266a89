"""Repair of conversation structure by a generalised LR parse with weighted edits.

The order of roles must follow a grammar over their initials: nothing, or an
optional ``s`` and then pairs ``u a``. Every row is a token. The parse keeps a
graph-structured stack: its nodes are the states of the LR automaton, each
linked to the one below, and all stacks with the same top are merged into the
one of least (cost, audit). A row is kept (0), given another role (2) or
deleted (3), and a turn can be inserted anywhere (2); a truncated row that
stays adds 1. Blank rows and repeats must be deleted. The audit spells the
edits in order: ``K R D I``. Equal costs are settled by the least audit, which
is safe to do at once: of two audits over the same rows that cost the same,
neither begins with the other.

Rows are put in order by a range exchange on (conversation, turn), so a
conversation can lie in many partitions. Each partition cuts its conversations
into fragments of at most ``_ROWS`` rows, as maps from the state at the start to
the states at the end; maps of one conversation are composed in order, a few at
a time, until one is left. Texts do not take part: the parse sees a letter per
row. At the end they are streamed past the audits, in order, in one pass.

Order of rows: by turn, null turns first, then by role and by the digest of the
text. Defined results: null roles and texts are one space; an empty role counts
as one space in the grammar; rows that agree in everything are adjacent, and all
but the first are repeats (a heap of them is one counted row until the end); a
null id is a conversation of its own; a conversation whose rows are all dropped
has zeros and an empty audit; ``gaps`` stops at the largest long. Repeats are
told by SHA-256. Other columns are never looked at.

One task streams all texts of a conversation past its audit, in bounded memory
apart from the audit, which is a value of the result.
"""

from __future__ import annotations

import hashlib
from collections import namedtuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulselake.sources.workspace import settle

#: Role grammar: left side and right side of each production; the first is the start.
GRAMMAR = (("C", ""), ("C", "D"), ("D", "Hua"), ("D", "Dua"), ("H", ""), ("H", "s"))
#: Roles that edits may give or insert, by their initial.
GIVEN = {"u": "user", "a": "assistant"}
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: Letter of a row that has to go; other rows are their initial, in capitals if truncated.
GONE = "x"
_BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"
_ROWS = 4096
_FAN_IN = 16
_MOST = 2**63 - 1


class RoleAutomaton:
    """The LR(0) automaton of a role grammar, and the moves of a merged stack."""

    def __init__(self, grammar=GRAMMAR, given=GIVEN):
        self.start, self.given = grammar[0][0], tuple(given)
        grammar = self.grammar = (("^", self.start), *grammar)  # the whole ends when this production would be reduced
        self.names = {left for left, _ in grammar}
        start = self._closed({(0, 0)})
        self.states, self.moves, self.below = [start], {}, [0]
        for state, items in enumerate(self.states):  # grows while it is read
            for symbol in sorted({grammar[p][1][at] for p, at in items if at < len(grammar[p][1])}):
                target = self._closed({(p, at + 1) for p, at in items if grammar[p][1][at : at + 1] == symbol})
                if target in self.states:
                    # A state under which two stacks can lie could not be merged by its number alone.
                    raise ValueError(f"grammar reaches a state in two ways: {grammar}")
                self.states.append(target)
                self.below.append(state)
                self.moves[state, symbol] = len(self.states) - 1
        self.complete = [[(grammar[p][0], at) for p, at in sorted(items) if at == len(grammar[p][1])] for items in self.states]
        shifting = {s for s, symbol in self.moves if symbol not in self.names}
        #: States a stack can rest in between rows; others only lead to these.
        self.resting = shifting | {s for s, items in enumerate(self.states) if any(at == 0 for p, at in items)}
        self.memo: dict[tuple[int, str], dict] = {}

    def _closed(self, items: set) -> frozenset:
        found = set(items)
        while True:
            wanted = {self.grammar[p][1][at] for p, at in found if at < len(self.grammar[p][1])}
            more = found | {(i, 0) for i, (left, _) in enumerate(self.grammar) if left in wanted}
            if more == found:
                return frozenset(found)
            found = more

    def _reduced(self, state: int):
        """Tops after each reduction that ``state`` allows."""
        for left, count in self.complete[state]:
            base = state
            for _ in range(count):
                base = self.below[base]
            if (base, left) in self.moves:
                yield self.moves[base, left]

    def close(self, tops: dict, final: bool = False) -> dict:
        """All tops that reductions and insertions reach, each with its least (cost, audit)."""
        best, waiting = dict(tops), list(tops)
        while waiting:
            state = waiting.pop()
            cost, audit = best[state]
            inserted = (cost + INSERT, audit + "I")
            reached = [(r, (cost, audit)) for r in self._reduced(state)]
            reached += [(self.moves[state, g], inserted) for g in self.given if (state, g) in self.moves]
            for target, weight in reached:
                if target not in best or weight < best[target]:
                    best[target] = weight
                    waiting.append(target)
        return best if final else {s: w for s, w in best.items() if s in self.resting}

    def consume(self, tops: dict, letter: str) -> dict:
        """Tops after one row."""
        out = {s: (cost + DELETE, audit + "D") for s, (cost, audit) in tops.items()}
        if letter == GONE:
            return out
        initial, extra = letter.lower(), TRUNCATED * letter.isupper()
        for state, (cost, audit) in tops.items():
            ways = [(initial, extra, "K"), *((g, REROLE + extra, "R") for g in self.given if g != initial)]
            for symbol, price, mark in ways:
                target = self.moves.get((state, symbol))
                if target is not None:
                    weight = (cost + price, audit + mark)
                    if target not in out or weight < out[target]:
                        out[target] = weight
        return out

    def across(self, letters: str, entry: int) -> dict:
        """Resting states at the end of a run of rows that is entered in ``entry``."""
        found = self.memo.get((entry, letters))
        if found is None:
            tops = self.close({entry: (0, "")})
            for letter in letters:
                tops = self.close(self.consume(tops, letter))
            found = tops
            if len(letters) <= 64:
                if len(self.memo) >= 100_000:
                    self.memo.clear()
                self.memo[entry, letters] = found
        return found

    def accepting(self) -> list[int]:
        """Resting states in which a conversation may end."""
        end = self.moves[0, self.start]
        return [s for s in sorted(self.resting) if self.close({s: (0, "")}, final=True).get(end) == (0, "")]

    def after(self, state: int, symbol: str) -> int:
        """Resting state after a token that the parse is known to accept."""
        waiting, seen = [state], {state}
        while waiting:
            at = waiting.pop()
            if (at, symbol) in self.moves:
                return next(s for s in self._settled(self.moves[at, symbol]) if s in self.resting)
            more = [r for r in self._reduced(at) if r not in seen]
            seen.update(more)
            waiting += more
        raise ValueError(f"no way on from state {state} with {symbol!r}")

    def _settled(self, state: int):
        yield state
        for target in self._reduced(state):
            yield from self._settled(target)

    def next_given(self, state: int) -> str:
        """The one initial of a given role that can follow."""
        for initial in self.given:
            try:
                self.after(state, initial)
            except ValueError:
                continue
            return initial
        raise ValueError(f"no given role follows state {state}")


AUTOMATON = RoleAutomaton()

Fragment = namedtuple("Fragment", "first last low high turns illegal blank duplicate truncated paths")
_FRAGMENT = (
    "first string, last string, low long, high long, turns long, illegal long, blank long, duplicate long, truncated long, "
    "paths array<struct<entry:int,exit:int,cost:long,audit:string>>"
)
_ARROW = pa.schema(
    [(n, pa.string()) for n in Fragment._fields[:2]]
    + [(n, pa.int64()) for n in Fragment._fields[2:-1]]
    + [("paths", pa.list_(pa.struct([("entry", pa.int32()), ("exit", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])))]
)


def _legal(left: str, right: str) -> bool:
    return left + right in ("su", "ua", "au")


def joined(left: Fragment, right: Fragment) -> Fragment:
    """Two neighbouring fragments as one; the operation is associative."""
    best: dict[tuple[int, int], tuple[int, str]] = {}
    onward: dict[int, list] = {}
    for entry, leave, cost, audit in right.paths:
        onward.setdefault(entry, []).append((leave, cost, audit))
    for entry, middle, cost, audit in left.paths:
        for leave, more, rest in onward.get(middle, ()):
            total = cost + more
            old = best.get((entry, leave))
            if old is None or total < old[0] or total == old[0] and audit + rest < old[1]:
                best[entry, leave] = (total, audit + rest)
    seam = left.last is not None and right.first is not None and not _legal(left.last, right.first)
    ends = [x for x in (left.low, left.high, right.low, right.high) if x is not None]
    return Fragment(
        first=right.first if left.first is None else left.first,
        last=left.last if right.last is None else right.last,
        low=min(ends, default=None),
        high=max(ends, default=None),
        turns=left.turns + right.turns - (left.high is not None and left.high == right.low),
        illegal=left.illegal + right.illegal + seam,
        blank=left.blank + right.blank,
        duplicate=left.duplicate + right.duplicate,
        truncated=left.truncated + right.truncated,
        paths=[(entry, leave, *weight) for (entry, leave), weight in best.items()],
    )


class _Run:
    """The rows of one fragment while they pass."""

    def __init__(self):
        self.letters: list[str] = []
        self.first = self.last = self.low = self.high = None
        self.turns = self.illegal = self.blank = self.duplicate = self.truncated = 0

    def add(self, turn, initial: str, fault: str | None, copies: int) -> None:
        if turn is not None and turn != self.high:
            self.turns += 1
            self.low = turn if self.low is None else self.low
            self.high = turn
        if self.last is not None:
            self.illegal += not _legal(self.last, initial)
        self.illegal += (copies - 1) * (not _legal(initial, initial))
        self.first, self.last = initial if self.first is None else self.first, initial
        if fault == "blank":
            self.blank += copies
            self.letters.append(GONE * copies)
            return
        self.duplicate += copies - (fault != "duplicate")
        self.truncated += fault == "truncated"
        known = initial if initial in "sua" else "o"
        own = GONE if fault == "duplicate" else known.upper() if fault == "truncated" else known
        self.letters.append(own + GONE * (copies - 1))

    def fragment(self, entries) -> Fragment:
        letters = "".join(self.letters)
        paths = [(e, x, *w) for e in entries for x, w in AUTOMATON.across(letters, e).items()]
        return Fragment(self.first, self.last, self.low, self.high, self.turns, self.illegal, self.blank, self.duplicate, self.truncated, paths)


def _as_batch(head: list[tuple[str, pa.DataType]], rows: list[tuple], found: list[Fragment]) -> pa.RecordBatch:
    columns = [pa.array(values, kind) for values, (_, kind) in zip(zip(*rows, strict=True), head, strict=True)]
    for field, values in zip(_ARROW, zip(*found, strict=True), strict=True):
        if field.name == "paths":
            values = [[dict(zip(("entry", "exit", "cost", "audit"), p, strict=True)) for p in own] for own in values]
        columns.append(pa.array(values, field.type))
    return pa.RecordBatch.from_arrays(columns, schema=pa.schema([*head, *_ARROW]))


def _fragments(id_type: pa.DataType):
    head = [("conv_id", id_type), ("part", pa.int32()), ("piece", pa.int64())]

    def cut(batches):
        entries = sorted(AUTOMATON.resting)
        run, open_id, opened, piece, size = None, None, False, 0, 0
        others = [0]  # only the first conversation of a partition can have begun in another one
        own = entries
        out: list[tuple[tuple, Fragment]] = []

        def flush():
            batch = _as_batch(head, [k for k, _ in out], [f for _, f in out])
            out.clear()
            return batch

        for batch in batches:
            columns = [batch[c].to_pylist() for c in ("conv_id", "part", "turn", "initial", "fault", "copies")]
            for conv, part, turn, initial, fault, copies in zip(*columns, strict=True):
                if run is None or conv != open_id or size >= _ROWS:
                    if run is not None:
                        out.append(((open_id, opened, piece), run.fragment(own)))
                        own = others if conv != open_id else entries
                        if len(out) >= 2000:
                            yield flush()
                    piece = piece + 1 if run is not None and conv == open_id else 0
                    run, open_id, opened, size = _Run(), conv, part, 0
                while copies > _ROWS:  # a heap of equal rows: its first part, and the repeats after it
                    run.add(turn, initial, fault, _ROWS)
                    out.append(((open_id, opened, piece), run.fragment(own)))
                    own, piece, copies, size = entries, piece + 1, copies - _ROWS, 0
                    fault = fault if fault == "blank" else "duplicate"
                    run = _Run()
                    if len(out) >= 2000:
                        yield flush()
                if copies:
                    run.add(turn, initial, fault, copies)
                    size += copies
        if run is not None:
            out.append(((open_id, opened, piece), run.fragment(own)))
        if out:
            yield flush()

    return cut


def _read(table: pa.Table) -> list[Fragment]:
    columns = [table[n].to_pylist() for n in Fragment._fields]
    return [Fragment(*row[:-1], [(p["entry"], p["exit"], p["cost"], p["audit"]) for p in row[-1]]) for row in zip(*columns, strict=True)]


def _composed(id_type: pa.DataType):
    head = [("conv_id", id_type), ("seq", pa.int64())]

    def compose(key, table):
        table = table.sort_by("seq")
        parts = _read(table)
        whole = parts[0]
        for part in parts[1:]:
            whole = joined(whole, part)
        return pa.Table.from_batches([_as_batch(head, [(table["conv_id"][0].as_py(), key[1].as_py())], [whole])])

    return compose


def faults(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, copies, digest, blank, truncated`` of rows with ``conv_id, turn, role, text, copies``."""
    text = F.rtrim(F.col("text"), F.lit(_BLANKS))
    return rows.select(
        "conv_id", "turn", "role", "copies", F.unhex(F.sha2("text", 256)).alias("digest"), (text == "").alias("blank"),
        (~F.substring(text, -1, 1).isin(".", "!", "?")).alias("truncated"),
    )


def _letters(rows: DataFrame) -> DataFrame:
    """One row per distinct row: ``conv_id, turn, role, digest, initial, fault, copies``."""
    keys = ["conv_id", "turn", "role", "digest"]
    heaps = faults(rows).groupBy(*keys).agg(F.sum("copies").alias("copies"), F.first("blank").alias("blank"), F.first("truncated").alias("truncated"))
    # Only texts told in several turns need to know their first turn.
    firsts = (
        heaps.where("copies > 0 AND NOT blank").groupBy("conv_id", "role", "digest")
        .agg(F.min(F.struct("turn")).alias("told"), F.count(F.lit(1)).alias("turns")).where("turns > 1")
        .select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"), F.col("told.turn").alias("told"))
        .withColumn("known", F.lit(True))
    )
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d"))
    repeat = F.col("known") & ~F.col("turn").eqNullSafe(F.col("told"))
    fault = F.when(F.col("blank"), "blank").when(F.coalesce(repeat, F.lit(False)), "duplicate").when(F.col("truncated"), "truncated")
    initial = F.when(F.col("role") == "", " ").otherwise(F.substring("role", 1, 1))
    return heaps.join(firsts, same, "left").select(*keys, initial.alias("initial"), fault.alias("fault"), "copies")


def _order(*ahead: Column) -> list[Column]:
    return [F.col("conv_id").asc_nulls_first(), *ahead, F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")]


def _id_type(rows: DataFrame) -> tuple[str, pa.DataType]:
    from pyspark.sql.pandas.types import to_arrow_type

    kind = rows.schema["conv_id"].dataType
    return kind.simpleString(), to_arrow_type(kind)


def audits(rows: DataFrame) -> DataFrame:
    """Per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit.

    ``rows`` has ``conv_id, turn, role, text, copies``; a row with no copies
    only names its conversation.
    """
    kind, arrow = _id_type(rows)
    order = _order()
    placed = _letters(rows).repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    # Written once, so that the numbers of partitions hold from here on.
    pieces = settle(
        placed.select("conv_id", "part", "turn", "initial", "fault", "copies").mapInArrow(_fragments(arrow), f"conv_id {kind}, part int, piece long, {_FRAGMENT}")
    )
    names = list(Fragment._fields)
    counts = pieces.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    most = counts.agg(F.max("n")).first()[0] or 0
    if most > 1:
        long = settle(counts.where("n > 1").select(F.col("conv_id").alias("c")))
        same = F.col("conv_id").eqNullSafe(F.col("c"))
        rank = F.row_number().over(_by_conversation())
        parts = pieces.join(long, same, "left_semi").withColumn("seq", rank.cast("bigint") - 1).select("conv_id", "seq", *names)
        while most > 1:
            up = F.floor(F.col("seq") / _FAN_IN)
            parts = parts.groupBy("conv_id", up).applyInArrow(_composed(arrow), f"conv_id {kind}, seq long, {_FRAGMENT}")
            most = -(-most // _FAN_IN)
        pieces = pieces.join(long, same, "left_anti").select("conv_id", *names).union(parts.select("conv_id", *names))
    ends = F.filter("paths", lambda p: (p["entry"] == 0) & p["exit"].isin(*AUTOMATON.accepting()))
    best = F.array_min(F.transform(ends, lambda p: F.struct(p["cost"].alias("cost"), p["audit"].alias("audit"))))
    span = F.col("high").cast("decimal(38,0)") - F.col("low") + 1 - F.col("turns")
    gaps = F.when(F.col("low").isNull(), 0).otherwise(F.least(span, F.lit(_MOST)))
    return pieces.withColumn("best", best).select(
        "conv_id", gaps.cast("bigint").alias("gaps"), "blank", "duplicate", "truncated", "illegal", "best.cost", "best.audit"
    )


def _by_conversation():
    from pyspark.sql import Window

    return Window.partitionBy("conv_id").orderBy("part", "piece")


def edited(audit: str, initials):
    """Walk an audit over the initials of its rows: ``(op, role given or None)`` per edit, rows taken as they come."""
    state, source = 0, iter(initials)
    for op in audit:
        if op == "I":
            initial = AUTOMATON.next_given(state)
            yield op, GIVEN[initial]
        else:
            own = next(source)
            if op == "D":
                yield op, None
                continue
            initial = own if op == "K" else AUTOMATON.next_given(state)
            yield op, None if op == "K" else GIVEN[initial]
        state = AUTOMATON.after(state, initial)


def _walk():
    """``edited`` by a table of moves, since texts pass by the million."""
    after, given = {}, {}
    for state in AUTOMATON.resting:
        for symbol in ("s", *GIVEN):
            try:
                after[state, symbol] = AUTOMATON.after(state, symbol)
            except ValueError:
                continue
        given[state] = next((g for g in GIVEN if (state, g) in after), None)
    return after, given


def _repaired(id_type: pa.DataType):
    schema = pa.schema([("conv_id", id_type), ("position", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string()), ("turn", pa.int64())])

    def repair(batches):
        after, given = _walk()
        rows: list[tuple] = []
        conv, audit, at, state, position = None, "", 0, 0, 0

        def put(edit, role, text, turn):
            nonlocal position
            rows.append((conv, position, edit, role, text, turn))
            position += 1

        def inserts():
            nonlocal at, state
            while at < len(audit) and audit[at] == "I":
                initial = given[state]
                put("I", GIVEN[initial], "", None)
                state, at = after[state, initial], at + 1

        def batch():
            out = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
            rows.clear()
            return out

        size = 0
        for table in batches:
            for plan, own, turn, role, text, copies in zip(*(table[c].to_pylist() for c in ("audit", "conv_id", "turn", "role", "text", "copies")), strict=True):
                if plan is not None:
                    conv, audit, at, state, position = own, plan, 0, 0, 0
                    inserts()
                    continue
                for _ in range(copies):
                    op, at = audit[at], at + 1
                    if op != "D":
                        initial = role[:1] if op == "K" else given[state]
                        put(op, role if op == "K" else GIVEN[initial], text, turn)
                        state = after[state, initial]
                        size += len(text)
                    inserts()
                if len(rows) >= 4000 or size >= 8_000_000:
                    size = 0
                    if rows:
                        yield batch()
        if rows:
            yield batch()

    return repair


def repaired(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """The repaired rows: conv_id, position, edit, role, text, turn (null where inserted).

    ``plans`` are ``audits(rows)``. Rows of a conversation come out in one
    partition in the order of ``position``.
    """
    kind, arrow = _id_type(rows)
    nothing = F.lit(None)
    texts = rows.where("copies > 0").select(
        "conv_id", nothing.cast("string").alias("audit"), F.col("turn").cast("bigint").alias("turn"), "role", "text", F.col("copies").cast("bigint").alias("copies"),
        F.unhex(F.sha2("text", 256)).alias("digest"),
    )
    heads = plans.select(
        "conv_id", "audit", nothing.cast("bigint").alias("turn"), nothing.cast("string").alias("role"), nothing.cast("string").alias("text"),
        nothing.cast("bigint").alias("copies"), nothing.cast("binary").alias("digest"),
    )
    placed = heads.union(texts).repartition("conv_id").sortWithinPartitions(*_order(F.col("audit").isNull()))
    return placed.drop("digest").mapInArrow(_repaired(arrow), f"conv_id {kind}, position long, edit string, role string, text string, turn long")


def _digests(id_type: pa.DataType):
    schema = pa.schema([("conv_id", id_type), ("repaired_sha256", pa.string())])

    def digest(batches):
        open_id, hashed, out = None, None, []
        for batch in batches:
            for conv, position, role, text in zip(*(batch[c].to_pylist() for c in ("conv_id", "position", "role", "text")), strict=True):
                if position == 0:
                    if hashed is not None:
                        out.append((open_id, hashed.hexdigest()))
                    open_id, hashed = conv, hashlib.sha256()
                else:
                    hashed.update(b"\n")
                hashed.update(f"{role}:{text}".encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
                out = []
        if hashed is not None:
            yield pa.RecordBatch.from_arrays([pa.array([open_id], id_type), pa.array([hashed.hexdigest()])], schema=schema)

    return digest


def repaired_digests(rows: DataFrame) -> DataFrame:
    """Per conversation with repaired rows, SHA-256 of its ``role:text`` lines; ``rows`` as ``repaired`` returns them."""
    kind, arrow = _id_type(rows)
    return rows.select("conv_id", "position", "role", "text").mapInArrow(_digests(arrow), f"conv_id {kind}, repaired_sha256 string")


def damaged(conversations: DataFrame, id_column: str = "conv_id", turn_column: str = "turn", role_column: str = "role", text_column: str = "text") -> DataFrame:
    """A table of conversations with a quarter of its rows spoilt, by the checksum of id and turn."""
    as_text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    code = F.crc32(F.concat(as_text(id_column), F.lit(":"), as_text(turn_column))) % 20
    text: Column = as_text(text_column)
    spoilt = F.when(F.col("code") == 1, "").when(F.col("code") == 2, F.translate(F.col("text"), ".!?", "")).otherwise(F.col("text"))
    rows = conversations.select(F.col(id_column).alias("conv_id"), F.col(turn_column).cast("bigint").alias("turn"), as_text(role_column).alias("role"), text.alias("text"), code.alias("code"))
    return rows.select(
        "conv_id", "turn", F.when(F.col("code") == 4, "user").otherwise(F.col("role")).alias("role"), spoilt.alias("text"),
        F.when(F.col("code") == 0, 0).when(F.col("code") == 3, 2).otherwise(1).alias("copies"),
    )


def repair(rows: DataFrame) -> DataFrame:
    """``audits`` of rows with the digest of each repaired conversation."""
    plans = settle(audits(rows))
    digests = repaired_digests(repaired(rows, plans)).withColumnRenamed("conv_id", "c")
    empty = F.lit(hashlib.sha256().hexdigest())
    found = plans.join(digests, F.col("conv_id").eqNullSafe(F.col("c")), "left").drop("c")
    return found.withColumn("repaired_sha256", F.coalesce("repaired_sha256", empty))


def plain_rows(conversations: DataFrame, id_column: str = "conv_id", turn_column: str = "turn", role_column: str = "role", text_column: str = "text") -> DataFrame:
    """A table of conversations as the other functions take it, nothing spoilt."""
    space = F.lit(" ")
    return conversations.select(
        F.col(id_column).alias("conv_id"), F.col(turn_column).cast("bigint").alias("turn"), F.coalesce(F.col(role_column), space).alias("role"),
        F.coalesce(F.col(text_column), space).alias("text"), F.lit(1).alias("copies"),
    )
