"""Conversation structure repair by a run-length min-plus program.

A repaired conversation has the roles ``system`` (at most once, at the start) and then ``user`` and ``assistant`` in turns, or
no row at all. Rows are kept, given another role or deleted, and empty ones inserted, at least total cost; of equally
cheap repairs the one whose audit (the edits' initials in order) is least in ASCII is taken.

How it works:

1. Every row becomes one symbol of its role and fault. Whether a row repeats an earlier one is an aggregate by conversation, role
   and text digest, so copies of a hot row are combined before they are shuffled.
2. Symbols are sorted by conversation and streamed. Equal neighbours are one run; a run is advanced from the
   end to the front by the binary powers of its 4 x 4 min-plus matrix, which are computed once per process. The choices are then
   unrolled from the front: at each row the least letter whose cost keeps to the optimum. Runs, vectors and choices
   recur, and are remembered in tables of bounded size.
3. The audit meets the texts again in a second sort, as a row in front of its conversation's rows, and repaired rows
   (or their digest) are streamed out. No task holds the texts of a conversation; it holds its symbols and audit, a letter or
   a few bytes per row, which the result has in one cell anyhow. The digest of a conversation is sequential by its nature.

Rows of a conversation are ordered by turn (NULL first), role and text digest; equal rows are interchangeable. NULL in
role or text counts as one space: a NULL text is blank, a NULL role is neither of the three. A role is known by its first
letter. NULL conv_id is a conversation of its own; texts may be empty or of any length that a row can hold; other columns are
ignored, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitlens.llm.common import same, settle

# --- fixed values -------------------------------------------------------------------------------------------
#: The characters that leave a text blank.
WHITE = " \t\n\v\f\r"
ENDS = (".", "!", "?")
KEEP, REROLE, DELETE, INSERT = 0, 3, 4, 3
TRUNCATED_EXTRA = 3
USER, ASSISTANT = "user", "assistant"
# ------------------------------------------------------------------------------------------------------------
#: States of a repaired conversation: nothing yet, after system, after user, after assistant.
NOTHING, SYSTEM, ASKED, ANSWERED = range(4)
STATES = range(4)
FORCED = (ASKED, ASKED, ANSWERED, ASKED)
ACCEPTED = (NOTHING, ANSWERED)
DOOMED = "-"
NEVER = 1 << 60

Vector = tuple[int, ...]
Matrix = tuple[Vector, ...]


def _kept(initial: str, state: int) -> int | None:
    """The state after a row of that role is kept as it is."""
    if initial == "s":
        return SYSTEM if state == NOTHING else None
    target = {"u": ASKED, "a": ANSWERED}.get(initial)
    return target if target == FORCED[state] else None


def _product(left: Matrix, right: Matrix) -> Matrix:
    return tuple(tuple(min(left[p][k] + right[k][q] for k in STATES) for q in STATES) for p in STATES)


def _applied(matrix: Matrix, vector: Vector) -> Vector:
    return tuple(min(matrix[p][q] + vector[q] for q in STATES) for p in STATES)


def _inserts() -> Matrix:
    """Least cost of inserted rows alone, from state to state."""
    one = tuple(tuple(0 if p == q else INSERT if FORCED[p] == q else NEVER for q in STATES) for p in STATES)
    return _product(_product(one, one), one)


INSERTS = _inserts()
#: Cost to go after the last row.
END: Vector = tuple(min(INSERTS[p][q] for q in ACCEPTED) for p in STATES)


def _edits(symbol: str, state: int) -> Iterator[tuple[str, int, int]]:
    """Letter, cost and next state of each edit that uses up a row, letters in ASCII order."""
    yield "D", DELETE, state
    if symbol != DOOMED:
        extra = TRUNCATED_EXTRA if symbol.isupper() else 0
        after = _kept(symbol.lower(), state)
        if after is not None:
            yield "K", KEEP + extra, after
        yield "R", REROLE + extra, FORCED[state]


@lru_cache(maxsize=None)  # symbols x bits of a run's length
def _power(symbol: str, bit: int) -> Matrix:
    """The transition of 2**bit rows of one symbol, with insertions in front of each."""
    if bit:
        half = _power(symbol, bit - 1)
        return _product(half, half)
    rows = []
    for state in STATES:
        row = [NEVER] * len(STATES)
        for _, cost, after in _edits(symbol, state):
            row[after] = min(row[after], cost)
        rows.append(tuple(row))
    return _product(INSERTS, tuple(rows))


@lru_cache(maxsize=1 << 16)
def _before(symbol: str, length: int, after: Vector) -> tuple[int, Vector]:
    """Cost to go before a run, as its least entry and the excess over that, from the cost to go after it."""
    bit = 0
    while length:
        if length & 1:
            after = _applied(_power(symbol, bit), after)
        length >>= 1
        bit += 1
    least = min(after)
    return least, tuple(min(cost - least, NEVER) for cost in after)


@lru_cache(maxsize=1 << 16)
def _one_row(symbol: str, state: int, after: Vector) -> tuple[str, int]:
    before = _applied(_power(symbol, 0), after)
    letters = ""
    while True:
        choices = list(_edits(symbol, state))
        choices.append(("I", INSERT, FORCED[state]))
        for letter, cost, follower in sorted(choices):
            rest = before[follower] if letter == "I" else after[follower]
            if cost + rest == before[state]:
                letters, state = letters + letter, follower
                break
        if letter != "I":
            return letters, state


def _unrolled(symbol: str, length: int, state: int, after: Vector, out: list[str]) -> int:
    """Append the least letters of the cheapest edits of a run; returns the state behind it. Long runs are halved, so that
    no cost vector per row is held."""
    if length == 1:
        letters, state = _one_row(symbol, state, after)
        out.append(letters)
        return state
    half = length // 2
    middle = _before(symbol, length - half, after)[1]
    return _unrolled(symbol, length - half, _unrolled(symbol, half, state, middle, out), after, out)


def cheapest_edits(runs: list[tuple[str, int]]) -> tuple[int, str]:
    """Least cost, and the ASCII-least audit of that cost, of (symbol, length) runs."""
    cost, vector, behind = 0, END, []
    for symbol, length in reversed(runs):
        behind.append(vector)
        least, vector = _before(symbol, length, vector)
        cost += least
    cost += vector[NOTHING]
    state, out = NOTHING, []
    for symbol, length in runs:
        state = _unrolled(symbol, length, state, behind.pop(), out)
    while state not in ACCEPTED:
        out.append("I")
        state = FORCED[state]
    return cost, "".join(out)


def _filled(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text without NULLs in the last two, and the text's digest."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    return rows.select(
        F.col("conv_id").cast("long"),
        F.col("turn").cast("long"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        text.alias("text"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
    )


def row_symbols(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, digest, copies, blank, truncated, and whether an earlier turn has the same role and text."""
    bare = F.rtrim(F.col("text"), F.lit(WHITE))
    marked = _filled(rows).select(
        "conv_id", "turn", "role", "digest",
        (bare == "").alias("blank"),
        (~F.substring(bare, -1, 1).isin(*ENDS)).alias("truncated"),
    )
    counted = marked.groupBy(*marked.columns).agg(F.count(F.lit(1)).alias("copies"))
    # NULL turns are first, and a struct orders them so.
    firsts = marked.groupBy(
        F.col("conv_id").alias("of_conv"), F.col("role").alias("of_role"), F.col("digest").alias("of_digest")
    ).agg(F.min(F.struct("turn")).alias("first"))
    match = same(F.col("conv_id"), F.col("of_conv")) & (F.col("role") == F.col("of_role")) & (F.col("digest") == F.col("of_digest"))
    joined = counted.join(firsts, match)
    return joined.select(*counted.columns, (~same(F.col("turn"), F.col("first.turn"))).alias("seen"))


AUDITS = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
)
_LEGAL = ("su", "ua", "au")


class _Conversation:
    """What is kept of a conversation while its symbols pass by."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.runs, self.last = conv_id, [], None
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.low = self.high = None

    def _add(self, symbol: str, copies: int) -> None:
        if self.runs and self.runs[-1][0] == symbol:
            symbol, copies = symbol, self.runs.pop()[1] + copies
        self.runs.append((symbol, copies))

    def take(self, turn: int | None, role: str, copies: int, blank: bool, truncated: bool, seen: bool) -> None:
        initial = role[:1]
        if self.last is not None and self.last + initial not in _LEGAL:
            self.illegal += 1
        self.illegal += copies - 1  # equal neighbours never follow each other
        self.last = initial
        if turn is not None and turn != self.high:
            self.turns += 1
            self.low, self.high = turn if self.low is None else self.low, turn
        if blank:
            self.blank += copies
            self._add(DOOMED, copies)
            return
        again = copies if seen else copies - 1
        self.duplicate += again
        if not seen:
            self.truncated += truncated
            symbol = initial if initial in ("s", "u", "a") else "x"
            self._add(symbol.upper() if truncated else symbol, 1)
        if again:
            self._add(DOOMED, again)

    def row(self) -> tuple:
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        cost, audit = cheapest_edits(self.runs)
        return (self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit)


def _columns(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


_AUDIT_FIELDS = pa.schema(
    [(name, pa.string() if kind == "string" else pa.int64()) for name, kind in (field.split() for field in AUDITS.split(", "))]
)


def _audit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation, from symbols sorted by conversation."""
    current = None
    for batch in batches:
        done = []
        ids, *facts = [column.to_pylist() for column in batch.columns]
        for conv_id, *fact in zip(ids, *facts, strict=True):
            if current is None or current.conv_id != conv_id:
                if current is not None:
                    done.append(current.row())
                current = _Conversation(conv_id)
            current.take(*fact)
        yield _columns(done, _AUDIT_FIELDS)
    if current is not None:
        yield _columns([current.row()], _AUDIT_FIELDS)


def audits(rows: DataFrame) -> DataFrame:
    """Faults, cost and audit of each conversation."""
    order = ("conv_id", F.asc_nulls_first("turn"), "role", "digest")
    sorted_rows = row_symbols(rows).repartition("conv_id").sortWithinPartitions(*order)
    return sorted_rows.select("conv_id", "turn", "role", "copies", "blank", "truncated", "seen").mapInArrow(_audit, AUDITS)


class _Replay:
    """Replays an audit over the rows of its conversation."""

    def __init__(self, conv_id: int | None, audit: str):
        self.conv_id, self.audit, self.at, self.state = conv_id, audit, 0, NOTHING

    def inserted(self) -> Iterator[tuple[str, str, str]]:
        while self.audit[self.at : self.at + 1] == "I":
            self.at, self.state = self.at + 1, FORCED[self.state]
            yield (USER if self.state == ASKED else ASSISTANT), "", "I"

    def edited(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.state = _kept(role[:1], self.state)
            yield role, text, edit
        elif edit == "R":
            self.state = FORCED[self.state]
            yield (USER if self.state == ASKED else ASSISTANT), text, edit


def _replayed(batches: Iterable[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Lists of (conv_id, role, text, edit) from audits and rows sorted by conversation, the audit first. A conversation starts with
    a row whose edit is its whole audit."""
    current = None
    for batch in batches:
        out = []
        for conv_id, audit, role, text in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            if audit is None:
                out.extend((conv_id, *row) for row in current.edited(role, text))
                continue
            if current is not None:
                out.extend((current.conv_id, *row) for row in current.inserted())
            current = _Replay(conv_id, audit)
            out.append((conv_id, None, None, audit))
        yield out
    if current is not None:
        yield [(current.conv_id, *row) for row in current.inserted()]


REPAIRED = "conv_id long, place long, role string, text string, edit string"
_REPAIRED_FIELDS = pa.schema(
    [("conv_id", pa.int64()), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("edit", pa.string())]
)


def _rows_out(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    place = 0
    for rows in _replayed(batches):
        out = []
        for conv_id, role, text, edit in rows:
            if role is None:
                place = 0
                continue
            out.append((conv_id, place, role, text, edit))
            place += 1
        yield _columns(out, _REPAIRED_FIELDS)


DIGESTS = "conv_id long, repaired_sha256 string"
_DIGEST_FIELDS = pa.schema([("conv_id", pa.int64()), ("repaired_sha256", pa.string())])


def _digests_out(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conversation = digest = None
    for rows in _replayed(batches):
        out = []
        for conv_id, role, text, _ in rows:
            if role is None:
                if digest is not None:
                    out.append((conversation, digest.hexdigest()))
                conversation, digest, between = conv_id, hashlib.sha256(), ""
                continue
            digest.update(f"{between}{role}:{text}".encode())
            between = "\n"
        yield _columns(out, _DIGEST_FIELDS)
    if digest is not None:
        yield _columns([(conversation, digest.hexdigest())], _DIGEST_FIELDS)


def _beside_rows(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Audits and rows, sorted so that each audit stands before its rows."""
    texts = _filled(rows).withColumn("audit", F.lit(None).cast("string"))
    columns = ("conv_id", "audit", "turn", "role", "digest", "text")
    both = found.select("conv_id", "audit").unionByName(texts.select(*columns), allowMissingColumns=True)
    order = ("conv_id", F.col("audit").isNull(), F.asc_nulls_first("turn"), "role", "digest")
    return both.repartition("conv_id").sortWithinPartitions(*order).select("conv_id", "audit", "role", "text")


def repaired_rows(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of the repaired conversations, in place, with the edit that each comes from. ``found``: ``audits(rows)``."""
    return _beside_rows(rows, found).mapInArrow(_rows_out, REPAIRED)


def repair(rows: DataFrame) -> DataFrame:
    """Faults, cost, audit and digest of the repaired ``role:text`` lines of each conversation that has rows."""
    found = settle(audits(rows), "conversation-audits")
    digests = _beside_rows(rows, found).mapInArrow(_digests_out, DIGESTS).withColumnRenamed("conv_id", "of_conv")
    return found.join(digests, same(F.col("conv_id"), F.col("of_conv"))).drop("of_conv")


def damaged(rows: DataFrame) -> DataFrame:
    """Rows with planted faults, chosen by a checksum of ``conv_id:turn`` (NULL as one space) modulo 20: 0 drops the row, 1 empties
    its text, 2 removes ``.!?`` from it, 3 repeats it, 4 makes it the user's."""

    def or_space(name: str):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    plain = rows.select(
        "conv_id", "turn", or_space("role").alias("role"), or_space("text").alias("text"),
        (F.crc32(F.concat(or_space("conv_id"), F.lit(":"), or_space("turn"))) % 20).alias("_fault"),
    ).where(F.col("_fault") != 0)
    fault, text = F.col("_fault"), F.col("text")
    copies = F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return plain.select(
        "conv_id", "turn",
        F.when(fault == 4, F.lit(USER)).otherwise(F.col("role")).alias("role"),
        F.when(fault == 1, F.lit("")).when(fault == 2, F.translate(text, "".join(ENDS), "")).otherwise(text).alias("text"),
        F.explode(copies).alias("_copy"),
    ).drop("_copy")


def repaired_conversations(rows: DataFrame) -> DataFrame:
    """``repair`` of the damaged rows, for every conv_id of the undamaged ones; a conversation without rows has zeros, an empty
    audit and the digest of nothing."""
    found = repair(damaged(rows)).withColumnRenamed("conv_id", "of_conv")
    every = rows.select(F.col("conv_id").cast("long")).distinct()
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return every.join(found, same(F.col("conv_id"), F.col("of_conv")), "left").select(
        "conv_id",
        *[F.coalesce(F.col(name), F.lit(0).cast("long")).alias(name) for name in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
