"""Conversation structure repair: cheapest edits that make role sequences ``(s?(ua)+)?``, by rank-convergence Viterbi.

Rows of a conversation are taken by turn (nulls first), then role, then the MD5 of the text. A null role or text is one
space, all rows with a null conversation id are one conversation. A row's first fault counts: ``blank`` (no character
but space and the controls 9 to 13), ``duplicate`` (role and text seen earlier in the conversation), ``truncated`` (last
such character not one of ``.!?``). Keeping a row costs 0, giving it the role that fits next 2, deleting it 3; inserting
an empty message costs 2. Blank and duplicate rows must be deleted, truncated ones add 1 unless they are. Of the cheapest
repairs the one whose edits K, R, D, I in order are ASCII-least is taken. A role whose first letter is none of s, u, a,
or which is empty, cannot be kept. Long texts pass whole; other columns are not read, so their names cannot clash; an
empty table gives an empty result.

The states are: nothing yet (0), after a system message (1), after user (2), after assistant (3). A cost vector holds the
least cost of the rest of the conversation from each state. Vectors are kept less their least entry, so two that
differ only by a constant are the same.

1. Rows are range-partitioned by conversation and order, which spreads a hot conversation over many tasks, and each
   task cuts its rows into pieces: whole conversations, except for those at its edges and those above ``PIECE_BYTES``.
2. Whole conversations are repaired where they are. Open pieces exchange digests of their distinct rows to learn which
   were seen in an earlier piece.
3. Each open piece but the last of a conversation runs backwards from a speculative vector. In fix-up passes, pieces
   whose successor begins with another vector than the one they ran from run again from that, until the vector is the old one. Nearly
   always the first rows do it. Some rows never forget (a run of users only keeps its parity), and would take a pass a
   piece; so what is still moving after ``PASSES`` is settled by 4 x 4 transfer matrices of the pieces.
4. The costs stitched this way drive the tracing forwards: pieces are traced from each of the four states, a stream over
   the pieces finds the state each really begins with, and that trace is the audit.

A piece is bounded by ``PIECE_BYTES`` or one row. Passes over the pieces of a conversation stream through rows of some
hundred bytes, one for each piece. Only the digest of one repaired conversation (``summary``) is sequential by nature; it
streams through the pieces, one at a time in memory.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

from churnflow.llm.columns import delete, require, shared_path, stored
from churnflow.llm.textmap import release

PIECE_BYTES = 16 << 20
PASSES = 4
_OUT_BYTES = 4 << 20

# Kinds of rows: twice the class of the role (s, u, a, other), plus one if truncated; then the two that must go.
_CLASSES = {"s": 0, "u": 1, "a": 2}
_OTHER, BLANK, DUPLICATE = 3, 8, 9
_SPACE = " \t\n\x0b\x0c\r"
_LEGAL = {"su", "ua", "au"}

_NEXT = (2, 2, 3, 2)  # the state after the only message that fits a state: user, or assistant after user
_KEPT_IN = ((0,), (0, 1, 3), (2,), ())  # states in which a role of each class can be kept ...
_KEPT_TO = (1, 2, 3, None)  # ... and the state after it
_FITTING = ("user", "user", "assistant", "user")
END = (0, 4, 2, 0)  # costs after the last row
SPECULATIVE = (0, 0, 0, 0)

Vector = tuple[int, int, int, int]


def _edits(after: Vector, kind: int) -> tuple[list[dict[str, tuple[int, int]]], list[int]]:
    """For each state, the edits of a row as {letter: (cost of all from here, next state)}; and the least costs, inserts included."""
    truncated, group = kind & 1, kind >> 1
    found: list[dict[str, tuple[int, int]]] = []
    for state in range(4):
        edits = {"D": (3 + after[state], state)}
        if kind < BLANK:
            if state in _KEPT_IN[group]:
                edits["K"] = (truncated + after[_KEPT_TO[group]], _KEPT_TO[group])
            edits["R"] = (2 + truncated + after[_NEXT[state]], _NEXT[state])
        found.append(edits)
    least = [min(cost for cost, _ in edits.values()) for edits in found]
    user, assistant = min(least[2], 2 + least[3]), min(least[3], 2 + least[2])
    return found, [min(least[0], 2 + user), min(least[1], 2 + user), user, assistant]


@lru_cache(1 << 16)
def before(after: Vector, kind: int) -> Vector:
    """The vector before a row, less its least entry."""
    costs = _edits(after, kind)[1]
    low = min(costs)
    return tuple(c - low for c in costs)


@lru_cache(1 << 16)
def move(after: Vector, kind: int, state: int) -> tuple[str, int]:
    """The least letters that lead past a row at least cost, and the state they lead to."""
    found, least = _edits(after, kind)
    letters = ""
    while True:
        options = {letter: to for letter, (cost, to) in found[state].items() if cost == least[state]}
        if "D" in options:
            return letters + "D", options["D"]
        if 2 + least[_NEXT[state]] == least[state]:
            letters, state = letters + "I", _NEXT[state]
            continue
        letter = min(options)
        return letters + letter, options[letter]


def vectors(kinds: bytes, end: Vector) -> list[Vector]:
    """The vector before each row, and the one after the last."""
    found = [end]
    for kind in reversed(kinds):
        end = before(end, kind)
        found.append(end)
    found.reverse()
    return found


def rerun(kinds: bytes, old: Vector, old_start: Vector, new: Vector) -> Vector:
    """The vector before the first row, coming from ``new``: as soon as it is that of the run from ``old``, the rest is known."""
    for kind in reversed(kinds):
        if new == old:
            return old_start
        old, new = before(old, kind), before(new, kind)
    return new


def trace(kinds: bytes, end: Vector, state: int, last: bool) -> tuple[list[str], int]:
    """The letters up to and with each row (after the last row, one more entry), and the state reached."""
    along = vectors(kinds, end)
    letters = []
    for i, kind in enumerate(kinds):
        text, state = move(along[i + 1], kind, state)
        letters.append(text)
    closing = "I" * (0, 2, 1, 0)[state] if last else ""
    return [*letters, closing], state


def transfer(kinds: bytes) -> list[list[int]]:
    """Least costs of a piece from each state to each: a min-plus matrix, by the four unit vectors."""
    far = 1 << 40
    columns = []
    for target in range(4):
        costs = tuple(0 if s == target else far for s in range(4))
        for kind in reversed(kinds):
            costs = tuple(min(c, far) for c in _edits(costs, kind)[1])
        columns.append(costs)
    return [[columns[t][s] for t in range(4)] for s in range(4)]


def _kind(role: str, text: str) -> int:
    body = text.rstrip(_SPACE)
    if not body:
        return BLANK
    return 2 * _CLASSES.get(role[:1], _OTHER) + (body[-1] not in ".!?")


def apply_edits(letters: list[str], roles: list[str], texts: list[str], state: int) -> tuple[list[str], list[str]]:
    """Roles and texts after the edits of a piece that begins in ``state``."""
    new_roles, new_texts = [], []
    for i, steps in enumerate(letters):
        for letter in steps:
            if letter == "D":
                continue
            if letter == "K":
                new_roles.append(roles[i])
                new_texts.append(texts[i])
                state = _KEPT_TO[_CLASSES[roles[i][0]]]
                continue
            new_roles.append(_FITTING[state])
            new_texts.append(texts[i] if letter == "R" else "")
            state = _NEXT[state]
    return new_roles, new_texts


def _cost(letters: list[str], kinds: bytes) -> int:
    own = "".join(letters)
    late = sum(1 for steps, kind in zip(letters, kinds) if kind < BLANK and kind & 1 and steps[-1] != "D")
    return 3 * own.count("D") + 2 * own.count("R") + 2 * own.count("I") + late


def _counts(kinds: bytes) -> tuple[int, int, int]:
    return kinds.count(BLANK), kinds.count(DUPLICATE), sum(kinds.count(k) for k in range(1, BLANK, 2))


_FACTS = "blank long, duplicate long, truncated long, illegal long, first_role string, last_role string, first_turn long, last_turn long, n_turns long"
_PIECE = f"piece long, open boolean, kinds binary, at array<int>, digests array<binary>, {_FACTS}, audit string, cost long, roles array<string>, texts array<string>"


class _Piece:
    """Rows of one conversation, in order, as they come in."""

    def __init__(self, conversation) -> None:
        self.conversation = conversation
        self.kinds, self.seen = bytearray(), {}
        self.roles: list[str] = []
        self.texts: list[str] = []
        self.turns: list[int | None] = [None, None]
        self.n_turns = self.illegal = self.bytes = 0

    def add(self, turn: int | None, role: str, text: str, times: int) -> None:
        for _ in range(times):
            kind = _kind(role, text)
            if kind != BLANK:
                if (role, text) in self.seen:
                    kind = DUPLICATE
                else:
                    self.seen[role, text] = len(self.kinds)
            if self.roles and self.roles[-1][:1] + role[:1] not in _LEGAL:
                self.illegal += 1
            self.kinds.append(kind)
            self.roles.append(role)
            self.texts.append(text)
            self.bytes += 64 + len(role) + len(text)
        if times and turn is not None:
            self.n_turns += turn != self.turns[1]
            self.turns = [turn if self.turns[0] is None else self.turns[0], turn]

    def row(self, number: int, is_open: bool) -> list:
        kinds, roles, texts, audit, cost, at, digests = bytes(self.kinds), self.roles, self.texts, None, None, [], []
        ends = [roles[0][:1], roles[-1][:1]] if roles else [None, None]
        if is_open:
            at = list(self.seen.values())
            digests = [hashlib.sha256(f"{r}\0{t}".encode()).digest() for r, t in self.seen]
        else:
            letters, _ = trace(kinds, END, 0, True)
            roles, texts = apply_edits(letters, roles, texts, 0)
            audit, cost = "".join(letters), _cost(letters, kinds)
        return [self.conversation, number, is_open, kinds, at, digests, *_counts(kinds), self.illegal, *ends, *self.turns, self.n_turns, audit, cost, roles, texts]


def _batches(rows: Iterator[list], schema: pa.Schema, weight: Callable[[list], int]) -> Iterator[pa.RecordBatch]:
    """Rows as record batches of about ``_OUT_BYTES``."""
    held, size = [], 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)

    for row in rows:
        held.append(row)
        size += weight(row)
        if size > _OUT_BYTES or len(held) >= 10_000:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()
    release()


def _mapped(df: DataFrame, schema: StructType, function: Callable[[Iterator[tuple]], Iterator[list]], weight: Callable[[list], int] = lambda row: 200) -> DataFrame:
    """``df`` through a function from its rows, in order, to rows of ``schema``."""
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for b in batches for row in zip(*(c.to_pylist() for c in b.columns), strict=True))
        yield from _batches(function(rows), arrow, weight)

    return df.mapInArrow(run, schema)


def _schema(conversation: StructField, columns: str) -> StructType:
    return StructType([StructField("conv_id", conversation.dataType), *_parse_datatype_string(columns).fields])


def _ordered(conversations: DataFrame, times: Column | None) -> DataFrame:
    number = F.monotonically_increasing_id().alias("number")
    rows = conversations.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"), (F.lit(1) if times is None else times).cast("int").alias("times"), number,
    ).withColumn("digest", F.md5("text"))
    order = ["conv_id", "turn", "role", "digest", "number"]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "turn", "role", "text", "times")


def _pieces(rows: DataFrame, piece_bytes: int) -> DataFrame:
    def cut(rows: Iterator[tuple]) -> Iterator[list]:
        """The first and the last conversation of a partition may go on beyond it, so their pieces are open."""
        first = TaskContext.get().partitionId() << 32
        number, current, is_open = 0, None, True
        for conversation, turn, role, text, times in rows:
            if current is not None and conversation != current.conversation:
                yield current.row(first + number, is_open)
                number, current, is_open = number + 1, None, False
            if current is not None and current.bytes > piece_bytes:
                yield current.row(first + number, True)
                number, current, is_open = number + 1, None, True
            if current is None:
                current = _Piece(conversation)
            current.add(turn, role, text, times)
        if current is not None:
            yield current.row(first + number, True)

    return _mapped(rows, _schema(rows.schema["conv_id"], _PIECE), cut, lambda row: 200 + sum(map(len, row[-1])))


_RUN = "piece long, following long, kinds binary, `end` array<int>, start array<int>"


def _open_kinds(pieces: DataFrame) -> DataFrame:
    """(conv_id, piece, following, kinds) of the open pieces, rows seen in earlier pieces marked; ``following`` is the next piece."""
    found = pieces.filter("open")
    seen = found.select("conv_id", "piece", F.explode(F.arrays_zip("at", "digests")).alias("d")).select("conv_id", "piece", "d.at", "d.digests")
    earlier = F.min("piece").over(Window.partitionBy("conv_id", "digests"))
    again = seen.withColumn("first", earlier).filter("piece > first").groupBy("piece").agg(F.collect_list("at").alias("again"))
    following = F.lead("piece").over(Window.partitionBy("conv_id").orderBy("piece"))
    chain = found.select("conv_id", "piece").select("piece", following.alias("following"))
    met = found.select("conv_id", "piece", "kinds").join(chain, "piece").join(again, "piece", "left").select("conv_id", "piece", "following", "kinds", "again")

    def mark(rows: Iterator[tuple]) -> Iterator[list]:
        for conversation, piece, following, kinds, again in rows:
            marked = bytearray(kinds)
            for i in again or ():
                marked[i] = DUPLICATE
            end = list(SPECULATIVE if following is not None else END)
            yield [conversation, piece, following, bytes(marked), end, list(vectors(bytes(marked), tuple(end))[0])]

    return _mapped(met, _schema(pieces.schema["conv_id"], _RUN), mark, lambda row: 200 + len(row[3]))


def _with_wanted(run: DataFrame) -> DataFrame:
    """The vector the following piece begins with: what each piece should have run from."""
    starts = run.select(F.col("piece").alias("following"), F.col("start").alias("wanted"))
    met = run.join(starts, "following", "left")
    return met.select(*run.columns, F.coalesce("wanted", "end").alias("wanted"))


def _converged(run: DataFrame, spent: list[str], passes: int) -> DataFrame:
    """Fix-up passes until every piece has run from the vector that its successor begins with."""
    spark = run.sparkSession
    schema = run.schema

    def fix(rows: Iterator[tuple]) -> Iterator[list]:
        for conversation, piece, following, kinds, end, start, wanted in rows:
            if wanted != end:
                start, end = list(rerun(kinds, tuple(end), tuple(start), tuple(wanted))), wanted
            yield [conversation, piece, following, kinds, end, start]

    def keep(df: DataFrame) -> DataFrame:
        spent.append(shared_path(spark, "conversation-run"))
        return stored(df, "", spent[-1])

    run = keep(run)
    for _ in range(passes):
        wanted = _with_wanted(run)
        if wanted.filter(~F.col("wanted").eqNullSafe(F.col("end"))).isEmpty():
            return run
        run = keep(_mapped(wanted, schema, fix, lambda row: 200 + len(row[3])))
    wanted = _with_wanted(run)
    if wanted.filter(~F.col("wanted").eqNullSafe(F.col("end"))).isEmpty():
        return run

    def summed(rows: Iterator[tuple]) -> Iterator[list]:
        for conversation, piece, following, kinds in rows:
            yield [conversation, piece, following, sum(transfer(kinds), [])]

    def stitch(rows: Iterator[tuple]) -> Iterator[list]:
        """From the last piece of a conversation to its first."""
        vector = END
        for conversation, piece, following, matrix in rows:
            vector = END if following is None else vector
            yield [conversation, piece, list(vector)]
            costs = [min(matrix[4 * s + t] + vector[t] for t in range(4)) for s in range(4)]
            vector = tuple(c - min(costs) for c in costs)

    of = schema["conv_id"]
    matrices = _mapped(run.select("conv_id", "piece", "following", "kinds"), _schema(of, "piece long, following long, matrix array<long>"), summed)
    matrices = matrices.repartition("conv_id").sortWithinPartitions("conv_id", F.desc("piece"))
    right = _mapped(matrices, _schema(of, "piece long, wanted array<int>"), stitch).drop("conv_id")
    return keep(_mapped(run.join(right, "piece").select(*run.columns, "wanted"), schema, fix, lambda row: 200 + len(row[3])))


def _entered(run: DataFrame) -> DataFrame:
    """(piece, state): the state each piece begins in."""

    def exits(rows: Iterator[tuple]) -> Iterator[list]:
        for conversation, piece, kinds, end in rows:
            yield [conversation, piece, [trace(kinds, tuple(end), state, False)[1] for state in range(4)]]

    def follow(rows: Iterator[tuple]) -> Iterator[list]:
        state, current = 0, ()
        for conversation, piece, reached in rows:
            state, current = (state if (conversation,) == current else 0), (conversation,)
            yield [conversation, piece, state]
            state = reached[state]

    of = run.schema["conv_id"]
    found = _mapped(run.select("conv_id", "piece", "kinds", "end"), _schema(of, "piece long, exits array<int>"), exits)
    return _mapped(found.repartition("conv_id").sortWithinPartitions("conv_id", "piece"), _schema(of, "piece long, state int"), follow).drop("conv_id")


def repair(conversations: DataFrame, times: Column | None = None, piece_bytes: int = PIECE_BYTES, passes: int = PASSES) -> DataFrame:
    """The repaired messages, a row a piece: nearly every conversation is one piece.

    ``conv_id``, ``piece`` (in order), ``open`` (whether other pieces may belong to the conversation), counts of faults
    and of illegal neighbours, first and last role and turn, ``audit``, ``cost``, ``roles`` and ``texts``. ``times`` says
    how often a row stands at its place, 1 by default; a conversation with none but rows of 0 is empty, and has a piece.
    """
    require(conversations, "conv_id", "turn", "role", "text")
    spark = conversations.sparkSession
    pieces = stored(_pieces(_ordered(conversations, times), piece_bytes), "conversation-pieces")
    spent: list[str] = []
    try:
        run = _converged(_open_kinds(pieces), spent, passes)
        traced = run.join(_entered(run), "piece").select("piece", F.col("kinds").alias("marked"), "end", "state", F.col("following").isNull().alias("last"))

        def finish(rows: Iterator[tuple]) -> Iterator[list]:
            for *row, kinds, end, state, last in rows:
                letters, _ = trace(kinds, tuple(end), state, last)
                values = dict(zip(names, row, strict=True))
                values["blank"], values["duplicate"], values["truncated"] = _counts(kinds)
                values["audit"], values["cost"] = "".join(letters), _cost(letters, kinds)
                values["roles"], values["texts"] = apply_edits(letters, values["roles"], values["texts"], state)
                yield list(values.values())

        kept = pieces.drop("kinds", "at", "digests")
        names = kept.columns
        finished = _mapped(kept.filter("open").join(traced, "piece").select(*names, "marked", "end", "state", "last"), kept.schema, finish, lambda row: 200 + sum(map(len, row[-1])))
        return kept.filter("NOT open").unionByName(stored(finished, "conversation-open"))
    finally:
        for path in spent:
            delete(spark, path)


_SUMMARY = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def summary(repaired: DataFrame) -> DataFrame:
    """A row a conversation: ``gaps`` in its turns, faults, ``cost``, ``audit`` and the digest of its repaired lines ``role:text``."""
    gaps = F.coalesce(F.col("last_turn") - F.col("first_turn") + 1 - F.col("n_turns"), F.lit(0)).alias("gaps")
    lines = F.array_join(F.zip_with("roles", "texts", lambda r, t: F.concat(r, F.lit(":"), t)), "\n")
    names = [f.name for f in _parse_datatype_string(_SUMMARY).fields]
    whole = repaired.filter("NOT open").select("*", gaps, F.sha2(lines, 256).alias("repaired_sha256")).select("conv_id", *names)

    facts = [f.name for f in _parse_datatype_string(_FACTS).fields]
    columns = ["conv_id", *facts, "cost", "audit", "roles", "texts"]
    split = repaired.filter("open").repartition("conv_id").sortWithinPartitions("conv_id", "piece").select(*columns)

    def combine(rows: Iterator[tuple]) -> Iterator[list]:
        current, total, audit, digest, begun = (), {}, [], None, False

        def row() -> list:
            spread = total["last_turn"] - total["first_turn"] + 1 - total["n_turns"] if total["last_turn"] is not None else 0
            return [current[0], spread, *(total[c] for c in ("blank", "duplicate", "truncated", "illegal", "cost")), "".join(audit), digest.hexdigest()]

        for values in rows:
            own = dict(zip(columns, values, strict=True))
            if (own["conv_id"],) != current:
                if current:
                    yield row()
                current, total, audit, digest, begun = (own["conv_id"],), own, [], hashlib.sha256(), False
            else:
                if total["last_role"] is not None and own["first_role"] is not None:
                    total["illegal"] += total["last_role"] + own["first_role"] not in _LEGAL
                if total["last_turn"] is not None and own["first_turn"] == total["last_turn"]:
                    total["n_turns"] -= 1
                for c in ("blank", "duplicate", "truncated", "illegal", "cost", "n_turns"):
                    total[c] += own[c]
                total["last_role"] = own["last_role"] if own["last_role"] is not None else total["last_role"]
                if own["last_turn"] is not None:
                    total["first_turn"] = own["first_turn"] if total["first_turn"] is None else total["first_turn"]
                    total["last_turn"] = own["last_turn"]
            audit.append(own["audit"])
            for role, text in zip(own.pop("roles"), own.pop("texts"), strict=True):
                digest.update(("\n" if begun else "").encode() + f"{role}:{text}".encode())
                begun = True
        if current:
            yield row()

    return whole.unionByName(_mapped(split, _schema(repaired.schema["conv_id"], _SUMMARY), combine, lambda row: 300 + len(row[7])))
