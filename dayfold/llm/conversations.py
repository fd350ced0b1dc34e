"""Repair of conversations by generalised LR parsing over a grammar of roles."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayfold.llm.tables import Scratch, need

# White space, marks that end a sentence, and the costs of edits.
BLANK = " \t\n\x0b\x0c\r"
ENDS = ".!?"
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
NEVER = 1 << 60
# Most different stacks of a grammar; more are taken to have no end.
MOST_STACKS = 64


class Grammar:
    """The LR automaton of a grammar of role initials, with all stacks it can have.

    ``productions`` are pairs of a capital letter and what it stands for; small letters are role initials, and
    the first capital is the start. ``placed`` maps the initials that rerole and insert may set to role names.
    The grammar must have finitely many stacks (lists recur on the left), and a stack may go on
    with one placed role only, so that the letters of the edits tell the roles.
    """

    def __init__(self, productions: Sequence[tuple[str, str]], placed: Mapping[str, str]):
        start = productions[0][0]
        self.rules = [("", start), *productions]
        self.placed = dict(placed)
        self.states: list[frozenset] = [self._closed({(0, 0)})]
        self.stacks: list[tuple[int, ...]] = [(0,)]
        self.shifts: list[dict[str, int]] = []
        self.accepts: list[bool] = []
        symbols = sorted({c for _, right in productions for c in right if c.islower()})
        for stack in self.stacks:  # grows as stacks are found
            shift = {}
            for symbol in symbols:
                after = self._after(stack, symbol)
                if len(after) > 1:
                    raise ValueError(f"{symbol!r} leads from one stack to {len(after)}")
                for found in after:
                    if found not in self.stacks:
                        self.stacks.append(found)
                    shift[symbol] = self.stacks.index(found)
            if len(self.stacks) > MOST_STACKS:
                raise ValueError("the grammar's stacks have no end")
            if sum(role in shift for role in placed) > 1:
                raise ValueError("two placed roles go on from one stack")
            self.shifts.append(shift)
            self.accepts.append(self._accepted(stack))
        self.symbols = symbols
        # The placed role that goes on from each stack, and where to.
        self.places = [next(((r, s[r]) for r in placed if r in s), None) for s in self.shifts]

    def _closed(self, items: set) -> frozenset:
        todo = list(items)
        while todo:
            rule, dot = todo.pop()
            right = self.rules[rule][1]
            for n, (left, _) in enumerate(self.rules):
                if dot < len(right) and left == right[dot] and (n, 0) not in items:
                    items.add((n, 0))
                    todo.append((n, 0))
        return frozenset(items)

    def _goto(self, state: int, symbol: str) -> int | None:
        moved = {(r, d + 1) for r, d in self.states[state] if self.rules[r][1][d : d + 1] == symbol}
        if not moved:
            return None
        following = self._closed(moved)
        if following not in self.states:
            self.states.append(following)
        return self.states.index(following)

    def _reduced(self, stack: tuple[int, ...]) -> set[tuple[int, ...]]:
        """The stack and all it can be reduced to."""
        seen, todo = {stack}, [stack]
        while todo:
            own = todo.pop()
            for rule, dot in self.states[own[-1]]:
                left, right = self.rules[rule]
                if rule and dot == len(right):
                    below = own[: len(own) - len(right)]
                    found = (*below, self._goto(below[-1], left))
                    if found not in seen:
                        seen.add(found)
                        todo.append(found)
        return seen

    def _accepted(self, stack: tuple[int, ...]) -> bool:
        return any((0, 1) in self.states[s[-1]] for s in self._reduced(stack))

    def _after(self, stack: tuple[int, ...], symbol: str) -> list[tuple[int, ...]]:
        """The stacks after a shift and its reductions that can go on, or else those that end."""
        moved = [(*s, state) for s in self._reduced(stack) if (state := self._goto(s[-1], symbol)) is not None]
        reduced = {r for s in moved for r in self._reduced(s)}
        going = [s for s in reduced if any(self.rules[r][1][d : d + 1].islower() for r, d in self.states[s[-1]])]
        return sorted(going or [s for s in reduced if self._accepted(s)][:1])


# A system message may come first; then pairs of user and assistant.
ROLES = Grammar(
    [("S", ""), ("S", "sP"), ("S", "P"), ("P", "Pua"), ("P", "ua")], placed={"u": "user", "a": "assistant"}
)

# What a row is to the parser: its role initial, whether it breaks off, whether it must go.
Sign = tuple[str, bool, bool]


def repair(signs: Sequence[Sign], grammar: Grammar = ROLES) -> tuple[int, str]:
    """The least cost, and of its edits the least by their initials: K(eep), R(erole), D(elete), I(nsert).

    The tops of a graph-structured stack move over the rows; equal ones merge by the least (cost, edits).
    Two edit texts of one top and one cost are never one the start of the other, so the merge is exact.
    """
    tops = _inserted({0: (0, "")}, grammar)
    for symbol, broken, must_go in signs:
        after: dict[int, tuple[int, str]] = {}

        def reach(top: int, cost: int, edits: str) -> None:
            if top not in after or (cost, edits) < after[top]:
                after[top] = cost, edits

        more = TRUNCATED if broken else 0
        for top, (cost, edits) in tops.items():
            reach(top, cost + DELETE, edits + "D")
            if must_go:
                continue
            if symbol in grammar.shifts[top]:
                reach(grammar.shifts[top][symbol], cost + more, edits + "K")
            place = grammar.places[top]
            if place and place[0] != symbol:
                reach(place[1], cost + REROLE + more, edits + "R")
        tops = _inserted(after, grammar)
    return min(found for top, found in tops.items() if grammar.accepts[top])


def _inserted(tops: dict[int, tuple[int, str]], grammar: Grammar) -> dict[int, tuple[int, str]]:
    todo = list(tops)
    while todo:
        top = todo.pop()
        place = grammar.places[top]
        if place:
            cost, edits = tops[top]
            found = cost + INSERT, edits + "I"
            if place[1] not in tops or found < tops[place[1]]:
                tops[place[1]] = found
                todo.append(place[1])
    return tops


def edited(
    rows: Sequence[tuple[str, str]], edits: str, grammar: Grammar = ROLES, top: int = 0
) -> tuple[list[tuple[str, str]], int]:
    """The rows (role, text) after the edits, and the stack's top then."""
    out, own = [], iter(rows)
    for edit in edits:
        role, text = ("", "") if edit == "I" else next(own)
        if edit == "D":
            continue
        if edit == "K":
            top = grammar.shifts[top][role[:1]]
        else:
            initial, top = grammar.places[top]
            role = grammar.placed[initial]
        out.append((role, text))
    return out, top


class Costs:
    """Edits of cut conversations by costs alone: a table from each stack to each for every kind of row.

    Tables of a part's rows multiply to the part's own, in which least sums take the place of sums of products.
    """

    def __init__(self, grammar: Grammar = ROLES):
        self.grammar, self.size = grammar, len(grammar.stacks)
        self.insert = self._table()
        for top in range(self.size):
            cost, at = 0, top
            while grammar.places[at] and cost < INSERT * self.size:
                cost, at = cost + INSERT, grammar.places[at][1]
                self.insert[top, at] = min(self.insert[top, at], cost)
        self.kinds: dict[Sign, np.ndarray] = {}
        self.end = times(self.insert, np.where(grammar.accepts, 0, NEVER)[:, None])[:, 0]

    def _table(self) -> np.ndarray:
        return np.where(np.eye(self.size, dtype=bool), 0, NEVER)

    def step(self, sign: Sign) -> np.ndarray:
        """From each stack before a row to each behind it, without inserts."""
        symbol, broken, must_go = sign
        sign = symbol if symbol in self.grammar.symbols else "", broken, must_go
        if sign not in self.kinds:
            out = np.full((self.size, self.size), NEVER)
            more = TRUNCATED if broken else 0
            for top in range(self.size):
                out[top, top] = DELETE
                for to, cost in self._moves(top, symbol, must_go):
                    out[top, to] = min(out[top, to], cost + more)
            self.kinds[sign] = out
        return self.kinds[sign]

    def _moves(self, top: int, symbol: str, must_go: bool) -> Iterator[tuple[int, int]]:
        if not must_go:
            if symbol in self.grammar.shifts[top]:
                yield self.grammar.shifts[top][symbol], 0
            place = self.grammar.places[top]
            if place and place[0] != symbol:
                yield place[1], REROLE

    def part(self, signs: Sequence[Sign]) -> np.ndarray:
        """The table of a part, inserts before it, in it and behind it included."""
        if not signs:
            return self.insert
        stack = np.array([times(self.insert, self.step(s)) for s in dict.fromkeys(signs)])
        number = {s: n for n, s in enumerate(dict.fromkeys(signs))}
        stack = stack[[number[s] for s in signs]]
        while len(stack) > 1:
            odd = stack[len(stack) // 2 * 2 :]
            stack = np.concatenate([times(stack[0 : len(stack) - 1 : 2], stack[1::2]), odd])
        return times(stack[0], self.insert)

    def walk(self, signs: Sequence[Sign], rest: np.ndarray) -> list[tuple[int, str]]:
        """For each stack before a part, the stack behind it and the least edits, where ``rest`` is the cost from there on.

        Letters are taken one by one, always the least that still leads to the least cost. Inserts behind
        the part's last row are the next part's.
        """
        togo = [rest]
        for sign in reversed(signs):
            after = (self.step(sign) + togo[-1][None, :]).min(1)
            togo.append((self.insert + after[None, :]).min(1))
        togo.reverse()
        out = []
        for top in range(self.size):
            edits = []
            if togo[0][top] < NEVER:
                n = 0
                while n < len(signs):
                    edit, top, n = self._next(signs[n], top, n, togo)
                    edits.append(edit)
            out.append((top, "".join(edits)))
        return out

    def _next(self, sign: Sign, top: int, n: int, togo: list[np.ndarray]) -> tuple[str, int, int]:
        left, (symbol, broken, must_go) = togo[n][top], sign
        more = TRUNCATED if broken else 0
        if DELETE + togo[n + 1][top] == left:
            return "D", top, n + 1
        place = self.grammar.places[top]
        if place and INSERT + togo[n][place[1]] == left:
            return "I", place[1], n
        if not must_go and symbol in self.grammar.shifts[top]:
            to = self.grammar.shifts[top][symbol]
            if more + togo[n + 1][to] == left:
                return "K", to, n + 1
        return "R", place[1], n + 1

    def last_inserts(self, top: int) -> tuple[str, int]:
        """The inserts that end a conversation at the least cost."""
        edits = ""
        while self.end[top]:
            edits, top = edits + "I", self.grammar.places[top][1]
        return edits, top


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.minimum((a[..., :, :, None] + b[..., None, :, :]).min(-2), NEVER)


def faults(rows: Sequence[tuple], repeated: Callable[[int, str, str], bool]) -> list[str | None]:
    """Each row's first fault: blank, duplicate or truncated."""
    out: list[str | None] = []
    for n, (_, role, text) in enumerate(rows):
        end = text.rstrip(BLANK)
        again = repeated(n, role, text)
        out.append("blank" if not end else "duplicate" if again else None if end[-1] in ENDS else "truncated")
    return out


def signs_of(rows: Sequence[tuple], found: Sequence[str | None]) -> list[Sign]:
    return [(r[1][:1], f == "truncated", f in ("blank", "duplicate")) for r, f in zip(rows, found)]


@dataclass
class Tally:
    """Counts of a run of rows that can be added up in order."""

    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    turns: int = 0
    first_turn: int | None = None
    last_turn: int | None = None
    first_role: str | None = None
    last_role: str | None = None

    FIELDS = (
        "blank bigint, duplicate bigint, truncated bigint, illegal bigint, turns bigint, "
        "first_turn bigint, last_turn bigint, first_role string, last_role string"
    )

    @staticmethod
    def of(rows: Sequence[tuple], found: Sequence[str | None]) -> Tally:
        out = Tally()
        for (turn, role, _), fault in zip(rows, found):
            out = out.plus(
                Tally(
                    fault == "blank", fault == "duplicate", fault == "truncated", 0,
                    int(turn is not None), turn, turn, role[:1], role[:1],
                )
            )
        return out

    def plus(self, other: Tally) -> Tally:
        between = None not in (self.last_role, other.first_role) and self.last_role + other.first_role not in ("su", "ua", "au")
        same = self.last_turn is not None and self.last_turn == other.first_turn
        return Tally(
            self.blank + other.blank,
            self.duplicate + other.duplicate,
            self.truncated + other.truncated,
            self.illegal + other.illegal + between,
            self.turns + other.turns - same,
            other.first_turn if self.first_turn is None else self.first_turn,
            self.last_turn if other.last_turn is None else other.last_turn,
            other.first_role if self.first_role is None else self.first_role,
            self.last_role if other.last_role is None else other.last_role,
        )

    @property
    def gaps(self) -> int:
        return 0 if self.first_turn is None else self.last_turn - self.first_turn + 1 - self.turns

    def counts(self) -> dict[str, int]:
        names = ("gaps", "blank", "duplicate", "truncated", "illegal")
        return {name: int(getattr(self, name)) for name in names}


COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
PIECE = (
    "whole boolean, part int, seq bigint, "
    + ", ".join(f"{c} bigint" for c in COUNTS)
    + ", audit string, roles array<string>, texts array<string>"
)


def repair_conversations(
    rows: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    present_col: str | None = None,
    grammar: Grammar = ROLES,
    most_rows: int = 4096,
    most_chars: int = 8_000_000,
) -> DataFrame:
    """Repaired conversations in pieces: their id, ``whole``, ``part`` and ``seq`` (order of pieces), the counts of
    faults, ``cost``, ``audit`` (edits) and the repaired ``roles`` and ``texts``.

    A conversation's rows stand in order of turn, NULL first; rows of one turn by the first 32 characters of the role, the
    first 64 of the text, and then by a hash. Of each row the first fault counts: blank, duplicate (role and text
    stood before) or truncated. The cheapest edits, by a generalised LR parser (:func:`repair`), make the roles a
    sentence of ``grammar``; blank and duplicate rows are deleted, ties go to the least audit.

    Rows are sorted by range over all tasks, a large conversation over many of them. Conversations that lie
    within a task and have at most ``most_rows`` rows and ``most_chars`` characters are repaired there at once, as
    one ``whole`` piece with all counts. Others are cut into pieces of that size; small cost tables of the pieces give
    what the rest of the conversation costs from each stack, with which each piece finds its edits for itself. Their
    counts are those of the conversation, on its first piece only (NULL on others). No task holds more rows of a
    conversation than a piece, but one small table per piece.

    NULL roles and texts count as one space; a NULL id is a conversation of its own. Where ``present_col`` is named, rows in
    which it is not true only tell that their conversation is there: one without other rows has counts 0 and an empty audit.
    Roles that the grammar does not know, empty ones included, must be changed or deleted. Other columns are
    left out. An empty table gives no rows.
    """
    need(rows, [conv_col, turn_col, role_col, text_col, *([present_col] if present_col else [])])
    scratch = Scratch(rows.sparkSession, "conversations")
    conv_type = rows.schema[conv_col].dataType
    known = rows.select(
        F.col(conv_col).alias("conv"),
        F.col(turn_col).cast("bigint").alias("turn"),
        F.coalesce(F.col(role_col), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text_col), F.lit(" ")).alias("text"),
        (F.coalesce(F.col(present_col), F.lit(False)) if present_col else F.lit(True)).alias("present"),
        # Splits a pile of equal rows over tasks.
        F.monotonically_increasing_id().alias("row"),
    )
    order = [
        F.asc_nulls_first("conv"),
        F.asc_nulls_first("turn"),
        F.substring("role", 1, 32),
        F.substring("text", 1, 64),
        F.xxhash64("role", "text"),
    ]
    dealt = known.repartitionByRange(*order, "row").sortWithinPartitions(*order, "role", "text").drop("row")
    schema = T.StructType(
        [T.StructField("conv", conv_type), *T._parse_datatype_string(f"{PIECE}, turns array<bigint>").fields]
    )
    conv_arrow = _arrow(schema["conv"].dataType)
    first = scratch.write(dealt.mapInArrow(_in_tasks(grammar, conv_arrow, most_rows, most_chars), schema))
    done = first.where("whole").drop("turns")
    cut = first.where("NOT whole").select("conv", "part", "seq", "turns", "roles", "texts")
    return done.unionByName(_cut_pieces(cut, grammar, scratch, schema)).withColumnRenamed("conv", conv_col)


def _arrow(dtype: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(dtype)


def _in_tasks(grammar: Grammar, conv_type: pa.DataType, most_rows: int, most_chars: int):
    """Sorted rows to whole conversations, repaired, and pieces of those that are cut."""

    def finished(rows: list[tuple]) -> dict:
        seen: set[tuple[str, str]] = set()

        def repeated(_: int, role: str, text: str) -> bool:
            before = (role, text) in seen
            seen.add((role, text))
            return before

        found = faults(rows, repeated)
        cost, audit = repair(signs_of(rows, found), grammar)
        out, _ = edited([r[1:] for r in rows], audit, grammar)
        return Tally.of(rows, found).counts() | {
            "whole": True, "cost": cost, "audit": audit, "roles": [r for r, _ in out], "texts": [t for _, t in out],
        }

    def piece(rows: list[tuple]) -> dict:
        return {"whole": False, "turns": [r[0] for r in rows], "roles": [r[1] for r in rows], "texts": [r[2] for r in rows]}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        rows: list[tuple] = []
        own, seq, chars, is_open, started = None, 0, 0, True, False
        out: list[dict] = []
        waiting = 0

        def close(last: bool) -> None:
            nonlocal rows, seq, chars, waiting
            made = piece(rows) if is_open or last else finished(rows)
            out.append(made | {"conv": own, "part": part, "seq": seq})
            seq, waiting = seq + 1, waiting + chars + len(rows)
            rows, chars = [], 0

        for batch in batches:
            for conv, turn, role, text, present in zip(*(c.to_pylist() for c in batch.columns)):
                if started and conv != own:
                    close(False)
                    is_open = False
                elif started and (len(rows) == most_rows or chars > most_chars):
                    is_open = True
                    close(False)
                own, started = conv, True
                if present:
                    rows.append((turn, role, text))
                    chars += len(text) + len(role)
                if waiting > 1_000_000:
                    yield _batch(out, conv_type)
                    out, waiting = [], 0
        if started:
            close(True)
        if out:
            yield _batch(out, conv_type)

    return run


def _batch(rows: list[dict], conv_type: pa.DataType) -> pa.RecordBatch:
    kinds = {"conv": conv_type, "whole": pa.bool_(), "part": pa.int32(), "seq": pa.int64()}
    kinds |= {c: pa.int64() for c in COUNTS} | {"audit": pa.string()}
    kinds |= {"roles": pa.list_(pa.string()), "texts": pa.list_(pa.string()), "turns": pa.list_(pa.int64())}
    return pa.RecordBatch.from_arrays(
        [pa.array([r.get(name) for r in rows], kind) for name, kind in kinds.items()], names=list(kinds)
    )


def _cut_pieces(cut: DataFrame, grammar: Grammar, scratch: Scratch, schema: T.StructType) -> DataFrame:
    """Repair conversations that lie in several pieces."""
    where = ["part", "seq"]
    stood = (
        cut.select("conv", *where, F.posexplode(F.arrays_zip("roles", "texts")).alias("n", "row"))
        .select("conv", *where, "n", F.col("row.roles").alias("role"), F.sha2(F.col("row.texts").cast("binary"), 256).alias("text"))
        .groupBy("conv", "role", "text", *where)
        .agg(F.min("n").alias("n"))
    )
    # At most one row per piece that holds the text.
    nth = F.row_number().over(Window.partitionBy("conv", "role", "text").orderBy(*where))
    firsts = stood.withColumn("nth", nth).where("nth = 1").groupBy(*where).agg(F.collect_list("n").alias("firsts"))
    tables = "signs array<struct<role:string,broken:boolean,must_go:boolean>>, steps array<bigint>"
    of_part = T.StructType(
        [schema["conv"], *T._parse_datatype_string(f"part int, seq bigint, {Tally.FIELDS}, {tables}").fields]
    )
    conv_type = _arrow(schema["conv"].dataType)
    sign_type = pa.list_(pa.struct([("role", pa.string()), ("broken", pa.bool_()), ("must_go", pa.bool_())]))
    tally_names = [f.split()[0] for f in Tally.FIELDS.split(", ")]
    part_kinds = [conv_type, pa.int32(), pa.int64(), *[pa.int64()] * 7, pa.string(), pa.string(), sign_type, pa.list_(pa.int64())]

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        costs = Costs(grammar)
        for batch in batches:
            for one in range(batch.num_rows):
                row = {name: batch.column(name)[one].as_py() for name in batch.schema.names}
                rows = list(zip(row["turns"], row["roles"], row["texts"]))
                fresh = set(row["firsts"] or ())
                found = faults(rows, lambda n, *_: n not in fresh)
                signs, tally = signs_of(rows, found), Tally.of(rows, found)
                values = [row["conv"], row["part"], row["seq"]]
                values += [v if v is None or isinstance(v, str) else int(v) for v in (getattr(tally, f) for f in tally_names)]
                values += [[dict(zip(("role", "broken", "must_go"), s)) for s in signs], costs.part(signs).ravel().tolist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v], kind) for v, kind in zip(values, part_kinds)], names=of_part.names
                )

    looked = scratch.write(cut.join(firsts, where, "left").mapInArrow(look, of_part))

    def in_order(table: pa.Table) -> list[dict]:
        return sorted(table.to_pylist(), key=lambda r: (r["part"], r["seq"]))

    def rests(table: pa.Table) -> pa.Table:
        costs, out = Costs(grammar), []
        rest = costs.end
        for n, row in enumerate(reversed(rows := in_order(table))):
            out.append({"part": row["part"], "seq": row["seq"], "rest": rest.tolist(), "last": n == 0})
            steps = np.array(row["steps"]).reshape(costs.size, costs.size)
            rest = times(steps, rest[:, None])[:, 0]
        tally = Tally()
        for row in rows:
            tally = tally.plus(Tally(*(row[f] for f in tally_names)))
        counts = tally.counts() | {"cost": int(rest[0])}
        for row in out:
            is_first = (row["part"], row["seq"]) == (rows[0]["part"], rows[0]["seq"])
            row |= counts if is_first else dict.fromkeys(counts)
        kinds = pa.schema(
            [("part", pa.int32()), ("seq", pa.int64()), ("rest", pa.list_(pa.int64())), ("last", pa.bool_())]
            + [(c, pa.int64()) for c in COUNTS]
        )
        return pa.Table.from_pylist(out, kinds)

    rest_schema = "part int, seq bigint, rest array<bigint>, last boolean, " + ", ".join(f"{c} bigint" for c in COUNTS)
    rested = scratch.write(
        looked.select("conv", *where, *tally_names, "steps").groupBy("conv").applyInArrow(rests, rest_schema)
    )

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        costs = Costs(grammar)
        for batch in batches:
            for one in range(batch.num_rows):
                conv, part, seq, signs, rest, last = (c[one] for c in batch.columns)
                listed = [(s["role"], s["broken"], s["must_go"]) for s in signs.as_py()]
                ways = costs.walk(listed, np.array(rest.as_py()))
                if last.as_py():
                    ways = [(end, edits + more) for top, edits in ways for more, end in [costs.last_inserts(top)]]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([conv.as_py()], conv_type),
                        pa.array([part.as_py()], pa.int32()),
                        pa.array([seq.as_py()], pa.int64()),
                        pa.array([[top for top, _ in ways]], pa.list_(pa.int32())),
                        pa.array([[edits for _, edits in ways]], pa.list_(pa.string())),
                    ],
                    names=["conv", "part", "seq", "tops", "edits"],
                )

    walk_schema = T.StructType(
        [schema["conv"], *T._parse_datatype_string("part int, seq bigint, tops array<int>, edits array<string>").fields]
    )
    walked = scratch.write(
        looked.select("conv", *where, "signs")
        .join(rested.select(*where, "rest", "last"), where)
        .select("conv", *where, "signs", "rest", "last")
        .mapInArrow(walk, walk_schema)
    )

    def entries(table: pa.Table) -> pa.Table:
        out, top = [], 0
        for row in in_order(table):
            out.append({"part": row["part"], "seq": row["seq"], "top": top})
            top = row["tops"][top]
        return pa.Table.from_pylist(out, pa.schema([("part", pa.int32()), ("seq", pa.int64()), ("top", pa.int32())]))

    entered = scratch.write(
        walked.select("conv", *where, "tops").groupBy("conv").applyInArrow(entries, "part int, seq bigint, top int")
    )
    chosen = walked.join(entered, where).select(*where, "top", F.get("edits", F.col("top")).alias("audit"))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for one in range(batch.num_rows):
                row = {name: batch.column(name)[one].as_py() for name in batch.schema.names}
                out, _ = edited(list(zip(row["roles"], row["texts"])), row["audit"], grammar, row["top"])
                made.append(row | {"whole": False, "roles": [r for r, _ in out], "texts": [t for _, t in out]})
            if made:
                full = _batch(made, conv_type)
                yield full.select([n for n in full.schema.names if n != "turns"])

    pieces = cut.drop("turns").join(chosen, where).join(rested.drop("rest", "last"), where)
    out_schema = T.StructType([f for f in schema.fields if f.name != "turns"])
    return scratch.write(pieces.mapInArrow(apply, out_schema))


def conversation_digests(pieces: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """Per conversation its id, counts, ``audit`` and ``repaired_sha256``: of its ``role:text``, joined by newlines.

    Whole pieces are digested where they are. The pieces of a cut conversation pass in order through one
    task, which keeps the digest's state alone: SHA-256 is sequential. Its audit is one value of a letter per row.
    """
    line = F.zip_with("roles", "texts", lambda r, t: F.concat(r, F.lit(":"), t))
    digest = F.sha2(F.array_join(line, "\n").cast("binary"), 256).alias("repaired_sha256")
    whole = pieces.where("whole").select(conv_col, *COUNTS, "audit", digest)
    conv = pieces.schema[conv_col]
    schema = T.StructType(
        [conv, *T._parse_datatype_string(", ".join(f"{c} bigint" for c in COUNTS) + ", audit string, repaired_sha256 string").fields]
    )
    conv_type = _arrow(conv.dataType)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, counts, state, audits, some = None, None, None, [], False

        def done() -> pa.RecordBatch:
            values = [own, *counts, "".join(audits), state.hexdigest()]
            kinds = [conv_type, *[pa.int64()] * len(COUNTS), pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names=schema.names)

        for batch in batches:
            for one in range(batch.num_rows):
                found, *rest = (c[one].as_py() for c in batch.columns)
                told, (audit, roles, texts) = rest[: len(COUNTS)], rest[len(COUNTS) :]
                if state is None or found != own:
                    if state is not None:
                        yield done()
                    own, counts, state, audits, some = found, told, hashlib.sha256(), [], False
                audits.append(audit)
                if roles:
                    state.update((b"\n" if some else b"") + "\n".join(map(":".join, zip(roles, texts))).encode())
                    some = True
        if state is not None:
            yield done()

    cut = pieces.where("NOT whole").repartition(conv_col).sortWithinPartitions(F.asc_nulls_first(conv_col), "part", "seq")
    joined = cut.select(conv_col, *COUNTS, "audit", "roles", "texts").mapInArrow(join, schema)
    return whole.unionByName(joined)
