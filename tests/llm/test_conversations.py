import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from dayfold.llm.conversations import (
    ROLES,
    Costs,
    Grammar,
    conversation_digests,
    edited,
    repair,
    repair_conversations,
    times,
)
from dayfold.llm.q_conversations import damaged


LEGAL = re.compile("(s?(ua)+)?")
WHITE = " \t\n\x0b\x0c\r"


def search(rows):
    """(cost, audit, repaired rows) by trying every edit, with at most two inserts in one place.

    ``rows`` are (role, text, broken, must_go).
    """
    best = None

    def options(row):
        role, text, broken, must_go = row
        yield 2, "D", []
        if not must_go:
            more = 5 if broken else 0
            yield more, "K", [(role, text)]
            for other in ("user", "assistant"):
                yield 1 + more, "R", [(other, text)]

    inserts = [(5 * n, "I" * n, list(r)) for n in range(3) for r in itertools.product([("user", ""), ("assistant", "")], repeat=n)]
    parts = [inserts]
    for row in rows:
        parts += [list(options(row)), inserts]
    for choice in itertools.product(*parts):
        out = [x for _, _, placed in choice for x in placed]
        if LEGAL.fullmatch("".join(r[:1] or "?" for r, _ in out)):
            found = sum(c for c, _, _ in choice), "".join(a for _, a, _ in choice), out
            if best is None or found[:2] < best[:2]:
                best = found
    return best


def table_repair(rows):
    """(cost, audit, repaired rows) by the least (cost, audit) for each place in the grammar, as plain dynamic programming."""
    ways = {"": (0, "", [])}
    states = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    def insert(ways):
        for _ in range(6):
            for at, (cost, audit, out) in list(ways.items()):
                for role in ("user", "assistant"):
                    to = states.get((at, role[0]))
                    if to and (to not in ways or (cost + 5, audit + "I") < ways[to][:2]):
                        ways[to] = cost + 5, audit + "I", [*out, (role, "")]
        return ways

    ways = insert(ways)
    for role, text, broken, must_go in rows:
        after = {}
        for at, (cost, audit, out) in ways.items():
            moves = [(at, cost + 2, audit + "D", out)]
            if not must_go:
                more = 5 if broken else 0
                for name, letter, price in ((role, "K", 0), ("user", "R", 1), ("assistant", "R", 1)):
                    to = states.get((at, name[:1]))
                    if to:
                        moves.append((to, cost + price + more, audit + letter, [*out, (name, text)]))
            for to, *found in moves:
                if to not in after or tuple(found[:2]) < after[to][:2]:
                    after[to] = tuple(found)
        ways = insert(after)
    return min((ways[s] for s in ("", "a") if s in ways), key=lambda w: w[:2])


def brute(rows, damage):
    """The figures of every conversation from plain lists."""
    convs = {}
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20 if damage else 9
        role, text = " " if role is None else role, " " if text is None else text
        own = convs.setdefault(conv, [])
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        own += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = []
    for conv, own in convs.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        counts, seen, listed = {"blank": 0, "duplicate": 0, "truncated": 0}, set(), []
        for _, role, text in own:
            end = text.rstrip(WHITE)
            fault = "blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            listed.append((role, text, fault == "truncated", fault in ("blank", "duplicate")))
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        pairs = zip(own, own[1:])
        illegal = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in pairs)
        cost, audit, kept = table_repair(listed)
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()
        out.append((conv, gaps, *counts.values(), illegal, cost, audit, digest))
    return sorted(out, key=str)


NAMES = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def got(df):
    return sorted([tuple(r) for r in df.select(NAMES).collect()], key=str)


def talks(seed=1):
    make = random.Random(seed)
    texts = ["Hi.", "Yes?", "No", "", " \n", "Go on!", "So it is. ", None, "é ß.", "x" * 70 + ".", "x" * 70 + "!"]
    roles = ["user", "assistant"] * 4 + ["system", "tool", "", None, "superuser"]
    rows = []
    for conv in [*range(40), None, 900]:
        for turn in range(make.randint(1, 9) if conv != 900 else 300):
            at = make.choice([turn, turn, turn, turn + 3, None])
            rows.append((conv, at, make.choice(roles), make.choice(texts)))
    # Long conversations, piles of equal rows, and one cut among rows of a turn.
    rows += [(901, n // 3, ("user", "assistant")[n % 2], f"Text {n}.") for n in range(500)]
    rows += [(902, 5, "user", "Same.")] * 200 + [(902, 6, "assistant", "Same.")] * 50 + [(902, None, "system", "Be kind.")]
    rows += [(903, n, "user", "Again.") for n in range(120)]
    return rows


SCHEMA = "conv_id bigint, turn bigint, role string, text string, part string, seq string, cost string, n string"


@pytest.fixture(scope="module")
def table(spark):
    rows = talks()
    df = spark.createDataFrame([(*r, *("x",) * 4) for r in rows], SCHEMA)
    return df.repartition(3), rows


def test_parser_against_every_edit():
    make = random.Random(2)
    for _ in range(120):
        rows = [
            (make.choice(["user", "assistant", "system", "tool", ""]), str(n), make.random() < 0.2, make.random() < 0.2)
            for n in range(make.randint(0, 4 if _ < 8 else 3))
        ]
        signs = [(r[:1], b, m) for r, _, b, m in rows]
        cost, audit = repair(signs)
        expected = search(rows)
        assert (cost, audit) == expected[:2]
        assert edited([r[:2] for r in rows], audit)[0] == expected[2]
        assert table_repair(rows) == expected


@pytest.mark.parametrize("cut", [1, 2, 7])
def test_costs_of_parts_against_the_parser(cut):
    """A sequence cut into parts gets the same edits as the whole one."""
    make = random.Random(cut)
    costs = Costs()
    for _ in range(60):
        signs = [(make.choice("usatx"), make.random() < 0.2, make.random() < 0.15) for _ in range(make.randint(0, 30))]
        parts = [signs[n : n + cut] for n in range(0, len(signs), cut)] or [[]]
        rests = [costs.end]
        for part in reversed(parts):
            rests.append(times(costs.part(part), rests[-1][:, None])[:, 0])
        rests.reverse()
        top, audit = 0, ""
        for part, rest in zip(parts, rests[1:]):
            top, edits = costs.walk(part, rest)[top]
            audit += edits
        audit += costs.last_inserts(top)[0]
        assert (int(rests[0][0]), audit) == repair(signs)


def test_whole_and_cut_conversations(table):
    df, rows = table
    expected = brute(rows, False)
    assert got(conversation_digests(repair_conversations(df))) == expected
    pieces = repair_conversations(df, most_rows=16)
    assert pieces.where("conv_id = 902 AND NOT whole").count() >= 15
    assert got(conversation_digests(pieces)) == expected
    assert got(conversation_digests(repair_conversations(df.repartition(1), most_rows=3, most_chars=50))) == expected


def test_damage_and_rows_not_present(table):
    df, rows = table
    assert got(conversation_digests(repair_conversations(damaged(df), present_col="present"))) == brute(rows, True)
    gone = df.where("conv_id < 3").withColumn("there", F.lit(None).cast("boolean"))
    empty = hashlib.sha256(b"").hexdigest()
    assert got(conversation_digests(repair_conversations(gone, present_col="there"))) == [
        (n, 0, 0, 0, 0, 0, 0, "", empty) for n in range(3)
    ]


def test_given_conversations(spark, folder):
    df = spark.read.parquet(f"{folder}/conversations.parquet")
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    assert got(conversation_digests(repair_conversations(damaged(df), present_col="present"))) == brute(rows, True)


def test_empty_table_and_other_names(table):
    df, rows = table
    assert repair_conversations(df.where("false")).collect() == []
    assert conversation_digests(repair_conversations(df.where("false"))).collect() == []
    other = df.select(F.col("conv_id").cast("string").alias("a"), F.col("turn").alias("b"), F.col("role").alias("c"), F.col("text").alias("d"))
    pieces = repair_conversations(other, "a", "b", "c", "d", most_rows=50)
    found = conversation_digests(pieces, "a").withColumnRenamed("a", "conv_id").withColumn("conv_id", F.col("conv_id").cast("bigint"))
    assert got(found) == brute(rows, False)


def test_grammars():
    assert len(ROLES.stacks) == 8 and ROLES.accepts[0]
    only_pairs = Grammar([("S", ""), ("S", "Sua")], placed={"u": "user", "a": "assistant"})
    assert repair([("s", False, False), ("u", False, False), ("a", False, False)], only_pairs) == (2, "DKK")
    with pytest.raises(ValueError, match="no end"):
        Grammar([("S", "uSa"), ("S", "ua")], placed={"u": "user"})
    with pytest.raises(ValueError, match="two placed roles"):
        Grammar([("S", "u"), ("S", "a")], placed={"u": "user", "a": "assistant"})
