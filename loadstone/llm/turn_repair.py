"""Repair of damaged conversations at the least cost, with an audit of the edits.

A conversation is a path through four states (nothing yet, after the system turn, after a
user turn, after an assistant turn), a layer for each row; the edits that meet a row are
the arcs. The weight of a path is one whole number: its high digits are the cost, and
below them every row has a slot of three octal digits for the letters of its edits, up to
two inserts and then the edit of the row, with zeros behind. Both parts add up along a
path, and the smallest sum at each node is kept: integer minima alone decide the cost and,
among the cheapest paths, the audit that is least by ASCII. Slots do not disturb that
order: no row's letters begin with another choice's letters, since they end at the first
letter that is not an insert; only the letters behind the last row may, and there a zero
makes the shorter audit the smaller one.

Rows are dealt out by a range of (conv_id, turn, role, digest of the text), once, and cut
into blocks of at most ``BLOCK`` rows. A conversation inside one block is solved at once.
One that has more rows, or lies across the cut of two ranges, is solved by the same
numbers in two directions: each block has the smallest weight from each state to each
state; up to 512 neighbours are joined into one weight in which a block's letters are
replaced by their rank among the block's sixteen, level by level, until one row is left; then
the states of its best path are handed down again. So no task holds a long conversation.

Nulls in conv_id are an id of their own; other nulls are one blank. Rows of one turn go by
role and digest of the text. Repeated rows are rows, and duplicates from the second on.
Texts of any length stay in their rows. Empty table: no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from hashlib import sha256

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadstone.llm.tables import bounded_batches, column, written

BLANKS = " \t\n\x0b\x0c\r"
ENDS = ".!?"

# A block closes at so many rows or characters.
BLOCK, BLOCK_CHARS = 256, 2_000_000
# Bits of a block's number, from the right, that a level of joining takes together; the
# number within a range has 33 bits, that of the range the others.
LEVELS = (8, 16, 24, 33, 41, 49, 57, 63)

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
LETTERS = "\0DIKR"
STATES = range(4)
START, SYSTEM, USER, ASSISTANT = STATES
SLOT = 9

# What a row is to the grammar: "-" must go; else the initial of its role (x: any other),
# as a capital letter if the text is truncated.
SYMBOLS = "-suaxSUAX"

ROW = T.StructType().add("role", "string").add("text", "string")
# Counts of a block that add up, but for what the seam of two blocks changes, and its ends.
COUNTS = ("n", "blank", "duplicate", "truncated", "illegal", "distinct_turns")
ENDS_OF = ("first_turn", "last_turn", "first_role", "last_role")
FACTS = [T.StructField(c, T.LongType()) for c in (*COUNTS, *ENDS_OF[:2])] + [
    T.StructField(c, T.StringType()) for c in ENDS_OF[2:]
]
WEIGHTS = [T.StructField("costs", T.ArrayType(T.LongType())), T.StructField("ranks", T.ArrayType(T.IntegerType()))]
REPORT = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
LEGAL = {"su", "ua", "au"}


def _after_insert(state: int) -> int:
    return ASSISTANT if state == USER else USER


def _slot(letters: str) -> int:
    value = 0
    for c in letters.ljust(3, "\0"):
        value = value << 3 | LETTERS.index(c)
    return value


def _edits(state: int, symbol: str) -> Iterator[tuple[int, int, str]]:
    """(next state, cost, letter) of each edit of a row."""
    yield state, DELETE, "D"
    if symbol == "-":
        return
    extra = TRUNCATED if symbol.isupper() else 0
    kept = {("s", START): SYSTEM, ("a", USER): ASSISTANT}
    kept |= {("u", s): USER for s in (START, SYSTEM, ASSISTANT)}
    to = kept.get((symbol.lower(), state))
    if to is not None:
        yield to, KEEP + extra, "K"
    yield _after_insert(state), REROLE + extra, "R"


def _arcs(symbol: str) -> list[tuple[int, int, int, int]]:
    """(state, next state, cost, slot): the best letters of a row between two states.

    A third insert would come back to a state that was left at a cost.
    """
    best: dict[tuple[int, int], tuple[int, int]] = {}
    for state in STATES:
        at, inserts = state, ""
        for _ in range(3):
            for to, cost, letter in _edits(at, symbol):
                found = (INSERT * len(inserts) + cost, _slot(inserts + letter))
                best[state, to] = min(best.get((state, to), found), found)
            at, inserts = _after_insert(at), inserts + "I"
    return [(s, t, cost, slot) for (s, t), (cost, slot) in best.items()]


ARCS = {symbol: _arcs(symbol) for symbol in SYMBOLS}
# Behind the last row: what completes a conversation that ends in a state.
CLOSING = {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}


def letters_of(digits: int, slots: int) -> str:
    """The audit that the low digits of a weight hold."""
    found = (digits >> 3 * i & 7 for i in range(3 * slots - 1, -1, -1))
    return "".join(LETTERS[d] for d in found if d)


def least_weights(symbols: str, state: int) -> list[int | None]:
    """The smallest weight of a path from ``state`` to each state, by the rows' symbols."""
    low = SLOT * len(symbols)
    now: list[int | None] = [None] * 4
    now[state] = 0
    for i, symbol in enumerate(symbols):
        shift = low - SLOT * (i + 1)
        after: list[int | None] = [None] * 4
        for s, t, cost, slot in ARCS[symbol]:
            if now[s] is not None:
                weight = now[s] + (cost << low) + (slot << shift)
                if after[t] is None or weight < after[t]:
                    after[t] = weight
        now = after
    return now


def closed(weights: list[int | None], slots: int) -> tuple[int, int]:
    """The smallest weight of a whole conversation, with one slot more, and its last state."""
    low = SLOT * (slots + 1)
    found = []
    for state, weight in enumerate(weights):
        if weight is not None:
            letters = CLOSING[state]
            found.append(((weight << SLOT) + (INSERT * len(letters) << low) + _slot(letters), state))
    return min(found)


@lru_cache(100_000)
def solve(symbols: str) -> tuple[int, str]:
    """(cost, audit) of a whole conversation."""
    weight, _ = closed(least_weights(symbols, START), len(symbols))
    slots = len(symbols) + 1
    return weight >> SLOT * slots, letters_of(weight & (1 << SLOT * slots) - 1, slots)


def replay(letters: str, state: int, symbols: str, rows: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """The rows after the edits, from a state on. The letters leave no choice of roles."""
    out, i = [], 0
    for letter in letters:
        if letter == "D":
            i += 1
            continue
        if letter == "K":
            out.append(rows[i])
            state = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[symbols[i].lower()]
        else:
            state = _after_insert(state)
            out.append(("user" if state == USER else "assistant", rows[i][1] if letter == "R" else ""))
        i += letter != "I"
    return out


def examine(turns: list, rows: list[tuple[str, str]], later: set[int] = frozenset()) -> tuple[str, dict]:
    """The symbols of consecutive rows and their counts; ``later`` are rows whose like
    stands in an earlier block."""
    symbols, seen, last = [], set(), None
    facts = dict.fromkeys(COUNTS, 0) | {"n": len(rows)}
    for i, row in enumerate(rows):
        first, bare = row[0][:1], row[1].rstrip(BLANKS)
        initial = first if first and first in "sua" else "x"
        symbol = initial
        if not bare:
            fault, symbol = "blank", "-"
        elif i in later or row in seen:
            fault, symbol = "duplicate", "-"
        elif bare[-1] not in ENDS:
            fault, symbol = "truncated", initial.upper()
        else:
            fault = None
        if fault:
            facts[fault] += 1
        seen.add(row)
        facts["illegal"] += last is not None and last + initial not in LEGAL
        symbols.append(symbol)
        last = initial
    numbered = [t for t in turns if t is not None]
    facts["distinct_turns"] = len(set(numbered))
    facts["first_turn"], facts["last_turn"] = (numbered[0], numbered[-1]) if numbered else (None, None)
    ends = [r[0][:1] if r[0][:1] and r[0][:1] in "sua" else "x" for r in (rows[:1] + rows[-1:])]
    facts["first_role"], facts["last_role"] = ends or (None, None)
    return "".join(symbols), facts


def gaps(facts: dict) -> int:
    if facts["first_turn"] is None:
        return 0
    return min(facts["last_turn"] - facts["first_turn"] + 1 - facts["distinct_turns"], 2**63 - 1)


def joined_facts(children: list[dict]) -> dict:
    """The counts of neighbouring blocks together."""
    facts = {c: sum(x[c] for x in children) for c in COUNTS}
    for first, last in (("first_turn", "last_turn"), ("first_role", "last_role")):
        there = [x for x in children if x[first] is not None]
        facts[first], facts[last] = (there[0][first], there[-1][last]) if there else (None, None)
        for a, b in zip(there, there[1:]):
            if first == "first_turn":
                facts["distinct_turns"] -= a[last] == b[first]
            else:
                facts["illegal"] += a[last] + b[first] not in LEGAL
    return facts


def _ranked(digits: list[int | None]) -> list[int]:
    order = {d: i for i, d in enumerate(sorted({d for d in digits if d is not None}))}
    return [order.get(d, 0) for d in digits]


def block_weights(symbols: str) -> tuple[list[int | None], list[int], list[str]]:
    """(costs, ranks, audits) of a block by first and last state, 16 of each."""
    n = len(symbols)
    weights = [w for s in STATES for w in least_weights(symbols, s)]
    low = SLOT * n
    costs = [None if w is None else w >> low for w in weights]
    digits = [None if w is None else w & (1 << low) - 1 for w in weights]
    return costs, _ranked(digits), ["" if d is None else letters_of(d, n) for d in digits]


def joined_weights(costs: list[list], ranks: list[list]) -> tuple[list, list[int], list[bytes]]:
    """(costs, ranks, paths) of neighbours together: a path is the state before each child
    and the one behind the last. A child's letters count by their rank."""
    k = len(costs)
    low = 4 * k
    all_costs, all_digits, paths = [], [], []
    for start in STATES:
        now: list[tuple[int, bytes] | None] = [None] * 4
        now[start] = (0, bytes([start]))
        for j, (cost, rank) in enumerate(zip(costs, ranks)):
            shift = 4 * (k - 1 - j)
            after: list[tuple[int, bytes] | None] = [None] * 4
            for s in STATES:
                for t in STATES if now[s] is not None else ():
                    c = cost[4 * s + t]
                    if c is not None:
                        weight = now[s][0] + (c << low) + (rank[4 * s + t] << shift)
                        if after[t] is None or weight < after[t][0]:
                            after[t] = (weight, now[s][1] + bytes([t]))
            now = after
        all_costs += [None if x is None else x[0] >> low for x in now]
        all_digits += [None if x is None else x[0] & (1 << low) - 1 for x in now]
        paths += [b"" if x is None else x[1] for x in now]
    return all_costs, _ranked(all_digits), paths


def best_end(costs: list, ranks: list[int]) -> tuple[int, int]:
    """(cost, last state) of the conversation that one joined weight stands for."""
    found = []
    for state in STATES:
        if costs[state] is not None:
            letters = CLOSING[state]
            cost = costs[state] + INSERT * len(letters)
            found.append(((cost << SLOT + 4) + (ranks[state] << SLOT) + _slot(letters), cost, state))
    _, cost, state = min(found)
    return cost, state


# The rows in blocks


def _blocks(turns: DataFrame) -> DataFrame:
    """(conv_id, key, whole, turns, rows): consecutive rows of a conversation, numbered in
    order over all tasks; ``whole`` if the block is known to hold all of them."""
    ordered = turns.withColumn("digest", F.md5("text")).withColumn("nth", F.monotonically_increasing_id())
    keys = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "digest", "nth")]
    ordered = ordered.repartitionByRange(*keys).sortWithinPartitions(*keys)
    given = ordered.select("conv_id", "turn", "role", "text", "live")
    kind = given.schema["conv_id"].dataType
    schema = T.StructType(
        [
            T.StructField("conv_id", kind),
            T.StructField("key", T.LongType()),
            T.StructField("whole", T.BooleanType()),
            T.StructField("turns", T.ArrayType(given.schema["turn"].dataType)),
            T.StructField("rows", T.ArrayType(ROW)),
        ]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        arrow = None
        done: list[tuple] = []
        conv, numbers, rows, chars = None, [], [], 0
        started = first = False
        parts = 0  # blocks of this conversation so far
        for batch in batches:
            arrow = arrow or batch.column(0).type
            for at, turn, role, text, live in zip(*[c.to_pylist() for c in batch.columns]):
                if not started or at != conv:
                    if started:
                        done.append((conv, number, parts == 0 and not first, numbers, rows))
                        number += 1
                    first, started = not started, True
                    conv, numbers, rows, chars, parts = at, [], [], 0, 0
                if live:
                    if len(rows) >= BLOCK or chars >= BLOCK_CHARS:
                        done.append((conv, number, False, numbers, rows))
                        number += 1
                        numbers, rows, chars, parts = [], [], 0, parts + 1
                    numbers.append(turn)
                    rows.append((role, text))
                    chars += len(text)
            yield _block_batch(done, arrow)
            done = []
        if started:
            # More of it may lie in the next range.
            yield _block_batch([(conv, number, False, numbers, rows)], arrow)

    return given.mapInArrow(cut, schema)


def _block_batch(blocks: list[tuple], conv_type: pa.DataType) -> pa.RecordBatch:
    convs, keys, whole, turns, rows = zip(*blocks) if blocks else ([],) * 5
    return pa.RecordBatch.from_arrays(
        [pa.array(convs, conv_type), pa.array(keys, pa.int64()), pa.array(whole, pa.bool_()),
         pa.array(turns, pa.list_(pa.int64())), _row_lists(rows)],
        names=["conv_id", "key", "whole", "turns", "rows"],
    )


def _row_lists(lists) -> pa.Array:
    """Lists of (role, text) as an array of lists of structs."""
    ends = [0]
    for rows in lists:
        ends.append(ends[-1] + len(rows))
    flat = [r for rows in lists for r in rows]
    pairs = pa.StructArray.from_arrays(
        [pa.array([r[i] for r in flat], pa.string()) for i in (0, 1)], names=["role", "text"]
    )
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs)


def _rows_of(lists: pa.ListArray) -> list[list[tuple[str, str]]]:
    return [[(r["role"], r["text"]) for r in rows or []] for rows in lists.to_pylist()]


# Conversations inside one block


def _solve_whole(blocks: DataFrame) -> DataFrame:
    """(conv_id, gaps, ..., cost, audit, rows), the rows repaired."""
    given = blocks.where("whole").select("conv_id", "turns", "rows")
    schema = T.StructType(
        [given.schema["conv_id"], *[T.StructField(c, T.LongType()) for c in REPORT],
         T.StructField("audit", T.StringType()), T.StructField("rows", T.ArrayType(ROW))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            reports, audits, repaired = [], [], []
            for turns, rows in zip(batch.column(1).to_pylist(), _rows_of(batch.column(2))):
                symbols, facts = examine(turns, rows)
                cost, audit = solve(symbols)
                reports.append([gaps(facts), *[facts[c] for c in REPORT[1:-1]], cost])
                audits.append(audit)
                repaired.append(replay(audit, START, symbols, rows))
            columns = [pa.array(c, pa.int64()) for c in zip(*reports)] or [pa.array([], pa.int64())] * len(REPORT)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *columns, pa.array(audits, pa.string()), _row_lists(repaired)],
                names=schema.names,
            )

    return given.mapInArrow(run, schema)


# Conversations over several blocks. ``conv`` is the id in a struct: two of them are equal
# where both ids are null.


def _later_copies(blocks: DataFrame) -> DataFrame:
    """(conv, key, later): rows whose role and text stand in an earlier block."""
    at = F.posexplode("rows").alias("at", "row")
    rows = blocks.select("conv", "key", at).select("conv", "key", "at", "row.role", F.md5("row.text").alias("digest"))
    same = ["conv", "role", "digest"]
    # A block finds its own copies; one row each is enough to find those of other blocks.
    rows = rows.groupBy(*same, "key").agg(F.collect_list("at").alias("at"))
    firsts = rows.groupBy(*same).agg(F.min("key").alias("first"), F.count(F.lit(1)).alias("blocks"))
    found = rows.join(firsts.where("blocks > 1"), same).where("key > first")
    return found.groupBy("conv", "key").agg(F.flatten(F.collect_list("at")).alias("later"))


def _fact_arrays(facts: list[dict]) -> list[pa.Array]:
    return [
        pa.array([f[s.name] for f in facts], pa.string() if isinstance(s.dataType, T.StringType) else pa.int64())
        for s in FACTS
    ]


def _weigh(blocks: DataFrame) -> DataFrame:
    """(conv, key, symbols, facts, costs, ranks, audits) of each block."""
    given = blocks.join(_later_copies(blocks), ["conv", "key"], "left").select("conv", "key", "turns", "rows", "later")
    schema = T.StructType(
        [*given.schema.fields[:2], T.StructField("symbols", T.StringType()), *FACTS, *WEIGHTS,
         T.StructField("audits", T.ArrayType(T.StringType()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = (batch.column(2).to_pylist(), _rows_of(batch.column(3)), batch.column(4).to_pylist())
            found = [examine(turns, rows, set(later or ())) for turns, rows, later in zip(*lists)]
            weights = [block_weights(symbols) for symbols, _ in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([s for s, _ in found], pa.string()),
                 *_fact_arrays([f for _, f in found]),
                 pa.array([w[0] for w in weights], pa.list_(pa.int64())),
                 pa.array([w[1] for w in weights], pa.list_(pa.int32())),
                 pa.array([w[2] for w in weights], pa.list_(pa.string()))],
                names=schema.names,
            )

    return given.mapInArrow(run, schema)


def _join_level(nodes: DataFrame, bits: int) -> DataFrame:
    """Neighbours whose keys agree above ``bits`` as one row with the keys, and the paths."""
    given = nodes.select("conv", "key", *[f.name for f in FACTS], "costs", "ranks")
    schema = T.StructType(
        [given.schema["conv"], T.StructField("key", T.LongType()), *FACTS, *WEIGHTS,
         T.StructField("children", T.ArrayType(T.LongType())), T.StructField("paths", T.ArrayType(T.BinaryType()))]
    )

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("key")
        children = group.select([f.name for f in FACTS]).to_pylist()
        costs, ranks, paths = joined_weights(group["costs"].to_pylist(), group["ranks"].to_pylist())
        keys = group["key"].to_pylist()
        return pa.Table.from_arrays(
            [group["conv"].slice(0, 1).combine_chunks(), pa.array([keys[0] >> bits << bits], pa.int64()),
             *_fact_arrays([joined_facts(children)]), pa.array([costs], pa.list_(pa.int64())),
             pa.array([ranks], pa.list_(pa.int32())), pa.array([keys], pa.list_(pa.int64())),
             pa.array([paths], pa.list_(pa.binary()))],
            names=schema.names,
        )

    return given.groupBy("conv", F.shiftright("key", bits)).applyInArrow(run, schema)


def _report(tops: DataFrame) -> DataFrame:
    """(conv, key, gaps, ..., cost, state) of conversations that have come to one row."""
    given = tops.select("conv", "key", *[f.name for f in FACTS], "costs", "ranks")
    schema = T.StructType(
        [*given.schema.fields[:2], *[T.StructField(c, T.LongType()) for c in REPORT], T.StructField("state", T.IntegerType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.select([f.name for f in FACTS]).to_pylist()
            ends = [best_end(*pair) for pair in zip(batch["costs"].to_pylist(), batch["ranks"].to_pylist())]
            values = [[gaps(r), *[r[c] for c in REPORT[1:-1]], cost] for r, (cost, _) in zip(rows, ends)]
            columns = [pa.array(c, pa.int64()) for c in zip(*values)] or [pa.array([], pa.int64())] * len(REPORT)
            states = pa.array([state for _, state in ends], pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns, states], names=schema.names)

    return given.mapInArrow(run, schema)


def _handed_down(chosen: DataFrame, level: DataFrame) -> DataFrame:
    """(conv, key, before, behind, last) of the children of the chosen rows."""
    path = F.get("paths", 4 * F.col("before") + F.col("behind"))
    rows = chosen.join(level.select("conv", "key", "children", "paths"), ["conv", "key"])
    rows = rows.select("conv", "last", F.size("children").alias("k"), F.hex(path).alias("path"), F.posexplode("children").alias("i", "key"))
    state = lambda i: F.substring("path", 2 * i + 2, 1).cast("int")
    return rows.select(
        "conv", "key", state(F.col("i")).alias("before"), state(F.col("i") + 1).alias("behind"),
        (F.col("last") & (F.col("i") == F.col("k") - 1)).alias("last"),
    )


def _repair_blocks(blocks: DataFrame, weighed: DataFrame, chosen: DataFrame) -> DataFrame:
    """(conv, key, audit, rows) of each block, by the states before and behind it."""
    weighed = weighed.select("conv", "key", "symbols", "audits")
    given = chosen.join(weighed, ["conv", "key"]).select(
        "conv", "key", "before", "symbols",
        F.concat(
            F.get("audits", 4 * F.col("before") + F.col("behind")),
            F.when(F.col("last"), F.get(F.array(*[F.lit(CLOSING[s]) for s in STATES]), "behind")).otherwise(""),
        ).alias("audit"),
    ).join(blocks.select("conv", "key", "rows"), ["conv", "key"]).select("conv", "key", "audit", "before", "symbols", "rows")
    schema = T.StructType([*given.schema.fields[:3], T.StructField("rows", T.ArrayType(ROW))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            audits, states, symbols = (batch.column(i).to_pylist() for i in (2, 3, 4))
            repaired = [replay(*x) for x in zip(audits, states, symbols, _rows_of(batch.column(5)))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], _row_lists(repaired)], names=schema.names)

    return given.mapInArrow(run, schema)


@dataclass(frozen=True)
class Repair:
    """``whole``: a row for each conversation that lay in one block, with its report, its
    audit and its repaired rows. ``reports`` and ``parts``: reports of the others, and
    their audits and rows by block, in the order of ``key``."""

    whole: DataFrame
    reports: DataFrame
    parts: DataFrame

    def turns(self) -> DataFrame:
        """All repaired rows: (conv_id, key, nth, role, text)."""
        parts = self.parts.select("conv_id", "key", F.posexplode("rows").alias("nth", "row"))
        whole = self.whole.select("conv_id", F.lit(0).cast("bigint").alias("key"), F.posexplode("rows").alias("nth", "row"))
        return whole.union(parts).select("conv_id", "key", "nth", "row.role", "row.text")

    def digests(self) -> DataFrame:
        """(conv_id, gaps, ..., cost, audit, repaired_sha256): the hash is of all
        ``role:text``, newline-joined, and read from the rows as a stream."""
        joined = F.array_join(F.transform("rows", lambda r: F.concat(r["role"], F.lit(":"), r["text"])), "\n")
        whole = self.whole.select("conv_id", *REPORT, "audit", F.sha2(joined, 256).alias("repaired_sha256"))
        conv = F.struct("conv_id").alias("conv")
        ordered = F.array_sort(F.collect_list(F.struct("key", "audit")))
        audits = self.parts.groupBy(conv).agg(F.array_join(F.transform(ordered, lambda x: x["audit"]), "").alias("audit"))
        bodies = self.parts.where(F.size("rows") > 0).select(conv, "key", joined.alias("body"))
        long = self.reports.select(conv, *REPORT).join(audits, "conv")
        long = long.join(_stream_digests(bodies), "conv", "left").select(
            "conv.conv_id", *REPORT, "audit", F.coalesce("sha", F.sha2(F.lit(""), 256)).alias("repaired_sha256")
        )
        return whole.union(long)


def _stream_digests(bodies: DataFrame) -> DataFrame:
    """(conv, sha) of the bodies of a conversation, joined by newlines in order."""
    given = bodies.repartition("conv").sortWithinPartitions("conv", "key")
    schema = T.StructType([given.schema["conv"], T.StructField("sha", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv = digest = None
        for batch in batches:
            done = []
            for at, body in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if digest is None or at != conv:
                    if digest is not None:
                        done.append((conv, digest.hexdigest()))
                    conv, digest = at, sha256()
                else:
                    digest.update(b"\n")
                digest.update(body.encode())
            kind = batch.schema.field(0).type
            yield _digest_batch(done, kind)
        if digest is not None:
            yield _digest_batch([(conv, digest.hexdigest())], kind)

    return given.mapInArrow(run, schema)


def _digest_batch(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], kind), pa.array([r[1] for r in rows], pa.string())], names=["conv", "sha"]
    )


def repair_conversations(turns: DataFrame, *, live: str | None = None) -> Repair:
    """Repair conversations given as rows of conv_id, turn, role and text.

    ``live`` names a boolean column: rows without it are not there, but their
    conversation is, and is reported even if nothing is left of it.
    """
    bounded_batches(turns.sparkSession)
    blank = lambda c: F.coalesce(column(turns, c).cast("string"), F.lit(" "))
    given = turns.select(
        column(turns, "conv_id").alias("conv_id"),
        column(turns, "turn").cast("bigint").alias("turn"),
        blank("role").alias("role"),
        blank("text").alias("text"),
        (F.coalesce(column(turns, live), F.lit(False)) if live else F.lit(True)).alias("live"),
    )
    blocks = written(_blocks(given), "turn-blocks")
    long = blocks.where("NOT whole").select(F.struct("conv_id").alias("conv"), "key", "turns", "rows")
    weighed = written(_weigh(long), "turn-weights")
    levels, nodes = [], weighed
    for bits in LEVELS:
        neighbours = nodes.groupBy("conv", F.shiftright("key", bits)).count()
        if neighbours.where("count > 1").isEmpty():
            continue
        nodes = written(_join_level(nodes, bits), "turn-levels")
        levels.append(nodes)
    reports = written(_report(nodes), "turn-reports")
    chosen = reports.select("conv", "key", F.lit(START).alias("before"), F.col("state").alias("behind"), F.lit(True).alias("last"))
    for level in reversed(levels):
        chosen = _handed_down(chosen, level)
    parts = _repair_blocks(long, weighed, chosen)
    return Repair(
        _solve_whole(blocks),
        reports.select("conv.conv_id", *REPORT),
        parts.select("conv.conv_id", "key", "audit", "rows"),
    )


def damaged_turns(turns: DataFrame) -> DataFrame:
    """Rows with planted faults, by a hash of ``conv_id:turn``: dropped, emptied, without
    full stops, repeated, or given to the user. Dropped rows are marked in ``live``."""
    blank = lambda c: F.coalesce(column(turns, c).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn")).cast("binary")) % 20
    text = F.when(F.col("fate") <= 1, "").when(F.col("fate") == 2, F.regexp_replace("text", r"[.!?]", ""))
    copies = F.when(F.col("fate") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    rows = turns.select(
        column(turns, "conv_id").alias("conv_id"), column(turns, "turn").alias("turn"),
        blank("role").alias("role"), blank("text").alias("text"), fate.alias("fate"),
    )
    return rows.select(
        "conv_id", "turn", F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.otherwise(F.col("text")).alias("text"), (F.col("fate") != 0).alias("live"), F.explode(copies).alias("copy"),
    ).drop("copy")
