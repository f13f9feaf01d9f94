"""Conversation repair beside a plain search of all edits."""

import hashlib
import random
import zlib
from functools import lru_cache

import pytest

from loadstone.llm import queries, turn_repair

BLANKS = " \t\n\x0b\x0c\r"


def plain_damage(rows):
    """{conv: rows after damage}, each (turn, role, text)."""
    out = {}
    for conv, turn, role, text in rows:
        kept = out.setdefault(conv, [])
        name = lambda x: " " if x is None else str(x)
        role, text = name(role), name(text)
        fate = zlib.crc32(f"{name(conv)}:{name(turn)}".encode()) % 20
        text = {1: "", 2: text.replace(".", "").replace("!", "").replace("?", "")}.get(fate, text)
        kept += [(turn, "user" if fate == 4 else role, text)] * {0: 0, 3: 2}.get(fate, 1)
    for kept in out.values():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
    return out


def plain_repair(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, repaired rows)"""
    faults, seen = [], set()
    for _, role, text in rows:
        bare = text.strip(BLANKS)
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))

    follows = {"": "su", "s": "u", "u": "a", "a": "u"}

    @lru_cache(None)
    def best(i, state, inserts):
        found = []
        if i == len(rows) and state in ("", "a"):
            found.append((0, "", ()))
        options = []
        if inserts < 3:
            options += [(2, "I", role[0], i, ((role, ""),), inserts + 1) for role in ("user", "assistant")]
        if i < len(rows):
            _, role, text = rows[i]
            options.append((3, "D", None, i + 1, (), 0))
            if faults[i] not in ("blank", "duplicate"):
                more = faults[i] == "truncated"
                options.append((0 + more, "K", role[:1], i + 1, ((role, text),), 0))
                options += [(2 + more, "R", r[0], i + 1, ((r, text),), 0) for r in ("user", "assistant")]
        for cost, letter, initial, to, made, run in options:
            if initial is None:
                after = state
            elif initial and initial in follows[state]:
                after = initial
            else:
                continue
            rest = best(to, after, run)
            if rest is not None:
                found.append((cost + rest[0], letter + rest[1], made + rest[2]))
        return min(found) if found else None

    cost, audit, made = best(0, "", 0)
    count = faults.count
    return gaps, count("blank"), count("duplicate"), count("truncated"), illegal, cost, audit, made


def expected(rows):
    out = {}
    for conv, kept in plain_damage(rows).items():
        *report, made = plain_repair(tuple(kept))
        joined = "\n".join(f"{r}:{t}" for r, t in made)
        out[conv] = (*report, hashlib.sha256(joined.encode()).hexdigest())
    return out


def found(spark, rows, partitions=3):
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(partitions)
    repair = turn_repair.repair_conversations(turn_repair.damaged_turns(turns), live="live")
    result = repair.digests().collect()
    assert len({r["conv_id"] for r in result}) == len(result)
    return {r["conv_id"]: tuple(r[c] for c in (*turn_repair.REPORT, "audit", "repaired_sha256")) for r in result}, repair


def made_up(rng, convs, most):
    texts = ["One.", "Two!", "Three?", "four", "", " \t", "Five. ", "six\n", "Seven.\n"]
    roles = ["system", "user", "assistant", "assistant", "user", "tool", None, "", "sage", "ua"]
    rows = []
    for conv in convs:
        for turn in range(rng.randint(1, most)):
            t = None if rng.random() < 0.05 else turn + rng.choice([0, 0, 0, 1, 7])
            rows.append((conv, t, rng.choice(roles), rng.choice(texts + [None, f"own {turn}."] * 3)))
    return rows


def test_beside_a_plain_search(spark):
    rows = made_up(random.Random(1), [*range(150), None], 9)
    got, repair = found(spark, rows)
    assert got == expected(rows)
    sent = [(r["conv_id"], r["role"], r["text"]) for r in repair.turns().orderBy("conv_id", "key", "nth").collect()]
    made = [(c, *row) for c, kept in plain_damage(rows).items() for row in plain_repair(tuple(kept))[-1]]
    assert sorted(sent, key=str) == sorted(made, key=str)


@pytest.mark.parametrize("block,levels", [(2, (1, 2, 3, 63)), (3, (2, 4, 33, 35, 63)), (7, turn_repair.LEVELS)])
def test_long_conversations_in_blocks(spark, monkeypatch, block, levels):
    """Blocks of a few rows, and ranges that cut conversations, change nothing."""
    monkeypatch.setattr(turn_repair, "BLOCK", block)
    monkeypatch.setattr(turn_repair, "LEVELS", levels)
    rows = made_up(random.Random(block), [1, 2, 3, None, 4, 5], 60)
    assert found(spark, rows, 5)[0] == expected(rows)


def test_one_row_many_times(spark, monkeypatch):
    monkeypatch.setattr(turn_repair, "BLOCK", 16)
    rows = [(7, 1, "user", "Again.")] * 100 + [(7, None, "system", "Be kind.")] * 3 + [(8, 2, "assistant", "Alone")]
    assert found(spark, rows)[0] == expected(rows)


def test_arcs_agree_with_the_letters():
    for symbols in ("", "s", "u-a", "Su-xXAa", "aaaa", "xx-x"):
        cost, audit = turn_repair.solve(symbols)
        rows = [("r", "t")] * len(symbols)
        roles = turn_repair.replay(audit, turn_repair.START, symbols, rows)
        assert sum(c != "I" for c in audit) == len(symbols) and cost >= 0
        assert len(roles) == len(audit) - audit.count("D")


def edge_tables(spark, path, rows):
    schema = "conv_id bigint, turn bigint, role string, text string, `key` int, whole string"
    spark.createDataFrame([(*r, 1, "x") for r in rows], schema).write.parquet(f"{path}/conversations.parquet")
    return str(path)


def test_edges(spark, tmp_path):
    long = "word " * 60_000
    rows = [(1, 0, "user", None), (2, None, None, "x"), (3, 0, "system", long), (3, 2**40, "user", long + "."), (None, None, None, None)]
    rows += [(100 + i, 0, "user", "Hi.") for i in range(40)]  # some of them lose their only row
    at = edge_tables(spark, tmp_path / "some", rows)
    out = {r["conv_id"]: r for r in queries.QUERIES["op11_turn_repair"](spark, at).collect()}
    plain = expected(rows)
    assert {c: tuple(r[k] for k in (*turn_repair.REPORT, "audit", "repaired_sha256")) for c, r in out.items()} == plain
    nothing = [r for c, r in plain.items() if c and c >= 100 and r[5] == 0 and r[6] == ""]
    assert nothing and all(r == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for r in nothing)
    at = edge_tables(spark, tmp_path / "none", [])
    assert queries.QUERIES["op11_turn_repair"](spark, at).collect() == []
