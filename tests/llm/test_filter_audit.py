"""The filter audit beside a plain run of every order."""

import re
from fractions import Fraction
from itertools import permutations
from math import factorial

import pytest

from loadstone.llm import filter_audit, queries
from loadstone.llm.filter_audit import FILTERS, audit_filters

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def plain_audit(docs, labels):
    """{(part, order, step): counts} of (doc_id, text, source) rows."""
    marks = {}
    for i, quality, toxic in labels:
        if i is not None:
            good, bad = marks.get(i, (False, False))
            marks[i] = (good or quality == 1, bad or toxic == 1)
    rows = []
    for i, text, source in docs:
        text = text or ""
        words = WORDS.findall(text)
        fails = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
            "D": bool(re.search("[#$%&*|]", text)),
            "E": i is not None and any(j is not None and j < i and (t or "") == text for j, t, _ in docs),
        }
        rows.append((source or "", {f for f in FILTERS if fails[f]}, *marks.get(i, (False, False))))
    out = {}
    for part in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == part]
        sums = dict.fromkeys(FILTERS, 0)
        for order in permutations(FILTERS):
            left = mine
            for k, f in enumerate(order):
                gone = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                redundant = sum(f in r[1] for r in mine) - len(gone)
                unique = sum(r[1] == {f} for r in mine)
                sums[f] += len(gone)
                out[part, "".join(order), k + 1] = [len(left), len(gone), redundant, unique, sum(r[2] for r in gone), sum(r[3] for r in gone)]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(sums[order[step - 1]])
    return out


def found(df):
    rows = df.collect()
    out = {(r["part"], r["filter_order"], r["step"]): [r[c] for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")] for r in rows}
    assert len(out) == len(rows)
    return out


LONG = " ".join(f"w{i}" for i in range(400))
TEXTS = [
    (1, LONG, "a"), (2, LONG, "a"), (3, LONG, "b"), (3, LONG, "b"), (4, LONG + " # x", None), (5, LONG + " # x", ""), (6, None, "a"), (7, "", "b"),
    (8, "word " * 60_000, "c"), (None, LONG, "a"), (None, "", None), (9, "ABC DEF", "c"), (10, LONG.upper(), "c"), (1, LONG, "c"), (11, "a\tb\x0bc\x1cd", "a"),
    (12, "　é " * 300, "b"), (13, "one two", "d"), (14, "x" * 50_000, "d"), (4, LONG + " # x", "d"), (15, " " + LONG, "a"),
]
LABELS = [(1, 1, 0), (2, 1, 1), (3, 0, 1), (4, 1, 1), (4, 0, 0), (6, None, 1), (None, 1, 1), (8, 1, None), (99, 1, 1)]


def frames(spark, docs, labels):
    return (
        spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id bigint, text string, source string, part string, fails int").repartition(3),
        spark.createDataFrame([(*x, 5) for x in labels], "doc_id bigint, quality int, toxic int, good int"),
    )


def test_beside_every_order(spark):
    assert found(audit_filters(*frames(spark, TEXTS, LABELS))) == plain_audit(TEXTS, LABELS)


def test_hot_text(spark):
    docs = [(i, LONG if i % 3 else "few words", "hot" if i % 2 else "b") for i in range(300)]
    docs += [(5, LONG, "hot")] * 50 + [(None, LONG, "hot")] * 50
    labels = [(i, i % 2, i % 5 == 0) for i in range(0, 300, 2)]
    labels = [(i, q, int(t)) for i, q, t in labels]
    assert found(audit_filters(*frames(spark, docs, labels))) == plain_audit(docs, labels)


def test_empty_tables(spark, tmp_path):
    docs, labels = frames(spark, TEXTS, LABELS)
    docs.limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    labels.limit(0).write.parquet(f"{tmp_path}/labels.parquet")
    assert queries.QUERIES["op13_filter_audit"](spark, str(tmp_path)).collect() == []
    rows = audit_filters(docs, labels.limit(0)).where("good_lost > 0 OR toxic_lost > 0")
    assert rows.isEmpty()


def test_solution_is_the_mean_over_orders():
    weights = filter_audit.shapley_rows()
    m = len(FILTERS)
    for i in range(m):
        for coalition in range(1 << m):
            size = bin(coalition).count("1")
            if coalition >> i & 1:
                want = factorial(size - 1) * factorial(m - size)
            else:
                want = -factorial(size) * factorial(m - size - 1)
            # Nothing is removed by nobody, whose weight is therefore of no account.
            assert coalition == 0 or weights[i][coalition] == want


def test_elimination_is_exact():
    solved = filter_audit._eliminated([[Fraction(0), Fraction(2), Fraction(1)], [Fraction(3), Fraction(1), Fraction(1)]])
    assert [r[2] for r in solved] == [Fraction(1, 6), Fraction(1, 2)]


@pytest.mark.parametrize("name", ["op13_filter_audit"])
def test_rows_of_a_table(spark, name):
    rows = queries.QUERIES[name](spark, "/root/testdata/sf0.001")
    parts = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("source").distinct().count()
    assert rows.count() == 600 * parts
