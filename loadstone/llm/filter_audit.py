"""How the filters of a corpus interact, whatever order they run in.

Every document has the set of filters that it fails, and so a part (a source) is known by
how many of its documents fail each of the 32 sets of five filters. From these, the
removals of each coalition of filters are tabulated: a document goes if the coalition
meets its set. A step of an order removes the difference of two coalitions, and the mean
over all orders, the Shapley value, is the solution of a constrained least squares
problem over the same table: the Shapley kernel weighs the coalitions, and the values
must sum to what all filters remove. Its normal equations are solved in rationals, once
for each coalition as right-hand side, so that applying the solution to the counts of a
part is a sum of whole numbers.

Filters: A under 200 words; B distinct words under half of the words; C over 2% capital
letters A-Z of the code points; D one of ``#$%&*|``; E the text of a smaller doc_id,
anywhere in the table, removed or not. Words are maximal runs of other characters than
blank and U+0009 to U+000D.

Null text is empty. Null sources and the empty source are one part, the empty string.
A null doc_id is neither smaller nor larger than another: its row never fails E and no
row fails E for it. Rows that repeat a doc_id count one by one; of the rows with a text's
smallest doc_id none fails E. A document is good (toxic) if any row of ``labels`` with its
id says 1; labels without an id say nothing. Empty table: no rows. Long texts are split
into words where they lie, and only their digests are shuffled.
"""

from __future__ import annotations

import json
from fractions import Fraction
from itertools import permutations
from math import comb

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadstone.llm.tables import column

FILTERS = "ABCDE"
COALITIONS = 1 << len(FILTERS)
COUNTS = ("removed", "good", "toxic")

WORD_GAP = r"[\x20\x09-\x0D]+"
# Fewest words; least distinct words, most capitals, of a hundred; marks of junk.
MIN_WORDS, MIN_DISTINCT, MAX_CAPITALS, MARKS = 200, 50, 2, r"[#$%&*|]"

SALTS = 1024  # groups that rows without an id are dealt into


def own_failures(docs: DataFrame) -> DataFrame:
    """doc_id, part, digest of the text and the bits of the filters that need the text only."""
    text = F.coalesce(column(docs, "text"), F.lit(""))
    given = docs.select(
        column(docs, "doc_id").alias("doc_id"),
        F.coalesce(column(docs, "source"), F.lit("")).alias("part"),
        text.alias("text"),
        F.filter(F.split(text, WORD_GAP), lambda w: w != "").alias("words"),
    )
    sized = given.select(
        "doc_id", "part", "text",
        F.size("words").cast("bigint").alias("n"),
        F.size(F.array_distinct("words")).cast("bigint").alias("distinct"),
    )
    capitals = F.length(F.regexp_replace("text", "[^A-Z]+", ""))
    failing = [
        F.col("n") < MIN_WORDS,
        100 * F.col("distinct") < MIN_DISTINCT * F.col("n"),
        100 * capitals.cast("bigint") > MAX_CAPITALS * F.length("text"),
        F.col("text").rlike(MARKS),
    ]
    return sized.select("doc_id", "part", F.sha2("text", 256).alias("digest"), _bits(failing).alias("fails"))


def _bits(failing: list[Column]) -> Column:
    bits = [F.when(f, 1 << i).otherwise(0) for i, f in enumerate(failing)]
    return sum(bits[1:], bits[0]).cast("int")


def failing_sets(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, fails, n, good, toxic): documents by the exact set of filters they fail.

    The rows of one text are counted by part and labels before they meet, so that a text
    with a third of all rows comes to a few rows.
    """
    rows = own_failures(docs).groupBy("doc_id", "digest", "part", "fails").agg(F.count(F.lit(1)).alias("n"))
    marks = labels.where(column(labels, "doc_id").isNotNull()).groupBy(column(labels, "doc_id").alias("doc_id"))
    marks = marks.agg(
        *[F.max(F.coalesce(column(labels, of) == 1, F.lit(False))).alias(name) for of, name in (("quality", "good"), ("toxic", "toxic"))]
    ).withColumn("salt", F.lit(0))
    # Rows without an id match nothing; salted, they do not meet in one task either.
    salt = F.when(F.col("doc_id").isNull(), 1 + F.pmod(F.xxhash64("digest"), F.lit(SALTS)).cast("int")).otherwise(0)
    marked = rows.withColumn("salt", salt).join(marks, ["doc_id", "salt"], "left").select(
        "doc_id", "digest", "part", "fails", "n",
        *[F.coalesce(F.col(c), F.lit(False)).alias(c) for c in ("good", "toxic")],
    )
    with_id = F.col("doc_id").isNotNull()
    texts = marked.groupBy("digest", "part", "fails", "good", "toxic").agg(
        F.sum("n").alias("n"),
        F.coalesce(F.sum(F.when(~with_id, F.col("n"))), F.lit(0)).alias("without_id"),
        F.min(F.when(with_id, F.struct("doc_id", "n"))).alias("first"),
    )
    # By now a text has a row for each part and pair of labels at most.
    smallest = F.min("first.doc_id").over(Window.partitionBy("digest"))
    leads = F.when(F.col("first.doc_id") == F.col("smallest"), F.col("first.n")).otherwise(0)
    copies = texts.withColumn("smallest", smallest).select(
        "part", "fails", "good", "toxic", "n", (F.col("without_id") + leads).alias("stay")
    )
    last = 1 << FILTERS.index("E")
    both = F.array(
        F.struct(F.col("fails").alias("fails"), F.col("stay").alias("n")),
        F.struct(F.col("fails").bitwiseOR(F.lit(last)).alias("fails"), (F.col("n") - F.col("stay")).alias("n")),
    )
    sets = copies.select("part", "good", "toxic", F.explode(both).alias("set"))
    n = F.col("set.n")
    return sets.groupBy("part", F.col("set.fails").alias("fails")).agg(
        F.sum(n).alias("n"),
        *[F.sum(F.when(F.col(c), n).otherwise(0)).alias(c) for c in ("good", "toxic")],
    )


def coalition_removals(sets: DataFrame) -> DataFrame:
    """(part, total, removals): what each of the 32 coalitions removes, as arrays by coalition."""
    met = F.explode(F.sequence(F.lit(0), F.lit(COALITIONS - 1)))
    pairs = sets.select("*", met.alias("coalition"))
    goes = F.col("coalition").bitwiseAND(F.col("fails")) != 0
    table = pairs.groupBy("part", "coalition").agg(
        F.sum("n").alias("total"),
        *[F.sum(F.when(goes, F.col(c)).otherwise(0)).alias(name) for c, name in zip(("n", "good", "toxic"), COUNTS)],
    )
    cells = F.array_sort(F.collect_list(F.struct("coalition", *COUNTS)))
    return table.groupBy("part").agg(F.first("total").alias("total"), cells.alias("removals"))


def shapley_rows() -> list[list[int]]:
    """For each filter, by what each coalition's removals enter the sum over all orders.

    Minimises sum k(S) (v(S) - sum of x_i in S)^2 over the proper coalitions S, under
    sum x_i = v(all), with k(S) = (m - 1) / (C(m, |S|) |S| (m - |S|)).
    """
    m = len(FILTERS)
    everything = COALITIONS - 1
    proper = range(1, everything)
    kernel = {}
    for s in proper:
        size = s.bit_count()
        kernel[s] = Fraction(m - 1, comb(m, size) * size * (m - size))
    # Unknowns: the values and the multiplier of the constraint. Right-hand sides: one
    # column for each coalition, as if it alone removed one document.
    system = []
    for i in range(m):
        left = [sum((kernel[s] for s in proper if s >> i & 1 and s >> j & 1), Fraction(0)) for j in range(m)]
        right = [kernel[s] if s in kernel and s >> i & 1 else Fraction(0) for s in range(COALITIONS)]
        system.append([*left, Fraction(1), *right])
    efficient = [Fraction(s == everything) for s in range(COALITIONS)]
    system.append([*[Fraction(1)] * m, Fraction(0), *efficient])
    solved = _eliminated(system)
    orders = Fraction(1)
    for i in range(2, m + 1):
        orders *= i
    weights = [[x * orders for x in row[m + 1 :]] for row in solved[:m]]
    if any(x.denominator != 1 for row in weights for x in row):
        raise ArithmeticError("sums over all orders must be whole")
    return [[int(x) for x in row] for row in weights]


def _eliminated(system: list[list[Fraction]]) -> list[list[Fraction]]:
    """Gauss-Jordan elimination; the solutions stand right of the unit matrix."""
    rows = [list(r) for r in system]
    for i in range(len(rows)):
        at = next(r for r in range(i, len(rows)) if rows[r][i])
        rows[i], rows[at] = rows[at], rows[i]
        rows[i] = [x / rows[i][i] for x in rows[i]]
        for r in range(len(rows)):
            if r != i and rows[r][i]:
                rows[r] = [x - rows[r][i] * y for x, y in zip(rows[r], rows[i])]
    return rows


def _steps() -> Column:
    """All orders' steps as one array: the filter, the coalition before it, and the
    filter's weights in its Shapley value."""
    weights = shapley_rows()
    steps = []
    for order in permutations(range(len(FILTERS))):
        before = 0
        for k, i in enumerate(order):
            name = "".join(FILTERS[x] for x in order)
            steps.append({"filter_order": name, "step": k + 1, "bit": 1 << i, "before": before, "weights": weights[i]})
            before |= 1 << i
    kind = "array<struct<filter_order string, step int, bit int, before int, weights array<bigint>>>"
    return F.from_json(F.lit(json.dumps(steps)), kind)


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, filter_order and step: kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, shapley.

    ``docs`` needs doc_id, text and source, ``labels`` doc_id, quality and toxic.
    """
    parts = coalition_removals(failing_sets(docs, labels))
    rows = parts.select("part", "total", "removals", F.explode(_steps()).alias("at"))
    cell = lambda coalition, name: F.get("removals", coalition)[name]
    before, bit = F.col("at.before"), F.col("at.bit")
    after, rest = before.bitwiseOR(bit), F.lit(COALITIONS - 1) - bit
    lost = lambda name: cell(after, name) - cell(before, name)
    shapley = F.aggregate(
        F.zip_with("removals", "at.weights", lambda v, w: v["removed"] * w), F.lit(0).cast("bigint"), lambda a, x: a + x
    )
    return rows.select(
        "part", "at.filter_order", "at.step",
        (F.col("total") - cell(after, "removed")).alias("kept"),
        lost("removed").alias("removed"),
        (cell(bit, "removed") - lost("removed")).alias("redundant"),
        (cell(F.lit(COALITIONS - 1), "removed") - cell(rest, "removed")).alias("unique_fails"),
        lost("good").alias("good_lost"),
        lost("toxic").alias("toxic_lost"),
        shapley.alias("shapley"),
    )
