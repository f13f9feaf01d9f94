"""Mixing sources to target weights by nested histograms over hash positions.

Every document has a fixed place in the 60-bit hash range of its source. A budget
is a threshold in that range: what lies at or below it is taken. Thresholds are
found without sorting: tokens are summed by source and leading hash digits, the
digit in which the budget runs out is split into finer digits, and only the
documents of that one bucket are looked at again.

Null source: a source of its own, the last. Null or empty text: size 0. Null ids
and repeated rows: the place comes from id and text, so rows equal in both are
taken or left together. Empty table: no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadstone.llm.tables import column, small_side, whole, written

WORD = r"[^\x20\x09-\x0D]+"
HASH_BITS = 60
DIGIT_BITS = 10


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("bigint")


def place(doc_id: Column, text: Column) -> Column:
    """A fixed 60-bit position of a document."""
    key = F.concat(
        F.coalesce(doc_id.cast("string"), F.lit("")), F.lit("\n"), F.coalesce(text, F.lit(""))
    )
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("bigint")


def measure(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source"
) -> DataFrame:
    """(source, size, place) of every document, beside its columns in ``row``."""
    return docs.select(
        column(docs, source).alias("source"),
        word_count(column(docs, text)).alias("size"),
        place(column(docs, doc_id), column(docs, text)).alias("place"),
        whole(docs).alias("row"),
    )


def source_targets(
    sized: DataFrame, weights: Sequence[int], share: float, repeats: int
) -> DataFrame:
    """(source, source_size, target): ``share`` of all sizes dealt out by weight.

    No target exceeds ``repeats`` times its source's size. What that cuts off is
    dealt to the others by weight, which ends in one level for all of them:
    sources are filled in the order in which they reach their cap. One row per
    source; these alone meet in a single task.
    """
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    nth = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (nth + 1).cast("int"))
    weighed = sizes.withColumn("weight", weight.cast("bigint"))
    weighed = weighed.withColumn("cap", F.col("source_size") * repeats)
    by_cap = Window.orderBy(
        F.col("cap").cast("double") / F.col("weight"), F.col("source").asc_nulls_last()
    )
    full = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    before = lambda c: F.coalesce(F.sum(c).over(full), F.lit(0))
    level = (
        F.sum("source_size").over(everything).cast("double") * F.lit(float(share))
        - before("cap").cast("double")
    ) / (F.sum("weight").over(everything) - before("weight")).cast("double")
    ranked = weighed.select("*", level.alias("level"), F.row_number().over(by_cap).alias("nth"))
    holds = F.col("level") <= F.col("cap").cast("double") / F.col("weight")
    chosen = F.min_by(F.when(holds, F.col("level")), F.when(holds, F.col("nth"))).over(everything)
    target = F.least(F.col("cap").cast("double"), chosen * F.col("weight"))
    return ranked.select(
        "source",
        "source_size",
        F.coalesce(target, F.col("cap").cast("double")).alias("target"),
    )


def plan_mix(
    sized: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.5, repeats: int = 2
) -> DataFrame:
    """(source, source_size, target, passes, threshold) from the sizes and places.

    A source is taken ``passes`` times whole, and once more up to ``threshold``.
    """
    goals = source_targets(sized, weights, share, repeats)
    size, target = F.col("source_size"), F.col("target")
    passes = F.when(size > 0, F.floor(target / size)).otherwise(0).cast("int")
    goals = written(
        goals.select("*", passes.alias("passes")).select(
            "*", (target - F.col("passes") * size).alias("need")
        ),
        "mix-goals",
    )
    # The whole range of a source is its first boundary bucket, nothing lies below it.
    state = goals.select(
        "source", "need", F.lit(0).cast("bigint").alias("bucket"), F.lit(0).cast("bigint").alias("below")
    ).where("need > 0")
    shift = HASH_BITS
    while shift > 0:
        inside = F.shiftright("place", shift) == F.col("bucket")
        known = state.select(F.col("source").alias("of"), "need", "bucket", "below")
        rows = sized.select("source", "size", "place").join(
            small_side(known), F.col("source").eqNullSafe(F.col("of")) & inside
        )
        shift -= DIGIT_BITS
        digits = rows.groupBy(
            "source", "need", "below", F.shiftright("place", shift).alias("digit")
        ).agg(F.sum("size").alias("tokens"), F.countDistinct("place").alias("places"))
        running = F.sum("tokens").over(Window.partitionBy("source").orderBy("digit"))
        summed = digits.withColumn("upto", F.col("below") + running)
        edge = F.struct(
            F.col("digit").alias("bucket"),
            (F.col("upto") - F.col("tokens")).alias("below"),
            "tokens",
            "places",
        )
        state = written(
            summed.where("upto > need")
            .groupBy("source", "need")
            .agg(F.min(edge).alias("edge"))
            .select("source", "need", "edge.*"),
            "mix-digits",
        )
        widest = state.agg(F.max("places")).first()[0]
        if widest is None or widest <= 1:
            break
    # The boundary bucket now has one place; it is taken if that comes nearer.
    nearer = F.col("below") + F.col("tokens") - F.col("need") < F.col("need") - F.col("below")
    last = F.when(nearer, F.col("bucket") + 1).otherwise(F.col("bucket"))
    found = state.select(
        F.col("source").alias("of"),
        (F.shiftleft(last, shift) - 1).alias("threshold"),
    )
    # A need that no bucket exceeds takes its whole source once more.
    rest = F.when(F.col("need") > 0, F.lit(2**HASH_BITS)).otherwise(F.lit(-1))
    plan = goals.join(found, F.col("source").eqNullSafe(F.col("of")), "left").select(
        "source", "source_size", "target", "passes",
        F.coalesce("threshold", rest).alias("threshold"),
    )
    return written(plan, "mix-plan")


def apply_mix(sized: DataFrame, plan: DataFrame) -> DataFrame:
    """Every document with the number of ``copies`` that the mix takes of it.

    One pass and no sort; the plan has a row per source, which is broadcast if these
    are few, and joined by source, splitting hot ones, if not.
    """
    known = small_side(plan.withColumnRenamed("source", "of"))
    once_more = (F.col("place") <= F.col("threshold")).cast("int")
    return sized.join(known, F.col("source").eqNullSafe(F.col("of"))).select(
        "row", "size", "source_size", "target", (F.col("passes") + once_more).alias("copies")
    )
