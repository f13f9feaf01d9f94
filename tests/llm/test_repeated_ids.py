"""One id on a large share of all rows."""

from collections import Counter
from random import Random

import pytest
from brute import near_duplicates
from pyspark.sql import functions as F

from loadstone.llm import fast_minhash, pairwise_quality
from loadstone.llm.pairwise_quality import labelled_sample


@pytest.mark.parametrize("texts", [1, 5000])
def test_samples_keep_their_limit(spark, texts):
    docs = spark.range(5000).select(F.lit(7).cast("bigint").alias("doc_id"), F.concat(F.lit("text "), F.col("id") % texts).alias("text"))
    docs = docs.union(spark.range(20, 40).select("id", F.concat(F.lit("other "), "id")))
    labels = spark.createDataFrame([(7, 1), (7, 1), *[(i, 1) for i in range(20, 40)]], "doc_id bigint, quality int")
    rows = {r["digest"] for r in labelled_sample(docs, labels, "quality", 1, 3).collect()}
    again = labelled_sample(docs.repartition(3), labels, "quality", 1, 3).collect()
    assert len(again) == len(rows) <= 3 and rows == {r["digest"] for r in again}


def test_long_texts_take_part_in_the_fit(spark):
    docs = spark.createDataFrame([(i, "word " * (20_000 if i % 2 else 3)) for i in range(40)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id bigint, quality int")
    model = pairwise_quality.train_quality(docs, labels)
    rows = pairwise_quality.score_quality(docs, model).collect()
    assert all(r["predicted"] == r["doc_id"] % 2 for r in rows)


@pytest.mark.parametrize("copies", [1, 2000])
def test_a_repeated_id_is_compared_once(spark, monkeypatch, copies):
    rng = Random(2)
    words = [f"w{rng.randrange(400)}" for _ in range(120)]
    rows = [(0, " ".join(words))] * copies
    for i in range(1, 60):
        near = list(words)
        near[rng.randrange(120)] = f"x{i}"
        rows.append((i, " ".join(near)))
    sizes = []
    compare = fast_minhash._compare_to_leader

    def watched(units, *more):
        sizes.append(Counter((r["leader"], r["part"]) for r in units.select("leader", "part").collect()))
        return compare(units, *more)

    monkeypatch.setattr(fast_minhash, "_compare_to_leader", watched)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in fast_minhash.near_duplicates(docs, shingle=3, percent=85).collect()}
    assert out == near_duplicates(rows[copies - 1 :], 3, 85)
    assert max(sizes[0].values()) <= 60
