"""From raw documents to packed training sequences, in stages.

Each stage takes all that its predecessor kept and returns the columns of documents;
the last one returns packed pieces. Nulls, empty and long texts, repeated rows and
empty tables behave as the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadstone.llm import (
    binary_packing,
    dictionary_toxicity,
    fast_minhash,
    hash_mixing,
    reversible_lines,
)
from loadstone.llm.queries import END_ID, LONGEST, word_tokenizer
from loadstone.llm.tables import column, small_side, table, whole, written

TOXIC = 0.5


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the toxicity threshold."""
    model = dictionary_toxicity.train_toxicity(
        docs.select("doc_id", "text"), table(spark, sf_dir, "labels")
    )
    rows = docs.select(whole(docs).alias("row"), column(docs, "doc_id"), column(docs, "text"))
    scored = dictionary_toxicity.score_toxicity(rows, model)
    return scored.where(F.col("toxicity_score") < TOXIC).select("row.*")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many of them share; all documents stay."""
    state = reversible_lines.build_lines(docs)
    cleaned = reversible_lines.clean_lines(state, docs, refs=state.references)
    new = {"text": F.col("text"), "n_chars": F.length("text").cast("bigint")}
    return cleaned.select(
        *[(new[c] if c in new else F.col("row").getField(c)).alias(c) for c in docs.columns]
    )


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicate texts, that with the smallest id; rows
    without an id come last. Rows are told apart by a key, not by their id: of several
    texts under one id only those go that resemble a text that stays."""
    keyed = written(
        docs.select(F.monotonically_increasing_id().alias("key"), whole(docs).alias("row")), "keyed-documents"
    )
    doc_id, text = (F.col("row").getField(c) for c in ("doc_id", "text"))
    found = fast_minhash.near_duplicates(
        keyed.select("key", text.alias("text")), doc_id="key", shingle=5, percent=80
    )
    found = written(found.select(F.col("doc_id").alias("key"), "component_id"), "near-groups")
    order = F.struct(doc_id.isNull().alias("last"), doc_id.alias("id"), F.md5(text).alias("digest"), "key")
    first = found.join(keyed.select("key", order.alias("order")), "key").groupBy("component_id")
    first = first.agg(F.min("order").getField("key").alias("key"))
    gone = written(found.select("key").join(first, "key", "left_anti"), "near-copies")
    return keyed.join(small_side(gone), "key", "left_anti").select("row.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: not at all, once or twice."""
    sized = hash_mixing.measure(docs)
    plan = hash_mixing.plan_mix(written(sized.select("source", "size", "place"), "mix-sizes"))
    mixed = hash_mixing.apply_mix(sized, plan).where("copies > 0")
    return mixed.select(F.explode(F.sequence(F.lit(1), F.col("copies"))), "row").select("row.*")


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return binary_packing.pack_binary(docs, word_tokenizer(), END_ID, longest=LONGEST)


STAGES = [
    ("toxicity", reject_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_documents),
]

# Trained scores, sketches and tokenizers are beyond SQL; tests/llm has the brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
