"""Every corpus query on the test tables, beside SQL or a plain version."""

import hashlib
import zlib

import numpy as np
import pytest
from brute import base_spans, held_out, near_duplicates, vector_links
from compare import compare, duck
from pyspark.sql import functions as F

from loadstone.llm import fast_minhash, queries, rp_forest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def table(spark, name, sf=SF):
    return spark.read.parquet(f"{sf}/{name}.parquet")


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_beside_sql(spark, con, name):
    assert compare(spark, con, SF, name, queries.QUERIES[name], queries.ORACLES[name]) is None


def test_forest_links_like_all_pairs(spark):
    rows = table(spark, "embeddings").collect()
    # The table has no near copies of its own; make some, at and around the threshold.
    rng = np.random.default_rng(3)
    made = [(r["vec_id"], list(r["embedding"]), r["label"]) for r in rows[:150]]
    for i, v, label in list(made):
        noise = rng.standard_normal(len(v)) * rng.choice([0.01, 0.03, 0.045])
        made.append((i + 10_000, [float(np.float32(x)) for x in np.array(v) + noise], label))
        made.append((i + 20_000, list(v), label if i % 3 else None))
    df = spark.createDataFrame(made, "vec_id bigint, embedding array<float>, label int")
    out = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in rp_forest.near_vectors(df).collect()}
    assert out == vector_links(made, 0.93)


def test_forest_splits_leaves_and_chunks(spark, monkeypatch):
    monkeypatch.setattr(rp_forest, "LEAF", 8)
    monkeypatch.setattr(rp_forest, "CHUNK", 7)
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((4, 16))
    made = [
        (i, [float(x) for x in centres[i % 4] + rng.standard_normal(16) * 0.1], 1) for i in range(200)
    ]
    df = spark.createDataFrame(made, "vec_id bigint, embedding array<double>, label int")
    out = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in rp_forest.near_vectors(df).collect()}
    expected = vector_links(made, 0.93)
    assert {i: c for i, (_, c) in out.items()} == {i: c for i, (_, c) in expected.items()}
    found, there = sum(n for n, _ in out.values()), sum(n for n, _ in expected.values())
    assert 0.95 * there <= found <= there


def test_personal_data_base_spans(spark):
    texts = {r["doc_id"]: r["text"] for r in table(spark, "documents").collect()}
    rows = queries.QUERIES["op3_pii_bootstrap"](spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        spans = base_spans(texts[r["doc_id"]])
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in ("email", "ip", "card", "phone")] == [
            sum(s[0] == k for s in spans) for k in ("email", "ip", "card", "phone")
        ]
        assert set(filter(None, joined.split(","))) <= set(r["spans"].split(","))


@pytest.mark.parametrize("name,label,least", [("op5_pairwise_quality", "quality", 0.97), ("op7_dictionary_toxicity", "toxic", 0.9)])
def test_held_out_accuracy(spark, name, label, least):
    sf = "/root/testdata/sf0.1"
    out = queries.QUERIES[name](spark, sf)
    rows = out.join(table(spark, "labels", sf), "doc_id").where("held_out").collect()
    assert all(0 <= r["score"] <= 1 and held_out(r["doc_id"]) for r in rows)
    for value in (0, 1):
        of = [r["predicted"] == value for r in rows if r[label] == value]
        assert sum(of) / len(of) >= least


def test_packing_round_trip(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(queries.word_tokenizer())
    texts = {r["doc_id"]: r["text"] for r in table(spark, "documents").collect()}
    pieces = {}
    for r in queries.QUERIES["op6_binary_packing"](spark, SF).collect():
        pieces.setdefault(r["doc_id"], []).append(r)
    assert set(pieces) == set(texts)
    assert len({r["sequence_id"] for p in pieces.values() for r in p}) == sum(map(len, pieces.values()))
    for doc, found in pieces.items():
        ids = [*tokenizer.encode(texts[doc], add_special_tokens=False).ids, queries.END_ID]
        at = 0
        for r in sorted(found, key=lambda r: r["start"]):
            data = np.array(ids[at : at + r["length"]], "<u4").tobytes()
            assert (r["start"], r["offset"], r["doc_tokens"]) == (at, 0, len(ids))
            assert r["ids_crc32"] == zlib.crc32(data)
            assert r["length"] & (r["length"] - 1) == 0 and r["length"] <= queries.LONGEST
            at += r["length"]
        assert at == len(ids)


def test_near_duplicates_like_all_pairs(spark):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, "documents", "/root/testdata/sf0.01").where("doc_id < 500").collect()]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in fast_minhash.near_duplicates(docs, shingle=3, percent=85).collect()}
    assert out == near_duplicates(rows, 3, 85)


def test_near_duplicates_around_the_threshold(spark, monkeypatch):
    """A large group whose members are alike in chains, so that leaders do not settle it."""
    monkeypatch.setattr(fast_minhash, "BLOCK", 8)
    rng = np.random.default_rng(1)
    base = [f"w{i}" for i in range(80)]
    rows = []
    for i in range(120):
        words = list(base)
        for at in rng.integers(0, 80, rng.integers(1, 5)):
            words[at] = f"x{rng.integers(0, 6)}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in fast_minhash.near_duplicates(docs, shingle=3, percent=85).collect()}
    assert out == near_duplicates(rows, 3, 85)


def test_sketches_fill_and_estimate():
    rng = np.random.default_rng(2)
    for n in (1, 3, 40, 400):
        items = rng.integers(0, 2**63, n).astype(np.uint64)
        sketch = fast_minhash.similarity_sketch(items, 80)
        assert (sketch != np.uint64(2**64 - 1)).all()
        other = np.concatenate([items[n // 10 :], rng.integers(0, 2**63, n // 10).astype(np.uint64)])
        true = len(set(items.tolist()) & set(other.tolist())) / len(set(items.tolist()) | set(other.tolist()))
        assert abs((fast_minhash.similarity_sketch(other, 80) == sketch).mean() - true) < 0.2


def test_chat_windows_keep_the_budget(spark):
    from loadstone.llm import chat_windows

    turns = table(spark, "conversations").select("conv_id", "turn", "role", "text")
    windows = chat_windows.format_windows(turns, budget=200, history=40, least=50)
    read = chat_windows.read_windows(windows).select("conv_id", "window", F.explode("fresh").alias("t"))
    back = read.groupBy("conv_id").agg(F.count("*").alias("n"))
    there = turns.groupBy("conv_id").agg(F.count("*").alias("n"))
    assert back.exceptAll(there).isEmpty() and there.exceptAll(back).isEmpty()
    sized = windows.select(F.char_length("formatted").alias("chars"), F.size(F.split("formatted", r"<\|im_start\|>")).alias("turns"))
    # A window of several turns: about four characters a token.
    over = sized.where("turns > 5 AND chars > 200 * 8")
    assert windows.count() > there.count() and over.isEmpty()


def test_quality_is_fitted_on_all_pairs(spark, monkeypatch):
    """The weights are those of all pairs of all labelled documents, however few a sample would hold."""
    from loadstone.llm import pairwise_quality as Q

    monkeypatch.setattr(Q, "SAMPLE_DOCS", 20, raising=False)
    docs = table(spark, "documents", "/root/testdata/sf0.01")
    labels = table(spark, "labels", "/root/testdata/sf0.01")
    model = Q.train_quality(docs, labels)
    rows = docs.join(labels.where("quality IN (0, 1)"), "doc_id").select("doc_id", "quality", "text").distinct().collect()
    rows = [r for r in rows if not held_out(r["doc_id"])]
    x = np.array([Q.features(r["text"]) for r in rows])
    good = np.array([r["quality"] == 1 for r in rows])
    assert np.allclose(model.mean, x.mean(axis=0)) and np.allclose(model.scale, x.std(axis=0) + 1e-6)
    x = Q.expand((x - x.mean(axis=0)) / (x.std(axis=0) + 1e-6))
    s = x @ np.array(model.weights)
    p = 1 / (1 + np.exp(-np.clip(s[good][:, None] - s[~good][None, :], -30, 30))) - 1
    slope = (x[good].T @ p.sum(axis=1) - x[~good].T @ p.sum(axis=0)) / p.size + 1e-3 * np.array(model.weights)
    assert np.abs(slope).max() < 1e-4
    ranked, bad = np.sort(model.margins(np.array([Q.features(r["text"]) for r in rows]))), int((~good).sum())
    assert abs(model.cut - (ranked[bad - 1] + ranked[bad]) / 2) < 1e-6
