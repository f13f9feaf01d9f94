"""Toxicity of texts of every length and of small groups."""

import random

from loadstone.llm import dictionary_toxicity

COMMON = [a + b + c for a in ("ka", "lo", "mi", "nu") for b in ("ber", "dan", "fol", "gim", "har") for c in ("", "s", "ta", "ve", "xi")]


def prose(rng, n, marker="", share=0.0, words=COMMON):
    return " ".join(marker if rng.random() < share else rng.choice(words) for _ in range(n))


def predicted(spark, docs):
    """doc_id to whether it is toxic, from {doc_id: (label or None, text)}."""
    rows = spark.createDataFrame([(i, t) for i, (_, t) in docs.items()], "doc_id bigint, text string").repartition(4)
    labels = spark.createDataFrame([(i, v) for i, (v, _) in docs.items() if v is not None], "doc_id bigint, toxic int")
    model = dictionary_toxicity.train_toxicity(rows, labels)
    scored = dictionary_toxicity.score_toxicity(rows, model).collect()
    return {r["doc_id"]: r["toxicity_score"] >= 0.5 for r in scored}


def test_long_texts(spark):
    rng = random.Random(1)
    docs = {i: (int(i % 4 == 0), prose(rng, rng.randint(60, 200), "vexil", 0.04 if i % 4 == 0 else 0.0003)) for i in range(400)}
    # Labelled and unlabelled ones, some above what dictionaries are made of; the marker is as rare as in short ones.
    docs |= {i: (0 if i % 2 else None, prose(rng, 2000 * (1 + i % 8), "vexil", 0.0003)) for i in range(1000, 1024)}
    docs |= {i: (1 if i % 2 else None, prose(rng, 2000 * (1 + i % 8), "vexil", 0.04)) for i in range(2000, 2008)}
    found = predicted(spark, docs)
    assert not [i for i in range(1000, 1024) if found[i]]
    assert all(found[i] for i in range(2000, 2008))
    assert sum(found[i] == bool(v) for i, (v, _) in docs.items() if i < 400) >= 390


def test_small_language(spark):
    rng = random.Random(2)
    theirs = [a + b for a in ("oste", "uru", "ami", "elle", "ippo") for b in ("ja", "zo", "que", "ll", "rra", "ñi")]
    for first in (0, 10_000):  # other documents are held out
        docs = {}
        for i in range(600):
            docs[first + i] = (int(i % 4 == 0), prose(rng, rng.randint(60, 200), "vexil", 0.04 if i % 4 == 0 else 0))
        for i in range(1000, 1200):  # the marker is ordinary, but not as often
            docs[first + i] = (int(i % 5 == 0), prose(rng, rng.randint(60, 200), "bomeri", 0.05 if i % 5 == 0 else 0.001, theirs))
        found = predicted(spark, docs)
        small = [(found[first + i], i % 5 == 0) for i in range(1000, 1200)]
        assert sum(f for f, toxic in small if toxic) >= 36 and sum(f for f, toxic in small if not toxic) <= 8


def test_window_gap_is_calibrated():
    import numpy as np

    counts = np.zeros((2, 40, dictionary_toxicity.GAPS), np.int64)
    counts[:, :, 0] = 30
    counts[1, :, 5] = np.arange(40) % 9  # ordinary windows have small gaps, at any number
    counts[0, :, 5] = np.arange(40) % 2
    counts[0, :, 14] = 1
    model = dictionary_toxicity.calibrated(dictionary_toxicity.ToxicityModel(b"", b""), *counts)
    assert (model.evidence(counts[0]) >= model.cut).all() and (model.evidence(counts[1]) < model.cut).all()
    assert model.window_gap > 5
