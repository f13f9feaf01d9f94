"""Encoding by chunks beside the tokenizers library, and buckets of equal length."""

import random

import numpy as np
from pyspark.sql import functions as F

from loadstone.llm import binary_packing, queries


def test_chunks_like_the_library(monkeypatch):
    from tokenizers import Tokenizer

    library = Tokenizer.from_str(queries.word_tokenizer())
    monkeypatch.setattr(binary_packing, "REMEMBERED", 300)
    encode = binary_packing.chunk_encoder(queries.word_tokenizer(), queries.END_ID)
    rng = random.Random(1)
    parts = [
        "a", "E", "J", "̌", "t", "th", " ", "\n", "\t", "É", "É", "İ", "Σ", "K", "1", "23", "'s", "'S", "!", "...",
        "<|endoftext|>", "<|ENDOFTEXT|>", "<|", "日", "Word,", "T̈", "ſ", "ı",
    ]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 25))) for _ in range(20_000)]
    for at in range(0, len(texts), 1000):
        some = texts[at : at + 1000]
        for text, ids in zip(some, encode([t.encode() for t in some])):
            assert np.frombuffer(ids, "<u4").tolist() == [*library.encode(text, add_special_tokens=False).ids, 2], text


def test_buckets(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    pieces = binary_packing.pack_binary(docs, queries.word_tokenizer(), queries.END_ID)
    path = str(tmp_path / "buckets")
    binary_packing.write_buckets(pieces, path)
    for length in (4096, 512, 1):
        bucket = binary_packing.read_bucket(spark, path, length)
        want = pieces.where(F.col("length") == length)
        assert bucket.count() == want.count() > 0
        assert bucket.where(F.length("ids") != 4 * length).isEmpty()
        files = {f.split("/")[-2] for f in bucket.inputFiles()}
        assert files == {f"length={length}"}
