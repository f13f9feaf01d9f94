"""The automaton beside the tokenizers library."""

import hashlib
import random

import numpy as np
import pytest

from loadstone.llm import merge_automaton, queries
from loadstone.llm.merge_automaton import Encoder, compile_merges


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_str(queries.byte_tokenizer())


@pytest.fixture(scope="module")
def automaton():
    return compile_merges(queries.byte_tokenizer())


@pytest.fixture
def same(library, automaton):
    encoder = Encoder(automaton)

    def check(text):
        ids = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == ids, text[:200]
        assert encoder.decode(np.array(ids, "<u4").tobytes()) == library.decode(ids, skip_special_tokens=False)

    return check


def test_mixed_texts(same):
    rng = random.Random(4)
    parts = [
        "a", "e", "t", "th", " ", "  ", "\n", "\t", "é", "日本", "\U0001f600", "0", "12", "'s", "'ll", "!", "...", "=", "--", "\x1c", "\x85",
        "　", "̀", "²", "<|endoftext|>", "<|", "\U0002f801", "₏", "ing", " the", "͸", "՘", "\x00",
    ]
    for _ in range(5000):
        same("".join(rng.choices(parts, k=rng.randint(0, 30))))
    for _ in range(3000):
        same("".join(rng.choices("aeiou stnr", k=rng.randint(0, 80))))
    for _ in range(3000):
        same("".join(chr(rng.choice([rng.randint(97, 122), rng.randint(32, 126), rng.randint(1, 0x2FFF)])) for _ in range(40)))


def test_long_words_and_chunks(same, monkeypatch):
    for unit in ("a", " ", "-", "=", "e_", "aaab", "thethin", "xq"):
        same(unit * 5000)
    monkeypatch.setattr(merge_automaton, "AT_ONCE", 50)
    same("It is, he's told, 12  of  them\n\n and we'll go on " * 50)
    monkeypatch.setattr(merge_automaton, "REMEMBERED", 10)
    same("one two three four five six seven eight nine ten eleven twelve one two " * 20)


def test_arcs_agree_with_merging_of_pairs(automaton, library):
    """Two tokens follow each other just if the merges leave them as they are."""
    rng = random.Random(6)
    encoder = Encoder(automaton)
    words = [t for t in automaton.state_of if automaton.labels[t].isalpha() and automaton.labels[t].isascii()]
    for _ in range(4000):
        a, b = rng.choice(words), rng.choice(words[:400])
        text = (automaton.labels[a] + automaton.labels[b]).decode()
        kept = library.encode(text, add_special_tokens=False).ids == [a, b]
        assert encoder.arcs[automaton.state_of[a] << 32 | b] == kept


def test_new_words_walk_together(automaton, library, monkeypatch):
    """Words that a task has not met are not walked one by one, the longest ones apart."""
    rng = random.Random(8)
    parts = ["a", "e", "t", "th", "é", "日本", "ó", "0", "12", "!", "=", "ing", "ción", "̀", "ß", "\U0001f600", "\x1c", "aaab", " "]
    texts = ["", *(" ".join("".join(rng.choices(parts, k=rng.randint(1, 14))) for _ in range(rng.randint(1, 60))) for _ in range(300))]
    texts += ["<|endoftext|>", "xq<|endoftext|><|endoftext|> e" + texts[5], "x" * 500, "  \n \t"]
    walked = []
    by_one = Encoder.path
    monkeypatch.setattr(Encoder, "path", lambda self, word: walked.append(word) or by_one(self, word))
    joined = np.frombuffer(Encoder(automaton).encode("\n".join(texts)), "<u4").tolist()
    assert joined == library.encode("\n".join(texts), add_special_tokens=False).ids
    assert walked == [b"x" * 500]
    ids = [np.frombuffer(x, "<u4").tolist() for x in Encoder(automaton).encode_all(texts)]
    assert ids == [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]
    assert walked == [b"x" * 500] * 2
    monkeypatch.setattr(merge_automaton, "AT_ONCE", 2000)
    monkeypatch.setattr(merge_automaton, "REMEMBERED", 100)
    monkeypatch.setattr(merge_automaton, "TOGETHER", 20)
    assert [np.frombuffer(x, "<u4").tolist() for x in Encoder(automaton).encode_all(texts)] == ids


def test_paths_agree_with_one_path(automaton):
    rng = random.Random(9)
    words = [bytes(rng.choices(rng.choice([b"aeiou stnr", b"ab", bytes(range(256))]), k=rng.randint(0, 40))) for _ in range(4000)]
    encoder = Encoder(automaton)
    assert automaton.paths(words) == [encoder.path(w) for w in words]
    assert automaton.paths([]) == [] and automaton.paths([b""]) == [b""]


def test_ascii_words_are_those_of_the_pattern(automaton):
    rng = random.Random(10)
    encoder = Encoder(automaton)
    for _ in range(3000):
        text = "".join(chr(rng.choice([rng.randint(0, 127), rng.choice(b"'stmdrevl \n0a")])) for _ in range(60))
        assert encoder.find_ascii_words(text) == encoder.find_words(text)


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError, match="byte-level"):
        compile_merges(queries.word_tokenizer())


def expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    digest = lambda b: hashlib.sha256(b).hexdigest()
    return len(ids), digest(np.array(ids, "<u4").tobytes()), digest(library.decode(ids, skip_special_tokens=False).encode())


def test_query(spark, library):
    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.QUERIES["op12_merge_automaton"](spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == expected(library, texts[r["doc_id"]])


def test_edges(spark, library, tmp_path):
    texts = [(1, None), (2, ""), (3, "word " * 300_000), (4, "x" * 200_000), (5, "<|endoftext|>"), (5, "<|endoftext|>"), (None, " \n"), (6, "\x00é")]
    docs = spark.createDataFrame([(*t, b"x") for t in texts], "doc_id bigint, text string, ids binary")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    rows = queries.QUERIES["op12_merge_automaton"](spark, str(tmp_path)).collect()
    found = sorted((str(r["doc_id"]), r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in rows)
    assert found == sorted((str(i), *expected(library, t)) for i, t in texts)
    docs.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert queries.QUERIES["op12_merge_automaton"](spark, f"{tmp_path}/none").collect() == []
