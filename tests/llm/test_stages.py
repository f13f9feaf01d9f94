"""Stages of the corpus pipeline against plain versions."""

import random
import re
from collections import Counter, defaultdict
from hashlib import md5

import corpus_pipeline
import numpy as np
import pytest

from loadstone.llm import dictionary_toxicity, queries, tables

SF = "/root/testdata/sf0.001"
SPACE = " \t\n\x0b\x0c\r"


@pytest.fixture(params=[tables.FEW_BYTES, -1], ids=["broadcast", "joined"])
def sides(request, monkeypatch):
    """Both ways of the joins whose side may be small."""
    monkeypatch.setattr(tables, "FEW_BYTES", request.param)


@pytest.fixture
def docs(spark):
    """The documents, some of them twice, a null text and a null source among them."""
    read = tables.table(spark, SF, "documents")
    odd = spark.createDataFrame(
        [(-1, None, "xx", "src", 0), (-2, "", "xx", None, 0), (None, "no id at all\n" * 3, "xx", None, 39)], read.schema
    )
    return read.union(read.where("doc_id % 7 = 0")).union(odd)


def key_of(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(SPACE))


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def test_toxicity_like_the_plain_score(spark):
    sf = "/root/testdata/sf0.01"
    docs = tables.table(spark, sf, "documents")
    docs = docs.union(docs.where("doc_id % 7 = 0"))
    model = dictionary_toxicity.train_toxicity(docs.select("doc_id", "text"), tables.table(spark, sf, "labels"))
    counts = model.counter()
    stays = lambda text: model.score(float(model.evidence(counts(text)))) < corpus_pipeline.TOXIC
    want = Counter(tuple(r) for r in docs.collect() if stays(r["text"]))
    out = corpus_pipeline.reject_toxic(spark, docs, sf)
    assert out.columns == docs.columns and Counter(tuple(r) for r in out.collect()) == want
    assert 0 < sum(want.values()) < docs.count()


def test_line_dedup_like_plain_lines(spark, docs, sides):
    rows, holders = docs.collect(), defaultdict(set)
    for r in rows:
        for line in (r["text"] or "").split("\n"):
            if r["doc_id"] is not None and len(key_of(line)) >= 20:
                holders[key_of(line)].add(r["doc_id"])
    last = {k: max(v) for k, v in holders.items() if len(v) >= 3}
    want = Counter()
    for r in rows:
        lines = (r["text"] or "").split("\n")
        gone = lambda x: r["doc_id"] is not None and last.get(key_of(x), r["doc_id"]) != r["doc_id"]  # noqa: E731, B023
        text = "\n".join(x for x in lines if not gone(x))
        want[r["doc_id"], text, r["lang"], r["source"], len(text)] += 1
    out = corpus_pipeline.drop_repeated_lines(spark, docs, SF)
    assert last and out.columns == docs.columns
    assert Counter(tuple(r) for r in out.select("doc_id", "text", "lang", "source", "n_chars").collect()) == want


def test_mixing_like_a_sorted_walk(spark, docs, sides):
    rows = docs.collect()
    sizes = Counter()
    for r in rows:
        sizes[r["source"]] += words(r["text"])
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    targets, free = {}, set(names)
    while free:
        level = (1.5 * sum(sizes.values()) - sum(targets.values())) / sum(weights[s] for s in free)
        full = {s for s in free if level * weights[s] > 2 * sizes[s]}
        targets |= {s: 2 * sizes[s] if s in full else level * weights[s] for s in (full or free)}
        free = free - full if full else set()
    want = Counter()
    for source in names:
        places = defaultdict(list)
        for r in rows:
            if r["source"] == source:
                name = "" if r["doc_id"] is None else str(r["doc_id"])
                places[md5(f"{name}\n{r['text'] or ''}".encode()).hexdigest()[:15]].append(r)
        passes = int(targets[source] // sizes[source]) if sizes[source] else 0
        need, taken, open_ = targets[source] - passes * sizes[source], 0, True
        for at in sorted(places):
            more = sum(words(r["text"]) for r in places[at])
            once = open_ and (taken + more <= need or taken + more - need < need - taken)
            open_ = open_ and taken + more <= need
            taken += more
            for r in places[at]:
                want[r["doc_id"], r["text"], r["source"]] += passes + once
    out = Counter(tuple(r) for r in corpus_pipeline.mix_sources(spark, docs, SF).select("doc_id", "text", "source").collect())
    sized = lambda found: {k: n for k, n in found.items() if n and words(k[1])}
    assert sized(out) == sized(want)


def test_packing_like_the_library(spark, docs):
    from tokenizers import Tokenizer

    library = Tokenizer.from_str(queries.word_tokenizer())
    want = Counter(
        (r["doc_id"], np.array([*library.encode(r["text"] or "", add_special_tokens=False).ids, 2], "<u4").tobytes())
        for r in docs.collect()
    )
    pieces = defaultdict(list)
    for r in corpus_pipeline.pack_documents(spark, docs, SF).collect():
        assert len(r["ids"]) == 4 * r["length"] and r["length"] & (r["length"] - 1) == 0 and r["length"] <= queries.LONGEST
        # Pieces of equal documents hold equal ids.
        pieces[r["doc_id"], r["doc_tokens"]].append((r["start"], bytes(r["ids"])))
    out = Counter()
    for (doc_id, tokens), found in pieces.items():
        times = Counter(found)
        joined = b"".join(ids for _, ids in sorted(times))
        assert len(joined) == 4 * tokens and len(set(times.values())) == 1
        out[doc_id, joined] = next(iter(times.values()))
    assert out == want


def test_near_dedup_goes_by_row(spark, sides):
    rng = random.Random(3)
    words = [f"word{i}" for i in range(500)]
    texts = [" ".join(rng.choices(words, k=60)) for _ in range(8)]
    near = texts[0] + " end"
    rows = [
        (1, texts[0]), (5, near), (5, texts[1]), (6, texts[2]), (6, texts[3]), (6, texts[3]),
        (7, texts[4]), (None, texts[4]), (None, texts[5]), (None, texts[5] + " end"), (8, None), (8, ""), (9, texts[6]),
    ]
    docs = spark.createDataFrame([(*r, n) for n, r in enumerate(rows)], "doc_id bigint, text string, key int").repartition(3)
    out = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert out.columns == docs.columns
    found = sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=str)
    null = [r for r in found if r[0] is None]
    assert len(null) == 1 and null[0][1].startswith(texts[5])
    assert [r for r in found if r[0] is not None] == sorted(
        [(1, texts[0]), (5, texts[1]), (6, texts[2]), (6, texts[3]), (7, texts[4]), (8, None), (8, ""), (9, texts[6])], key=str
    )
