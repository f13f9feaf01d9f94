"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing names."""

import hashlib

import pytest
from brute import base_spans

import corpus_pipeline
from loadstone.llm import queries, reversible_lines
from loadstone.llm.reversible_lines import CuckooFilter

LONG = "word " * 60_000
SHARED = "A Line that several documents share, word for word"
TEXTS = [
    (1, "plain text of a few words"), (2, None), (3, ""), (4, LONG), (5, "  \t\n \x0b "), (6, "x" * 50_000),
    (7, SHARED + "\nown"), (8, "  " + SHARED.upper() + "\t\nother"), (9, SHARED), (9, SHARED), (10, "été 日本 𝒳 a@b.co 10.0.0.1"),
    (None, "no id at all " + SHARED), (11, "plain text of a few words"), (12, "+1 (212) 555-0100 idiot"),
]


@pytest.fixture(scope="module")
def edge_dir(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("edges"))
    docs = [(i, t, None if n % 4 == 0 else "en", None if n % 3 == 0 else "src", 5, "clash", 1) for n, (i, t) in enumerate(TEXTS)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, `row` string, `key` int"
    spark.createDataFrame(docs, schema).write.parquet(f"{path}/documents.parquet")
    labels = [(i, n % 2, n % 2) for n, (i, _) in enumerate(TEXTS)] + [(99, None, None), (None, 1, 1)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    vectors = [
        (0, [1.0, 0.0], 1), (20, [1.0, 0.0], 1), (21, [2.0, 0.01], 1), (22, [1.0, 0.0], None), (23, None, 1), (24, [None, 1.0], 1),
        (40, [float("nan"), 1.0], 1), (41, [float("inf"), 1.0], 1), (42, [0.0, 0.0], 1), (43, [], 1), (44, [1.0, 0.0, 0.0], 1),
        (21, [2.0, 0.01], 1), (None, [1.0, 0.0], 1), (60, [3e30, 1.0], 2), (61, [3e30, 1.0], 2),
    ]
    spark.createDataFrame([(*v, "x") for v in vectors], "vec_id bigint, embedding array<float>, label int, `rank` string").write.parquet(
        f"{path}/embeddings.parquet"
    )
    turns = [
        (1, 0, "system", "be kind"), (1, 1, "user", None), (1, 2, "assistant", "a <|im_end|> <\\|x| b"), (1, 2, "assistant", "tie"),
        (2, 0, None, "no role"), (3, 0, "assistant", LONG), (3, 1, "as\nsi\\nst\\", "odd role"), (None, 0, "user", "hi"), (4, None, "system", ""),
        (5, 0, "user", "<|im_start|>user\nx"),
    ]
    spark.createDataFrame([(*t, 1) for t in turns], "conv_id bigint, turn bigint, role string, text string, `window` int").write.parquet(
        f"{path}/conversations.parquet"
    )
    return path


@pytest.fixture(scope="module")
def empty_dir(spark, edge_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("empty"))
    for name in ("documents", "labels", "embeddings", "conversations"):
        spark.read.parquet(f"{edge_dir}/{name}.parquet").limit(0).write.parquet(f"{path}/{name}.parquet")
    return path


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_empty_tables(spark, empty_dir, name):
    rows = queries.QUERIES[name](spark, empty_dir).collect()
    assert [r["conv_id"] for r in rows] == ([-1] if name == "op2_chat_windows" else [])


def by_id(rows, name="doc_id"):
    out = {}
    for r in rows:
        out.setdefault(r[name], []).append(r)
    return out


def test_vectors(spark, edge_dir):
    rows = by_id(queries.QUERIES["op1_rp_forest"](spark, edge_dir).collect(), "vec_id")
    assert {i: (r[0]["n_links"], r[0]["component_id"], r[0]["kept"], len(r)) for i, r in rows.items()} == {
        0: (2, 0, True, 1), 20: (2, 0, False, 1), 21: (2, 0, False, 1), 60: (1, 60, True, 1), 61: (1, 60, False, 1),
        **{i: (0, i, True, 1) for i in (22, 23, 24, 40, 41, 42, 43, 44, None)},
    }


def test_top_k(spark, edge_dir):
    rows = by_id(queries.QUERIES["op4_block_topk"](spark, edge_dir).collect(), "query_id")
    assert set(rows) == {0, 20, 60}
    best = sorted((r["rank"], r["vec_id"], r["score"]) for r in rows[0])
    assert best[0] == (1, 60, 2**63 - 1) or best[0][1] == 60
    assert [b[1] for b in best] == [60, 61, 21, 20, 22, 44, 42, 43]
    assert len(rows[20]) == 8 and all(r["vec_id"] != 20 for r in rows[20])


def test_conversations(spark, edge_dir):
    rows = {r["conv_id"]: r for r in queries.QUERIES["op2_chat_windows"](spark, edge_dir).collect()}
    turns = {
        1: [("system", "be kind"), ("user", ""), ("assistant", "a <|im_end|> <\\|x| b"), ("assistant", "tie")],
        2: [("", "no role")], 3: [("assistant", LONG), ("as\nsi\\nst\\", "odd role")], None: [("user", "hi")], 4: [("system", "")],
        5: [("user", "<|im_start|>user\nx")],
        -1: [(r, "<|im_end|><|im_start|>assistant ok") for r in ("user", "assistant")],
    }
    assert set(rows) == set(turns)
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for conv, expected in turns.items():
        loss = "".join(t for r, t in expected if r == "assistant")
        got = rows[conv]
        assert got["n_turns"] == len(expected)
        assert got["turns_sha256"] == digest("".join(f"{r}\n{t}\n" for r, t in expected))
        assert (got["loss_chars"], got["loss_sha256"]) == (len(loss), digest(loss))


def test_personal_data(spark, edge_dir):
    rows = queries.QUERIES["op3_pii_bootstrap"](spark, edge_dir).collect()
    found = sorted((str(r["doc_id"]), r["spans"]) for r in rows)
    joined = lambda t: ",".join(f"{k}:{a}:{b}" for k, a, b in base_spans(t))
    assert found == sorted((str(i), joined(t)) for i, t in TEXTS)


def test_contexts_discover_unseen_identifiers(spark):
    from loadstone.llm import pii_bootstrap

    texts = [f"entry {i} my desk number: +1 (212) 555-01{i:02d} is open" for i in range(9)]
    texts += ["entry z my desk number: 555-0199, is open", "version 555-0200 of it", "code number 12-34"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    spans = {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in pii_bootstrap.find_personal_data(docs).collect()}
    at = texts[9].index("555")
    assert spans[9] == [("phone", at, at + 8, False)]
    assert spans[10] == [] and spans[11] == [] and all(len(spans[i]) == 1 for i in range(9))


def test_contexts_of_seeds_and_unseen_tokens_are_alike(spark):
    from loadstone.llm import pii_bootstrap

    long = "x" * 5000
    heads = ["call a1 b22", "call\n a1 \t b22 ", f"some {long}:", " alone", ""]
    rows = [(f"{head} {hit} {tail}",) for head in heads for hit in ("+12125550100", "555-0199") for tail in ("", "now", "z9 x")]
    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id bigint, text string")
    spans = pii_bootstrap.located(pii_bootstrap.mentions(docs)).where("hit IN ('+12125550100', '555-0199')").collect()
    assert len(spans) == len(rows)
    seen = {kind: sorted((s["left"], s["right"]) for s in spans if s["base"] == kind) for kind in (True, False)}
    assert seen[True] == seen[False]
    short = hashlib.md5(f"{long}:".encode()).hexdigest() + ":"
    lefts = [["a0", "b0"], ["a0", "b0"], ["some", short], ["alone"], []]
    assert seen[True] == sorted((left, right) for left in lefts for right in ([], ["now"], ["z0"]))


@pytest.mark.parametrize("name", ["op5_pairwise_quality", "op7_dictionary_toxicity"])
def test_scores(spark, edge_dir, name):
    rows = queries.QUERIES[name](spark, edge_dir).collect()
    assert len(rows) == len(TEXTS) and all(0 <= r["score"] <= 1 for r in rows)
    same = {r["score"] for r in rows if r["doc_id"] in (1, 11)}
    assert len(same) == 1


def test_packing(spark, edge_dir):
    rows = by_id(queries.QUERIES["op6_binary_packing"](spark, edge_dir).collect())
    assert set(rows) == {i for i, _ in TEXTS}
    for i in (2, 3, 5):
        assert [(r["start"], r["length"], r["doc_tokens"]) for r in rows[i]] == [(0, 1, 1)]
    assert sum(r["length"] for r in rows[4]) == rows[4][0]["doc_tokens"] == 60_001


def test_near_duplicates(spark, edge_dir):
    rows = by_id(queries.QUERIES["op8_fast_minhash"](spark, edge_dir).collect())
    assert {i: (r[0]["n_shingles"], r[0]["component_id"]) for i, r in rows.items() if i in (1, 2, 3, 4, 5, 6, 9, 11)} == {
        1: (4, 1), 2: (0, 2), 3: (0, 3), 4: (1, 4), 5: (0, 5), 6: (1, 6), 9: (7, 7), 11: (4, 1),
    }
    assert len(rows[9]) == 2 and rows[None][0]["component_id"] is None


def test_mixing(spark, edge_dir):
    rows = queries.QUERIES["op9_hash_mixing"](spark, edge_dir).collect()
    assert len(rows) == len(TEXTS)
    total = sum(r["size"] for r in rows)
    targets = {r["target"] for r in rows}
    assert abs(sum(targets) - 1.5 * total) < 1e-6 and all(0 <= r["taken"] <= 2 * r["size"] for r in rows)
    assert all(r["target"] <= 2 * r["source_size"] for r in rows)


def test_lines(spark, edge_dir):
    rows = by_id(queries.QUERIES["op10_reversible_lines"](spark, edge_dir).collect())
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert {i: (r[0]["n_lines"], r[0]["n_dropped"]) for i, r in rows.items()} == {
        1: (1, 0), 2: (1, 0), 3: (1, 0), 4: (1, 0), 5: (2, 0), 6: (1, 0), 7: (2, 1), 8: (2, 1), 9: (1, 0), 10: (1, 0),
        11: (1, 0), 12: (1, 0), None: (1, 0),
    }
    assert rows[7][0]["kept_sha256"] == digest("own") and rows[2][0]["kept_sha256"] == digest("")


def test_line_state_is_reversible(spark):
    lines = [f"this is shared line number {i}" for i in range(5)]
    docs = [(d, "\n".join(lines[: 1 + d % 5])) for d in range(12)]
    make = lambda rows: spark.createDataFrame(rows, "doc_id bigint, text string")
    table = lambda df: sorted(map(tuple, df.collect()))
    half = reversible_lines.build_lines(make(docs[:6]))
    full = reversible_lines.insert_documents(half, make(docs[6:]))
    direct = reversible_lines.build_lines(make(docs))
    assert table(full.counts) == table(direct.counts) and table(full.references) == table(direct.references)
    back = reversible_lines.delete_documents(full, make(docs[6:]).select("doc_id"))
    assert table(back.counts) == table(half.counts)
    keys = [r["key"] for r in full.counts.where("n_docs >= 3").collect()]
    gone = {bytes(k) for k in keys} - {bytes(r["key"]) for r in back.counts.where("n_docs >= 3").collect()}
    has = lambda state, k: any(CuckooFilter.load(r["filter"]).contains([bytes(k)])[0] for r in state.filters.collect())
    assert gone and all(has(full, k) for k in keys) and not any(has(back, k) for k in gone)
    cleaned = {r["row"]["doc_id"]: r["text"] for r in reversible_lines.clean_lines(full, make(docs)).collect()}
    again = {r["row"]["doc_id"]: r["text"] for r in reversible_lines.clean_lines(direct, make(docs)).collect()}
    assert cleaned == again


def test_cuckoo_filter():
    keys = [hashlib.md5(str(i).encode()).digest() for i in range(5000)]
    made = CuckooFilter.of(keys)
    assert made.contains(keys).all()
    others = [hashlib.md5(f"o{i}".encode()).digest() for i in range(5000)]
    assert made.contains(others).mean() < 0.01
    made.remove(keys[:2500])
    assert made.contains(keys[2500:]).all() and made.contains(keys[:2500]).mean() < 0.01
    assert CuckooFilter.load(made.dump()).contains(keys[2500:]).all()


def test_pipeline(spark, edge_dir, empty_dir):
    docs = spark.read.parquet(f"{edge_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, edge_dir)
        assert out.columns == docs.columns, name
        path_rows = out.collect()
        docs = spark.createDataFrame(path_rows, docs.schema)
        if name == "near_dedup":
            ids = [r["doc_id"] for r in path_rows if r["doc_id"] is not None]
            assert len(ids) == len(set(ids)) and not {1, 11} <= set(ids)
    assert corpus_pipeline.run(spark, edge_dir).count() > 0
    assert corpus_pipeline.run(spark, empty_dir).count() == 0


