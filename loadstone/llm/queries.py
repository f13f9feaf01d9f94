"""The registered queries of the operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadstone.llm import (
    binary_packing,
    block_topk,
    chat_windows,
    dictionary_toxicity,
    fast_minhash,
    filter_audit,
    hash_mixing,
    merge_automaton,
    pairwise_quality,
    pii_bootstrap,
    reversible_lines,
    rp_forest,
    turn_repair,
)
from loadstone.llm.tables import table, written

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

END_ID = 2
LONGEST = 4096


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def tokenizer_file(name: str) -> str:
    """The public tokenizer file a query is defined by."""
    import public_tokenizers

    return Path(public_tokenizers.path(name)).read_text(encoding="utf-8")


def word_tokenizer() -> str:
    return tokenizer_file("word_bpe_49k.json")


def byte_tokenizer() -> str:
    return tokenizer_file("byte_bpe_50k.json")


@query("op6_binary_packing")
def op6_binary_packing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    pieces = binary_packing.pack_binary(docs, word_tokenizer(), END_ID, longest=LONGEST)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset",
    )


_MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || chr(10) || coalesce(text, '')), 1, 15)
      AS BIGINT) AS place
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    [5, 2, 1][(row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1] AS weight
  FROM sized GROUP BY source),
levels AS (
  SELECT *, 2 * source_size AS cap,
    row_number() OVER w AS nth,
    (CAST(sum(source_size) OVER () AS DOUBLE) * 1.5
      - CAST(coalesce(sum(2 * source_size) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE))
    / CAST(sum(weight) OVER ()
      - coalesce(sum(weight) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE) AS level
  FROM sources
  WINDOW w AS (ORDER BY CAST(2 * source_size AS DOUBLE) / weight, source ASC NULLS LAST)),
goals AS (
  SELECT source, source_size, coalesce(least(CAST(cap AS DOUBLE), weight * (
      SELECT min_by(level, nth) FROM levels WHERE level <= CAST(cap AS DOUBLE) / weight)),
    CAST(cap AS DOUBLE)) AS target
  FROM levels),
needs AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS passes
  FROM goals),
running AS (
  SELECT s.*, n.source_size, n.target, n.passes, n.target - n.passes * n.source_size AS need,
    sum(size) OVER (PARTITION BY s.source ORDER BY place RANGE UNBOUNDED PRECEDING) AS upto,
    sum(size) OVER (PARTITION BY s.source, place) AS here
  FROM sized s JOIN needs n ON s.source IS NOT DISTINCT FROM n.source)
SELECT doc_id, size, source_size, target,
  size * (passes + CAST(need > 0 AND (upto <= need OR (upto - here <= need
    AND upto - need < need - (upto - here))) AS INT)) AS taken
FROM running"""


@query("op9_hash_mixing", _MIX_SQL)
def op9_hash_mixing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    sized = hash_mixing.measure(docs).select(
        "source", "size", "place", F.struct("row.doc_id").alias("row")
    )
    sized = written(sized, "mix-sizes")
    mixed = hash_mixing.apply_mix(sized, hash_mixing.plan_mix(sized))
    return mixed.select(
        "row.doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


_LINES_SQL = r"""
WITH lines AS (
  SELECT doc_id, nth, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS nth
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents))),
often AS (
  SELECT key, max(doc_id) AS last_doc FROM lines WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
marked AS (
  SELECT l.doc_id, l.nth, l.line, o.key IS NOT NULL AND l.doc_id <> o.last_doc AS dropped
  FROM lines l LEFT JOIN often o USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY nth) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id"""


@query("op10_reversible_lines", _LINES_SQL)
def op10_reversible_lines(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    state = reversible_lines.build_lines(docs)
    cleaned = reversible_lines.clean_lines(state, docs, refs=state.references)
    return cleaned.select(
        "row.doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256")
    )


@query("op8_fast_minhash")
def op8_fast_minhash(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return fast_minhash.near_duplicates(docs, shingle=3, percent=85)


@query("op5_pairwise_quality")
def op5_pairwise_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = pairwise_quality.described(docs)
    model = pairwise_quality.train_described(rows, table(spark, sf_dir, "labels"), threshold=0.3)
    return pairwise_quality.score_described(rows, model)


@query("op7_dictionary_toxicity")
def op7_dictionary_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = dictionary_toxicity.train_toxicity(docs, table(spark, sf_dir, "labels"))
    scored = dictionary_toxicity.score_toxicity(docs, model)
    return scored.select(
        "doc_id",
        F.col("toxicity_held_out").alias("held_out"),
        F.col("toxicity_score").alias("score"),
        (F.col("toxicity_score") >= 0.5).cast("int").alias("predicted"),
    )


_TOP_SQL = """
WITH rows AS (
  SELECT vec_id, [floor(64 * CAST(x AS DOUBLE)) FOR x IN max(embedding)] AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
  GROUP BY vec_id),
scored AS (
  SELECT q.vec_id AS query_id, d.vec_id, CAST(list_dot_product(q.v, d.v) AS BIGINT) AS score
  FROM rows q JOIN rows d ON q.vec_id % 20 = 0 AND q.vec_id <> d.vec_id),
ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank,
    vec_id, score FROM scored)
SELECT * FROM ranked WHERE rank <= 20"""


@query("op4_block_topk", _TOP_SQL)
def op4_block_topk(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return block_topk.top_k(vectors, F.col("vec_id") % 20 == 0, k=20)


@query("op1_rp_forest")
def op1_rp_forest(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    return rp_forest.near_vectors(vectors, threshold=0.93)


BUDGET, HISTORY, LEAST_SPAN = 1024, 192, 256
_CONTROL = "<|im_end|><|im_start|>assistant ok"

_CHAT_SQL = rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{_CONTROL}' UNION ALL SELECT -1, 1, 'assistant', '{_CONTROL}'),
sized AS (
  SELECT *, CAST(ceil(length(text) / 4.0) AS BIGINT) + 4 AS tokens,
    24 + length(regexp_replace(replace(replace(role, chr(92), chr(92) || chr(92)), chr(10), chr(92) || 'n'), '<(\\*)\|', '<\\\1|', 'g'))
      + length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g')) AS chars
  FROM turns),
summed AS (
  SELECT *, row_number() OVER w AS pos, sum(tokens) OVER w AS upto,
    first_value(role) OVER w AS head, first_value(tokens) OVER w AS head_tokens, first_value(chars) OVER w AS head_chars
  FROM sized WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING)),
placed AS (
  SELECT *, upto - tokens AS start, CASE WHEN head = 'system' THEN head_tokens ELSE 0 END AS kept FROM summed),
cells AS (
  SELECT *, greatest({BUDGET - HISTORY} - kept, {LEAST_SPAN}) AS step,
    [floor((start - kept) / greatest({BUDGET - HISTORY} - kept, {LEAST_SPAN})),
     floor((upto - kept - 1) / greatest({BUDGET - HISTORY} - kept, {LEAST_SPAN}))] AS cell
  FROM placed),
marked AS (
  SELECT *, pos > 1 AND cell <> lag(cell) OVER (PARTITION BY conv_id ORDER BY start)
      AND NOT (pos = 2 AND head = 'system') AS begins,
    CASE WHEN head = 'system' THEN head_chars ELSE 0 END + coalesce(
      sum(CASE WHEN pos = 1 AND head = 'system' THEN 0 ELSE chars END) OVER (PARTITION BY conv_id ORDER BY start
        RANGE BETWEEN {HISTORY} PRECEDING AND 1 PRECEDING), 0) AS repeated
  FROM cells)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars + CASE WHEN begins THEN repeated ELSE 0 END) AS BIGINT) AS formatted_chars
FROM marked GROUP BY conv_id"""


@query("op2_chat_windows", _CHAT_SQL)
def op2_chat_windows(spark, sf_dir):
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(_CONTROL).alias("text"),
    )
    formatted = chat_windows.format_windows(
        given.union(extra), budget=BUDGET, history=HISTORY, least=LEAST_SPAN
    )
    return chat_windows.read_conversations(formatted).select(
        "conv_id",
        "n_turns",
        F.sha2("turns", 256).alias("turns_sha256"),
        F.char_length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )


@query("op3_pii_bootstrap")
def op3_pii_bootstrap(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii_bootstrap.find_personal_data(docs)
    written_out = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
    base = F.filter("spans", lambda s: s["base"])
    count = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("bigint")
    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in pii_bootstrap.KINDS],
        F.sha2(written_out(base), 256).alias("base_sha256"),
        written_out(F.col("spans")).alias("spans"),
    )


_AUDIT_SQL = r"""
WITH texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
marks AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
flags AS (
  SELECT t.doc_id, part, len(words) < 200 AS a, 100 * len(list_distinct(words)) < 50 * len(words) AS b,
    100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text) AS c,
    regexp_matches(text, '[#$%&*|]') AS d,
    coalesce(t.doc_id > min(t.doc_id) OVER (PARTITION BY text), false) AS e,
    coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic
  FROM texts t LEFT JOIN marks USING (doc_id)),
sets AS (
  SELECT part, a::INT + 2 * b::INT + 4 * c::INT + 8 * d::INT + 16 * e::INT AS fails,
    count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM flags GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l),
orders AS (
  SELECT v.l || w.l || x.l || y.l || z.l AS filter_order
  FROM letters v, letters w, letters x, letters y, letters z
  WHERE len(list_distinct([v.l, w.l, x.l, y.l, z.l])) = 5),
steps AS (
  SELECT filter_order, step, letter, 1 << (ascii(letter) - 65) AS bit,
    coalesce((SELECT sum(1 << (ascii(filter_order[i]) - 65)) FROM range(1, step) r(i)), 0)::INT AS before
  FROM (SELECT filter_order, unnest(range(1, 6))::INT AS step, filter_order[step] AS letter FROM orders)),
counted AS (
  SELECT part, filter_order, step, letter,
    coalesce(sum(n) FILTER (fails & (before | bit) = 0), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (fails & before = 0 AND fails & bit != 0), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (fails & before != 0 AND fails & bit != 0), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (fails = bit), 0)::BIGINT AS unique_fails,
    coalesce(sum(good) FILTER (fails & before = 0 AND fails & bit != 0), 0)::BIGINT AS good_lost,
    coalesce(sum(toxic) FILTER (fails & before = 0 AND fails & bit != 0), 0)::BIGINT AS toxic_lost
  FROM sets, steps GROUP BY part, filter_order, step, letter)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley
FROM counted"""


@query("op13_filter_audit", _AUDIT_SQL)
def op13_filter_audit(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return filter_audit.audit_filters(docs, table(spark, sf_dir, "labels"))


_REPAIR_SQL = r"""
WITH RECURSIVE given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    [ascii(x) FOR x IN string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), '')] AS bytes
  FROM conversations),
fated AS (
  SELECT *, xor(list_reduce([4294967295::BIGINT] || bytes::BIGINT[], lambda c, b:
    list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 20 AS fate
  FROM given),
live AS (
  SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
    CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN fate = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM fated WHERE fate > 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS i FROM live),
judged AS (
  SELECT *, left(role, 1) AS initial, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before
  FROM placed),
faults AS (
  SELECT *, CASE WHEN bare = '' THEN 'blank' WHEN again THEN 'duplicate'
    WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM judged),
counted AS (
  SELECT conv_id, count(*) AS n,
    coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (i > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faults GROUP BY conv_id),
hops(s, mid, letters, cost, added) AS (VALUES
  (0, 0, '', 0, []::VARCHAR[]), (1, 1, '', 0, []), (2, 2, '', 0, []), (3, 3, '', 0, []),
  (0, 2, 'I', 2, ['user:']), (1, 2, 'I', 2, ['user:']), (3, 2, 'I', 2, ['user:']), (2, 3, 'I', 2, ['assistant:']),
  (0, 3, 'II', 4, ['user:', 'assistant:']), (1, 3, 'II', 4, ['user:', 'assistant:'])),
kept(mid, t, initial) AS (VALUES (0, 1, 's'), (0, 2, 'u'), (1, 2, 'u'), (3, 2, 'u'), (2, 3, 'a')),
arcs AS (
  SELECT f.conv_id, f.i, h.s, e.t, {'cost': h.cost + e.cost, 'audit': h.letters || e.letter, 'body': h.added || e.body} AS w
  FROM faults f, hops h, LATERAL (
    SELECT h.mid AS t, 3 AS cost, 'D' AS letter, []::VARCHAR[] AS body
    UNION ALL SELECT k.t, (f.fault = 'truncated')::INT, 'K', [f.role || ':' || f.text] FROM kept k
      WHERE k.mid = h.mid AND k.initial = f.initial AND f.fault IN ('', 'truncated')
    UNION ALL SELECT CASE h.mid WHEN 2 THEN 3 ELSE 2 END, 2 + (f.fault = 'truncated')::INT, 'R',
      [CASE h.mid WHEN 2 THEN 'assistant:' ELSE 'user:' END || f.text] WHERE f.fault IN ('', 'truncated')) e),
steps AS (
  SELECT conv_id, i, s, t, min(w) AS w FROM arcs GROUP BY ALL),
paths AS (
  SELECT conv_id, 0::BIGINT AS i, 0 AS s, {'cost': 0, 'audit': '', 'body': []::VARCHAR[]} AS w FROM counted
  UNION ALL
  SELECT p.conv_id, p.i + 1, a.t,
    min({'cost': p.w.cost + a.w.cost, 'audit': p.w.audit || a.w.audit, 'body': p.w.body || a.w.body})
  FROM paths p JOIN steps a ON a.conv_id = p.conv_id AND a.i = p.i + 1 AND a.s = p.s
  GROUP BY p.conv_id, p.i, a.t),
ended AS (
  SELECT p.conv_id, min({'cost': p.w.cost + 2 * length(e.letters), 'audit': p.w.audit || e.letters, 'body': p.w.body || e.body}) AS w
  FROM paths p JOIN counted c ON c.conv_id = p.conv_id AND c.n = p.i
  JOIN (VALUES (0, '', []::VARCHAR[]), (1, 'II', ['user:', 'assistant:']), (2, 'I', ['assistant:']), (3, '', [])) e(s, letters, body)
    ON e.s = p.s
  GROUP BY p.conv_id)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
  coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
  coalesce(illegal, 0)::BIGINT AS illegal, coalesce(w.cost, 0)::BIGINT AS cost, coalesce(w.audit, '') AS audit,
  sha256(coalesce(array_to_string(w.body, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counted USING (conv_id) LEFT JOIN ended USING (conv_id)"""


@query("op11_turn_repair", _REPAIR_SQL)
def op11_turn_repair(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return turn_repair.repair_conversations(turn_repair.damaged_turns(turns), live="live").digests()


@query("op12_merge_automaton")
def op12_merge_automaton(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = merge_automaton.encode_documents(docs, byte_tokenizer())
    return merge_automaton.decode_documents(encoded, byte_tokenizer()).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )
