"""MinHash near-dedup with fast similarity sketches.

A sketch has ``bins`` coordinates. In each of the first ``bins`` rounds every
shingle is hashed to one bin with a value; a bin keeps the smallest value of the
first round that reaches it. In the next ``bins`` rounds, round i sends everything
to bin i, so every coordinate fills; long documents are done after a round or two.
Agreement of two sketches is then concentrated around the similarity of the sets.

Documents with equal sets form a class, and one representative of each goes on.
Bands of the sketch put representatives into buckets. In each bucket all others are
compared, on their whole sets, with the smallest one; this links nearly everything
that is alike. Only buckets whose members still lie in different components are
compared pair by pair, in blocks, across components. No bucket is capped, no pair
of a bucket is emitted as a row, and a bucket of any size spreads over tasks.

Null or empty text, or text of white space: an empty set, linked with nothing. A
null id: linked with nothing. Rows that repeat a doc_id are one node and share its
component. Empty table: no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadstone.llm.components import connected_components
from loadstone.llm.tables import bounded_batches, column, give_back_memory, small_side, written

BANDS, ROWS = 20, 4
BLOCK = 256  # documents that one comparing task takes beside its leader or other block

_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX2 = np.uint64(0xD6E8FEB86659FD93)
_LOW = np.uint64(0xFFFFFFFF)
_HALF = np.uint64(32)
_EMPTY = np.uint64(2**64 - 1)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _HALF)) * _MIX2
    x = (x ^ (x >> _HALF)) * _MIX2
    return x ^ (x >> _HALF)


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z lowered: just what bytes do."""
    return (text or "").encode().lower().split()


def shingle_set(words: list[bytes], k: int) -> set[tuple[bytes, ...]]:
    if len(words) < k:
        return {tuple(words)} if words else set()
    return set(zip(*(words[i:] for i in range(k))))


def shingle_hashes(words: list[bytes], k: int) -> np.ndarray:
    """Distinct 64-bit hashes of the shingles, sorted."""
    from xxhash import xxh3_64_intdigest

    hashes = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))
    if not words:
        return hashes
    n = max(1, len(words) - k + 1)
    combined = np.full(n, np.uint64(min(k, len(words))))
    for i in range(min(k, len(words))):
        combined = mixed(combined ^ hashes[i : i + n]) + _MIX
    return np.unique(combined)


def similarity_sketch(items: np.ndarray, bins: int) -> np.ndarray:
    """The sketch of a non-empty set of 64-bit hashes."""
    out = np.full(bins, _EMPTY)
    seeds = mixed(np.arange(1, 2 * bins + 1, dtype=np.uint64) * _MIX)
    done = 0
    while done < 2 * bins and (out == _EMPTY).any():
        # Several rounds at a time for small sets; a later round never replaces an earlier one.
        turns = np.arange(done, min(2 * bins, done + max(1, 4 * bins // len(items))), dtype=np.uint64)
        h = mixed(items[None, :] ^ seeds[turns.astype(np.int64)][:, None])
        free = ((h >> _HALF) * np.uint64(bins)) >> _HALF
        where = np.where(turns[:, None] < bins, free, turns[:, None] % np.uint64(bins))
        np.minimum.at(out, where.ravel().astype(np.int64), (turns[:, None] << np.uint64(40) | (h & _LOW)).ravel())
        done += len(turns)
    return out


def band_hashes(sketch: np.ndarray, bands: int) -> np.ndarray:
    parts = sketch.reshape(bands, -1)
    h = np.arange(1, bands + 1, dtype=np.uint64) * _MIX
    for i in range(parts.shape[1]):
        h = mixed(h ^ parts[:, i]) + _MIX
    return h.view(np.int64)


def sketch_documents(
    docs: DataFrame, doc_id: str, text: str, shingle: int, bands: int, rows: int
) -> DataFrame:
    """(doc_id, n_shingles, digest, bands) of every row; empty sets have neither of the last two."""
    from xxhash import xxh3_128_digest

    bounded_batches(docs.sparkSession)
    given = docs.select(column(docs, doc_id).cast("bigint").alias("doc_id"), column(docs, text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, bucket = [], [], []
            for value in batch.column(1):
                items = shingle_hashes(words_of(value.as_py()), shingle)
                sizes.append(len(items))
                full = len(items) > 0
                digests.append(xxh3_128_digest(items.tobytes()) if full else None)
                bucket.append(band_hashes(similarity_sketch(items, bands * rows), bands) if full else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array(bucket, pa.list_(pa.int64())),
                ],
                names=["doc_id", "n_shingles", "digest", "bands"],
            )
        give_back_memory()  # idle workers are kept beside those of later stages

    return given.mapInArrow(run, "doc_id bigint, n_shingles bigint, digest binary, bands array<bigint>")


def alike(common: int, a: int, b: int, percent: int) -> bool:
    return 100 * common >= percent * (a + b - common)


def _compare_to_leader(units: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Links (a, b) of each unit's documents to the unit's leader."""

    def run(group: pa.Table) -> pa.Table:
        leader = group.column("leader")[0].as_py()
        sets = [
            (d, shingle_set(words_of(t), shingle))
            for d, t in zip(group.column("doc").to_pylist(), group.column("text").to_pylist())
        ]
        heads = [s for d, s in sets if d == leader]
        linked = sorted(
            {d for d, s in sets for h in heads if d != leader and alike(len(s & h), len(s), len(h), percent)}
        )
        return pa.table({"a": pa.array([leader] * len(linked), pa.int64()), "b": pa.array(linked, pa.int64())})

    return units.groupBy("leader", "part").applyInArrow(run, "a bigint, b bigint")


def _compare_blocks(units: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Links between the components that one pair of blocks has alike documents of:
    enough of them to join these, one for each join."""

    def run(group: pa.Table) -> pa.Table:
        comps = group.column("component").to_pylist()
        sets = [shingle_set(words_of(t), shingle) for t in group.column("text").to_pylist()]
        root = {c: c for c in comps}

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        common, sizes = common_counts(sets), np.array([len(s) for s in sets])
        either = sizes[:, None] + sizes[None, :] - common
        left, right = np.nonzero(np.triu(100 * common >= percent * either, 1))
        a, b = [], []
        for i, j in zip(left.tolist(), right.tolist()):
            x, y = find(comps[i]), find(comps[j])
            if x != y:
                root[max(x, y)] = min(x, y)
                a.append(comps[i])
                b.append(comps[j])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return units.groupBy("band", "left", "right").applyInArrow(run, "a bigint, b bigint")


def common_counts(sets: list[set]) -> np.ndarray:
    """Exact sizes of all pairwise intersections, by products of incidence blocks."""
    held: dict = {}
    for i, s in enumerate(sets):
        for item in s:
            held.setdefault(item, []).append(i)
    shared = [rows for rows in held.values() if len(rows) > 1]
    out = np.zeros((len(sets), len(sets)), np.int64)
    np.fill_diagonal(out, [len(s) for s in sets])
    off = ~np.eye(len(sets), dtype=bool)
    for start in range(0, len(shared), 4096):
        block = np.zeros((len(sets), 4096), np.float32)
        for k, rows in enumerate(shared[start : start + 4096]):
            block[rows, k] = 1
        out += (block @ block.T).astype(np.int64) * off
    return out


def near_duplicates(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = 5,
    percent: int = 80,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row.

    Documents whose sets have a Jaccard similarity of at least ``percent`` / 100 are
    linked; the component is the smallest id reachable by links.
    """
    sketches = written(sketch_documents(docs, doc_id, text, shingle, bands, rows), "sketches")
    usable = sketches.where("digest IS NOT NULL AND doc_id IS NOT NULL")
    classes = written(
        usable.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.any_value("bands").alias("bands")),
        "sketch-classes",
    )
    members = classes.select("rep", F.explode("bands").alias("band"))
    heads = members.groupBy("band").agg(F.min("rep").alias("leader"), F.max("rep").alias("most"))
    filled = written(
        members.join(heads.where("leader != most"), "band").select("band", "leader", "rep"), "buckets"
    )
    again = usable.groupBy(F.col("doc_id").alias("doc")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    wanted = filled.select(F.col("rep").alias("doc")).distinct()
    wanted = written(wanted.join(again, "doc", "left").select("doc", F.col("n").isNotNull().alias("again")), "bucket-ids")
    texts = written(
        docs.select(column(docs, doc_id).cast("bigint").alias("doc"), column(docs, text).alias("text")).join(
            small_side(wanted), "doc"
        ),
        "bucket-texts",
    )
    # An id on many rows brings each of its texts once.
    once = texts.where("again").withColumn("digest", F.md5("text")).dropDuplicates(["doc", "digest"])
    texts = texts.where("NOT again").select("doc", "text").union(once.select("doc", "text"))

    pairs = filled.where("rep != leader").select("leader", "rep").distinct()
    parts = pairs.groupBy("leader").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("parts"))
    dealt = pairs.join(parts, "leader").select(
        "leader", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int").alias("part"), F.col("rep").alias("doc")
    )
    repeated = parts.select(
        "leader", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("leader").alias("doc")
    )
    units = dealt.union(repeated).join(texts, "doc")
    links = _compare_to_leader(units, shingle, percent).union(_shared_ids(usable, classes))
    links = written(links, "leader-links")
    found = connected_components(links)

    rest = _open_buckets(filled, found)
    blocks = written(_compare_blocks(rest.join(texts, "doc"), shingle, percent), "block-links")
    placed = classes.join(found, F.col("rep") == F.col("id"), "left").select(
        F.col("digest").alias("of"), F.coalesce("component", "rep").alias("first")
    )
    joined = connected_components(blocks)
    known = placed.join(joined, F.col("first") == F.col("id"), "left").select(
        "of", F.coalesce("component", "first").alias("component_id")
    )
    linked = usable.join(known, F.col("digest") == F.col("of")).select("doc_id", "n_shingles", "component_id")
    alone = sketches.where("digest IS NULL OR doc_id IS NULL").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id")
    )
    return linked.union(alone).select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    )


def _shared_ids(usable: DataFrame, classes: DataFrame) -> DataFrame:
    """Links (a, b) that join the classes of an id that comes with several texts."""
    several = usable.groupBy("doc_id").agg(F.min("digest").alias("low"), F.max("digest").alias("high"))
    several = several.where("low != high").select("doc_id")
    rows = usable.join(several, "doc_id", "left_semi").select("doc_id", "digest")
    return rows.join(classes, "digest").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))


def _open_buckets(filled: DataFrame, found: DataFrame) -> DataFrame:
    """(band, left, right, doc, component): the members of buckets that still hold
    several components, in pairs of blocks. Equal buckets of several bands count once."""
    placed = filled.join(found, F.col("rep") == F.col("id"), "left").select(
        "band", "rep", F.coalesce("component", "rep").alias("component")
    )
    buckets = placed.groupBy("band").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64("rep").cast("decimal(20,0)")).alias("mark"),
        F.min("rep").alias("first"),
        F.min("component").alias("low"),
        F.max("component").alias("high"),
    )
    # In a bucket of two, the leader has met the other one already.
    chosen = (
        buckets.where("low != high AND n > 2")
        .groupBy("n", "mark", "first")
        .agg(F.min("band").alias("band"))
        .select("band", F.ceil(F.col("n") / BLOCK).cast("int").alias("parts"))
    )
    own = F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int")
    spread = placed.join(chosen, "band").select(
        "band", "component", F.col("rep").alias("doc"), own.alias("own"),
        F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"),
    )
    return spread.select(
        "band", F.least("own", "other").alias("left"), F.greatest("own", "other").alias("right"), "doc", "component"
    )
