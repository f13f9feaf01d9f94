"""Exact top-k inner products by block-at-a-time pruning.

Vectors are integer impacts: dimension d is a term, the component its impact. Rows
in the order of their ids form blocks of ``BLOCK`` rows, each with a forward index
(its rows of impacts) and with the largest and smallest impact of every term. For a
query, the sum over terms of the better of query impact times maximum and query
impact times minimum bounds every score in a block. A query visits the blocks of a
shard in the order of their bounds, and stops when the next bound lies below its kth
score; bounds that equal it are still visited, since ties go to smaller ids.

Shards of blocks and groups of queries meet in a grid of cells of bounded size. Each
group meets one shard first, whose kth scores are its floors in all others, so these
prune from the beginning. The others are dealt into at most ``SPANS`` spans, and a task
takes a few groups through the shards of a span one after the other. Its floors rise
with what it finds, and it returns at most k rows per query; these are merged. The pairs
of the grid are made in the tasks that score them: neither the driver nor a shuffle
gets a row for each.

Vectors that are null or hold null, NaN or infinite components take no part, nor do
rows with a null id. Of rows that repeat an id, the largest vector counts. Vectors of
different length are padded with zeros. Scores beyond 64 bits are clipped to them.
Empty table: no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadstone.llm.tables import bounded_batches, written

BLOCK = 512
SHARD_BLOCKS = 32
QUERIES = 1024
SPANS = 8
GROUPS = 4  # of a task

_PLACE = 1 << 24  # more than the rows of a shard
_LONG = (-(2**63), 2**63 - 1)
_CELL = ("part", "query_id", "query", "floors", "vec_id", "impacts")


def impacts(vector: Column) -> Column:
    """floor(64 x) of every component as a double; from 2^53 on, doubles are whole."""
    scaled = lambda x: 64 * x.cast("double")
    whole = lambda x: F.when(F.abs(x) < 2.0**53, F.floor(x).cast("double")).otherwise(x)
    return F.transform(vector, lambda x: whole(scaled(x)))


def usable(vector: Column) -> Column:
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(64 * x.cast("double")) < float("inf"))
    return vector.isNotNull() & F.coalesce(F.forall(vector, finite), F.lit(False))


def matrix(rows: pa.ListArray, width: int) -> np.ndarray:
    """Vectors as the rows of a matrix, padded with zeros."""
    lengths = rows.value_lengths().to_numpy(zero_copy_only=False)
    flat = rows.flatten().to_numpy(zero_copy_only=False)
    if (lengths == width).all():
        return flat.reshape(len(rows), width)
    out = np.zeros((len(rows), width))
    out[np.arange(width)[None, :] < lengths[:, None]] = flat
    return out


def exact(queries: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as a type in which sums of products and sort keys are exact: doubles for
    products, where these fit, else Python's integers."""
    reach = lambda m: float(np.abs(m).max(initial=0))
    if reach(queries) * reach(docs) * max(1, docs.shape[1]) < 2**38:
        return queries, docs
    whole = np.vectorize(int, otypes=[object])
    return whole(queries) if queries.size else queries, whole(docs) if docs.size else docs


def top_of_shard(
    query_ids: np.ndarray, queries: np.ndarray, floors: list[int | None], ids: np.ndarray, docs: np.ndarray, k: int
) -> list[list[tuple[int, int]]]:
    """For each query the (score, id) of its k best rows of a shard, block by block.

    ``ids`` ascend. A floor is a score that k rows elsewhere reach: what lies below
    it cannot be among the best.
    """
    queries, docs = exact(queries, docs)
    kind = object if docs.dtype == object else np.int64
    starts = range(0, len(ids), BLOCK)
    high = np.stack([docs[s : s + BLOCK].max(axis=0) for s in starts])
    low = np.stack([docs[s : s + BLOCK].min(axis=0) for s in starts])
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    bounds = up.dot(high.T) + down.dot(low.T)
    order = np.argsort(-bounds, axis=1, kind="stable")
    bounds = np.take_along_axis(bounds, order, axis=1)
    # A key is a score and, below it, the place of the row: larger keys come first.
    nothing = -(2**62) if kind is np.int64 else -(2**400)
    best = np.full((len(queries), k), nothing, kind)
    floor = np.array([nothing // _PLACE if f is None else f for f in floors], kind)
    active = np.arange(len(queries))
    for turn in range(order.shape[1]):
        kth = np.maximum(best[active, -1] // _PLACE, floor[active])
        active = active[bounds[active, turn] >= kth]
        if not len(active):
            break
        for block in np.unique(order[active, turn]).tolist():
            some = active[order[active, turn] == block]
            rows = slice(block * BLOCK, min(len(ids), (block + 1) * BLOCK))
            scores = queries[some].dot(docs[rows].T).astype(kind)
            keys = scores * _PLACE + (_PLACE - 1 - np.arange(rows.start, rows.stop).astype(kind))
            own = np.searchsorted(ids, query_ids[some])
            for i, at in enumerate(own.tolist()):
                if rows.start <= at < rows.stop and ids[at] == query_ids[some[i]]:
                    keys[i, at - rows.start] = nothing
            merged = np.concatenate([best[some], keys], axis=1)
            if kind is np.int64 and merged.shape[1] > k:
                merged = np.partition(merged, merged.shape[1] - k, axis=1)[:, -k:]
            best[some] = np.sort(merged, axis=1)[:, ::-1][:, :k]
    out = []
    for row, least in zip(best.tolist(), floor.tolist()):
        found = [(key // _PLACE, int(ids[_PLACE - 1 - key % _PLACE])) for key in row if key > nothing]
        out.append([f for f in found if f[0] >= least])
    return out


def _grouped(rows: DataFrame, group: str, id_name: str) -> DataFrame:
    """Rows gathered into one row per group: ids and vectors, by ascending id."""
    return (
        rows.groupBy(group)
        .agg(F.array_sort(F.collect_list(F.struct(id_name, "impacts"))).alias("members"))
        .select(group, F.col(f"members.{id_name}").alias(id_name), F.col("members.impacts").alias("impacts"))
    )


def _score(cells: DataFrame, k: int) -> DataFrame:
    """(query_id, vec_id, score): the best k of each group's queries in the shards that it
    meets in a task."""

    def cell(row: dict, best: list[list[tuple[int, int]]]) -> list[list[tuple[int, int]]]:
        width = max([0, *(len(v) for part in ("impacts", "query") for v in row[part].values)])
        queries, docs = (matrix(row[part].values, width) for part in ("query", "impacts"))
        ids, vec_ids = (row[part].values.to_numpy() for part in ("query_id", "vec_id"))
        floors = [b[-1][0] if len(b) == k else f for b, f in zip(best, row["floors"].as_py(), strict=True)]
        found = top_of_shard(ids, queries, floors, vec_ids, docs, k)
        found = [[(min(max(s, _LONG[0]), _LONG[1]), v) for s, v in f] for f in found]
        return [sorted(b + f, key=lambda x: (-x[0], x[1]))[:k] if b and f else b or f for b, f in zip(best, found, strict=True)]

    def rows(held: dict) -> pa.RecordBatch:
        found = ((q, v, s) for ids, best in held.values() for q, b in zip(ids, best, strict=True) for s, v in b)
        columns = list(zip(*found, strict=True)) or [(), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["query_id", "vec_id", "score"])

    def run(batches):
        held: dict[int, tuple[list[int], list[list[tuple[int, int]]]]] = {}
        for batch in batches:
            for at in range(batch.num_rows):
                row = {name: batch.column(name)[at] for name in batch.schema.names}
                part = row["part"].as_py()
                if part not in held and len(held) == 4 * GROUPS:
                    yield rows(held)
                    held.clear()
                ids, best = held.get(part) or (ids := row["query_id"].as_py(), [[] for _ in ids])
                held[part] = ids, cell(row, best)
        yield rows(held)

    return cells.mapInArrow(run, "query_id bigint, vec_id bigint, score bigint")


def _best(found: DataFrame, k: int) -> DataFrame:
    """The k best rows of each query: (query_id, rank, vec_id, score). Spark keeps k
    rows per query on both sides of the shuffle."""
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def top_k(vectors: DataFrame, queries: Column, k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best rows for each query.

    ``vectors`` has vec_id and embedding; ``queries`` tells which of its rows are
    queries, each against every row but its own.
    """
    bounded_batches(vectors.sparkSession)
    rows = vectors.where(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    rows = rows.groupBy("vec_id").agg(F.max("embedding").alias("embedding"))
    rows = written(rows.select("vec_id", impacts(F.col("embedding")).alias("impacts")), "impacts")
    total = rows.count()
    asked = rows.where(queries)
    shards = max(1, -(-total // (BLOCK * SHARD_BLOCKS)))
    groups = max(1, -(-asked.count() // QUERIES))
    # Ranges of ids make the shards, so that a shard's blocks are document ranges.
    ranged = rows.repartitionByRange(shards, "vec_id").withColumn("shard", F.spark_partition_id())
    index = written(_grouped(ranged, "shard", "vec_id"), "shards")
    dealt = asked.withColumn("part", F.pmod(F.xxhash64("vec_id"), F.lit(groups)).cast("int"))
    batches = _grouped(dealt, "part", "vec_id").select(
        "part", F.col("vec_id").alias("query_id"), F.col("impacts").alias("query")
    )
    batches = written(batches, "query-groups")
    count = (index.agg(F.max("shard")).first()[0] or 0) + 1
    home = F.pmod(F.col("part"), F.lit(count))
    # Each group meets one shard first; its kth scores are the floors in all others. All joins
    # name their kind: Spark knows sizes from compressed files, and would send a side of many
    # times that to the driver to broadcast it.
    unknown = F.transform("query_id", lambda _: F.lit(None).cast("bigint"))
    homed = batches.select("*", home.alias("shard"), unknown.alias("floors"))
    first = written(_score(homed.join(index.hint("merge"), "shard").select(*_CELL), k), "first-scores")
    kth = F.struct("query_id", "floor")
    floors = first.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("floor"))
    floors = (
        floors.where(F.col("n") >= k)
        .withColumn("part", F.pmod(F.xxhash64("query_id"), F.lit(groups)).cast("int"))
        .groupBy("part")
        .agg(F.map_from_entries(F.collect_list(kth)).alias("known"))
    )
    known = F.transform("query_id", lambda q: F.try_element_at(F.col("known"), q))
    informed = batches.join(floors.hint("merge"), "part", "left").withColumn("floors", known).drop("known")
    spans, few = index.repartition(min(count, SPANS)), informed.repartition(-(-groups // GROUPS))
    others = spans.join(few.hint("shuffle_replicate_nl"), F.col("shard") != home)
    return _best(first.union(_score(others.select(*_CELL), k)), k)
