"""Near-duplicate vectors by a forest of random-projection trees.

Each tree splits space by random directions at the median of a sample, again and
again, down to leaves of about ``LEAF`` vectors of the largest label. Vectors within
a margin of a split go to both sides, so that close pairs are seldom parted; several
trees leave next to no pair parted in all of them. Vectors of one label are compared
within leaves, by cosine in double precision, and only true links count.

A pair that shares several leaves counts in the first of them: every vector carries
its leaves along. Equal vectors are one class with a weight. A leaf larger than
``CHUNK`` is compared in pairs of chunks, in tasks of their own. A task returns a row
per vector: its number of links and the smallest vector it is connected to there, so
no pair becomes a row however large a group of copies is.

Vectors that are null, empty or zero, or hold null, NaN or infinite components, and
rows without a label link with nothing. Vectors of one label but different length
link with nothing. Rows that repeat a vec_id count once, with their largest vector;
rows without a vec_id stay as they are. Empty table: no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadstone.llm.components import connected_components
from loadstone.llm.tables import bounded_batches, drawn, written

TREES = 5
LEAF = 2048
CHUNK = 2048
SAMPLE = 20_000  # vectors that the splits are fitted on
FORESTS = 1000  # lengths of vectors that get a forest; vectors of others share a leaf
LEAST_SAMPLE = 8  # sample vectors below which a node is not split
MARGIN = 0.5  # of the standard deviation of a projected link at the threshold
BLOCK = 512

_TREE_BITS = 24  # leaves of a tree are numbered within this


def usable(vector: Column) -> Column:
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    zero = F.coalesce(F.forall(vector, lambda x: x == 0), F.lit(True))
    return vector.isNotNull() & F.coalesce(F.forall(vector, finite), F.lit(False)) & ~zero


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one in double precision, safe for tiny and huge components."""
    vectors = vectors.astype(np.float64)
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


class ProjectionTree:
    """A full binary tree in heap order: a direction and a threshold for each node."""

    def __init__(self, directions: np.ndarray, thresholds: np.ndarray, depth: int, margin: float):
        self.directions, self.thresholds = directions, thresholds
        self.depth, self.margin = depth, margin

    @classmethod
    def fit(cls, sample: np.ndarray, depth: int, margin: float, seed: int) -> ProjectionTree:
        rng = np.random.default_rng(seed)
        nodes = 2**depth - 1
        directions = rng.standard_normal((nodes, sample.shape[1]))
        directions /= np.maximum(np.linalg.norm(directions, axis=1, keepdims=True), 1e-300)
        thresholds = np.zeros(nodes)
        held = {0: np.arange(len(sample))}
        for node in range(nodes):
            rows = held.pop(node, np.zeros(0, int))
            along = sample[rows] @ directions[node]
            if len(rows):
                thresholds[node] = np.median(along)
            held[2 * node + 1] = rows[along <= thresholds[node]]
            held[2 * node + 2] = rows[along > thresholds[node]]
        return cls(directions, thresholds, depth, margin)

    def parts(self) -> tuple:
        return self.directions, self.thresholds, self.depth, self.margin

    def leaves(self, rows: np.ndarray) -> list[tuple[int, np.ndarray]]:
        """(leaf, indexes of the rows in it); a row may lie in several leaves."""
        found, open_nodes = [], [(0, np.arange(len(rows)))]
        first_leaf = 2**self.depth - 1
        while open_nodes:
            node, held = open_nodes.pop()
            if not len(held):
                continue
            if node >= first_leaf:
                found.append((node - first_leaf, held))
                continue
            off = rows[held] @ self.directions[node] - self.thresholds[node]
            open_nodes.append((2 * node + 1, held[off <= self.margin]))
            open_nodes.append((2 * node + 2, held[off > -self.margin]))
        return found


def plant(sample: np.ndarray, largest: int, threshold: float, trees: int) -> list[ProjectionTree]:
    """The forest for a table whose largest label has ``largest`` vectors."""
    most = max(0, int(math.log2(max(1, len(sample)) / LEAST_SAMPLE))) if len(sample) >= LEAST_SAMPLE else 0
    depth = min(most, _TREE_BITS, max(0, math.ceil(math.log2(max(1, largest) / LEAF))))
    spread = math.sqrt(2 * (1 - threshold)) / math.sqrt(max(1, sample.shape[1]))
    # Trees without a split are all the same leaf.
    return [ProjectionTree.fit(sample, depth, MARGIN * spread, seed) for seed in range(trees if depth else 1)]


def _leaf_keys(classes: DataFrame, forests: dict[int, list[ProjectionTree]]) -> DataFrame:
    """The classes with all their leaves, as one ascending list of keys."""
    # Bounded by the size of the sample that the forests are fitted on.
    plain = {width: [tree.parts() for tree in forest] for width, forest in forests.items()}
    shared = classes.sparkSession.sparkContext.broadcast(plain)

    def run(batches):
        planted = {width: [ProjectionTree(*p) for p in trees] for width, trees in shared.value.items()}
        for batch in batches:
            vectors = batch.column("embedding")
            lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
            keys = [[] for _ in range(batch.num_rows)]
            for width in np.unique(lengths).tolist():
                at = np.flatnonzero(lengths == width)
                rows = vectors.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False)
                rows = unit_rows(rows.reshape(len(at), width))
                if width not in planted:  # of more lengths than there are forests: one leaf
                    for i in at.tolist():
                        keys[i].append(0)
                for number, tree in enumerate(planted.get(width, [])):
                    for leaf, held in tree.leaves(rows):
                        key = (number << _TREE_BITS) + leaf
                        for i in at[held].tolist():
                            keys[i].append(key)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([sorted(k) for k in keys], pa.list_(pa.int64()))],
                names=[*batch.schema.names, "keys"],
            )

    return classes.mapInArrow(run, classes.withColumn("keys", F.array().cast("array<bigint>")).schema)


def compare_leaf(
    vectors: np.ndarray, weights: np.ndarray, sides: np.ndarray, earlier: list[list[int]], threshold: float
) -> tuple[np.ndarray, np.ndarray]:
    """(links, root) of each vector of a leaf or of a pair of its chunks.

    ``sides`` tells the chunk; of two chunks only pairs across count. Pairs that
    share one of their ``earlier`` leaves count there.
    """
    n = len(vectors)
    rows = unit_rows(vectors)
    columns = {k: i for i, k in enumerate(sorted({k for keys in earlier for k in keys}))}
    shared = np.zeros((n, max(1, len(columns))), np.float32)
    for i, keys in enumerate(earlier):
        shared[i, [columns[k] for k in keys]] = 1
    across = len(np.unique(sides)) > 1
    links, near = np.zeros(n, np.int64), []
    for start in range(0, n, BLOCK):
        part = slice(start, min(n, start + BLOCK))
        valid = (rows[part] @ rows.T >= threshold) & (shared[part] @ shared.T == 0)
        valid[np.arange(part.stop - start), np.arange(start, part.stop)] = False
        if across:
            valid &= sides[part, None] != sides[None, :]
        links[part] = valid @ weights
        near.append(np.packbits(valid, axis=1))
    roots = np.arange(n)
    while True:  # the smallest index reachable, by steps over links and jumps to roots
        before = roots
        steps = []
        for i, bits in enumerate(near):
            valid = np.unpackbits(bits, axis=1, count=n).astype(bool)
            steps.append(np.where(valid, roots[None, :], n).min(axis=1, initial=n))
        roots = np.minimum(roots, np.concatenate(steps))
        roots = np.minimum(roots, roots[roots])
        if (roots == before).all():
            return links, roots


def _compare(units: DataFrame, threshold: float) -> DataFrame:
    """(rep, links, root) of each class and unit."""

    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks().sort_by("rep")
        key = group.column("key")[0].as_py()
        vectors = group.column("embedding").combine_chunks()
        lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
        width = int(lengths[0])
        flat = vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(lengths), width)
        earlier = [[k for k in keys if k < key] for keys in group.column("keys").to_pylist()]
        links, roots = compare_leaf(
            flat, group.column("weight").to_numpy(), group.column("own").to_numpy(), earlier, threshold
        )
        reps = group.column("rep").to_numpy()
        return pa.table({"rep": reps, "links": links, "root": reps[roots]})

    return units.groupBy("label", "width", "key", "left", "right").applyInArrow(
        run, "rep bigint, links bigint, root bigint"
    )


def near_vectors(vectors: DataFrame, threshold: float = 0.93, trees: int = TREES) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for ``vectors`` (vec_id, embedding, label)."""
    bounded_batches(vectors.sparkSession)
    named = vectors.where("vec_id IS NOT NULL").groupBy("vec_id").agg(F.max(F.struct("embedding", "label")).alias("of"))
    text = F.concat_ws(",", F.col("of.label").cast("string"), F.transform("of.embedding", lambda x: x.cast("string")))
    fit_for_links = usable(F.col("of.embedding")) & F.col("of.label").isNotNull()
    rows = written(
        named.select("vec_id", "of.embedding", "of.label", F.when(fit_for_links, F.md5(text)).alias("digest")),
        "vectors",
    )
    classes = rows.where("digest IS NOT NULL").groupBy("digest").agg(
        F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("weight"),
        F.any_value("embedding").alias("embedding"), F.any_value("label").alias("label"),
    )
    classes = written(classes, "vector-classes")
    forests = _forests(classes, threshold, trees)
    placed = written(_leaf_keys(classes.withColumn("width", F.size("embedding")), forests), "vector-leaves")

    spread = placed.withColumn("key", F.explode("keys"))
    leaf = ["label", "width", "key"]
    large = spread.groupBy(*leaf).agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("parts")).where("parts > 1")
    dealt = spread.join(large, leaf, "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int"))
    units = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        *leaf, F.least("own", "other").alias("left"), F.greatest("own", "other").alias("right"),
        "own", "rep", "weight", "embedding", "keys",
    )
    found = written(_compare(units, threshold), "vector-links")

    joined = connected_components(found.where("root != rep").select("rep", "root"))
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    results = (
        classes.select("digest", "rep", "weight")
        .join(counts, "rep", "left")
        .join(joined.withColumnRenamed("id", "rep"), "rep", "left")
        .select(
            "digest",
            (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
            F.coalesce("component", "rep").alias("component_id"),
        )
    )
    linked = rows.where("digest IS NOT NULL").join(results, "digest").select("vec_id", "n_links", "component_id")
    none = F.lit(0).cast("bigint").alias("n_links")
    alone = rows.where("digest IS NULL").select("vec_id", none, F.col("vec_id").alias("component_id"))
    nameless = vectors.where("vec_id IS NULL").select("vec_id", none, F.col("vec_id").alias("component_id"))
    return linked.union(alone).union(nameless).withColumn("kept", F.expr("vec_id <=> component_id"))


def _forests(classes: DataFrame, threshold: float, trees: int) -> dict[int, list[ProjectionTree]]:
    """A forest for each length of vectors, fitted on a sample of at most ``SAMPLE``,
    always the same vectors."""
    few = drawn(classes, F.col("digest"), SAMPLE, classes.count())
    sample = few.select("embedding").toArrow().column(0).combine_chunks()
    lengths = sample.value_lengths().to_numpy(zero_copy_only=False) if len(sample) else np.zeros(0, int)
    sizes = classes.groupBy(F.size("embedding").alias("width"), "label").count()
    most = sizes.groupBy("width").agg(F.max("count").alias("most")).orderBy(F.desc("most"), "width")
    largest = {r[0]: r[1] for r in most.limit(FORESTS).collect()}
    forests = {}
    for width, most in largest.items():
        at = np.flatnonzero(lengths == width)
        rows = sample.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(len(at), width)
        rows = unit_rows(rows) if len(rows) else np.zeros((0, width))
        forests[width] = plant(rows, most, threshold, trees)
    return forests
