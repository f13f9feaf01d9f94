"""Line dedup that can be taken back: exact reference counts behind cuckoo filters.

The state of a corpus has three tables:

* ``references``: which document holds which line key (a 128-bit digest), exactly;
* ``counts``: how many documents hold a key and the largest of them, derived from
  the references, and re-derived only for keys that a change touches;
* ``filters``: for each shard of the key range a cuckoo filter of the keys that
  enough documents hold. Cuckoo filters forget keys as well as learn them, so
  deleting documents undoes what inserting them did.

To clean documents, their line keys are probed against the filter of their shard.
Most lines end there; what passes is looked up in the exact counts, so a false
positive of a filter changes nothing. A shard's probes are dealt out over as many
tasks as it has references, so a line that a third of all documents hold spreads too.

Null or empty text is one empty line and keeps it. A document without an id holds
no reference and keeps all of its lines. Rows that repeat a doc_id count as one
document. Empty tables give empty tables.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadstone.llm.tables import bounded_batches, column, small_side, whole, written

# The white space that is stripped from a line, and the letters lowered.
SPACE = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

SHARD_KEYS = 50_000  # keys that one filter is made for
PROBE_ROWS = 200_000  # references that one probing task is made for
SLOTS = 4
MAX_KICKS = 500


class CuckooFilter:
    """A set of 16-byte keys kept as 16-bit fingerprints, with deletion.

    ``add`` returns False when the filter is full; the caller then builds a larger
    one from the exact table. Only keys that were added may be removed.
    """

    def __init__(self, keys: int = 0, table: np.ndarray | None = None):
        buckets = 1 << max(2, math.ceil(math.log2(max(1, keys) / (SLOTS * 0.8) + 1)))
        self.table = np.zeros((buckets, SLOTS), np.uint16) if table is None else table
        self.mask = np.uint64(len(self.table) - 1)

    @classmethod
    def of(cls, keys: list[bytes]) -> CuckooFilter:
        room = len(keys)
        while True:
            made = cls(room)
            if made.add(keys):
                return made
            room = 2 * room + 1

    @classmethod
    def load(cls, data: bytes) -> CuckooFilter:
        return cls(table=np.frombuffer(data, np.uint16).reshape(-1, SLOTS).copy())

    def dump(self) -> bytes:
        return self.table.tobytes()

    def _places(self, keys: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        parts = np.frombuffer(b"".join(keys), "<u8").reshape(-1, 2)
        prints = ((parts[:, 1] & np.uint64(0xFFFF)) | np.uint64(1)).astype(np.uint16)
        first = (parts[:, 0] >> np.uint64(16)) & self.mask
        return prints, first, first ^ self._jump(prints)

    def _jump(self, prints: np.ndarray) -> np.ndarray:
        spread = prints.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return ((spread >> np.uint64(32)) | np.uint64(1)) & self.mask

    def contains(self, keys: list[bytes]) -> np.ndarray:
        prints, first, second = self._places(keys)
        at = lambda where: (self.table[where] == prints[:, None]).any(axis=1)
        return at(first) | at(second)

    def add(self, keys: list[bytes]) -> bool:
        state = 12345
        jumps = None
        for mark, a, b in zip(*(x.tolist() for x in self._places(keys))) if keys else ():
            at = a
            for kick in range(MAX_KICKS):
                free = np.flatnonzero(self.table[at] == 0)
                if len(free):
                    self.table[at, free[0]] = mark
                    break
                if kick == 0:
                    at = b
                    continue
                state = (state * 1103515245 + 12345) & 0x7FFFFFFF
                slot = (state >> 16) % SLOTS
                mark, self.table[at, slot] = int(self.table[at, slot]), mark
                jumps = self._jump(np.array([mark], np.uint16))
                at = int(at ^ int(jumps[0]))
            else:
                return False
        return True

    def remove(self, keys: list[bytes]) -> None:
        for mark, a, b in zip(*(x.tolist() for x in self._places(keys))) if keys else ():
            for at in (a, b):
                held = np.flatnonzero(self.table[at] == mark)
                if len(held):
                    self.table[at, held[0]] = 0
                    break


def line_key_text(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(SPACE)), UPPER, LOWER)


def shard_of(key: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(shards)).cast("int")


def references(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = 20
) -> DataFrame:
    """(key, doc_id): every line key of a document, once for each row of it."""
    lines = F.split(F.coalesce(column(docs, text), F.lit("")), "\n", -1)
    keys = F.filter(F.transform(lines, line_key_text), lambda k: F.length(k) >= min_chars)
    held = docs.select(column(docs, doc_id).alias("doc_id"), F.array_distinct(keys).alias("keys"))
    return (
        held.where("doc_id IS NOT NULL")
        .select("doc_id", F.explode("keys").alias("line"))
        .select(F.unhex(F.md5("line")).alias("key"), "doc_id")
    )


def count_references(refs: DataFrame) -> DataFrame:
    """(key, n_docs, last_doc), combined on the map side: a line that very many
    documents hold arrives as one row from each task."""
    return refs.groupBy("key").agg(
        F.countDistinct("doc_id").alias("n_docs"), F.max("doc_id").alias("last_doc")
    )


@dataclass(frozen=True)
class LineState:
    references: DataFrame
    counts: DataFrame
    filters: DataFrame
    shards: int
    min_docs: int
    min_chars: int


def _build_filters(frequent: DataFrame, shards: int) -> DataFrame:
    """(shard, filter), made from the exact keys; a shard's keys are bounded on average."""

    def build(group: pa.Table) -> pa.Table:
        keys = sorted(group.column("key").to_pylist())
        return pa.table(
            {"shard": group.column("shard")[:1], "filter": [CuckooFilter.of(keys).dump()]}
        )

    sharded = frequent.select(shard_of(F.col("key"), shards).alias("shard"), "key")
    return sharded.groupBy("shard").applyInArrow(build, "shard int, filter binary")


def build_lines(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    min_chars: int = 20,
    min_docs: int = 3,
) -> LineState:
    """The state of a whole corpus, inserted as one batch."""
    refs = written(references(docs, doc_id, text, min_chars), "line-references")
    counts = written(count_references(refs), "line-counts")
    frequent = counts.where(F.col("n_docs") >= min_docs).select("key")
    shards = max(1, math.ceil(frequent.count() / SHARD_KEYS))
    filters = written(_build_filters(frequent, shards), "line-filters")
    return LineState(refs, counts, filters, shards, min_docs, min_chars)


def _changed(state: LineState, refs: DataFrame, touched: DataFrame) -> LineState:
    """The state after its references changed for the ``touched`` keys."""
    old = state.counts.join(touched, "key", "left_semi")
    new = written(count_references(refs.join(touched, "key", "left_semi")), "line-touched")
    counts = written(state.counts.join(touched, "key", "left_anti").union(new), "line-counts")
    enough = F.col("n_docs") >= state.min_docs
    was, now = old.where(enough).select("key"), new.where(enough).select("key")
    moves = (
        now.join(was, "key", "left_anti").select("key", F.lit(True).alias("add"))
        .union(was.join(now, "key", "left_anti").select("key", F.lit(False).alias("add")))
        .withColumn("shard", shard_of(F.col("key"), state.shards))
    )

    def update(shard: tuple, kept: pa.Table, moved: pa.Table) -> pa.Table:
        keys = list(zip(moved.column("key").to_pylist(), moved.column("add").to_pylist()))
        has = kept.num_rows > 0
        made = CuckooFilter.load(kept.column("filter")[0].as_py()) if has else CuckooFilter()
        made.remove([k for k, add in keys if not add])
        # None asks for a filter made anew from the exact table.
        data = made.dump() if made.add(sorted(k for k, add in keys if add)) else None
        return pa.table(
            {"shard": pa.array([shard[0].as_py()], pa.int32()), "filter": pa.array([data], pa.binary())}
        )

    updated = written(
        state.filters.groupBy("shard")
        .cogroup(moves.groupBy("shard"))
        .applyInArrow(update, "shard int, filter binary"),
        "line-filters",
    )
    full = updated.where("filter IS NULL").select("shard")
    frequent = counts.where(enough).select("key")
    again = frequent.withColumn("shard", shard_of(F.col("key"), state.shards)).join(full, "shard", "left_semi")
    filters = updated.where("filter IS NOT NULL").union(_build_filters(again.select("key"), state.shards))
    return LineState(refs, counts, written(filters, "line-filters"), state.shards, state.min_docs, state.min_chars)


def insert_documents(
    state: LineState, docs: DataFrame, doc_id: str = "doc_id", text: str = "text"
) -> LineState:
    """The state with more documents. Only counts of keys they hold are re-derived."""
    more = written(references(docs, doc_id, text, state.min_chars), "line-more")
    refs = state.references.union(more)
    return _changed(state, refs, more.select("key").distinct())


def delete_documents(state: LineState, doc_ids: DataFrame) -> LineState:
    """The state without the documents whose ids are in the only column of ``doc_ids``."""
    gone = doc_ids.toDF("doc_id").distinct()
    lost = state.references.join(gone, "doc_id", "left_semi").select("key").distinct()
    refs = written(state.references.join(gone, "doc_id", "left_anti"), "line-references")
    return _changed(state, refs.select("key", "doc_id"), written(lost, "line-lost"))


def _probe(state: LineState, refs: DataFrame) -> DataFrame:
    """The references whose key the filter of its shard knows.

    A shard's references are dealt out by document over enough tasks that each
    sees a bounded number; the counts tell how many that takes.
    """
    shard = shard_of(F.col("key"), state.shards)
    loads = refs.groupBy(shard.alias("shard")).agg(F.count(F.lit(1)).alias("rows"))
    parts = loads.select("shard", F.ceil(F.col("rows") / PROBE_ROWS).cast("int").alias("parts"))
    parts = small_side(written(parts, "line-parts"))  # two integers for each shard
    known = state.filters.join(parts, "shard")
    copies = known.select("shard", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "filter")
    dealt = (
        refs.withColumn("shard", shard)
        .join(parts, "shard")
        .select("shard", F.pmod(F.xxhash64("doc_id", "key"), F.col("parts")).cast("int").alias("part"), "key", "doc_id")
    )

    def probe(found: pa.Table, filters: pa.Table) -> pa.Table:
        found = found.select(["key", "doc_id"])
        if not filters.num_rows or not found.num_rows:
            return found.slice(0, 0)
        made = CuckooFilter.load(filters.column("filter")[0].as_py())
        return found.filter(pa.array(made.contains(found.column("key").to_pylist())))

    return (
        dealt.groupBy("shard", "part")
        .cogroup(copies.groupBy("shard", "part"))
        .applyInArrow(probe, refs.select("key", "doc_id").schema)
    )


def dropped_keys(state: LineState, refs: DataFrame) -> DataFrame:
    """(doc_id, keys): what each document loses, the last holder of a key nothing."""
    enough = state.counts.where(F.col("n_docs") >= state.min_docs).select("key", "last_doc")
    lost = _probe(state, refs).join(enough, "key").where("doc_id != last_doc")
    return lost.groupBy("doc_id").agg(F.collect_set("key").alias("keys"))


_CUT = T.StructType(
    [
        T.StructField("text", T.StringType()),
        T.StructField("n_lines", T.LongType()),
        T.StructField("n_dropped", T.LongType()),
    ]
)


@F.pandas_udf(_CUT)
def _cut(texts: pd.Series, keys: pd.Series) -> pd.DataFrame:
    from hashlib import md5

    upper = str.maketrans(UPPER, LOWER)
    out = []
    for text, drop in zip(texts, keys):
        lines = (text or "").split("\n")
        kept = lines
        if drop is not None and len(drop):
            drop = {bytes(k) for k in drop}
            kept = [x for x in lines if md5(x.strip(SPACE).translate(upper).encode()).digest() not in drop]
        out.append(("\n".join(kept), len(lines), len(lines) - len(kept)))
    return pd.DataFrame(out, columns=["text", "n_lines", "n_dropped"])


def clean_lines(
    state: LineState, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", refs: DataFrame | None = None
) -> DataFrame:
    """Every row of ``docs``, in ``row``, with its cleaned text and both line counts.

    ``refs`` are the references of these documents, where they are at hand.
    """
    bounded_batches(docs.sparkSession)
    if refs is None:
        refs = references(docs, doc_id, text, state.min_chars)
    drops = written(dropped_keys(state, refs), "line-drops")
    rows = docs.select(
        whole(docs).alias("row"), column(docs, doc_id).alias("of"), column(docs, text).alias("text")
    )
    joined = rows.join(small_side(drops), F.col("of") == F.col("doc_id"), "left")
    return joined.select("row", _cut("text", "keys").alias("cut")).select("row", "cut.*")
