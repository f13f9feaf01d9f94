"""Quality scores learned from preferences (Bradley-Terry).

Every text becomes a short vector of features of the whole text. Each good and each bad
labelled document make a preference pair; the score is linear in the
features and minimizes the logistic loss of the differences, so a pair is decided by
the difference of its two scores. The cut between good and bad is the quantile of the
scores that leaves the share of bad documents below it, and the margin to
that cut is mapped to 0..1 so that the cut lies at ``threshold``.

The fit goes over all labelled documents and all of their pairs, whose number is no matter:
a document enters a pair by its score alone, so each is met by the other kind's scores in
``BINS`` bins, each bin at its mean. A pass over the vectors counts the bins, another one
adds up the curvature; both are sums.

Null and empty texts are scored like any text; they have the features of no words.
Repeated rows score alike, and are one document of the fit. Without labels of both
kinds every score is 0.5. Empty table: no rows. A long text is one Arrow value, read whole.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadstone.llm.tables import bounded_batches, drawn, written

WIDTH = 19  # features of a text
BINS, REACH = 1024, 32.0  # of scores between -REACH and REACH; the outer ones hold what lies beyond
STEPS, STILL = 20, 1e-4  # most steps of the fit, and a step that ends it
RIDGE = 1e-3
RANKS = 1_000_000  # the cut is exact to this part of all ranks

_LETTERS = np.zeros(256, bool)
_LETTERS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_MARKS = np.zeros(256, bool)
_MARKS[[b for b in range(33, 127) if not chr(b).isalnum() and chr(b) not in ".,;:!?'\"()-"]] = True


def features(text: str | None) -> list[float]:
    data = (text or "").encode()
    words = data.split()
    bytes_of = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    n, size = max(1, len(words)), max(1, len(data))
    letters = max(1, int(bytes_of[_LETTERS].sum()))
    lengths = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    counts = Counter(words)
    top = counts.most_common(1)[0][1] if words else 0
    same = sum(map(bytes.__eq__, words, words[1:]))
    lines = [x for x in data.split(b"\n") if x.strip()]
    stops = int(bytes_of[46] + bytes_of[33] + bytes_of[63])
    return [
        math.log1p(len(words)),
        float(lengths.mean()),
        float(lengths.std()),
        float(lengths.max()) ** 0.5,
        bytes_of[65:91].sum() / letters,
        bytes_of[_MARKS].sum() / size,
        bytes_of[33] / n,
        (bytes_of[48:58].sum()) / size,
        bytes_of[44] / n,
        stops / n,
        len(counts) / n,
        len(counts) / n**0.8,
        top / n,
        same / n,
        1 - len(set(lines)) / max(1, len(lines)),
        math.log1p(size / max(1, len(lines))),
        len(zlib.compress(data, 1)) / size if data else 0.0,
        math.log1p(bytes_of[60] + bytes_of[62] + bytes_of[123] + bytes_of[125]) / math.log1p(size + 1),
        1.0 if not words else 0.0,
    ]


@dataclass(frozen=True)
class QualityModel:
    mean: list[float]
    scale: list[float]
    weights: list[float]
    cut: float
    spread: float
    threshold: float

    def scores(self, rows: np.ndarray) -> np.ndarray:
        margin = self.margins(rows) - self.cut
        edge = math.log(self.threshold / (1 - self.threshold))
        return 1 / (1 + np.exp(-np.clip(margin / self.spread + edge, -30, 30)))

    def margins(self, rows: np.ndarray) -> np.ndarray:
        return linear(expand((rows - np.array(self.mean)) / np.array(self.scale)), np.array(self.weights))


def linear(rows: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The product of each row alone: a matrix product rounds by the rows it has beside it."""
    return (rows * weights).sum(axis=1)


def expand(rows: np.ndarray) -> np.ndarray:
    """Clipped features and their squares: good values may lie in the middle."""
    rows = np.clip(rows, -6, 6)
    return np.concatenate([rows, rows**2], axis=1)


def fit(vectors: DataFrame, threshold: float) -> QualityModel | None:
    """The Bradley-Terry weights of all pairs of a good and a bad document, from their
    ``quality`` and features ``v``; None without documents of both kinds."""
    parts = [F.col("v")[i] for i in range(WIDTH)]
    sums = [f(p).alias(f"{n}{i}") for i, p in enumerate(parts) for n, f in (("m", F.avg), ("s", F.stddev_pop))]
    found = vectors.agg(F.count_if(F.col("quality") == 1).alias("good"), F.count_if(F.col("quality") == 0).alias("bad"), *sums).first()
    if not found["good"] or not found["bad"]:
        return None
    mean = np.array([found[f"m{i}"] for i in range(WIDTH)])
    scale = np.array([found[f"s{i}"] for i in range(WIDTH)]) + 1e-6
    all_pairs = found["good"] * found["bad"]
    weights = np.zeros(2 * WIDTH)
    for _ in range(STEPS):  # Newton's method on the mean logistic loss
        bins = _binned(vectors, mean, scale, weights)
        (n_good, x_good), (n_bad, x_bad) = bins[1], bins[0]
        at = [x @ weights / np.maximum(n, 1) for n, x in ((n_good, x_good), (n_bad, x_bad))]
        p = 1 / (1 + np.exp(-np.clip(at[0][:, None] - at[1][None, :], -30, 30)))
        slope = (x_good.T @ ((p - 1) @ n_bad) - x_bad.T @ ((p - 1).T @ n_good)) / all_pairs + RIDGE * weights
        bend = p * (1 - p)
        both = x_good.T @ bend @ x_bad
        own = _curvature(vectors, mean, scale, weights, [bend.T @ n_good, bend @ n_bad])
        curve = (own - both - both.T) / all_pairs + RIDGE * np.eye(len(weights))
        step = np.linalg.solve(curve, slope)
        weights = weights - step
        if np.abs(step).max() < STILL:
            break
    # Sums of a shuffle come in any order: what it changes lies beyond these digits.
    weights = np.round(weights, 8)
    model = QualityModel(mean.round(10).tolist(), scale.round(10).tolist(), weights.tolist(), 0.0, 1.0, threshold)
    total = found["good"] + found["bad"]
    rank = min(total - 1, max(1, found["bad"]))
    ranks = [min(1.0, (rank + half) / total) for half in (-0.5, 0.5)]

    @F.pandas_udf("double")
    def margin(given: pd.Series) -> pd.Series:
        return pd.Series(model.margins(_matrix(given)))

    scores = vectors.select(margin("v").alias("score")).agg(
        F.percentile_approx("score", ranks, RANKS).alias("cut"), F.stddev_pop("score").alias("spread")
    ).first()
    return replace(model, cut=sum(scores["cut"]) / 2, spread=round(scores["spread"] / 4 + 1e-9, 10))


def _matrix(given: pd.Series) -> np.ndarray:
    return np.array([np.asarray(v, float) for v in given]).reshape(-1, WIDTH)


def _bin_of(rows: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return np.clip((linear(rows, weights) + REACH) * (BINS / 2 / REACH), 0, BINS - 1).astype(int)


def _binned(vectors: DataFrame, mean, scale, weights) -> list[tuple[np.ndarray, np.ndarray]]:
    """For bad and good documents: how many there are in each bin of scores, and the sum of
    their expanded features."""
    columns = ["n", *[f"x{i}" for i in range(2 * WIDTH)]]

    def parts(frames):
        sums = np.zeros((2 * BINS, len(columns)))
        for frame in frames:
            rows = expand((_matrix(frame["v"]) - mean) / scale)
            np.add.at(sums, frame["quality"].to_numpy() * BINS + _bin_of(rows, weights), np.insert(rows, 0, 1, axis=1))
        filled = np.flatnonzero(sums[:, 0])
        yield pd.DataFrame(sums[filled], columns=columns).assign(bin=filled)

    kinds = ", ".join(f"{c} double" for c in columns)
    found = vectors.select("quality", "v").mapInPandas(parts, f"{kinds}, bin long")
    out = np.zeros((2 * BINS, len(columns)))
    for r in found.groupBy("bin").agg(*[F.sum(c).alias(c) for c in columns]).collect():
        out[r["bin"]] = [r[c] for c in columns]
    return [(half[:, 0], half[:, 1:]) for half in (out[:BINS], out[BINS:])]


def _curvature(vectors: DataFrame, mean, scale, weights, by_bin: list[np.ndarray]) -> np.ndarray:
    """The sum of all documents' squares of expanded features, each by the weight that its
    kind has in its bin."""
    each = np.concatenate(by_bin)

    def parts(frames):
        total = np.zeros((2 * WIDTH, 2 * WIDTH))
        for frame in frames:
            rows = expand((_matrix(frame["v"]) - mean) / scale)
            share = each[frame["quality"].to_numpy() * BINS + _bin_of(rows, weights)]
            total += (rows * share[:, None]).T @ rows
        yield pd.DataFrame({"at": np.arange(total.size), "value": total.ravel()})

    found = vectors.select("quality", "v").mapInPandas(parts, "at long, value double")
    out = np.zeros(4 * WIDTH * WIDTH)
    for r in found.groupBy("at").agg(F.sum("value").alias("value")).collect():
        out[r["at"]] = r["value"]
    return out.reshape(2 * WIDTH, 2 * WIDTH)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, value: int, limit: int) -> DataFrame:
    """(digest, text) of at most ``limit`` labelled documents, always the same ones: the
    labels are drawn first, by the digest of their id, and are few enough to broadcast. Rows
    that repeat an id and its text are one document; of the texts of ids that come with many,
    those of the smallest digests are drawn."""
    key = F.col("doc_id").cast("string")
    known = labels.where((F.col(label) == value) & (F.crc32(key) % 5 != 0)).select("doc_id").distinct()
    few = drawn(known, F.md5(key), limit, known.count())
    text = F.coalesce("text", F.lit(""))
    rows = docs.join(F.broadcast(few), "doc_id").select(F.md5(F.concat_ws("\n", key, text)).alias("digest"), "text")
    # The sample is small and what is done with its texts is not: spread it.
    spread = 2 * docs.sparkSession.sparkContext.defaultParallelism
    rows = written(rows.dropDuplicates(["digest"]).repartition(spread, "digest"), "labelled-sample")
    total = rows.count()
    return drawn(rows, F.col("digest"), limit, total) if total > limit else rows


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def described(docs: DataFrame) -> DataFrame:
    """``doc_id``, a ``digest`` of id and text, and the features ``v`` of every row's whole text."""
    bounded_batches(docs.sparkSession)
    digest = F.md5(F.concat_ws("\n", F.col("doc_id").cast("string"), F.coalesce("text", F.lit(""))))
    return written(docs.select("doc_id", digest.alias("digest"), _features("text").alias("v")), "quality-features")


def train_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> QualityModel | None:
    """A model from all labelled documents that are not held out."""
    return train_described(described(docs), labels, threshold)


def train_described(rows: DataFrame, labels: DataFrame, threshold: float) -> QualityModel | None:
    """The model of :func:`described` documents. Rows that repeat an id and its text are one."""
    known = labels.where("quality IN (0, 1)").where(F.crc32(F.col("doc_id").cast("string")) % 5 != 0)
    known = known.select("doc_id", F.col("quality").cast("int").alias("quality")).distinct()
    vectors = rows.join(known, "doc_id").dropDuplicates(["digest", "quality"]).sortWithinPartitions("digest")
    return fit(written(vectors.select("quality", "v"), "labelled-features"), threshold)


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def _features(texts: pd.Series) -> pd.Series:
    return texts.map(features)


def score_quality(docs: DataFrame, model: QualityModel | None) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row, from its whole text."""
    bounded_batches(docs.sparkSession)
    return score_described(docs.select("doc_id", _features("text").alias("v")), model)


def score_described(rows: DataFrame, model: QualityModel | None) -> DataFrame:
    """What :func:`score_quality` gives, from the features ``v`` of each row."""

    @F.pandas_udf("double")
    def score(given: pd.Series) -> pd.Series:
        if model is None:
            return pd.Series(np.full(len(given), 0.5))
        return pd.Series(model.scores(_matrix(given)))

    limit = model.threshold if model else 0.3
    return rows.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), score("v").alias("score")
    ).select("*", (F.col("score") >= limit).cast("int").alias("predicted"))
