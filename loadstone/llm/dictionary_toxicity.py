"""Toxicity by compression distance.

Words are written as fixed codes of eight bytes, one for the word and one for its
stem (its first letters), so that zstandard finds whole words and stems and never
chance runs of letters. A window of words is compressed twice: with a dictionary
trained on ordinary text, and with that dictionary behind one trained on toxic text.
The bytes that the toxic dictionary saves are the window's gap. A document's evidence
is the sum of the gaps of its windows that reach the window threshold, less a rate for
each of its windows, so that ordinary text of any length stays below the cut. The window
threshold, the rate and the cut are calibrated on labelled documents that the dictionaries
have not seen, or on the sample itself where it is too small to be halved.

The toxic dictionary is not trained on toxic text as it stands but on a list of words and
stems: those of toxic text that are typical of it beyond chance, in made-up passages, the
whole list in front. The ordinary dictionary is trained on real windows. A toxic phrase of
words that are each ordinary has no evidence.

Null and empty texts have one empty window and no gap. Repeated rows score alike.
Without labelled documents of both kinds, or with nothing that sets toxic ones apart,
every score is 0.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadstone.llm.pairwise_quality import held_out, labelled_sample
from loadstone.llm.tables import bounded_batches, column, give_back_memory, written

SAMPLE_TOXIC, SAMPLE_ORDINARY = 2000, 4000  # most labelled documents a model is fitted on
SAMPLE_CHARS, PIECES = 40_000, 8  # longest part of a text that dictionaries are made of, its pieces
WINDOW_WORDS = 8
STEM = 4
WINDOW_GAPS = (4, 1, 2, 6, 8, 12, 16)  # tried; of equally good ones the first is taken
GAPS = 256  # gaps are counted up to this one; windows have fewer bytes
CHANCE = 0.01  # of any unit being typical of toxic text by chance
REMEMBERED = 100_000  # words whose codes a task remembers; no result depends on it

# From a model to (toxic, half, windows by gap) of every text of a sample.
Measure = Callable[["ToxicityModel"], list[tuple[int, int, np.ndarray]]]

_EDGES = b".,!*$&%#?;:()[]{}\"'"


def units(word: bytes) -> list[bytes]:
    """A word without the marks around it, and its stem if it is longer than that."""
    word = word.strip(_EDGES)
    letters = word.decode(errors="replace")
    return [word] + ([letters[:STEM].encode() + b"-"] if len(letters) > STEM else [])


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode().split()


def coder() -> Callable[[bytes], bytes]:
    from xxhash import xxh3_64_digest

    known: dict[bytes, bytes] = {}

    def code(word: bytes) -> bytes:
        found = known.get(word)
        if found is None:
            if len(known) > REMEMBERED:
                known.clear()
            found = known[word] = b"".join(map(xxh3_64_digest, units(word)))
        return found

    return code


def windows(words: list[bytes], code: Callable[[bytes], bytes]) -> list[bytes]:
    codes = list(map(code, words))
    return [b"".join(codes[i : i + WINDOW_WORDS]) for i in range(0, max(1, len(codes)), WINDOW_WORDS)]


def typical_units(toxic: list[str], ordinary: list[str]) -> list[tuple[bytes, float]]:
    """Units that set toxic documents apart, most frequent first, and how many times as
    frequent they are there as in ordinary ones.

    A unit is judged against chance, whatever its share of the documents: by the documents
    that hold it and by its frequency within them, each at the level that leaves ``CHANCE``
    for all units together. A document counts for a unit if most contexts it has it in are
    new, so copies of one document count once.
    """
    sizes = [[len(words_of(t)) for t in texts] for texts in (toxic, ordinary)]
    n_words = [max(1, sum(x)) for x in sizes]
    share = max(len(toxic) / (len(toxic) + len(ordinary)), n_words[0] / sum(n_words))
    held = Counter(u for t in toxic for u in {u for w in set(words_of(t)) for u in units(w)})
    level = CHANCE / max(1, 2 * sum(n > 1 for n in held.values()))
    # What no count in ordinary text could make significant needs no look at its contexts.
    may = {u for u, n in held.items() if share**n <= level}

    def fresh(texts: list[str]) -> dict[bytes, np.ndarray]:
        """By unit: documents, occurrences, sum of frequencies and of their squares."""
        seen: set = set()
        sums: dict[bytes, np.ndarray] = defaultdict(lambda: np.zeros(4))
        for text in texts:
            words = [b"", *words_of(text), b""]
            contexts, times = defaultdict(set), Counter()
            for context in zip(words, words[1:], words[2:]):
                for unit in units(context[1]):
                    if unit in may:
                        contexts[unit].add(context)
                        times[unit] += 1
            for unit, found in contexts.items():
                if 2 * sum(c not in seen for c in found) > len(found):
                    often = times[unit] / (len(words) - 2)
                    sums[unit] += (1, times[unit], often, often**2)
            for found in contexts.values():
                seen.update(found)
        return sums

    bad, good = fresh(toxic), fresh(ordinary)
    typical = []
    for unit, x in bad.items():
        y = good.get(unit, np.zeros(4))
        means = [z[2] / n for z, n in ((x, len(toxic)), (y, len(ordinary)))]
        error = sum((z[3] / n - m * m) / n for z, n, m in zip((x, y), map(len, (toxic, ordinary)), means))
        by_frequency = math.erfc((means[0] - means[1]) / math.sqrt(2 * max(error, 1e-30))) / 2
        if min(by_frequency, chance(int(x[0]), int(x[0] + y[0]), share)) <= level:
            typical.append((unit, x[1] / n_words[0] * n_words[1] / (y[1] + 0.5)))
    return sorted(typical, key=lambda u: (-bad[u[0]][0], u[0]))


def chance(least: int, of: int, share: float) -> float:
    """The probability that at least ``least`` of ``of`` documents are toxic."""
    if share >= 1:
        return 1.0
    ways = math.lgamma(of + 1)
    return sum(
        math.exp(
            ways - math.lgamma(k + 1) - math.lgamma(of - k + 1)
            + k * math.log(share) + (of - k) * math.log(1 - share)
        )
        for k in range(least, of + 1)
    )


@dataclass(frozen=True)
class ToxicityModel:
    ordinary: bytes
    toxic: bytes
    rate: float = 0.0  # what a window of ordinary text may have
    cut: float = 4.0
    window_gap: int = 4

    def counter(self) -> Callable[[str | None], np.ndarray]:
        """The number of windows of a text by their gap; the compressors are made once."""
        plain, both, code = compressor(self.ordinary), compressor(self.toxic + self.ordinary), coder()

        def counts(text: str | None) -> np.ndarray:
            found = np.zeros(GAPS, np.int64)
            for window in windows(words_of(text), code):
                gap = len(plain.compress(window)) - len(both.compress(window))
                found[max(0, min(GAPS - 1, gap))] += 1
            return found

        return counts

    def evidence(self, counts: np.ndarray) -> np.ndarray:
        """The gaps from ``window_gap`` on above those expected of so many windows, for
        one text or one in each row. Ordinary text has the less of it the longer it is."""
        gaps = np.arange(GAPS) * (np.arange(GAPS) >= self.window_gap)
        return counts @ gaps - self.rate * counts.sum(axis=-1)

    def score(self, evidence: float) -> float:
        return 1 / (1 + math.exp(-max(-20.0, min(20.0, (evidence - self.cut) / max(1.0, self.cut / 3)))))


def compressor(dictionary: bytes):
    import zstandard

    # The toxic part lies in front: the distances within the ordinary part, and with
    # them the price of its matches, are the same for both compressors.
    return zstandard.ZstdCompressor(
        dict_data=zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT),
        compression_params=zstandard.ZstdCompressionParameters.from_level(
            3, window_log=17, min_match=6, strategy=zstandard.STRATEGY_LAZY2,
            write_content_size=False, write_checksum=False, write_dict_id=False,
        ),
    )


def train_dictionary(size: int, samples: list[bytes]) -> bytes:
    """A trained zstandard dictionary; the samples themselves where they are too few."""
    import zstandard

    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def learn(toxic: list[str], ordinary: list[str], seed: int) -> ToxicityModel | None:
    """Both dictionaries; None if nothing sets the toxic texts apart."""
    from xxhash import xxh3_64_digest

    rng, code = np.random.default_rng(seed), coder()
    typical = [u for u, _ in typical_units(toxic, ordinary)]
    if not typical:
        return None
    known = set(typical)
    codes = [xxh3_64_digest(u) for t in toxic for w in words_of(t) for u in units(w) if u in known]
    codes = [codes[i] for i in rng.permutation(len(codes))]
    passages = [b"".join(codes[i : i + WINDOW_WORDS]) for i in range(0, len(codes), WINDOW_WORDS)]
    prose = [w for t in ordinary for w in windows(words_of(t), code)]
    prose = [prose[i] for i in rng.permutation(len(prose))[:20_000]]
    bad = train_dictionary(max(1024, 32 * len(typical)), passages)
    # Every typical unit has a place in the dictionary, whatever training left out.
    bad = b"".join(c for c in map(xxh3_64_digest, typical) if c not in bad) + bad
    return ToxicityModel(train_dictionary(4096, prose), bad)


def fit(
    toxic: list[tuple[int, str]], ordinary: list[tuple[int, str]], measure: Measure | None = None, seed: int = 5
) -> ToxicityModel | None:
    """Thresholds from dictionaries of half 0 of the sample and the gaps that they find in
    half 1, then dictionaries of the whole sample. The texts come with their half.
    ``measure`` counts the gaps in the whole texts, where these are more than what is given.

    A sample that has no half for each is calibrated on what its dictionaries are made of.
    """
    if not toxic or not ordinary:
        return None

    def local(model: ToxicityModel) -> list[tuple[int, int, np.ndarray]]:
        count = model.counter()
        return [(kind, h, count(t)) for kind, rows in ((1, toxic), (0, ordinary)) for h, t in rows]

    texts = [[t for _, t in rows] for rows in (toxic, ordinary)]
    model = learn(*texts, seed)
    if model is None:
        return None
    half = learn(*[[t for h, t in rows if h == 0] for rows in (toxic, ordinary)], seed)
    parted = half is not None and all(any(h == 1 for h, _ in rows) for rows in (toxic, ordinary))
    found = (measure or local)(half if parted else model)
    counts = [np.array([c for k, h, c in found if k == kind and (h == 1 or not parted)]) for kind in (1, 0)]
    return calibrated(model, *counts)


def calibrated(model: ToxicityModel, toxic: np.ndarray, ordinary: np.ndarray) -> ToxicityModel:
    """The window gap, the rate and the cut with the best sum of both rates, over all texts
    and over the longest quarter of either kind; the cut is in the middle of the gap that it
    lies in. A window gap replaces those tried before it if it is better by more than one of the
    longest toxic texts: less is chance."""
    longest = [x.sum(axis=1) >= np.quantile(x.sum(axis=1), 0.75) for x in (toxic, ordinary)]
    least = 1 / len(toxic) + 1 / longest[0].sum()
    best, chosen = -1.0, model
    for window_gap in WINDOW_GAPS:
        gaps = replace(model, window_gap=window_gap, rate=0.0)
        mean = [gaps.evidence(x).sum() / x.sum() for x in (toxic, ordinary)]
        low = max(mean[1], 0.5 / ordinary.sum())
        own, here = -1.0, gaps
        for power in (0.5, 0.25, 0.75) if mean[0] > low else (0.5,):
            tried = replace(gaps, rate=float(low * (max(mean[0], low) / low) ** power))
            bad, good = tried.evidence(toxic), tried.evidence(ordinary)
            levels = np.unique(np.concatenate([bad, good, [0.0]]))
            cuts = (levels[1:] + levels[:-1]) / 2
            for cut in cuts[cuts > 0]:
                rates = sum(f.mean() + f[part].mean() for f, part in zip((bad >= cut, good < cut), longest))
                if rates > own + 1e-9:
                    own, here = rates, replace(tried, cut=float(cut))
        if own > best + least:
            best, chosen = own, here
    return chosen


def train_toxicity(docs: DataFrame, labels: DataFrame) -> ToxicityModel | None:
    """A model from a bounded sample of the labelled documents: ``SAMPLE_TOXIC`` and
    ``SAMPLE_ORDINARY`` of them, of every length. Of a text above ``SAMPLE_CHARS`` the
    dictionaries are made of pieces from all over it; thresholds come from whole texts.
    Copies are in the same half."""
    bounded_batches(docs.sparkSession)
    kinds = ((1, SAMPLE_TOXIC), (0, SAMPLE_ORDINARY))
    drawn = [
        labelled_sample(docs, labels, "toxic", value, limit)
        .select(F.coalesce("text", F.lit("")).alias("text"), F.lit(value).alias("toxic"))
        for value, limit in kinds
    ]
    sample = written(drawn[0].union(drawn[1]), "toxicity-sample")
    half = (F.conv(F.substring(F.md5("text"), 1, 1), 16, 10).cast("int") % 2).alias("half")
    length, piece = F.length("text"), SAMPLE_CHARS // PIECES
    at = F.sequence(F.lit(0), F.lit(PIECES - 1))
    pieces = F.transform(
        at, lambda i: F.substring("text", 1 + F.floor(i * (length - piece) / (PIECES - 1)).cast("int"), F.lit(piece))
    )
    text = F.when(length <= SAMPLE_CHARS, F.col("text")).otherwise(F.concat_ws(" ", pieces))
    texts = [
        [(r[0], r[1]) for r in sample.where(F.col("toxic") == value).orderBy(F.md5("text"))
         .select(half, text.alias("text")).collect()]
        for value, _ in kinds
    ]

    def measure(model: ToxicityModel) -> list[tuple[int, int, np.ndarray]]:
        @F.pandas_udf("array<bigint>")
        def counts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            count = model.counter()
            for some in batches:
                yield some.map(count)

        rows = sample.select("toxic", half, counts("text")).collect()
        return [(r[0], r[1], np.array(r[2])) for r in rows]

    return fit(*texts, measure)


def score_toxicity(
    docs: DataFrame, model: ToxicityModel | None, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Every row of ``docs`` and, behind it, toxicity_score and toxicity_held_out."""
    bounded_batches(docs.sparkSession)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        count = model.counter() if model else None
        for texts in batches:
            yield texts.map(lambda t: model.score(model.evidence(count(t))) if count else 0.0).astype(float)
        count = None
        give_back_memory()  # idle workers are kept beside those of later stages

    return docs.select(
        "*",
        score(column(docs, text)).alias("toxicity_score"),
        held_out(column(docs, doc_id)).alias("toxicity_held_out"),
    )
