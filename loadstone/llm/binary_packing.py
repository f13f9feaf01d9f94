"""Packing by power-of-two decomposition.

A document of n tokens is cut, from its start, into whole sequences of the longest
length and then into one piece for each binary digit of what is left, the largest
first. Every piece is a sequence of its own, so no sequence crosses documents and
none is padded; sequences of one length form a bucket, from which training draws
batches of equal shape.

Null text is empty and has one token, the end mark. Repeated rows and null ids are
packed like any other row. Empty table: no rows. A text of any length is one row
here and one Arrow value; its pieces leave as rows of bounded size.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator
from itertools import pairwise
from operator import add

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadstone.llm.merges import WordMerges
from loadstone.llm.tables import bounded_batches, column, give_back_memory, without_cycle_search

# Words and marks, and other chunks of text, whose tokens a task remembers, twice over; a
# speed-up that no result depends on.
REMEMBERED = 75_000

# Bytes whose chunks are held at once, as Arrow arrays.
AT_ONCE = 2_000_000

# A word of Latin letters, each of which is stable under NFC and lowered to one
# letter, and the marks behind it: two pre-tokens for sure. Other chunks take the
# tokenizer itself.
_MARKS = b".,!*$&%#?;:"
_PLAIN = re.compile("([A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u012f\u0131-\u017f]{1,40})([.,!*$&%#?;:]{0,12})")

# Lowers A-Z and turns newlines into blanks.
_LOWERED = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\n", b"abcdefghijklmnopqrstuvwxyz ")
# Where these occur, letters are not lowered ahead of the tokenizer: lead bytes of
# combining marks, which NFC joins to some small letters only, and special tokens.
_AS_THEY_ARE = (b"\xcc", b"\xcd", b"<|")


def chunk_encoder(tokenizer_json: str, end_id: int) -> Callable[[list[bytes]], list[bytes]]:
    """UTF-8 texts to their ids, as little-endian 32-bit integers, with the end mark.

    For lower-casing byte-level tokenizers with word ends that drop white space and
    never join what it separates: each blank-separated chunk is then encoded on its
    own, once for many texts, and plain words all together.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(tokenizer_json)
    merges = WordMerges(tokenizer_json)
    words, others = _Generations(), _Generations()
    end = np.array([end_id], "<u4").tobytes()

    def ids_of(chunks: list[bytes]) -> list[bytes]:
        words_in, marks_in, odd = [], [], {}
        for i, chunk in enumerate(chunks):
            word = chunk.rstrip(_MARKS)
            marks = chunk[len(word) :]
            if word.isalpha() and len(word) <= 40 and len(marks) <= 12:
                words_in.append(word.lower())
                marks_in.append(marks)
            elif found := _PLAIN.fullmatch(text := chunk.decode()):
                words_in.append(found[1].lower().encode())
                marks_in.append(found[2].encode())
            else:
                words_in.append(b"")
                marks_in.append(b"")
                odd[chunk] = i
        new = list(words.without({*words_in, *marks_in}))
        words.young.update(zip(new, merges.encode(new)))
        known = words.young.__getitem__
        out = list(map(add, map(known, words_in), map(known, marks_in)))
        new = list(others.without(set(odd)))
        encoded = tokenizer.encode_batch_fast([x.decode() for x in new], add_special_tokens=False)
        others.young.update((x, np.array(e.ids, "<u4").tobytes()) for x, e in zip(new, encoded))
        for chunk, i in odd.items():
            out[i] = others.young[chunk]
        return out

    def encode_some(texts: list[bytes]) -> list[bytes]:
        blank = []
        for text in texts:
            odd = any(x in text for x in _AS_THEY_ARE)
            blank.append(text.replace(b"\n", b" ") if odd else text.translate(_LOWERED))
        split = pc.split_pattern(pa.array(blank, pa.large_binary()), pattern=b" ")
        coded = split.flatten().dictionary_encode()
        chunks = coded.dictionary.to_pylist()
        made = pa.array(ids_of(chunks), pa.large_binary()).take(coded.indices)
        _, places, data = made.buffers()
        at = np.frombuffer(places, np.int64)[split.offsets.to_numpy()].tolist()
        data = memoryview(data) if data is not None else memoryview(b"")
        return [b"".join((data[a:b], end)) for a, b in pairwise(at)]

    def encode(texts: list[bytes]) -> list[bytes]:
        out, some, size = [], [], 0
        for text in texts:
            some.append(text)
            size += len(text)
            if size >= AT_ONCE:
                out += encode_some(some)
                some, size = [], 0
        return out + encode_some(some) if some else out

    return encode


class _Generations:
    """A memory of two generations: what the young one asks for is taken over from the old
    one, which goes when the young one is full."""

    def __init__(self):
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def without(self, keys: set[bytes]) -> set[bytes]:
        """The keys that neither knows; all others are in the young one afterwards."""
        if len(self.young) > REMEMBERED:
            self.young, self.old = {}, self.young
        missing = keys.difference(self.young)
        back = missing.intersection(self.old)
        self.young.update((k, self.old[k]) for k in back)
        return missing - back


def piece_lengths(tokens: int, longest: int) -> list[int]:
    rest = tokens % longest
    binary = [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]
    return [longest] * (tokens // longest) + binary


def pack_binary(
    docs: DataFrame,
    tokenizer_json: str,
    end_id: int,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    longest: int = 4096,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (little-endian 32-bit
    integers), doc_tokens, sequence_id, offset. ``length`` is also the bucket;
    pieces that are made together come bucket by bucket.

    A single pass without a shuffle. ``longest`` must be a power of two.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("the longest length must be a power of two")
    bounded_batches(docs.sparkSession)
    given = docs.select(
        column(docs, doc_id).alias("doc_id"), F.coalesce(column(docs, text), F.lit("")).alias("text")
    )
    schema = T.StructType(
        [
            given.schema["doc_id"],
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids", T.BinaryType()),
            T.StructField("doc_tokens", T.LongType()),
        ]
    )
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer_json)  # a file of fixed size

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with without_cycle_search():
            yield from cut_all(batches)

    def cut_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = chunk_encoder(shared.value, end_id)
        give_back_memory()  # what reading the tokenizer's file has taken
        for batch in batches:
            sizes = pc.binary_length(batch.column(1).cast(pa.binary())).to_numpy(zero_copy_only=False)
            # Some texts at a time, so that their pieces leave before the next are made.
            at = 0
            while at < len(sizes):
                upto = np.cumsum(sizes[at:], dtype=np.int64)
                rows = 1 + int(np.searchsorted(upto, AT_ONCE))
                yield cut_some(encode, batch.slice(at, rows))
                at += rows

    def cut_some(encode: Callable, batch: pa.RecordBatch) -> pa.RecordBatch:
        parents, starts, lengths, ids, totals = [], [], [], [], []
        texts = batch.column(1).cast(pa.binary()).to_pylist()
        for row, encoded in enumerate(encode(texts)):
            total = len(encoded) // 4
            at = 0
            for n in piece_lengths(total, longest):
                parents.append(row)
                starts.append(at)
                lengths.append(n)
                ids.append(encoded[4 * at : 4 * (at + n)])
                totals.append(total)
                at += n
        order = np.argsort(np.array(lengths, np.int64), kind="stable")[::-1]
        take = lambda values: [values[i] for i in order.tolist()]
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0).take(pa.array(take(parents), pa.int64())),
                pa.array(take(starts), pa.int64()),
                pa.array(take(lengths), pa.int64()),
                pa.array(take(ids), pa.binary()),
                pa.array(take(totals), pa.int64()),
            ],
            names=["doc_id", "start", "length", "ids", "doc_tokens"],
        )

    # A piece is numbered by its place in its task, which a task run again repeats.
    return given.mapInArrow(cut, schema).select(
        "*",
        F.monotonically_increasing_id().alias("sequence_id"),
        F.lit(0).cast("bigint").alias("offset"),
    )


def write_buckets(pieces: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """The pieces as Parquet in one folder for each length, ``length=...``, from which
    training reads sequences of one shape. No shuffle: every task writes to all folders."""
    pieces.write.mode(mode).partitionBy("length").parquet(path)


def read_bucket(spark: SparkSession, path: str, length: int) -> DataFrame:
    """The sequences of one length; other folders are not opened."""
    return spark.read.option("basePath", path).parquet(f"{path.rstrip('/')}/length={length}")
