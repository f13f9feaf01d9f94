"""Byte-pair encoding by a deterministic automaton over tokens.

The automaton starts as one state with an arc to itself for each byte, and every merge
(a, b) in turn adds its gadget: the state that a leads to is copied without its b-arc,
all a-arcs go to the copy, and the merged token gets an arc wherever a has one, to the
state that b led to. Then a path of arcs spells a text just if its labels are the text's
tokens, and every text has one path. All arcs of a token lead to the same state, so a state
is kept as what the gadgets took away: the tokens on the right edge of the token that leads
to it, each with the time up to which its gadgets count. An arc is missing if one of these
gadgets took, in time, a token on the left edge of the arc's own.

A text is cut into words by the tokenizer's pattern. A word walks a trie of labels from its
first byte; the longest label whose arc leaves the current state is taken, shorter ones
where the way turns out to be blocked, and a place that was found blocked is not entered
again: time in proportion to the length, whatever the word. New words of many texts walk
together (``paths``), long ones by themselves. Labels emitted along a path are the text
again: that is how ids are decoded.

Null text is empty and has no tokens. Special tokens inside a text are ids of their own, as
in the ``tokenizers`` library. Repeated rows, null ids and extra columns are of no account.
Empty table: no rows. A long text is one Arrow value, cut between words into chunks for
the pattern; a word of any length is encoded whole.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadstone.llm.merges import byte_letters
from loadstone.llm.paths import START, Paths
from loadstone.llm.tables import bounded_batches, column, without_cycle_search

# Fixed value: how byte-level tokenizers cut text into words.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# The same for ASCII text, without tables of letters.
ASCII_PATTERN = r" ?[A-Za-z]+|'s|'t|'re|'ve|'m|'ll|'d| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+"

# Words and arcs that a task remembers, twice over, and bytes of a word that is; speed only.
REMEMBERED, REMEMBERED_BYTES = 150_000, 256

# Characters that are cut into words at once.
AT_ONCE = 1_000_000

# New words that walk together, at least and at most, and the characters of the longest; speed only.
TOGETHER, TOGETHER_MOST, TOGETHER_LENGTH = 200, 4_000, 64

FOREVER = 1 << 62


@dataclass(frozen=True)
class Automaton:
    """What the merges compile to; plain tables that travel to the executors."""

    labels: dict[int, bytes]  # bytes of each token, special ones too
    special: dict[str, int]
    splitter: str  # the tokenizer without its merges, for words of unknown letters
    trie: dict[int, int]  # node << 8 | byte -> node
    token_at: list[int]  # the token that a node of the trie spells, or -1
    shorter: dict[int, int]  # the longest token that begins a token
    state_of: dict[int, int]  # where the arcs of a token lead
    states: list[tuple[tuple[int, int], ...]]  # (token, time): its gadgets before that time
    left: dict[int, tuple[tuple[int, int], ...]]  # (token, time) on the left edge of a token
    gadgets: dict[int, int]  # a << 32 | b -> when b was taken from behind a
    paths: Paths  # the same for many words at once


def _missing(right: tuple, left: tuple, gadgets: dict[int, int]) -> bool:
    """Whether a gadget took the arc of a token, by the edges that meet."""
    for r, until in right:
        for l, made in left:  # noqa: E741
            at = gadgets.get(r << 32 | l)
            if at is not None and at < until and at <= made:
                return True
    return False


class _Labels(dict):
    """Bytes by token; an id that no token has stands for none."""

    def __missing__(self, token: int) -> bytes:
        return b""


def _supported(tokenizer_json: str) -> dict:
    given = json.loads(tokenizer_json)
    model, cutter = given["model"], given["pre_tokenizer"] or {}
    odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges") if model.get(k)]
    plain = cutter.get("type") == "ByteLevel" and cutter.get("use_regex", True) and not cutter.get("add_prefix_space")
    if model["type"] != "BPE" or odd or given.get("normalizer") or not plain:
        raise ValueError("a byte-level tokenizer without normalizer, prefix space or word marks is required")
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in given["added_tokens"]):
        raise ValueError("special tokens that take in their surroundings are not supported")
    return given


def token_labels(tokenizer_json: str) -> dict[int, bytes]:
    """The bytes of each token, special ones too."""
    given = _supported(tokenizer_json)
    byte_of = {c: b for b, c in enumerate(byte_letters())}
    labels = _Labels({i: bytes(byte_of[c] for c in t) for t, i in given["model"]["vocab"].items() if all(c in byte_of for c in t)})
    labels.update({t["id"]: t["content"].encode() for t in given["added_tokens"]})
    return labels


def spelt(labels: dict[int, bytes], ids: bytes) -> str:
    """The labels of the ids, one after the other; ids that no token has are passed over."""
    numbers = np.frombuffer(ids, "<u4")
    chunks = [b"".join(map(labels.__getitem__, numbers[k : k + AT_ONCE].tolist())) for k in range(0, len(numbers), AT_ONCE)]
    return b"".join(chunks).decode("utf-8", "replace")


def compile_merges(tokenizer_json: str) -> Automaton:
    """The automaton of a byte-level tokenizer file."""
    given = _supported(tokenizer_json)
    model = given["model"]
    vocab = model["vocab"]
    byte_of = {c: b for b, c in enumerate(byte_letters())}

    live = {vocab[c]: bytes([b]) for c, b in byte_of.items() if c in vocab}
    right = {t: ((t, FOREVER),) for t in live}
    left = dict(right)
    gadgets: dict[int, int] = {}
    for now, merge in enumerate(model["merges"]):
        a, b = merge.split(" ") if isinstance(merge, str) else merge
        made, a, b = vocab[a + b], vocab[a], vocab[b]
        if a not in live or b not in live or _missing(right[a], left[b], gadgets):
            continue  # no path has these two in a row any more
        if made in live:
            raise ValueError("two merges make one token")
        gadgets[a << 32 | b] = now
        live[made] = live[a] + live[b]
        right[made] = ((made, FOREVER), *((t, min(until, now)) for t, until in right[b]))
        left[made] = ((made, FOREVER), *((t, min(until, now)) for t, until in left[a]))

    times: dict[int, list[int]] = {}
    for pair, at in gadgets.items():
        times.setdefault(pair >> 32, []).append(at)
    numbers: dict[tuple, int] = {}
    state_of = {}
    for token, edge in right.items():
        # Two tokens lead to one state if the same gadgets count for both.
        counted = [(t, sum(at < until for at in times.get(t, ()))) for t, until in edge]
        state = tuple((t, times[t][n - 1] + 1) for t, n in counted if n)
        state_of[token] = numbers.setdefault(state, len(numbers))

    trie: dict[int, int] = {}
    token_at = [-1]
    for token, label in live.items():
        node = 0
        for byte in label:
            key = node << 8 | byte
            node = trie.get(key, -1)
            if node < 0:
                node = trie[key] = len(token_at)
                token_at.append(-1)
        token_at[node] = token
    shorter = {}
    for token, label in live.items():
        node, found = 0, -1
        for byte in label[:-1]:
            node = trie[node << 8 | byte]
            found = token_at[node] if token_at[node] >= 0 else found
        shorter[token] = found

    labels, special = token_labels(tokenizer_json), {t["content"]: t["id"] for t in given["added_tokens"]}
    states = list(numbers)
    paths = Paths(live, trie, token_at, shorter, state_of, states, left, gadgets)
    cutting = {**given, "model": {**model, "vocab": {}, "merges": []}, "added_tokens": []}
    return Automaton(
        labels, special, json.dumps(cutting), trie, token_at, shorter, state_of, states, left, gadgets, paths
    )


class _Remembered(dict):
    """A memory of bounded size: what has not been asked for in a while is forgotten."""

    def __init__(self, find):
        super().__init__()
        self.find, self.old = find, {}

    def __missing__(self, key):
        found = self.old.get(key)
        if found is None:
            found = self.find(key)
        self.make_room()
        if not isinstance(key, str) or len(key) <= REMEMBERED_BYTES:
            self[key] = found
        return found

    def make_room(self) -> None:
        if len(self) >= REMEMBERED:
            self.old = dict(self)
            self.clear()


class Encoder:
    """Texts to ids by the automaton, and back."""

    def __init__(self, automaton: Automaton):
        import regex

        self.auto = automaton
        self.words = _Remembered(lambda word: self.path(word.encode()))
        self.arcs = _Remembered(self._arc)
        self.find_words = regex.compile(PATTERN).findall
        self.find_ascii_words = re.compile(ASCII_PATTERN, re.ASCII).findall
        self.gap = regex.compile(r"(?<=[A-Za-z])(?= [A-Za-z])")
        special = sorted(automaton.special, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None
        self.known_letters: set[str] = set()
        self.library = None

    def _arc(self, key: int) -> bool:
        auto = self.auto
        return not _missing(auto.states[key >> 32], auto.left[key & 0xFFFFFFFF], auto.gadgets)

    def path(self, word: bytes) -> bytes:
        """Ids of one word, little-endian 32-bit: the labels of the one path that spells it."""
        auto, arcs = self.auto, self.arcs
        trie, token_at, labels, state_of = auto.trie, auto.token_at, auto.labels, auto.state_of
        n, at, state = len(word), 0, START
        taken: list[int] = []
        blocked: set[int] = set()
        token = self._longest(word, 0)
        while at < n:
            if token < 0:
                blocked.add(at)
                token = taken.pop()
                at -= len(labels[token])
                state = state_of[taken[-1]] if taken else START
                token = auto.shorter[token]
                continue
            end = at + len(labels[token])
            if end in blocked or state != START and not arcs[state << 32 | token]:
                token = auto.shorter[token]
                continue
            taken.append(token)
            at, state, node, token = end, state_of[token], 0, -1
            for i in range(at, n):
                node = trie.get(node << 8 | word[i], -1)
                if node < 0:
                    break
                if token_at[node] >= 0:
                    token = token_at[node]
        return np.array(taken, "<u4").tobytes()

    def _longest(self, word: bytes, at: int) -> int:
        node, token = 0, -1
        for byte in word[at:]:
            node = self.auto.trie.get(node << 8 | byte, -1)
            if node < 0:
                break
            token = self.auto.token_at[node] if self.auto.token_at[node] >= 0 else token
        return token

    def _knows(self, text: str) -> bool:
        """Whether all letters were assigned when this interpreter's tables were made. Those
        that are newer may be letters to one library and not to another."""
        for c in set(text) - self.known_letters:
            if unicodedata.category(c) == "Cn":
                return False
            self.known_letters.add(c)
        return True

    def _words(self, text: str) -> list[str]:
        if text.isascii():
            return self.find_ascii_words(text)
        if self._knows(text):
            return self.find_words(text)
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_str(self.auto.splitter).pre_tokenizer
        return [text[a:b] for _, (a, b) in self.library.pre_tokenize_str(text)]

    def _chunks(self, text: str) -> Iterator[str]:
        """The text in chunks that are cut where one blank stands between two letters."""
        at = 0
        while len(text) - at > AT_ONCE:
            gap = self.gap.search(text, at + AT_ONCE)
            if gap is None:
                break
            yield text[at : gap.start()]
            at = gap.start()
        yield text[at:] if at else text

    def _pieces(self, text: str) -> Iterator[tuple[list[str] | bytes, int]]:
        """The words of the text, chunk by chunk, and the ids of special tokens between them,
        each with the characters cut into words."""
        special = self.auto.special
        parts = self.special.split(text) if self.special and any(s in text for s in special) else [text]
        for i, part in enumerate(parts):
            if i % 2:
                yield np.array([special[part]], "<u4").tobytes(), 0
            else:
                for chunk in self._chunks(part):
                    words = self._words(chunk)
                    for k in range(0, len(words), AT_ONCE):
                        yield words[k : k + AT_ONCE], len(chunk)

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text; the words of about AT_ONCE characters are looked up together."""
        out: list[list[bytes]] = [[] for _ in texts]
        pieces: list[tuple[list[bytes], list[str] | bytes]] = []
        size = 0
        for ids, text in zip(out, texts, strict=True):
            for piece, cut in self._pieces(text):
                pieces.append((ids, piece))
                size += cut
                if size >= AT_ONCE:
                    self._look_up(pieces)
                    pieces, size = [], 0
        self._look_up(pieces)
        return [b"".join(ids) for ids in out]

    def _look_up(self, pieces: list[tuple[list[bytes], list[str] | bytes]]) -> None:
        self._learn(set().union(*[piece for _, piece in pieces if isinstance(piece, list)]))
        for ids, piece in pieces:
            ids.append(b"".join(map(self.words.__getitem__, piece)) if isinstance(piece, list) else piece)

    def _learn(self, words: set[str]) -> None:
        """Find the ids of words that are not remembered, many at once."""
        self.words.make_room()
        known, old = self.words, self.words.old
        new = [w for w in words if w not in known and w not in old and len(w) <= TOGETHER_LENGTH]
        if len(new) >= TOGETHER:
            for k in range(0, len(new), TOGETHER_MOST):
                some = new[k : k + TOGETHER_MOST]
                known.update(zip(some, self.auto.paths([w.encode() for w in some]), strict=True))

    def decode(self, ids: bytes) -> str:
        return spelt(self.auto.labels, ids)


def encode_documents(docs: DataFrame, tokenizer_json: str, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids): little-endian 32-bit ids of each text. One pass, no shuffle."""
    bounded_batches(docs.sparkSession)
    given = docs.select(column(docs, doc_id).alias("doc_id"), F.coalesce(column(docs, text), F.lit("")).alias("text"))
    schema = T.StructType([given.schema["doc_id"], T.StructField("ids", T.BinaryType())])
    shared = docs.sparkSession.sparkContext.broadcast(compile_merges(tokenizer_json))  # as large as the file

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with without_cycle_search():
            encoder = Encoder(shared.value)
            for batch in batches:
                ids = encoder.encode_all(batch.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], names=["doc_id", "ids"])

    return given.mapInArrow(run, schema)


def decode_documents(encoded: DataFrame, tokenizer_json: str) -> DataFrame:
    """The rows with the texts that their ``ids`` spell, as ``text``."""
    schema = T.StructType([*encoded.schema.fields, T.StructField("text", T.StringType())])
    shared = encoded.sparkSession.sparkContext.broadcast(token_labels(tokenizer_json))
    at = encoded.columns.index("ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels = shared.value
        for batch in batches:
            texts = [spelt(labels, x or b"") for x in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=schema.names)

    return encoded.mapInArrow(run, schema)
