"""Byte-pair merges of many words at once, for the tokenizer files that
``tokenizers`` reads."""

from __future__ import annotations

import json

import numpy as np

NEVER = np.int32(2**31 - 1)


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable
    Latin-1 bytes stand for themselves, the others for the letters from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class WordMerges:
    """Ids of single pre-tokens under a byte-level vocabulary with word ends.

    Words of one length in bytes form a matrix. In each round every row merges its
    best pair, and so all rows shorten by one; rows without a pair are finished.
    """

    def __init__(self, tokenizer_json: str):
        model = json.loads(tokenizer_json)["model"]
        vocab, suffix = model["vocab"], model["end_of_word_suffix"]
        letters = byte_letters()
        self.inner = np.array([vocab[x] for x in letters], np.uint32)
        self.last = np.array([vocab[x + suffix] for x in letters], np.uint32)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = np.array([vocab[a] << 16 | vocab[b] for a, b in pairs], np.uint32)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        self.made = np.array([vocab[a + b] for a, b in pairs], np.uint32)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        want = left << np.uint32(16) | right
        at = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
        return np.where(self.keys[at] == want, self.ranks[at], NEVER)

    def encode(self, words: list[bytes]) -> list[bytes]:
        """Little-endian 32-bit ids of each word."""
        out: list[bytes] = [b""] * len(words)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        for n in np.unique(lengths[lengths > 0]).tolist():
            rows = np.flatnonzero(lengths == n)
            raw = np.frombuffer(b"".join([words[i] for i in rows]), np.uint8).reshape(-1, n)
            ids = self.inner[raw]
            ids[:, -1] = self.last[raw[:, -1]]
            self._merge(ids, rows, out)
        return out

    def _merge(self, ids: np.ndarray, rows: np.ndarray, out: list[bytes]) -> None:
        ranks = self._rank(ids[:, :-1], ids[:, 1:])
        while len(rows):
            n = ids.shape[1]
            at = ranks.argmin(axis=1) if n > 1 else np.zeros(len(rows), np.int64)
            best = ranks[np.arange(len(rows)), at] if n > 1 else np.full(len(rows), NEVER)
            done = best == NEVER
            if done.any():
                data, width = ids[done].astype("<u4").tobytes(), 4 * n
                for k, row in enumerate(rows[done].tolist()):
                    out[row] = data[k * width : (k + 1) * width]
                go = ~done
                ids, ranks, rows, at, best = ids[go], ranks[go], rows[go], at[go], best[go]
                if not len(rows):
                    return
            each = np.arange(len(rows))
            ids[each, at] = self.made[best]
            stay = np.ones(ids.shape, bool)
            stay[each, at + 1] = False
            ids = ids[stay].reshape(len(rows), n - 1)
            stay = np.ones(ranks.shape, bool)
            stay[each, at] = False
            ranks = ranks[stay].reshape(len(rows), n - 2)
            # Only the pairs on both sides of the new symbol have changed.
            left = np.flatnonzero(at > 0)
            ranks[left, at[left] - 1] = self._rank(ids[left, at[left] - 1], ids[left, at[left]])
            right = np.flatnonzero(at < n - 2)
            ranks[right, at[right]] = self._rank(ids[right, at[right]], ids[right, at[right] + 1])
