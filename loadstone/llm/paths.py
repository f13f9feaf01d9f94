"""Paths of many words at once through the automaton of ``merge_automaton``."""

from __future__ import annotations

import numpy as np

START = -1
MIX = np.uint64(0x9E3779B97F4A7C15)


class Places:
    """Whole numbers by keys of at least 0, looked up many at once: open addresses."""

    def __init__(self, given: dict[int, int]):
        bits = (4 * len(given) + 1).bit_length()
        self.shift, self.last = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.values = np.full((2, 1 << bits), -1, np.int64)
        keys = np.fromiter(given.keys(), np.int64, len(given))
        values = np.fromiter(given.values(), np.int64, len(given))
        at = self._first(keys)
        while len(keys):
            _, one = np.unique(at, return_index=True)
            one = one[self.keys[at[one]] < 0]
            self.keys[at[one]], self.values[at[one]] = keys[one], values[one]
            rest = np.ones(len(keys), bool)
            rest[one] = False
            keys, values, at = keys[rest], values[rest], at[rest] + 1 & self.last

    def _first(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * MIX >> self.shift).view(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, or -1."""
        at = self._first(keys)
        there = self.keys[at]
        other = np.flatnonzero((there != keys) & (there >= 0))
        while len(other):
            at[other] = at[other] + 1 & self.last
            there[other] = self.keys[at[other]]
            other = other[(there[other] != keys[other]) & (there[other] >= 0)]
        return np.where(there == keys, self.values[at], -1)


class Edges:
    """Tokens and times on the edges of numbered things, one after the other."""

    def __init__(self, edges: list[tuple[tuple[int, int], ...]]):
        self.count = np.array([len(x) for x in edges], np.int64)
        self.first = np.cumsum(self.count) - self.count
        self.token, self.time = np.array([x for edge in edges for x in edge], np.int64).reshape(-1, 2).T.copy()


class Paths:
    """The tables of an automaton as arrays."""

    def __init__(self, labels, trie, token_at, shorter, state_of, states, left, gadgets):
        size = max(state_of, default=0) + 1
        of_tokens = lambda found: np.fromiter((found(t) for t in range(size)), np.int64, size)
        self.steps, self.token_at = Places(trie), np.array(token_at, np.int64)
        self.length = of_tokens(lambda t: len(labels.get(t, b"")))
        self.shorter = of_tokens(lambda t: shorter.get(t, -1))
        self.state_of = of_tokens(lambda t: state_of.get(t, START))
        self.right, self.left = Edges(states), Edges([left.get(t, ()) for t in range(size)])
        self.gadgets = Places(gadgets)

    def _longest(self, data: np.ndarray, room: np.ndarray) -> np.ndarray:
        """The longest token at each byte, within the bytes that its word has from there."""
        found = np.full(len(data), -1, np.int64)
        at = np.flatnonzero(room)
        nodes, deep = np.zeros(len(at), np.int64), 0
        while len(at):
            nodes = self.steps.find(nodes << 8 | data[at + deep])
            at, nodes = at[nodes >= 0], nodes[nodes >= 0]
            token = self.token_at[nodes]
            found[at[token >= 0]] = token[token >= 0]
            deep += 1
            more = room[at] > deep
            at, nodes = at[more], nodes[more]
        return found

    def arcs(self, keys: np.ndarray) -> np.ndarray:
        """Whether a token's arc leaves a state, by state << 32 | token: no gadget took, in time, a
        token on the left edge of the arc's own from behind one on the right edge of the state's."""
        keys, back = np.unique(keys, return_inverse=True)
        state, token = keys >> 32, keys & 0xFFFFFFFF
        wide = self.left.count[token]
        pairs = self.right.count[state] * wide
        which = np.repeat(np.arange(len(keys)), pairs)
        pair = np.arange(len(which)) - np.repeat(np.cumsum(pairs) - pairs, pairs)
        r, l = np.divmod(pair, wide[which])  # noqa: E741
        r, l = r + self.right.first[state[which]], l + self.left.first[token[which]]  # noqa: E741
        at = self.gadgets.find(self.right.token[r] << 32 | self.left.token[l])
        there = np.ones(len(keys), bool)
        there[which[(at >= 0) & (at < self.right.time[r]) & (at <= self.left.time[l])]] = False
        return there[back]

    def __call__(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word, little-endian 32-bit. A round tries one token of every word that has
        not come to its end: its arc, else a shorter token, else back to the token before."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        data = np.frombuffer(b"\0".join([*words, b""]), np.uint8).astype(np.int64)  # a place behind each word, too
        ends = np.cumsum(lengths + 1) - 1
        starts = ends - lengths
        longest = self._longest(data, np.repeat(ends, lengths + 1) - np.arange(len(data)))
        taken = np.full(len(data), -1, np.int64)  # the token that a path takes at a place
        before = np.zeros(len(data), np.int64)  # where the token that leads to a place begins
        blocked = np.zeros(len(data), bool)

        some = lengths > 0
        start, end, at = starts[some], ends[some], starts[some]
        token, state = longest[at], np.full(len(at), START, np.int64)
        while len(at):
            stuck = np.flatnonzero(token < 0)
            if len(stuck):
                here = at[stuck]
                if (here == start[stuck]).any():
                    raise ValueError("no tokens spell a word")
                blocked[here] = True
                here = before[here]
                at[stuck], token[stuck] = here, self.shorter[taken[here]]
                taken[here] = -1
                state[stuck] = np.where(here == start[stuck], START, self.state_of[taken[before[here]]])
            tried = np.flatnonzero(token >= 0)
            to = at[tried] + self.length[token[tried]]
            good = ~blocked[to]
            asked = np.flatnonzero(good & (state[tried] != START))
            good[asked] = self.arcs(state[tried[asked]] << 32 | token[tried[asked]])
            bad, tried, to = tried[~good], tried[good], to[good]
            token[bad] = self.shorter[token[bad]]
            here, made = at[tried], token[tried]
            taken[here], before[to] = made, here
            at[tried], state[tried], token[tried] = to, self.state_of[made], longest[to]
            go = at < end
            if not go.all():
                start, end, at, token, state = start[go], end[go], at[go], token[go], state[go]

        found = taken >= 0
        sizes = 4 * (np.add.reduceat(found, starts, dtype=np.int64) if len(words) else lengths)
        ids, last = taken[found].astype("<u4").tobytes(), np.cumsum(sizes)
        return [ids[a:b] for a, b in zip((last - sizes).tolist(), last.tolist(), strict=True)]
