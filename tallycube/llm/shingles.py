"""Words of many texts at once, and 64-bit hashes of words and of runs of words, in numpy."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from tallycube.llm.common import held

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

# Bytes of words, after lower-casing. Texts are UTF-8, so each byte from 0x80 on belongs to a code point beyond ASCII.
LETTERS = np.zeros(256, bool)  # [^\x00-\x2F\x3A-\x60\x7B-\x7F]
LETTERS[0x30:0x3A] = LETTERS[0x61:0x7B] = LETTERS[0x80:] = True
VISIBLE = np.ones(256, bool)  # [^\x20\x09-\x0D]
VISIBLE[0x09:0x0E] = VISIBLE[0x20] = False

BASE = np.uint64(0x9E3779B97F4A7C15)
STEP = np.uint64(0xD6E8FEB86659FD93)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x9FB21C651E98DF25)
    return h ^ (h >> np.uint64(32))


BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * BASE)
BYTE_VALUE[0] |= np.uint64(1)


KEPT = 2_000_000


class Powers:
    """Powers of BASE and of its inverse, kept as far as they have been needed, up to KEPT; more, for a long text, are made anew."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
            up, down = (np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, x, np.uint64)])) for x in (BASE, inverse))
            if n > KEPT:
                return up, down
            self.up, self.down = up, down
        return self.up, self.down


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers that this worker holds until its task or its kind of tasks ends."""
    return held("powers", Powers).upto(n)


class Words:
    """The words of some texts, A-Z lower-cased unless `fold` is off: `start` and `end` (bytes in `data`), `owner` (place of the text), `hash`, and `first`, the
    number of the first word of each text (one more entry than texts). `cuts` gives places inside words where another word begins."""

    def __init__(self, texts: list[bytes], inside: np.ndarray, fold: bool = True, cuts: Callable[[np.ndarray], np.ndarray] | None = None):
        raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        self.data = LOWER[raw] if fold else raw
        lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        bounds = np.concatenate([[0], np.cumsum(lengths)])
        word = np.concatenate([[False], inside[self.data]])
        edges = np.flatnonzero(word[1:] != word[:-1])
        self.start, self.end = edges[0::2], edges[1::2]
        if cuts:
            more = cuts(self.data)
            self.start, self.end = (np.sort(np.concatenate([x, more])) for x in (self.start, self.end))
        self.first = np.searchsorted(self.start, bounds)
        self.owner = np.repeat(np.arange(len(texts)), np.diff(self.first))
        up, down = powers(len(self.data) + 1)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(BYTE_VALUE[self.data] * up[: len(self.data)])])
        self.hash = mix((sums[self.end] - sums[self.start]) * down[self.start])

    def runs(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of n consecutive words of one text, and the number of the first word of each."""
        count = len(self.hash) - n + 1
        if count <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        at = np.flatnonzero(self.owner[:count] == self.owner[n - 1 :])
        h = np.full(len(at), n, np.uint64)
        for k in range(n):
            h = h * STEP + self.hash[at + k]
        return mix(h), at

    def word(self, k: int) -> str:
        return self.data[self.start[k] : self.end[k]].tobytes().decode()
