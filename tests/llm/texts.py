"""Small texts with the odd cases: nulls, empty and long texts, repeated rows, copies, shared passages."""

from __future__ import annotations

import random

WORDS = "the of and to in is that it was for on with as at by from river stone cloud matter signal paper window garden motion letter über naïve".split()


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + (rng.choice(["", "", "", ".", ",", "\n"])) + ("x" * rng.randint(0, 2)) for _ in range(n))


def edited(text: str, seed: int, changes: int) -> str:
    rng, words = random.Random(seed), text.split(" ")
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"edit{rng.randint(0, 10**6)}"
    return " ".join(words)


def documents(schema_extra: bool = False) -> list[tuple]:
    base = prose(1, 220)
    passage = prose(2, 60)
    rows = [
        (0, base),
        (1, base),
        (2, edited(base, 3, 4)),
        (3, edited(base, 4, 6)),
        (4, prose(5, 150) + passage + prose(6, 80)),
        (5, prose(7, 90) + passage),
        (6, None),
        (7, ""),
        (8, "one two"),
        (9, "one two"),
        (10, "Word"),
        (11, prose(8, 20_000)),
        (12, "a b c d e f g h i j k l"),
        (13, "\x1c\x85   odd\x0bspaces\tİSTANBUL ſtrasse \x00 nul"),
        (14, "=" * 500),
        (15, "=" * 300),
        (16, passage[:49]),
    ]
    return rows + [(100 + k, edited(base, 50 + k, k)) for k in range(1, 30)]
