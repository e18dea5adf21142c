"""Hashed character n-grams of many texts at once, in numpy."""

from __future__ import annotations

from functools import cache

import numpy as np

#: Odd multipliers of the polynomial hash and of its last mix.
STEP, MIX = np.uint32(0x01000193), np.uint32(0x9E3779B1)


#: Beyond this code point there are no letters.
LETTERS_END = 0x34000


@cache
def letter_table() -> np.ndarray:
    """True for each code point that is a letter; made once in each Python worker."""
    out = np.zeros(0x110000, bool)
    out[:LETTERS_END] = np.fromiter((chr(i).isalpha() for i in range(LETTERS_END)), bool, LETTERS_END)
    return out


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the lower-cased texts, each closed by a 0, and where each text starts."""
    lowered = [t.lower() for t in texts]
    lengths = np.fromiter((len(t) + 1 for t in lowered), np.int64, len(lowered))
    codes = np.frombuffer(("\0".join(lowered) + "\0").encode("utf-32-le", "surrogatepass"), np.uint32)
    return codes, np.concatenate(([0], np.cumsum(lengths)))[:-1]


def subwords(codes: np.ndarray, letters: np.ndarray, sizes: tuple[int, ...], buckets: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each size, the bucket of the n-gram at each position and whether it lies in one word.

    Every character that isn't a letter is the same boundary; an n-gram may begin and end with a boundary, not hold one inside. None begins with
    the 0 that closes a text, as it would be one of the next text.
    """
    letter = letters[codes]
    symbol = np.where(letter, codes, 32).astype(np.uint32)
    out = []
    for n in sizes:
        m = len(codes) - n + 1
        if m <= 0:
            continue
        h = np.zeros(m, np.uint32)
        for k in range(n):
            h *= STEP
            h += symbol[k : k + m]
        h += np.uint32(n)
        h *= MIX
        h ^= h >> np.uint32(15)
        inside = letter[1 : 1 + m].copy() if n > 2 else letter[:m] | (letter[1 : 1 + m] if n == 2 else False)
        for k in range(2, n - 1):
            inside &= letter[k : k + m]
        inside &= codes[:m] != 0
        out.append(((h & np.uint32(buckets - 1)).astype(np.int32), inside))
    return out
