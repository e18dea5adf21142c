"""64-bit hashes of the words of many texts at once, in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

#: Texts are hashed in slices of about this many bytes, which keeps numpy's temporaries in the cache.
SLICE_BYTES = 1 << 19
U = np.uint64
BASE = 0x9E3779B97F4A7C15
_TABLES: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> U(30))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash's base and their inverses modulo 2 ** 64."""
    if len(_TABLES.get("pow", ())) < n:
        size = max(n, 2 * SLICE_BYTES)
        for name, base in (("pow", BASE), ("inv", pow(BASE, -1, 1 << 64))):
            steps = np.full(size, U(base))
            steps[0] = 1
            _TABLES[name] = np.multiply.accumulate(steps)
    return _TABLES["pow"][:n], _TABLES["inv"]


def _word_bytes() -> np.ndarray:
    out = np.zeros(256, bool)
    out[ord("0") : ord("9") + 1] = out[ord("a") : ord("z") + 1] = out[0x80:] = True
    return out


WORD_BYTES = _word_bytes()


@dataclass
class Words:
    """Words of lower-cased UTF-8 texts: runs of ASCII letters, digits and all bytes of other characters."""

    text_of: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    upto: np.ndarray
    inverse: np.ndarray

    def hashes(self, most: int | None = None) -> np.ndarray:
        """Hash of each word, or of its first ``most`` bytes where it's longer."""
        ends = self.ends if most is None else np.minimum(self.ends, self.starts + most)
        return mix((self.upto[ends] - self.upto[self.starts]) * self.inverse[self.starts])


def words(texts: list[bytes], word_bytes: np.ndarray = WORD_BYTES) -> Words:
    """Runs of ``word_bytes`` (a line feed is none)."""
    raw = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    first = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))[:-1]
    inside = word_bytes[raw]
    before = np.concatenate(([False], inside[:-1]))
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(before & ~inside)
    power, inverse = _powers(len(raw) + 1)
    upto = np.concatenate((np.zeros(1, U), np.cumsum((raw.astype(U) + U(1)) * power[: len(raw)])))
    return Words(np.searchsorted(first, starts, "right") - 1, starts, ends, upto, inverse)


def cuts(texts: list) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most SLICE_BYTES, or of one text."""
    lo = total = 0
    for i, t in enumerate(texts):
        if i > lo and total + len(t) > SLICE_BYTES:
            yield lo, i
            lo, total = i, 0
        total += len(t)
    if lo < len(texts):
        yield lo, len(texts)
