"""Vectorised hashing of the words of many texts at once (numpy; used by operators of free style)."""

from __future__ import annotations

import numpy as np

_rng = np.random.Generator(np.random.PCG64(20240607))
#: A random 64-bit number per byte value, and an odd multiplier: the word hash is the sum of RANDOM[byte] * MULT^i mod 2^64.
RANDOM = _rng.integers(0, 2**64, 256, dtype=np.uint64)
MULT = np.uint64(int(_rng.integers(0, 2**63, dtype=np.uint64)) * 2 + 1)
INVERSE = np.uint64(pow(int(MULT), -1, 2**64))
IS_WHITE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
LOWER = np.where((np.arange(256) >= 65) & (np.arange(256) <= 90), np.arange(256) + 32, np.arange(256)).astype(np.uint8)
_powers: dict[str, np.ndarray] = {}


def powers(n: int, of: np.uint64 = MULT, name: str = "up") -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        with np.errstate(over="ignore"):
            have = np.cumprod(np.full(max(n, 1 << 16), of, np.uint64), dtype=np.uint64)
            have = np.concatenate(([np.uint64(1)], have[:-1]))
        _powers[name] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: spreads every input bit over all output bits."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def word_spans(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of non-white bytes. UTF-8 keeps white space apart from all other bytes."""
    solid = np.zeros(len(buf) + 2, np.int8)
    solid[1:-1] = ~IS_WHITE[buf]
    edge = np.diff(solid)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def range_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Mixed hash of buf[s:e] for every pair, in one pass over buf."""
    n = len(buf)
    with np.errstate(over="ignore"):
        sums = np.concatenate(([np.uint64(0)], np.cumsum(RANDOM[buf] * powers(n), dtype=np.uint64)))
        return mix((sums[ends] - sums[starts]) * powers(n + 1, INVERSE, "down")[starts] + (ends - starts).astype(np.uint64))


def joined(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of texts, a line feed after each, and where each begins (with the end appended)."""
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    at = np.concatenate(([0], np.cumsum([len(r) + 1 for r in raw]))).astype(np.int64)
    return np.frombuffer(b"\n".join(raw) + b"\n", np.uint8), at


def chunks(texts: list, limit: int = 1 << 19):
    """Index ranges of consecutive texts of about limit characters, one text at least."""
    i = 0
    while i < len(texts):
        j, n = i, 0
        while j < len(texts) and (j == i or n + len(texts[j] or "") <= limit):
            n += len(texts[j] or "")
            j += 1
        yield i, j
        i = j
