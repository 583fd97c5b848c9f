"""Word sequences as arrays of 64-bit ids, and hashes over their windows."""
from __future__ import annotations

import numpy as np
import xxhash

BASE = np.uint64(0x9E3779B97F4A7C15)


SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: longer words are hashed one by one
LONG_WORD = 48
#: texts are hashed together until they make so many bytes
CHUNK = 1 << 20


def hash_words(texts: list[bytes]) -> list[np.ndarray]:
    """64-bit hashes of each text's words, for all texts in one go: the k-th bytes of all words that
    have one are mixed in together (words ordered by length, so these are a prefix)."""
    data = np.frombuffer(b" " + b" ".join(texts) + b" ", np.uint8)
    word = ~SPACE[data]
    edge = np.flatnonzero(word[1:] != word[:-1]) + 1
    starts, ends = edge[::2], edge[1::2]
    sizes = ends - starts
    order = np.argsort(np.minimum(sizes, (1 << 15) - 1).astype(np.int16) * np.int16(-1), kind="stable")
    first, size = starts[order], sizes[order]
    longest = min(int(size[0]), LONG_WORD) if len(size) else 0
    holding = np.searchsorted(-size, -np.arange(longest), "left") if longest else []
    with np.errstate(over="ignore"):
        h = size.astype(np.uint64) * BASE
        for k in range(longest):
            m = int(holding[k])
            part = h[:m]
            part ^= data[first[:m] + k]
            part *= np.uint64(0x100000001B3)
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(29)
    for i in range(int(np.searchsorted(-size, -LONG_WORD, "left"))):
        h[i] = xxhash.xxh3_64_intdigest(data[first[i]:first[i] + size[i]].tobytes())
    out = np.empty(len(h), np.uint64)
    out[order] = h
    # a text begins after its separator
    begin = np.cumsum([0, *(len(t) + 1 for t in texts)])
    cuts = np.searchsorted(starts, begin + 1)
    return [out[cuts[i]:cuts[i + 1]] for i in range(len(texts))]


def hashed(texts: list[str | None], lower: bool = False):
    """Word hashes of each text, in order. ``lower`` folds A-Z (bytes.lower() changes nothing else)."""
    held, size = [], 0
    for text in texts:
        body = (text or "").encode("utf-8", "surrogatepass")
        held.append(body.lower() if lower else body)
        size += len(body)
        if size >= CHUNK:
            yield from hash_words(held)
            held, size = [], 0
    if held:
        yield from hash_words(held)


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values."""
    values = np.sort(values)
    return values[np.concatenate(([True], values[1:] != values[:-1]))] if len(values) else values


def split_words(text: str | None) -> list[bytes]:
    """Words of a text as UTF-8; bytes.split() splits at exactly the six ASCII white-space characters."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def window_hashes(ids: np.ndarray, size: int) -> np.ndarray:
    """Karp-Rabin hashes of all windows of ``size`` ids (polynomials modulo 2^64, built by doubling).
    The order of the pieces depends on ``size`` alone, so equal windows have equal hashes."""
    n = len(ids) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out, done, power, step, base = None, 0, ids.astype(np.uint64), 1, BASE
    with np.errstate(over="ignore"):
        left = size
        while left:
            if left & 1:
                piece = power[done:done + n]
                out = piece.copy() if out is None else out * base + piece
                done += step
            left >>= 1
            if left:
                power = power[:-step] * base + power[step:]
                base, step = base * base, step * 2
        out ^= out >> np.uint64(29)
        out *= np.uint64(0xBF58476D1CE4E5B9)
        out ^= out >> np.uint64(32)
        # a second round: fragments and samples are cut by the high bits
        out *= np.uint64(0x94D049BB133111EB)
        out ^= out >> np.uint64(29)
    return out


def sliding(op, values: np.ndarray, size: int) -> np.ndarray:
    """``op`` (minimum or maximum) over every window of ``size`` values, by doubling."""
    if len(values) < size:
        return values[:0]
    have = 1
    while have * 2 <= size:
        values = op(values[:-have], values[have:])
        have *= 2
    rest = size - have
    return op(values[:-rest], values[rest:]) if rest else values


def signed(values: np.ndarray) -> np.ndarray:
    """64-bit hashes as the longs that Spark holds."""
    return values.view(np.int64)
