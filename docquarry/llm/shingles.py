"""Word-shingle hashing and fast similarity sketches over Arrow string buffers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
FULL = U64(0xFFFFFFFFFFFFFFFF)
#: Bytes of text hashed at once, and documents sketched at once: both bound a worker's memory.
SEGMENT = 1 << 20
GROUP = 2048
_BASE = 0x9E3779B97F4A7C15
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mixed(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_BYTE = mixed(np.arange(1, 257, dtype=U64) * U64(_BASE))


class _Powers:
    """base ** i and base ** -i mod 2 ** 64, for i below the longest segment so far."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, U64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, SEGMENT + 1)
            for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
                row = np.full(size, base, U64)
                row[0] = 1
                setattr(self, name, np.cumprod(row, dtype=U64))
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


def word_hashes(text: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words of one UTF-8 text (bytes as uint8), in order, taken in segments that end
    at white space. Equal words have equal hashes wherever they stand."""
    out, at = [], 0
    while at < len(text):
        end = min(len(text), at + SEGMENT)
        while end < len(text) and not _SPACE[text[end]]:
            end += 1
        part = _LOWER[text[at:end]]
        at = end
        space = _SPACE[part]
        edge = np.flatnonzero(np.diff(np.concatenate(([True], space, [True])).astype(np.int8)))
        starts, ends = edge[::2], edge[1::2]
        up, down = _POWERS.upto(len(part) + 1)
        run = np.zeros(len(part) + 1, U64)
        np.cumsum(_BYTE[part] * up[:-1], dtype=U64, out=run[1:])
        out.append(mixed((run[ends] - run[starts]) * down[starts] + (ends - starts).astype(U64) * U64(0xD6E8FEB86659FD93)))
    return np.concatenate(out) if out else np.zeros(0, U64)


def shingle_set(text: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles; fewer words than k make one shingle of all."""
    w = word_hashes(text)
    if not len(w):
        return w
    size = min(k, len(w))
    total = np.full(len(w) - size + 1, U64(size), U64)
    for j in range(size):
        total = mixed(total * U64(0xC2B2AE3D27D4EB4F) + w[j : len(w) - size + 1 + j])
    return np.unique(total)


def texts(column: pa.Array) -> Iterator[np.ndarray]:
    """The bytes of each text; null is empty."""
    column = column.cast(pa.large_string())
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    none = column.is_null().to_pylist() if column.null_count else None
    for i in range(len(column)):
        yield data[:0] if none and none[i] else data[ends[i] : ends[i + 1]]


def sketches(sets: list[np.ndarray], bins: int) -> np.ndarray:
    """Fast similarity sketch of each non-empty set: a row of `bins` coordinates.

    In round i < bins every element falls into a hashed bin with the value (i, hash); in round bins + j it
    falls into bin j. A bin keeps its least value, and a set is done when no bin is empty, which takes about
    bins * ln(bins) / |set| rounds and 2 * bins at most, so every coordinate is filled. Two sets agree in a
    coordinate with the probability of their Jaccard similarity, and agreement is concentrated as with
    independent coordinates (Dahlgaard, Knudsen and Thorup, 2017). `bins` is a power of two.
    """
    out = np.full((len(sets), bins), FULL, U64)
    flat = out.reshape(-1)
    active = np.flatnonzero([len(s) > 0 for s in sets])
    items = np.concatenate([sets[i] for i in active]) if len(active) else np.zeros(0, U64)
    owner = np.repeat(active, [len(sets[i]) for i in active]) if len(active) else active
    for i in range(2 * bins):
        if not len(active):
            break
        x = mixed(items ^ U64((i + 1) * 0xA0761D6478BD642F & 0xFFFFFFFFFFFFFFFF))
        bin_ = (x & U64(bins - 1)).astype(np.int64) if i < bins else i - bins
        np.minimum.at(flat, owner * bins + bin_, (U64(i) << U64(48)) | (x >> U64(16)))
        left = (out[active] == FULL).any(axis=1)
        if not left.all():
            active = active[left]
            keep = np.zeros(len(sets), bool)
            keep[active] = True
            mask = keep[owner]
            items, owner = items[mask], owner[mask]
    return out


def band_keys(sketch: np.ndarray, rows: int) -> np.ndarray:
    """A 64-bit key for each band of `rows` coordinates; bands don't share keys."""
    n, bins = sketch.shape
    bands = sketch.reshape(n, bins // rows, rows)
    key = np.broadcast_to(mixed(np.arange(1, bins // rows + 1, dtype=U64) * U64(_BASE)), (n, bins // rows)).copy()
    for j in range(rows):
        key = mixed(key * U64(0xC2B2AE3D27D4EB4F) + bands[:, :, j])
    return key
