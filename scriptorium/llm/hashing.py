"""Words of many texts at once: places and hashes by numpy, and packed entries.

Texts are joined to one array of bytes; words are runs without ASCII white
space, hashed 8 bytes at a time. Entries (arrays of one length) are packed into
one binary value for each bucket, so that Spark deals a few large rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_TAILS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def mix(h: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit finaliser (splitmix64)."""
    h = h + np.uint64((0x9E3779B97F4A7C15 * (salt + 1)) & (2**64 - 1))
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def joined(texts: list[bytes], lower: bool = True) -> np.ndarray:
    """The texts, in lower case (A to Z) if asked for, a line end after each, and 8 bytes to spare."""
    text = np.frombuffer(b"\n".join(texts) + b"\n" + bytes(8), np.uint8)
    if lower:
        text = text.copy()
        text[(text >= 65) & (text <= 90)] += 32
    return text


def of_texts(starts: np.ndarray, texts: list[bytes]) -> np.ndarray:
    """Number of the first word of each joined text, and of all."""
    return np.searchsorted(starts, np.cumsum([0] + [len(t) + 1 for t in texts]))


def different(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each different value comes first, and which of them each value is."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    new = np.append(True, key[1:] != key[:-1])[: len(key)]
    which = np.empty(len(key), np.int32)
    which[order] = np.cumsum(new, dtype=np.int32) - 1
    return order[new], which


def word_places(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of joined texts."""
    space = _SPACE[text[:-8]]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if not space[0]:
        edge = np.append(0, edge)
    return edge[::2], edge[1::2]


def word_hashes(text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of words of a byte array that has 8 bytes to spare, 8 bytes at a time."""
    eight = np.ndarray((len(text) - 7,), "<u8", buffer=text, strides=(1,))
    size = ends - starts
    h = mix(size.astype(np.uint64))
    live = np.arange(len(starts))
    for k in range(0, int(min(size.max(initial=0), 128)), 8):
        live = live[size[live] > k]
        left = np.minimum(size[live] - k, 8)
        h[live] = mix(h[live] ^ (eight[starts[live] + k] & _TAILS[left]), 1)
    for k in np.flatnonzero(size > 128).tolist():
        h[k] = xxhash.xxh64_intdigest(text[starts[k] : ends[k]].tobytes())
    return h


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions of stretches, one after the other."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


def packed(entries: dict[str, np.ndarray], fields: tuple, bucket: np.ndarray, buckets: int) -> Iterator[tuple[int, bytes, np.ndarray]]:
    """Bucket, its packed entries, and which they are."""
    order = np.argsort(bucket, kind="stable")
    cuts = np.append(0, np.cumsum(np.bincount(bucket, minlength=buckets)))
    for k in np.flatnonzero(np.diff(cuts)).tolist():
        rows = order[cuts[k] : cuts[k + 1]]
        yield k, b"".join(entries[f][rows].astype(t).tobytes() for f, t in fields), rows


def unpacked(blobs: list[bytes], fields: tuple) -> dict[str, np.ndarray]:
    """The entries of packed values, one after the other."""
    width = sum(np.dtype(t).itemsize for _, t in fields)
    parts: dict[str, list[np.ndarray]] = {f: [] for f, _ in fields}
    for blob in blobs:
        n, at = len(blob) // width, 0
        for f, t in fields:
            parts[f].append(np.frombuffer(blob, t, n, at))
            at += n * np.dtype(t).itemsize
    return {f: np.concatenate(v) if v else np.zeros(0, dict(fields)[f]) for f, v in parts.items()}
