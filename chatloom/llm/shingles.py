"""Word shingles of texts as sorted arrays of 64-bit hashes, many texts at a time."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np

MASK = (1 << 64) - 1
BASE, INVERSE = 0x100000001B3, pow(0x100000001B3, -1, 1 << 64)
#: One odd factor per place of a word in its shingle, and a last one for the length of a word.
FACTORS = tuple((0x9E3779B97F4A7C15 * (2 * i + 1) + 2 * i) & MASK | 1 for i in range(1, 66))
CHUNK = 1 << 20  # bytes of text that are hashed together


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(n: int, made: list = []) -> tuple[np.ndarray, np.ndarray]:  # noqa: B006
    if not made or len(made[0]) < n:
        size = max(n, 1 << 16)
        made[:] = [np.cumprod(np.full(size, np.uint64(b))) for b in (BASE, INVERSE)]
    return made[0][:n], made[1][:n]


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first place of every word of bytes that begin and end with white space."""
    edge = np.flatnonzero((data == 32) | ((data >= 9) & (data <= 13)))
    begin, end = edge[:-1] + 1, edge[1:]
    full = end > begin
    begin, end = begin[full], end[full]
    power, inverse = powers(len(data))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(data * power)])
    return mixed((total[end] - total[begin]) * inverse[begin] + (end - begin).astype(np.uint64) * np.uint64(FACTORS[-1])), begin


def sets(texts: list[str | None], words: int = 5, seed: int = 0) -> Iterator[np.ndarray]:
    """The distinct shingles of each text, sorted; a shorter text's whole word sequence; nothing for a text without words."""
    chunk, size = [], 0
    for t in texts:
        raw = (t or "").encode("utf-8", "replace").lower()
        chunk.append(raw)
        size += len(raw)
        if size > CHUNK:
            yield from _sets(chunk, words, seed)
            chunk, size = [], 0
    yield from _sets(chunk, words, seed)


def _sets(chunk: list[bytes], words: int, seed: int) -> Iterator[np.ndarray]:
    if not chunk:
        return
    data = np.frombuffer(b"\n" + b"\n".join(chunk) + b"\n", np.uint8)
    with np.errstate(over="ignore"):
        hashes, begin = word_hashes(data.astype(np.uint64))
        starts = np.cumsum([1, *[len(c) + 1 for c in chunk]])
        first = np.searchsorted(begin, starts)
        salt = np.uint64(mix_int(seed))
        many = np.full(max(0, len(hashes) - words + 1), np.uint64(words)) + salt
        for i in range(words):
            many = many + hashes[i : i + len(many)] * np.uint64(FACTORS[i])
        many = mixed(many)
        for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            n = b - a
            if n >= words:
                yield np.unique(many[a : b - words + 1])
            elif n:
                one = np.uint64(n) + salt
                for i in range(n):
                    one = one + hashes[a + i] * np.uint64(FACTORS[i])
                yield mixed(np.array([one]))
            else:
                yield np.zeros(0, np.uint64)


def mix_int(seed: int) -> int:
    return (seed * 0x9E3779B97F4A7C15) & MASK


def name(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set, as two signed numbers."""
    raw = blake2b(shingles.tobytes(), digest_size=16).digest()
    return int.from_bytes(raw[:8], "little", signed=True), int.from_bytes(raw[8:], "little", signed=True)


def sketch(shingles: np.ndarray) -> bytes:
    """Shingles counted by their leading bits, about four to a place: the sum of the smaller counts bounds an intersection from above."""
    bits = min(14, max(3, len(shingles).bit_length() - 3))
    return np.bincount((shingles >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits).astype("<u4").astype("<u2" if len(shingles) < 65536 else "<u4").tobytes()


def counts_of(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, "<u2" if n < 65536 else "<u4").astype(np.int64)


def most_common(a: np.ndarray, b: np.ndarray) -> int:
    """The bound of two sketches, on the coarser grid."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) > len(a):
        b = b.reshape(len(a), -1).sum(1)
    return int(np.minimum(a, b).sum())
