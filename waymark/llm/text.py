"""Words and shingle hashes of whole texts, as numpy arrays inside tasks.

Words are the maximal runs outside the blanks space and 0x09-0x0D, with A-Z lower-cased; nothing else is changed.
The array form works on a block of texts at once: bytes are hashed with a polynomial modulo 2^64, so a word hash is a
difference of two prefix sums and a shingle hash a weighted sum of word hashes, and no Python object is made per word.
"""

from __future__ import annotations

import re

import numpy as np
import xxhash

WORD = re.compile(rb"[^\x20\x09-\x0d]+")
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_LUT = np.frombuffer(bytes(range(256)).translate(_LOWER), np.uint8).astype(np.uint64) + np.uint64(1)
_BLANK = np.zeros(256, bool)
_BLANK[[32, *range(9, 14)]] = True
# odd multipliers of the byte and word polynomials, and the inverse of the first modulo 2^64
_P = 0x9E3779B97F4A7C15
_P_INV = pow(_P, -1, 1 << 64)
_Q = 0xC2B2AE3D27D4EB4F


def lowered(text: str | None) -> bytes:
    """UTF-8 of a text (null: empty) with A-Z lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_LOWER)


def words(text: str | None) -> list[bytes]:
    return WORD.findall(lowered(text))


def shingles(text: str | None, width: int) -> list[bytes]:
    """Space-joined runs of `width` words with repeats; a shorter text is one shingle, a text without words none."""
    w = words(text)
    if not w:
        return []
    return [b" ".join(w[i:i + width]) for i in range(max(1, len(w) - width + 1))]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_KEPT: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64; the longest run of moderate length is kept for the next block."""
    kept = _KEPT.get(base)
    if kept is None or len(kept) < n:
        kept = np.full(max(n, 1), base, np.uint64)
        kept[0] = 1
        kept = np.multiply.accumulate(kept)
        if n <= 1 << 22:
            _KEPT[base] = kept
    return kept[:n]


def _runs(blank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last (exclusive) place of every run that is not blank; the last place is blank."""
    edge = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    if len(blank) and not blank[0]:
        edge = np.concatenate(([0], edge))
    return edge[0::2], edge[1::2]


def _shingled(words: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word number of every shingle, the number after its text's last word, and the first shingle number of each text."""
    n = np.diff(words)
    count = np.where(n == 0, 0, np.maximum(n - width + 1, 1))
    first = np.concatenate(([0], np.cumsum(count)))
    return np.arange(first[-1]) - np.repeat(first[:-1] - words[:-1], count), np.repeat(words[1:], count), first


def spelled_shingles(texts: list[str | None], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes in which every shingle of `width` words stands space-joined, where each starts and stops, and the first shingle number of each text."""
    raw = [lowered(t) for t in texts]
    buf = np.frombuffer(b" ".join(raw) + b" ", np.uint8)
    blank = _BLANK[buf]
    start, stop = _runs(blank)
    words = np.searchsorted(start, np.concatenate(([0], np.cumsum(np.fromiter((len(r) + 1 for r in raw), np.int64, len(raw))))))
    kept = ~blank
    kept[stop] = True  # one blank after each word
    buf = buf[kept]
    buf = np.where(_BLANK[buf], np.uint8(32), buf)
    after = np.cumsum(stop - start + 1)
    at, over, first = _shingled(words, width)
    last = np.minimum(at + width, over) - 1
    return buf, (after - (stop - start + 1))[at], after[last] - 1, first


_U = np.uint64
_XXH = tuple(_U(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def _rotated(x: np.ndarray, n: int) -> np.ndarray:
    return (x << _U(n)) | (x >> _U(64 - n))


def xxh64(buf: np.ndarray, start: np.ndarray, stop: np.ndarray, seed: int) -> np.ndarray:
    """XXH64 of many short runs of bytes at once; those of 32 bytes and more, which the hash mixes differently, go to the library."""
    p1, p2, p3, p4, p5 = _XXH
    padded = np.concatenate((buf, np.zeros(8, np.uint8)))
    at = np.ascontiguousarray(np.lib.stride_tricks.as_strided(padded, (len(buf) + 1, 8), (1, 1))).view("<u8").ravel()
    size = stop - start
    h = _U(seed) + p5 + size.astype(_U)
    for lane in range(0, 24, 8):
        i = np.flatnonzero(size >= lane + 8)
        h[i] = _rotated(h[i] ^ (_rotated(at[start[i] + lane] * p2, 31) * p1), 27) * p1 + p4
    i = np.flatnonzero(size & 4)
    h[i] = _rotated(h[i] ^ ((at[(start + (size & ~7))[i]] & _U(0xFFFFFFFF)) * p1), 23) * p2 + p3
    rest = at[start + (size & ~3)]
    for k in range(3):
        i = np.flatnonzero((size & 3) > k)
        h[i] = _rotated(h[i] ^ (((rest[i] >> _U(8 * k)) & _U(255)) * p5), 11) * p1
    h = (h ^ (h >> _U(33))) * p2
    h = (h ^ (h >> _U(29))) * p3
    h ^= h >> _U(32)
    i = np.flatnonzero(size >= 32)
    if len(i):
        raw = buf.tobytes()
        h[i] = [xxhash.xxh64_intdigest(raw[a:b], seed) for a, b in zip(start[i].tolist(), stop[i].tolist())]
    return h


class WordBlock:
    """The words of some texts in one run: `hashes` of all words, `first` word number of each text (one more at the end)."""

    BLANK = _BLANK  # bytes that lie between words

    def __init__(self, texts: list[str | None]):
        raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
        buf = np.frombuffer(b" ".join(raw) + b" ", np.uint8)
        sizes = np.fromiter((len(r) + 1 for r in raw), np.int64, len(raw))
        ends_at = np.cumsum(sizes)
        self.start, self.stop = _runs(self.BLANK[buf])
        self.first = np.searchsorted(self.start, np.concatenate(([0], ends_at)))
        self.hashes = self._hash(buf)

    def _hash(self, buf: np.ndarray) -> np.ndarray:
        up, down = _powers(_P, len(buf)), _powers(_P_INV, len(buf))
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_LUT[buf] * up)))
        return mixed((sums[self.stop] - sums[self.start]) * down[self.start]) if len(self.start) else np.zeros(0, np.uint64)

    def shingle_block(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Shingle hashes of all texts in one run and the first shingle number of each text; shorter texts have one shingle of all their words."""
        at, over, first = _shingled(self.first, width)
        out = np.zeros(len(at), np.uint64)
        q = 1
        for k in range(width):
            here = at + k
            ok = here < over
            out = out + np.where(ok, self.hashes[np.minimum(here, len(self.hashes) - 1)] if len(self.hashes) else 0, np.uint64(0)) * np.uint64(q)
            q = q * _Q % (1 << 64)
        return mixed(out), first


def mapped(df, fn, schema: str, text: str = "text", limit: int = 1 << 20):
    """Run fn(batch) -> record batches over a table's Arrow batches, cut so that a call sees about `limit` bytes of text (always whole texts)."""
    import pyarrow.compute as pc

    def run(batches):
        for b in batches:
            sizes = pc.fill_null(pc.binary_length(b.column(text)), 0).to_pylist()
            for lo, hi in blocks(sizes, limit):
                yield from fn(b.slice(lo, hi - lo))

    return df.mapInArrow(run, schema)


def blocks(sizes: list[int], limit: int) -> list[tuple[int, int]]:
    """Cut a run of texts with these lengths into ranges of at most `limit` characters, at least one text each."""
    out, start, total = [], 0, 0
    for i, n in enumerate(sizes):
        if i > start and total + n > limit:
            out.append((start, i))
            start, total = i, 0
        total += n
    if len(sizes) > start:
        out.append((start, len(sizes)))
    return out
