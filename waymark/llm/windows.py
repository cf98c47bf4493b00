"""MinHash over overlapping windows of texts, against a small indexed set of patterns.

Patterns are partitioned by size. A size class [lo, hi] has its own blocks and windows: a run of `hi` shingles always lies
within one window of `span` blocks, so a pattern that stands in a text with at least the wanted containment meets a window
with a Jaccard similarity of at least `least`. From that bound come the bands: the number of bands of `rows` hashes is the
smallest with a miss probability below the given one. Block minima of larger classes are minima of smaller blocks, so every
hash is computed once for all classes.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np

from waymark.llm import text as T


@dataclass
class SizeClass:
    width: int
    lo: int
    hi: int
    rows: int
    containment: float
    miss: float
    wide: bool
    block: int = 0
    span: int = 0
    bands: int = 0
    least: float = 0.0
    #: sorted keys of all bands, the pattern of each, and a small bitmap per band
    tables: list = field(default_factory=list)

    def __post_init__(self):
        # wide: two long blocks; else steps of a quarter of the smallest size
        self.block = self.hi + 1 if self.wide else max(1, self.lo // 4)
        self.span = 2 if self.wide else math.ceil((self.hi + self.block - 1) / self.block)
        window = self.block * self.span if self.hi > 1 else 1
        if self.hi == 1:
            self.block = self.span = 1
        found = lambda q: math.ceil(self.containment * q - 1e-9)
        self.least = min(found(q) / (window + q - found(q)) for q in range(self.lo, self.hi + 1))
        p = self.least ** self.rows
        self.bands = 1 if p >= 1 else math.ceil(math.log(self.miss) / math.log(1 - p))


def _multipliers(n: int, seed: int) -> np.ndarray:
    return T.mixed(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


def _hash(x: np.ndarray, a: np.uint64) -> np.ndarray:
    return ((x * a) >> np.uint64(32)).astype(np.uint32)


def _band_keys(mins: list[np.ndarray]) -> np.ndarray:
    out = mins[0].astype(np.uint64)
    for m in mins[1:]:
        out = out * np.uint64(0x9E3779B97F4A7C15) + m
    return out


class PatternIndex:
    """Patterns (id, text) prepared for search; small enough to travel with a task (the caller bounds their number)."""

    def __init__(self, patterns: list[tuple[object, str | None]], width: int = 5, containment: float = 0.8, rows: int = 1,
                 miss: float = 1e-6, wide: bool = True, seed: int = 7):
        self.containment, self.ids, self.shingles = containment, [], []
        by_class: dict[tuple[int, int], list[int]] = {}
        for key, text in patterns:
            n = len(T.words(text))
            if n == 0:
                continue
            w = min(width, n)
            run = T.shingles(text, w)
            by_class.setdefault((w, len(run).bit_length() - 1), []).append(len(self.ids))
            self.ids.append(key)
            self.shingles.append(sorted(set(run)))
        self.classes: list[SizeClass] = []
        self.multipliers = np.zeros(0, np.uint64)
        for (w, c), members in sorted(by_class.items()):
            k = SizeClass(w, 1 << c, (2 << c) - 1, rows, containment, miss, wide)
            a = _multipliers(k.bands * rows, seed)
            self.multipliers = a if len(a) > len(self.multipliers) else self.multipliers
            signs = []
            for i in members:
                x, _ = T.WordBlock([s.decode("utf-8", "surrogatepass") for s in self.shingles[i]]).shingle_block(w)
                signs.append([int(_hash(x, m).min()) for m in a])
            signs = np.array(signs, np.uint32).reshape(len(members), k.bands * rows)
            for band in range(k.bands):
                keys = _band_keys([signs[:, band * rows + r] for r in range(rows)])
                order = np.argsort(keys, kind="stable")
                bitmap = np.zeros(1 << 16, bool)
                bitmap[(keys & np.uint64(0xFFFF)).astype(np.int64)] = True
                k.tables.append((keys[order], np.array(members)[order], bitmap))
            self.classes.append(k)

    def candidates(self, texts: list[str | None]) -> set[tuple[int, int]]:
        """(text number, pattern number) pairs that share a band in some window."""
        found: set[tuple[int, int]] = set()
        if not self.classes:
            return found
        block = T.WordBlock(texts)
        for width in sorted({k.width for k in self.classes}):
            x, first = block.shingle_block(width)
            if len(x):
                self._search(x, first, [k for k in self.classes if k.width == width], found)
        return found

    def _search(self, x: np.ndarray, first: np.ndarray, classes: list[SizeClass], found: set) -> None:
        owner = np.flatnonzero(np.diff(first))
        first = np.concatenate((first[owner], first[-1:]))
        steps = []  # classes by block size: cuts into the blocks before, text of every block
        for k in sorted(classes, key=lambda k: k.block):
            at, owners = _cuts(first, k.block)
            if steps and k.block % steps[-1][0].block == 0:
                before = steps[-1][2]
                steps.append((k, np.searchsorted(before, at), at, owners, True))
            else:
                steps.append((k, at, at, owners, False))
        kept: list[list[np.ndarray]] = [[] for _ in steps]
        most = max(k.bands * k.rows for k in classes)
        for p in range(most):
            y = _hash(x, self.multipliers[p])
            low = y
            for s, (k, cut, at, owners, nested) in enumerate(steps):
                source = low if nested else y
                low = source if len(cut) == len(source) else np.minimum.reduceat(source, cut)
                if p >= k.bands * k.rows:
                    continue
                window = low
                if k.span > 1:
                    window = _sliding(low, k.span)
                kept[s].append(window)
                if len(kept[s]) == k.rows:
                    keys, members, bitmap = k.tables[p // k.rows]
                    got = _band_keys(kept[s])
                    kept[s] = []
                    hit = np.flatnonzero(bitmap[(got & np.uint64(0xFFFF)).astype(np.int64)])
                    if len(hit):
                        lo = np.searchsorted(keys, got[hit], "left")
                        hi = np.searchsorted(keys, got[hit], "right")
                        for h, a, b in zip(hit[hi > lo], lo[hi > lo], hi[hi > lo]):
                            t = int(owner[owners[h]])
                            found.update((t, int(i)) for i in members[a:b])

    def verified(self, texts: list[str | None]) -> list[tuple[int, object, int, int]]:
        """(text number, pattern id, distinct shingles of the pattern, those found) where enough shingles stand in the text."""
        out = []
        by_text: dict[int, list[int]] = {}
        for t, i in self.candidates(texts):
            by_text.setdefault(t, []).append(i)
        for t, members in sorted(by_text.items()):
            line = b" " + b" ".join(T.words(texts[t])) + b" "
            for i in sorted(members):
                need = self.shingles[i]
                n = sum(b" " + s + b" " in line for s in need)
                if n >= self.containment * len(need) - 1e-9:
                    out.append((t, self.ids[i], len(need), n))
        return out


def _cuts(first: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of blocks that begin anew at every text, and each block's text."""
    n = -(-np.diff(first) // block)
    owners = np.repeat(np.arange(len(n)), n)
    within = np.arange(len(owners)) - np.repeat(np.cumsum(n) - n, n)
    return first[:-1][owners] + within * block, owners


def _sliding(low: np.ndarray, span: int) -> np.ndarray:
    """Minimum of every `span` neighbours. A window at the end of a text runs into the next one: it stays as large as any
    other, so the bound holds, and a match that only the next text has fails the exact check."""
    out, done = low, 1
    while done < span:
        step = min(done, span - done)
        moved = out.copy()
        moved[:-step] = np.minimum(out[:-step], out[step:]) if len(out) > step else out[:-step]
        out, done = moved, done + step
    return out
