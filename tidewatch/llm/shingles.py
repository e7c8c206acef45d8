"""Word-shingle sets of whole texts as 64-bit hashes, and their MinHash signatures; numpy, run inside tasks."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

WIDTH = 5
#: Bytes hashed at a time, so that a very long text needs no more memory than many short ones.
SEGMENT = 1 << 20

_U = np.uint64
_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _rng.integers(0, 2**64, 256, dtype=np.uint64)
_BYTE[65:91] = _BYTE[97:123]  # A-Z count as a-z
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_STEP = _U(0x9E3779B97F4A7C15)
_BACK = _U(pow(0x9E3779B97F4A7C15, -1, 2**64))
_PLACE = _rng.integers(0, 2**63, WIDTH, dtype=np.uint64) * _U(2) + _U(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


_POWERS: dict[str, np.ndarray] = {"up": _powers(_STEP, 1), "down": _powers(_BACK, 1)}


def _word_hashes(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first byte) of each word of a byte array: differences of prefix sums, shifted back to place 0."""
    n = len(raw)
    if len(_POWERS["up"]) < n + 1:
        _POWERS.update(up=_powers(_STEP, n + 1), down=_powers(_BACK, n + 1))
    space = _SPACE[raw]
    edge = np.diff(np.concatenate(([True], space, [True])).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[raw] * _POWERS["up"][:n], dtype=np.uint64)))
    return mix((total[ends] - total[starts]) * _POWERS["down"][starts]), starts


def shingle_sets(texts: list[str | None], width: int = WIDTH) -> list[np.ndarray]:
    """Each text's distinct shingles, sorted; a text of fewer words is one shingle, one without words none."""
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    words: list[list[np.ndarray]] = [[] for _ in raw]
    for piece, owner in _in_order(raw):
        hashes, starts = _word_hashes(np.frombuffer(piece, np.uint8))
        cuts = np.searchsorted(starts, [s for s, _ in owner[1:]])
        for (_, i), part in zip(owner, np.split(hashes, cuts), strict=True):
            words[i].append(part)
    out = []
    for parts in words:
        w = np.concatenate(parts) if len(parts) > 1 else parts[0] if parts else np.zeros(0, np.uint64)
        if len(w) >= width:
            n = len(w) - width + 1
            s = np.zeros(n, np.uint64)
            for k in range(width):
                s += w[k : k + n] * _PLACE[k % WIDTH]
            out.append(np.unique(mix(s)))
        elif len(w):
            out.append(mix(np.sum(w * _PLACE[: len(w)], keepdims=True, dtype=np.uint64) + _U(len(w))))
        else:
            out.append(w)
    return out


def _in_order(raw: list[bytes]) -> Iterator[tuple[bytes, list[tuple[int, int]]]]:
    """Short texts joined, each long text on its own, part after part."""
    short: list[int] = []
    size = 0

    def joined() -> tuple[bytes, list[tuple[int, int]]]:
        at, owner = 0, []
        for i in short:
            owner.append((at, i))
            at += len(raw[i]) + 1
        return b"\n".join(raw[i] for i in short), owner

    for i, text in enumerate(raw):
        if len(text) > SEGMENT:
            at = 0
            while at < len(text):
                cut = len(text)
                if cut - at > SEGMENT:
                    cut = 1 + max(text.rfind(b" ", at, at + SEGMENT), text.rfind(b"\n", at, at + SEGMENT))
                    if cut <= at:  # a word longer than a segment stays whole
                        ends = [p + 1 for p in (text.find(b" ", at + SEGMENT), text.find(b"\n", at + SEGMENT)) if p >= 0]
                        cut = min(ends, default=len(text))
                yield text[at:cut], [(0, i)]
                at = cut
            continue
        if short and size + len(text) > SEGMENT:
            yield joined()
            short, size = [], 0
        short.append(i)
        size += len(text) + 1
    if short:
        yield joined()


class MinHash:
    """``count`` minima of ``(a * x + b) >> 32`` over a set: one agrees between two sets with their Jaccard similarity."""

    def __init__(self, count: int, seed: int = 7):
        rng = np.random.Generator(np.random.PCG64(seed))
        self.a = rng.integers(0, 2**63, count, dtype=np.uint64) * _U(2) + _U(1)
        self.b = rng.integers(0, 2**64, count, dtype=np.uint64)

    def signatures(self, sets: list[np.ndarray], tile: int = 1 << 15) -> np.ndarray:
        """(sets, count) uint32; an empty set's row is all ones."""
        out = np.full((len(sets), len(self.a)), 0xFFFFFFFF, np.uint32)
        rows: list[int] = []
        size = 0
        for i, s in enumerate(sets):
            if len(s):
                rows.append(i)
                size += len(s)
            if rows and (size >= tile or i == len(sets) - 1):
                self._fill(out, rows, sets, tile)
                rows, size = [], 0
        if rows:
            self._fill(out, rows, sets, tile)
        return out

    def _fill(self, out: np.ndarray, rows: list[int], sets: list[np.ndarray], tile: int) -> None:
        if len(rows) == 1:  # one large set: tile by tile
            s = sets[rows[0]]
            for at in range(0, len(s), tile):
                part = s[at : at + tile]
                for j in range(len(self.a)):
                    out[rows[0], j] = min(out[rows[0], j], ((part * self.a[j] + self.b[j]) >> _U(32)).min())
            return
        x = np.concatenate([sets[i] for i in rows])
        starts = np.concatenate(([0], np.cumsum([len(sets[i]) for i in rows])[:-1]))
        for j in range(len(self.a)):
            out[rows, j] = np.minimum.reduceat((x * self.a[j] + self.b[j]) >> _U(32), starts)
