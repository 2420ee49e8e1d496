"""Words of many texts as 64-bit hashes, with numpy over the bytes of a whole batch."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

U = np.uint64
CHUNK_BYTES = 1 << 19
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = U(0x9E3779B97F4A7C15)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)
_POWER = U(0xD6E8FEB86659FD93)
_POWERS = np.cumprod(np.append(U(1), np.full(255, _POWER)), dtype=np.uint64)


def _powers(n: int) -> np.ndarray:
    """The first powers of an odd number, ``n`` at least; longer words extend them."""
    global _POWERS
    if len(_POWERS) < n:
        _POWERS = np.cumprod(np.append(U(1), np.full(2 * n, _POWER)), dtype=np.uint64)
    return _POWERS


class Words:
    """The words of a run of texts: ``hashes`` of all, and where each text's words begin and end.

    ``starts`` and ``ends`` are byte offsets in ``data``, the texts' UTF-8 joined by a line feed.
    """

    def __init__(self, texts: list[str], lower: bool = False) -> None:
        coded = [t.encode("utf-8", "surrogatepass") for t in texts]
        self.data = b"\n".join(coded) + b"\n"
        raw = np.frombuffer(self.data, np.uint8)
        inside = np.concatenate([[False], ~_SPACE[raw]])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        self.starts, self.ends = edges[0::2], edges[1::2]
        offsets = np.cumsum([0, *(len(c) + 1 for c in coded)])
        self.bounds = np.searchsorted(self.starts, offsets)
        sizes = self.ends - self.starts
        if len(sizes):
            letters = _LOWER[raw] if lower else raw
            within = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            values = _BYTES[letters[inside[1:]]] * _powers(int(sizes.max()))[within]
            self.hashes = mix(np.add.reduceat(values, np.cumsum(sizes) - sizes) + sizes.astype(np.uint64))
        else:
            self.hashes = np.zeros(0, np.uint64)

    def __iter__(self) -> Iterator[tuple[int, int]]:
        """First and last-plus-one word of each text."""
        return zip(self.bounds[:-1].tolist(), self.bounds[1:].tolist(), strict=True)


def runs(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` consecutive words, of all hashes in a row.

    Spans of 1, 2, 4, ... words are doubled and joined, so the cost grows with the logarithm of ``size``.
    """
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out, covered = np.full(n, U(size)), 0
    span, width, odd = hashes, 1, 0xFF51AFD7ED558CCD
    while width <= size:
        factor = U(odd)
        if size & width:
            out = out * factor + span[covered : covered + n]
            covered += width
        odd = (odd * 0xC4CEB9FE1A85EC53 + 2) % (1 << 64)
        factor = U(odd)
        if 2 * width <= size:
            span = span[:-width] * factor + span[width:]
        width *= 2
    return mix(out)


def in_chunks(texts: list[str | None]) -> Iterator[tuple[int, list[str]]]:
    """Position and texts (null: empty) of runs of about ``CHUNK_BYTES`` characters."""
    run: list[str] = []
    size = 0
    for i, text in enumerate(texts):
        run.append(text or "")
        size += len(run[-1])
        if size >= CHUNK_BYTES:
            yield i + 1 - len(run), run
            run, size = [], 0
    if run:
        yield len(texts) - len(run), run
