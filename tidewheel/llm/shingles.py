"""Hashes of words and of runs of words, many texts at a time.

Words are runs of anything but space and the characters 09 to 0D, with A-Z as a-z. A word's hash
is the sum of its bytes times powers of an odd number, from running sums over a stretch of text,
so that no word becomes an object of its own; runs of words mix the hashes of their words.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

# Bytes that are handled at a time; a longer text goes on in the next stretch.
STRETCH = 1 << 19
# Odd multipliers: fixed values.
BASE, STEP, FINAL = 0x9E3779B97F4A7C15, np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xD6E8FEB86659FD93)

GAPS = np.zeros(256, bool)
GAPS[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(1, 257, dtype=np.uint64)
LOWER[0x41:0x5B] += np.uint64(0x20)

_powers: dict[int, np.ndarray] = {}


def _powers_of(base: int, n: int) -> np.ndarray:
    """Powers of ``base`` modulo 2 ** 64, at least ``n`` of them."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        steps = np.full(max(n, STRETCH), base, np.uint64)
        steps[0] = 1
        known = _powers[base] = np.cumprod(steps)
    return known


def finished(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * FINAL
    h = (h ^ (h >> np.uint64(29))) * STEP
    return h ^ (h >> np.uint64(32))


def _stretch(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, starts and ends of the words of a stretch that cuts no word."""
    gap = GAPS[raw]
    edges = np.flatnonzero(np.diff(gap, prepend=True, append=True))
    starts, ends = edges[::2], edges[1::2]
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(LOWER[raw] * _powers_of(BASE, len(raw))[: len(raw)], out=sums[1:])
    back = _powers_of(pow(BASE, -1, 1 << 64), len(raw))
    return finished((sums[ends] - sums[starts]) * back[starts]), starts, ends


class Text:
    """Words of several texts: their hashes, places in the bytes, and where each text begins."""

    def __init__(self, texts: list[bytes | None]):
        raw = b"\n".join(text or b"" for text in texts) + b"\n"
        self.raw = np.frombuffer(raw, np.uint8)
        parts, at = [], 0
        while at < len(raw):
            end = min(at + STRETCH, len(raw))
            while end < len(raw) and not GAPS[raw[end - 1]]:
                end += 1
            hashes, starts, ends = _stretch(self.raw[at:end])
            parts.append((hashes, starts + at, ends + at))
            at = end
        self.hashes, self.starts, self.ends = (np.concatenate(part) for part in zip(*parts, strict=True))
        begins = np.cumsum([0, *(len(text or b"") + 1 for text in texts)])
        #: The first word of each text, and the number of all words.
        self.bounds = np.searchsorted(self.starts, begins)

    def runs(self, width: int) -> np.ndarray:
        """A hash for each run of ``width`` words, whether or not it lies in one text."""
        n = max(len(self.hashes) - width + 1, 0)
        mixed = np.full(n, width, np.uint64)
        for k in range(width):
            mixed = mixed * STEP + self.hashes[k : n + k]
        return finished(mixed)


def gathered(texts: Iterable[bytes | None]) -> Iterator[list[bytes | None]]:
    """Texts in lists of about STRETCH bytes."""
    some, size = [], 0
    for text in texts:
        some.append(text)
        size += len(text or b"")
        if size >= STRETCH:
            yield some
            some, size = [], 0
    if some:
        yield some


def sets(texts: Iterable[bytes | None], width: int) -> Iterator[np.ndarray]:
    """The distinct hashes of the runs of ``width`` words of each text, sorted.

    A shorter text is one run; one without words has none.
    """
    for some in gathered(texts):
        text = Text(some)
        runs = text.runs(width)
        for first, end in zip(text.bounds[:-1], text.bounds[1:], strict=True):
            if end - first >= width:
                yield np.unique(runs[first : end - width + 1])
            else:
                short = text.hashes[first:end]
                mixed = np.full(min(len(short), 1), len(short), np.uint64)
                for word in short:
                    mixed = mixed * STEP + word
                yield finished(mixed)
