"""Words of a text as numpy arrays, and minimiser anchors of its windows."""

from __future__ import annotations

import numpy as np

_PRIME = 0x9E3779B97F4A7C15
_INVERSE = pow(_PRIME, -1, 1 << 64)
#: Bytes whose sums of powers are held at once; longer texts are taken in overlapping parts.
PART = 1 << 21
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        for name, base in (("up", _PRIME), ("down", _INVERSE)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _POWERS[name] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS["up"], _POWERS["down"]


def line_of(text: str | None) -> bytes:
    """The words, as they end at ASCII white space, joined by one space."""
    return b" ".join((text or "").encode("utf-8", "surrogatepass").split())


def bounds(line: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where each word of a line starts and ends."""
    if not line:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    spaces = np.flatnonzero(np.frombuffer(line, dtype=np.uint8) == 32)
    return np.concatenate([[0], spaces + 1]), np.concatenate([spaces, [len(line)]])


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _grams(line: bytes, starts: np.ndarray, ends: np.ndarray, width: int) -> np.ndarray:
    """A hash of each run of ``width`` words, from sums of bytes times powers of an odd number."""
    base, top = int(starts[0]), int(ends[-1])
    up, down = _powers(top - base + 1)
    octets = np.frombuffer(line, dtype=np.uint8)[base:top].astype(np.uint64) + np.uint64(1)
    sums = np.zeros(len(octets) + 1, dtype=np.uint64)
    np.cumsum(octets * up[:len(octets)], out=sums[1:])
    first, last = starts[:len(starts) - width + 1] - base, ends[width - 1:] - base
    return _mixed((sums[last] - sums[first]) * down[first] + (last - first).astype(np.uint64))


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours."""
    have = 1
    while 2 * have <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    return np.minimum(x[:len(x) - (width - have)], x[width - have:]) if have < width else x


def segments(line: bytes, window: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, first window, windows): runs of windows that share their anchor.

    A window's anchor is the run of ``width`` words in it with the least hash, leftmost
    on ties, so equal windows have equal anchors wherever they are. Windows of one
    segment contain its anchor at different places and are all different.
    """
    starts, ends = bounds(line)
    out = []
    n = len(starts) - window + 1
    at = 0
    while at < n:
        stop = int(np.searchsorted(ends, starts[at] + PART))
        stop = min(max(stop, at + 4 * window), len(starts))
        s, e = starts[at:stop], ends[at:stop]
        grams = _grams(line, s, e, width)
        place = np.arange(len(grams), dtype=np.uint64)
        best = _least((grams & ~np.uint64((1 << 22) - 1)) | place, window - width + 1)
        anchor = (best & np.uint64((1 << 22) - 1)).astype(np.int64)
        new = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
        out.append((grams[anchor[new]].view(np.int64), at + new, np.diff(np.append(new, len(anchor)))))
        at += len(anchor)
    if not out:
        return (np.zeros(0, dtype=np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*out))
