"""Word hashes of a text, computed for all its words at once."""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_SLICE = 1 << 18  # characters hashed at once
_TOGETHER = 1 << 15  # characters of short texts that are hashed as one text


def _powers(base: int) -> np.ndarray:
    p = np.full(_SLICE + 16, np.uint64(base), dtype=np.uint64)
    p[0] = 1
    return np.cumprod(p)


_UP, _DOWN = _powers(_BASE), _powers(pow(_BASE, -1, 1 << 64))
# Letters and digits of the basic plane; what lies above it counts as a letter.
_IN_WORD = np.array([chr(c).isalnum() for c in range(1 << 16)])


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _MIX
    return h ^ (h >> np.uint64(29))


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")


def in_words(codes: np.ndarray) -> np.ndarray:
    """Whether each character is a letter or a digit."""
    return _IN_WORD[np.minimum(codes, 0xFFFF)] | (codes > 0xFFFF)


def word_hashes(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hashes, start positions) of the words of a text: its runs of
    letters and digits, in lower case. Words longer than a slice are cut."""
    codes = code_points(text.lower())
    hashes, starts_at, at = [], [], 0
    while at < len(codes):
        part = codes[at: at + _SLICE]
        inside = in_words(part)
        if at + len(part) < len(codes) and inside[-1]:  # end the slice before its last word
            gaps = np.flatnonzero(~inside)
            if len(gaps):
                part, inside = part[: gaps[-1] + 1], inside[: gaps[-1] + 1]
        edge = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).astype(np.int8)))
        starts, ends = edge[::2], edge[1::2]
        sums = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * _UP[: len(part)], out=sums[1:])
        hashes.append((sums[ends] - sums[starts]) * _DOWN[starts])
        starts_at.append(starts + at)
        at += len(part)
    if not hashes:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    return mixed(np.concatenate(hashes)), np.concatenate(starts_at)


def many_word_hashes(texts: list[str]) -> list[np.ndarray]:
    """The word hashes of each text; short texts are hashed together, a line feed between them."""
    low = [t.lower() for t in texts]
    out, at = [], 0
    while at < len(low):
        end, size = at + 1, len(low[at]) + 1
        while end < len(low) and size + len(low[end]) < _TOGETHER:
            size += len(low[end]) + 1
            end += 1
        hashes, place = word_hashes("\n".join(low[at:end]))
        ends = np.cumsum([len(t) + 1 for t in low[at:end - 1]])
        out += np.split(hashes, np.searchsorted(place, ends))
        at = end
    return out
