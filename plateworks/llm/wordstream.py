"""The words of a batch of texts as flat arrays: hashes, places and document bounds, without a loop over documents."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Bytes of words that are hashed at a time.
BLOCK_BYTES = 1 << 17

_SEED = np.random.default_rng(20240301)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BYTE = _SEED.integers(0, 1 << 64, 256, dtype=np.uint64)
_BYTE[0x41:0x5B] = _BYTE[0x61:0x7B]  # A-Z count as a-z
_PLACE = _SEED.integers(0, 1 << 64, 1 << 16, dtype=np.uint64) | np.uint64(1)
STEP = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose bits all depend on all."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a string array (null: no words).

    ``begins`` and ``ends`` are bytes of ``data``; text k has the words ``first[k]`` to ``first[k + 1]``
    and the bytes ``at[k]`` to ``at[k + 1]``. ``hashes`` do not tell A-Z from a-z.
    """

    def __init__(self, column: pa.Array):
        column = column.cast(pa.string())
        if column.null_count:
            column = column.fill_null("")
        _, offsets, raw = column.buffers()
        at = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, np.int64)
        self.data = np.frombuffer(raw, np.uint8)[at[0] : at[-1]] if raw is not None and at[-1] > at[0] else np.empty(0, np.uint8)
        self.at = at - at[0]
        inside = ~_SPACE[self.data]
        begin, end = inside.copy(), inside.copy()
        begin[1:] &= ~inside[:-1]
        end[:-1] &= ~inside[1:]
        full = self.at[:-1] < self.at[1:]
        heads, tails = self.at[:-1][full], self.at[1:][full] - 1
        begin[heads], end[tails] = inside[heads], inside[tails]
        self.begins, self.ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
        self.first = np.searchsorted(self.begins, self.at)
        self.hashes = self._hashed(inside)
        self._lead: np.ndarray | None = None

    def _hashed(self, inside: np.ndarray) -> np.ndarray:
        size = self.ends - self.begins
        out = np.empty(len(size), np.uint64)
        chars = self.data[inside]
        cuts = np.concatenate([[0], np.cumsum(size)])
        a = 0
        while a < len(size):
            b = max(a + 1, int(np.searchsorted(cuts, cuts[a] + BLOCK_BYTES, "right")) - 1)
            starts = cuts[a:b] - cuts[a]
            place = np.arange(cuts[b] - cuts[a]) - np.repeat(starts, size[a:b])
            value = _BYTE[chars[cuts[a] : cuts[b]]] * _PLACE[place & 0xFFFF]
            if b == a + 1 and size[a] > 1 << 16:
                value *= (place >> 16).astype(np.uint64) * STEP * np.uint64(2) + np.uint64(1)
            out[a:b] = np.add.reduceat(value, starts)
            a = b
        return mixed(out + size.astype(np.uint64) * STEP)

    def points(self, place: np.ndarray, text: np.ndarray) -> np.ndarray:
        """Code points before each byte ``place`` within its ``text``."""
        if self._lead is None:
            lead = (self.data & 0xC0) != 0x80
            self._lead = np.empty(0, np.int64) if lead.all() else np.concatenate([[0], np.cumsum(lead)])
        if not len(self._lead):
            return place - self.at[text]
        return self._lead[place] - self._lead[self.at[text]]


def ordered_hash(hashes: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """One 64-bit hash, as signed, of each segment of words, which depends on their order."""
    size = end - begin
    cuts = np.concatenate([[0], np.cumsum(size)])
    place = np.arange(cuts[-1]) - np.repeat(cuts[:-1], size)
    value = mixed(hashes[np.repeat(begin, size) + place] + (place.astype(np.uint64) + np.uint64(1)) * STEP)
    out = np.zeros(len(size), np.uint64)
    full = size > 0
    if full.any():
        out[full] = np.add.reduceat(value, cuts[:-1][full])
    return mixed(out + size.astype(np.uint64)).view(np.int64)


def shingle_sets(hashes: np.ndarray, begin: np.ndarray, end: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of the ``width``-word shingles of each segment, one set after another, and the sets' offsets.

    A segment with fewer words has its whole sequence as one shingle; one without words is empty.
    """
    size = end - begin
    wide = max(len(hashes) - width + 1, 0)
    rolled = np.full(wide, width, np.uint64)
    for k in range(width):
        rolled *= STEP
        rolled += hashes[k : k + wide]
    rolled = mixed(rolled)
    count = np.where(size >= width, size - width + 1, np.minimum(size, 1))
    offsets = np.concatenate([[0], np.cumsum(count)])
    place = np.arange(offsets[-1]) + np.repeat(begin - offsets[:-1], count)
    found = rolled[np.minimum(place, wide - 1)] if wide else np.empty(offsets[-1], np.uint64)
    for few in range(1, width):
        short = np.flatnonzero(size == few)
        if len(short):
            value = np.full(len(short), few, np.uint64)
            for k in range(few):
                value = value * STEP + hashes[begin[short] + k]
            found[offsets[:-1][short]] = mixed(value)
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        if b - a > 1:
            found[a:b].sort()
    keep = np.ones(len(found), bool)
    keep[1:] = found[1:] != found[:-1]
    keep[offsets[:-1][count > 0]] = True
    return found[keep], np.concatenate([[0], np.cumsum(keep)])[offsets]


def binaries(flat: np.ndarray, offsets: np.ndarray, keep: np.ndarray | None = None) -> pa.Array:
    """Each segment of a flat array as bytes (of all, or of those that ``keep`` marks)."""
    parts = zip(offsets[:-1].tolist(), offsets[1:].tolist())
    wanted = [True] * (len(offsets) - 1) if keep is None else keep.tolist()
    return pa.array([flat[a:b].tobytes() for (a, b), good in zip(parts, wanted) if good], pa.binary())
