"""Word shingles as 64-bit hashes, computed on the UTF-8 bytes of whole Arrow columns.

Words are runs of anything but the six ASCII spaces; A-Z count as a-z. A text's set is its
distinct shingles of `width` words; a shorter text is one shingle; no words, an empty set.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Bytes hashed at once, and bytes of the rows handled together.
WINDOW = 1 << 20
SLICE = 2 << 20

_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words whose output bits all depend on all input bits."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def constants(seed: int, n: int) -> np.ndarray:
    """`n` odd 64-bit numbers, the same everywhere."""
    return mix((np.arange(n, dtype=_U) + _U(seed * 1_000_003 + 1)) * _U(0x9E3779B97F4A7C15)) | _U(1)


_BASE = 0xD6E8FEB86659FD93
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BYTE = constants(1, 256)
_BYTE[ord("A") : ord("Z") + 1] = _BYTE[ord("a") : ord("z") + 1]
_PLACE = constants(2, 64)
_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2^64."""
    if len(_powers.get("up", ())) < n:
        one = np.ones(1, _U)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            _powers[name] = np.concatenate((one, np.cumprod(np.full(n - 1, base, _U))))
    return _powers["up"][:n], _powers["down"]


def _cut(buf: np.ndarray, at: int) -> int:
    """The end of a window that begins at `at` and cuts no word."""
    step = WINDOW
    while at + step < len(buf):
        spaces = np.flatnonzero(_SPACE[buf[at : at + step]])
        if spaces.size:
            return at + int(spaces[-1]) + 1
        step *= 2
    return len(buf)


def words(buf: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word of texts that lie end to end, and the number of its text."""
    hashes, places = [np.empty(0, _U)], [np.empty(0, np.int64)]
    at = 0
    while at < len(buf):
        end = _cut(buf, at)
        part = buf[at:end]
        inside = ~_SPACE[part]
        begins = starts[(starts >= at) & (starts < end)] - at
        before = np.concatenate(([False], inside[:-1]))
        before[begins] = False
        after = np.concatenate((inside[1:], [False]))
        after[begins[begins > 0] - 1] = False
        first = np.flatnonzero(inside & ~before)
        last = np.flatnonzero(inside & ~after) + 1
        up, down = _power(len(part))
        total = np.concatenate((np.zeros(1, _U), np.cumsum(_BYTE[part] * up)))
        hashes.append(mix((total[last] - total[first]) * down[first]))
        places.append(first + at)
        at = end
    place = np.concatenate(places)
    return np.concatenate(hashes), np.searchsorted(starts, place, side="right") - 1


def sets_of(buf: np.ndarray, starts: np.ndarray, width: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    # an empty text shares its start with the next one, to which searchsorted gives the words
    word, text = words(buf, starts)
    n = len(starts)
    count = np.bincount(text, minlength=n)
    first = np.concatenate(([0], np.cumsum(count)))
    weight = _PLACE[:width]
    rolled = np.empty(0, _U)
    if len(word) >= width:
        span = len(word) - width + 1
        rolled = word[:span] * weight[0]
        for i in range(1, width):
            rolled = rolled + word[i : i + span] * weight[i]
        rolled = mix(rolled)
    out = []
    for i in range(n):
        if count[i] >= width:
            out.append(np.unique(rolled[first[i] : first[i] + count[i] - width + 1]))
        elif count[i]:
            own = word[first[i] : first[i + 1]]
            short = np.sum(own * weight[: len(own)], dtype=_U, keepdims=True)
            out.append(mix(short + _PLACE[40 + len(own) % 20]))
        else:
            out.append(np.empty(0, _U))
    return out


def text_slices(batch: pa.RecordBatch, column: str, limit: int = SLICE):
    """(first row, bytes, start of each text) of runs of rows of about `limit` bytes."""
    texts = batch.column(batch.schema.get_field_index(column)).cast(pa.large_string())
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    row = 0
    while row < len(texts):
        stop = int(np.searchsorted(ends, ends[row] + limit, side="right"))
        stop = min(max(stop - 1, row + 1), len(texts))
        yield row, raw[ends[row] : ends[stop]], ends[row:stop] - ends[row]
        row = stop


def minima(sets: list[np.ndarray], n: int) -> np.ndarray:
    """`n` minima of each non-empty set under independent hashings, one row per hashing."""
    every = np.concatenate(sets)
    starts = np.cumsum([0, *(len(s) for s in sets[:-1])])
    flip, times = constants(3, n), constants(4, n)
    out = np.empty((n, len(sets)), _U)
    for i in range(n):
        out[i] = np.minimum.reduceat((every ^ flip[i]) * times[i], starts)
    return out


def packed(mins: np.ndarray) -> np.ndarray:
    """The low four bits of each minimum, sixteen to a 64-bit word; one row per set."""
    low = (mins & _U(15)).astype(np.uint8).T
    return np.ascontiguousarray(low[:, 0::2] | (low[:, 1::2] << 4)).view(np.int64)
