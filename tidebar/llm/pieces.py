"""SentencePiece encoding and decoding by suffix-array matching.

The distinct units of a batch of texts are laid end to end and their suffixes sorted, as deep
as the longest piece. Each piece is then found by binary search as a range of suffixes, and
every occurrence becomes an edge over the text. The edges are sorted by position and relaxed:
a unit starts as single characters, and in each round the best edge that spans exactly two of
its present symbols, by score and then from the left, replaces them, until none is left. That
is the order in which a BPE model merges, so the result is the library's own.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidebar.llm.frames import appended, map_batches, place
from tidebar.llm.units import SPACE, Units

#: No byte of UTF-8 text: it ends each unit.
_END = 0xFF
#: Units of more bytes are relaxed with a heap, since a round changes one place of a unit.
_LONG = 48
_PLACE = (1 << 24) - 1
_ROWS = 256


class Vocabulary:
    """The pieces of a model, each as UTF-8 with the space sign as one space byte."""

    def __init__(self, model: str) -> None:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        n = len(sp)
        names = [sp.id_to_piece(i) for i in range(n)]
        self.unknown = sp.unk_id()
        byte = np.array([sp.is_byte(i) for i in range(n)])
        silent = np.array([sp.is_control(i) or sp.is_unused(i) for i in range(n)])
        plain = ~byte & ~silent
        plain[self.unknown] = False
        self.byte_ids = np.full(256, self.unknown, np.int32)
        self.pieces: list[bytes] = [b""] * n
        for i, name in enumerate(names):
            if byte[i]:
                value = int(name[3:5], 16)
                self.byte_ids[value], self.pieces[i] = i, bytes([value])
            elif plain[i]:
                if SPACE in name.lstrip(SPACE):
                    raise ValueError(f"piece {name!r} holds a space after another character")
                self.pieces[i] = name.replace(SPACE, " ").encode()
        self.pieces[self.unknown] = " ⁇ ".encode()
        ids = np.flatnonzero(plain).astype(np.int32)
        one = np.array([len(names[i]) == 1 for i in ids])
        self.single, self.longer = _Matcher(self.pieces, ids[one]), _Matcher(self.pieces, ids[~one])
        scores = np.array([sp.get_score(int(i)) for i in range(n)])
        self.rank = np.unique(-scores, return_inverse=True)[1].astype(np.int64)
        self.length = np.array([len(p) for p in self.pieces], np.int64)
        self.flat = np.frombuffer(b"".join(self.pieces), np.uint8)
        self.start = np.cumsum(self.length) - self.length
        self.depth = max(self.single.depth, self.longer.depth)


class _Matcher:
    """Pieces as rows of 64-bit keys of eight bytes, for binary search in a suffix array."""

    def __init__(self, pieces: list[bytes], ids: np.ndarray) -> None:
        self.ids = ids
        self.length = np.array([len(pieces[i]) for i in ids], np.int64)
        self.depth = 8 * max(1, -(-int(self.length.max(initial=1)) // 8))
        low = np.zeros((len(ids), self.depth), np.uint8)
        high = np.full((len(ids), self.depth), 0xFF, np.uint8)
        for row, i in enumerate(ids):
            piece = np.frombuffer(pieces[i], np.uint8)
            low[row, : len(piece)] = high[row, : len(piece)] = piece
        self.low, self.high = (x.view(">u8").astype(np.uint64) for x in (low, high))

    def ranges(self, suffixes: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each piece the range of suffixes that begin with it."""
        ordered = keys[suffixes]
        a = np.searchsorted(ordered, self.low[:, 0], side="left")
        b = np.searchsorted(ordered, self.high[:, 0], side="right")
        for level in range(1, self.depth // 8):
            deep = np.flatnonzero((self.length > 8 * level) & (a < b))
            at = 8 * level
            for bound, after in ((self.low, False), (self.high, True)):
                lo, hi, goal = a[deep], b[deep], bound[deep, level]
                while (active := lo < hi).any():
                    mid = (lo + hi) >> 1
                    value = keys[np.minimum(suffixes[np.minimum(mid, len(suffixes) - 1)] + at, len(keys) - 1)]
                    right = active & ((value <= goal) if after else (value < goal))
                    lo, hi = np.where(right, mid + 1, lo), np.where(active & ~right, mid, hi)
                if after:
                    b[deep] = lo
                else:
                    first = lo
            a[deep] = first
        return a, b


@lru_cache(maxsize=2)
def vocabulary(model: str) -> Vocabulary:
    return Vocabulary(model)


def _ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each range, one after another."""
    ends = np.cumsum(length)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(start - (ends - length), length)


def _sorted(values: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stable order of values below 2^40, and the values in it."""
    if len(values) > _PLACE:
        order = np.argsort(values, kind="stable")
        return order, values[order]
    packed = (values.view(np.uint64) << np.uint64(24)) | place.view(np.uint64)
    packed.sort()
    return (packed & np.uint64(_PLACE)).view(np.int64), packed >> np.uint64(24)


def suffix_array(text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions sorted by the `depth` bytes that follow, and each position's first eight.

    Ranks are doubled, like a full suffix array's, but no piece looks deeper. `text` has fewer
    than 2^24 bytes or is a single unit; places fit beside sort keys in 64 bits or are sorted apart.
    """
    n = len(text)
    padded = np.concatenate((text, np.full(8, _END, np.uint8)))
    keys = np.zeros(n, np.uint64)
    for i in range(8):
        keys <<= np.uint64(8)
        keys |= padded[i : i + n]
    place = np.arange(n, dtype=np.int64)
    order, prefix = _sorted((keys >> np.uint64(24)).view(np.int64), place)
    new = prefix[1:] != prefix[:-1]
    reach = 5
    while reach < depth and not new.all():
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.concatenate(([0], new)))
        # suffixes in order of what follows `reach` bytes on, then stably by rank
        listed = np.concatenate((place[n - min(n, reach) :], order[order >= reach] - reach))
        order = listed[_sorted(rank[listed], place)[0]]
        first, second = rank[order], np.zeros(n, np.int64)
        within = order + reach < n
        second[within] = rank[order[within] + reach] + 1
        new = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
        reach *= 2
    return order, keys


def _edges(matcher: _Matcher, suffixes, keys) -> tuple[np.ndarray, np.ndarray]:
    """(position, piece) of every occurrence, sorted by position."""
    a, b = matcher.ranges(suffixes, keys)
    count = b - a
    packed = suffixes[_ranges(a, count)] << 20
    packed |= np.repeat(matcher.ids, count)
    packed.sort()
    return (packed >> 20).astype(np.int32), (packed & 0xFFFFF).astype(np.int32)


def _relax_long(edges: dict, follow: np.ndarray, symbol: np.ndarray, at: int, end: int) -> None:
    """The same relaxation of one unit, by a heap of edges. edges: (start, end) to (rank, id)."""
    before, heap = {}, []
    place = at
    while place < end:
        before[follow[place]] = place
        place = follow[place]

    def offer(left: int) -> None:
        middle = follow[left]
        if middle < end and (found := edges.get((left, follow[middle]))):
            heapq.heappush(heap, (found[0], left, int(middle), int(follow[middle]), found[1]))

    place = at
    while place < end:
        offer(place)
        place = int(follow[place])
    while heap:
        _, left, middle, right, piece = heapq.heappop(heap)
        if symbol[left] == -2 or follow[left] != middle or symbol[middle] == -2 or follow[middle] != right:
            continue
        follow[left], symbol[left], symbol[middle] = right, piece, -2
        before[right] = left
        offer(left)
        if left > at:
            offer(int(before[left]))


def encode_units(vocab: Vocabulary, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All token ids of the units one after another, and the number of each unit's."""
    coded = [u.encode() for u in units]
    text = np.frombuffer(b"\xff".join(coded) + b"\xff", np.uint8)
    ends = np.cumsum([len(c) + 1 for c in coded]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    suffixes, keys = suffix_array(text, vocab.depth)

    begins = (text & 0xC0) != 0x80
    spots = np.flatnonzero(begins)
    follow = np.zeros(len(text) + 1, np.int32)
    follow[spots[:-1]] = spots[1:]
    follow[ends] = ends
    symbol = np.full(len(text), -2, np.int32)
    symbol[spots] = -1
    where, piece = _edges(vocab.single, suffixes, keys)
    symbol[where] = piece

    where, piece = _edges(vocab.longer, suffixes, keys)
    del suffixes, keys
    stop = (where + vocab.length[piece]).astype(np.int32)
    owner = (np.cumsum(text == _END, dtype=np.int32))[where]
    long = (ends - starts > _LONG)[owner]
    for unit in np.unique(owner[long]):
        a, b = np.searchsorted(owner, (unit, unit + 1))
        own = zip(where[a:b].tolist(), stop[a:b].tolist(), vocab.rank[piece[a:b]].tolist(), piece[a:b].tolist(), strict=True)
        _relax_long({(s, e): (r, p) for s, e, r, p in own}, follow, symbol, int(starts[unit]), int(ends[unit]))
    where, stop, piece, owner = (x[~long] for x in (where, stop, piece, owner))
    while len(where):
        middle = follow[where]
        fits = (symbol[where] != -2) & (middle < stop)
        where, stop, piece, owner, middle = (x[fits] for x in (where, stop, piece, owner, middle))
        ready = np.flatnonzero(follow[middle] == stop)
        if not len(ready):
            break
        unit = owner[ready]
        first = np.flatnonzero(np.concatenate(([True], unit[1:] != unit[:-1])))
        best = np.minimum.reduceat((vocab.rank[piece[ready]] << 32) | ready, first) & 0xFFFFFFFF
        symbol[middle[best]] = -2
        follow[where[best]], symbol[where[best]] = stop[best], piece[best]
        alive = np.zeros(len(ends), bool)
        alive[unit] = True
        keep = alive[owner]
        where, stop, piece, owner = (x[keep] for x in (where, stop, piece, owner))

    symbol[ends] = -2
    raw = np.flatnonzero(symbol == -1)
    for place in raw:  # characters without a piece become their bytes
        span = slice(place, follow[place])
        symbol[span] = vocab.byte_ids[text[span]]
    there = np.flatnonzero(symbol != -2)
    count = np.bincount(np.searchsorted(ends, there), minlength=len(units))
    return symbol[there], count


class Encoder:
    """Encodes one batch of texts after another and keeps what it knows of their units."""

    def __init__(self, vocab: Vocabulary) -> None:
        self.vocab = vocab
        self.units = Units(self._learn, self._forget)
        self._forget()

    def _forget(self) -> None:
        self.ids, self.count = np.empty(0, np.int32), np.empty(0, np.int64)
        self.start = np.empty(0, np.int64)

    def _learn(self, units: list[str]) -> None:
        ids, count = encode_units(self.vocab, units)
        self.ids, self.count = np.concatenate((self.ids, ids)), np.concatenate((self.count, count))
        self.start = np.cumsum(self.count) - self.count

    def slices(self, texts: pa.Array) -> Iterator[tuple[int, pa.ListArray]]:
        """(first row, token ids of each text) of some rows at a time; a null counts as empty."""
        for row, each in self.units.slices(texts):
            numbers = np.concatenate(each)
            count = self.count[numbers]
            ids = self.ids[_ranges(self.start[numbers], count)]
            last = np.cumsum([len(n) for n in each])
            ends = np.concatenate(([0], np.cumsum(count)))[np.concatenate(([0], last))]
            yield row, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))


def decode_ids(vocab: Vocabulary, lists: pa.ListArray) -> pa.Array:
    """The text of each list of ids, without the space that encoding put in front."""
    ends = lists.offsets.to_numpy()
    ids = lists.values.fill_null(vocab.unknown).to_numpy()[ends[0] : ends[-1]]
    ids = np.where((ids >= 0) & (ids < len(vocab.pieces)), ids, vocab.unknown)
    size = vocab.length[ids]
    place = np.concatenate(([0], np.cumsum(size)))[ends - ends[0]]
    raw = vocab.flat[_ranges(vocab.start[ids], size)].tobytes()
    there = lists.is_valid().to_pylist()
    out = [
        raw[a:b].decode("utf-8", "replace").removeprefix(" ") if known else None
        for a, b, known in zip(place[:-1], place[1:], there, strict=True)
    ]
    return pa.array(out, pa.string())


_IDS = T.ArrayType(T.IntegerType())


def encode(df: DataFrame, model: str, source: str = "text", target: str = "token_ids") -> DataFrame:
    """`df` with the token ids of a text column, an array of int, as its last column.

    The ids are those of the SentencePiece library for the BPE model at path `model`, which
    every executor has: no begin or end token, special strings are plain text, characters
    without a piece become bytes. A null or empty text gives an empty array. All other
    columns and repeated rows are kept; a column named `target` is replaced.
    """
    at = place(df, source, (target,))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary(model))
        for batch in batches:
            for row, ids in encoder.slices(batch.column(at)):
                yield appended(batch.slice(row, len(ids)), ids)

    return map_batches(df, run, [T.StructField(target, _IDS)])


def decode(df: DataFrame, model: str, source: str = "token_ids", target: str = "decoded") -> DataFrame:
    """`df` with the text of a column of token ids as its last column.

    Undoes `encode`, except that the space sign itself comes back as a space. Control ids
    give nothing; null ids inside an array and ids out of range give the unknown sign; bytes
    that are no UTF-8 give U+FFFD. A null array gives null, an empty one an empty text.
    """
    at = place(df, source, (target,))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(0, batch.num_rows, _ROWS):
                part = batch.slice(row, _ROWS)
                yield appended(part, decode_ids(vocabulary(model), part.column(at)))

    return map_batches(df, run, [T.StructField(target, T.StringType())])


def encode_and_decode(df: DataFrame, model: str, source: str = "text") -> DataFrame:
    """`df` with token_ids and decoded as `encode` and `decode` give them, in one pass."""
    added = [T.StructField("token_ids", _IDS), T.StructField("decoded", T.StringType())]
    at = place(df, source, ("token_ids", "decoded"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary(model))
        for batch in batches:
            for row, ids in encoder.slices(batch.column(at)):
                part = batch.slice(row, len(ids))
                texts = [decode_ids(encoder.vocab, ids.slice(i, _ROWS)) for i in range(0, len(ids), _ROWS)]
                yield appended(part, ids, pa.concat_arrays(texts))

    return map_batches(df, run, added)
