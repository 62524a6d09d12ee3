"""Byte strings that occur more than once, by a distributed suffix array with its tree of common-prefix intervals.

Every window of 200 bytes belongs to one anchor, the place of the gram with the least hash inside it; so equal windows
have anchors at the same distance and equal grams there. The suffix array holds the suffixes at anchors, dealt by gram:

1. Hashes of the grams at all anchors go to their hash range; anchors whose gram occurs twice come back by chunk. All
   others have no repeated window.
2. Each such anchor becomes a context: the 200 bytes from it on (its suffix, as far as any window reaches) and the bytes
   before it back to the first window that is its own. A chunk sends equal contexts once. A range sorts its contexts
   by suffix, finds the common prefixes of neighbours, and scans them with a stack, which closes the intervals of the tree
   from the deepest up. The members of an interval share its prefix. They are held in order of their left contexts,
   smaller children merged into the larger: where neighbours in that order differ to the left is where a repeat cannot
   be extended. Those whose common left and right parts reach 200 bytes are the occurrences of a maximal repeat.
3. Each occurrence learns how far its repeats reach to both sides; these spans come back by chunk and go by text.

Contexts are compared byte by byte; equal hashes only cost contexts that are sent in vain.
"""

from __future__ import annotations

import hashlib
from bisect import bisect
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from shelfmark.llm.common import (
    as_row,
    chunks,
    free_name,
    from_row,
    in_small_batches,
    read_table,
    stage,
    text_keys,
    texts_in,
)

LENGTH = 200
#: Bytes whose anchors are found at a time; windows of longer texts are dealt into slices of them.
SLICE = 1 << 20
#: Anchors at which a chunk of the first pass ends; bytes of different contexts at which one of the second does.
CHUNK_ANCHORS = 1 << 18
CHUNK_CONTEXTS = 8 << 20
#: Bytes of text for each hash range of the first pass (about an anchor in 68); contexts for each range of the second.
RANGE_BYTES = 48 << 20
RANGE_CONTEXTS = 1 << 16


def gram_length(length: int) -> int:
    """Bytes of the gram that makes an anchor: a third of a window."""
    return max(1, length // 3)


@cache
def _byte_hashes() -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(bytes([b])) for b in range(256)], np.uint64)


@cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2^64."""
    base = 0x9E3779B97F4A7C15
    both = []
    for b in (base, pow(base, -1, 1 << 64)):
        steps = np.full(n, b, np.uint64)
        steps[0] = 1
        both.append(np.multiply.accumulate(steps))
    return both[0], both[1]


def _mix(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(29))


def _least(keys: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` consecutive keys, from least values up to and from the borders of blocks."""
    n = len(keys) - width + 1
    padded = np.full(-(-len(keys) // width) * width, np.iinfo(np.uint64).max)
    padded[: len(keys)] = keys
    blocks = padded.reshape(-1, width)
    upto = np.minimum.accumulate(blocks, axis=1).ravel()
    onward = np.ascontiguousarray(np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1]).ravel()
    return np.minimum(onward[:n], upto[width - 1 : width - 1 + n])


def _anchors(data: bytes, ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of texts laid end to end: the anchors, how many windows before an anchor are its own, and hashes of the grams.

    A window's anchor is its gram with the least hash, the first of equal ones.
    """
    gram = gram_length(length)
    raw = np.frombuffer(data, np.uint8)
    if len(raw) < length:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    power, inverse = (p[: len(raw) + 1] for p in _powers(1 << (len(raw) + 1).bit_length()))
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_byte_hashes()[raw] * power[:-1], out=sums[1:])
    hashes = _mix((sums[gram:] - sums[:-gram]) * inverse[: len(raw) - gram + 1])
    # 40 bits of hash, 24 bits of place.
    keys = (hashes & ~np.uint64(0xFFFFFF)) | np.arange(len(hashes), dtype=np.uint64)
    least = (_least(keys, length - gram + 1) & np.uint64(0xFFFFFF)).astype(np.int64)
    # Windows that lie inside one text.
    starts = np.concatenate([[0], ends[:-1]])
    inside = np.zeros(len(raw) + 1, np.int32)
    long = ends - starts >= length
    np.add.at(inside, starts[long], 1)
    np.add.at(inside, ends[long] - length + 1, -1)
    window = np.flatnonzero(np.cumsum(inside[: len(least)]))
    at = least[window]
    first = np.flatnonzero(np.diff(at, prepend=-1))
    return at[first], at[first] - window[first], hashes[at[first]]


def anchors_of(texts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per text the number of anchors; of all anchors the place in the text, the windows before it, and the hash."""
    ends = np.cumsum([len(t) for t in texts])
    if len(texts) > 1 or ends[-1] <= SLICE:
        at, before, hashes = _anchors(b"".join(texts), ends, length)
        whose = np.searchsorted(ends, at, side="right")
        return np.bincount(whose, minlength=len(texts)), at - np.concatenate([[0], ends])[whose], before, hashes
    found, last = [], -1
    for start in range(0, len(texts[0]) - length + 1, SLICE):
        part = texts[0][start : start + SLICE + length - 1]
        at, before, hashes = _anchors(part, np.array([len(part)]), length)
        # The first anchor may be the last one of the slice before, which then has these windows already.
        new = at + start > last
        found.append((at[new] + start, before[new], hashes[new]))
        last = max(last, int(at[-1]) + start)
    at, before, hashes = (np.concatenate(column) for column in zip(*found))
    return np.array([len(at)]), at, before, hashes


def _pack(values: np.ndarray, kind: str) -> bytes:
    """Numbers byte by byte, compressed."""
    planes = np.ascontiguousarray(values.astype(kind)).view(np.uint8).reshape(-1, np.dtype(kind).itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpack(raw: bytes, kind: str) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8)
    return np.ascontiguousarray(planes.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


# ---- first pass: which grams occur twice ----

_SENT = "part int, chunk long, hashes binary, numbers binary, keys binary, counts binary, places binary, before binary"


def _send_grams(length: int, ranges: int) -> Callable:
    """Per chunk and hash range the hashes of grams, each once, with the number of the anchor, or 0 if the chunk has
    it twice. One more row per chunk lists its texts and anchors and those that it repeats."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, done = TaskContext.get().partitionId(), 0
        keys, found, size = [], [], 0

        def flush() -> pa.RecordBatch:
            counts, places, before, hashes = (np.concatenate(column) for column in zip(*found))
            hashes = hashes >> np.uint64(8)
            order = np.argsort(hashes, kind="stable")
            ordered = hashes[order]
            first = np.append(True, ordered[1:] != ordered[:-1])
            alone = first & np.append(first[1:], True)
            again = np.sort(order[~alone])
            ordered, number = ordered[first], np.where(alone, order + 1, 0)[first]
            part = (ordered >> np.uint64(24)) * np.uint64(ranges) >> np.uint64(32)
            cuts = np.searchsorted(part, np.arange(ranges + 1, dtype=np.uint64))
            parts = np.flatnonzero(np.diff(cuts)).tolist()
            some = [slice(cuts[p], cuts[p + 1]) for p in parts]
            all_keys = b"".join(keys)
            # The same for a task that runs again, but for one that then meets other texts.
            chunk = xxhash.xxh3_64_intdigest(all_keys + b"%d,%d" % (task, done)) >> 1
            none = [None] * len(parts)
            columns = [
                [_pack(np.diff(ordered[s], prepend=np.uint64(0)), "<u8") for s in some] + [None],
                [_pack(number[s], "<u4") for s in some] + [_pack(again, "<u4")],
                [*none, all_keys],
                [*none, _pack(counts, "<u4")],
                [*none, _pack(places, "<u8")],
                [*none, _pack(before, "<u4")],
            ]
            keys.clear()
            found.clear()
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([*parts, chunk % ranges], pa.int32()),
                    pa.array([chunk] * (len(parts) + 1), pa.int64()),
                    *(pa.array(column, pa.binary()) for column in columns),
                ],
                names=[field.split()[0] for field in _SENT.split(", ")],
            )

        for batch in batches:
            batch_keys, place = _keys(batch), 0
            for texts in chunks(batch.column("t").to_pylist(), SLICE):
                counts, places, before, hashes = anchors_of(texts, length)
                some = np.flatnonzero(counts)
                if len(some):
                    keys.append(batch_keys[place : place + len(texts)][some].tobytes())
                    found.append((counts[some], places, before, hashes))
                    size += len(places)
                place += len(texts)
                if size > CHUNK_ANCHORS:
                    yield flush()
                    size, done = 0, done + 1
        if found:
            yield flush()

    return run


def _keys(batch: pa.RecordBatch) -> np.ndarray:
    return np.stack([batch.column(k).to_numpy() for k in ("k1", "k2")], axis=1)


_TWICE = "chunk long, numbers binary, keys binary, counts binary, places binary, before binary"
_TWICE_NAMES = [field.split()[0] for field in _TWICE.split(", ")]


def _twice(key: tuple, frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of one hash range: the numbers, by chunk, of the anchors whose gram several chunks have. Rows of texts pass."""
    held, chunk = [], []
    for frame in frames:
        listed = frame["hashes"].isna()
        if listed.any():
            yield frame.loc[listed, _TWICE_NAMES]
        for row in frame[~listed].itertuples(index=False):
            chunk.append(row.chunk)
            held.append((np.cumsum(_unpack(row.hashes, "<u8"), dtype=np.uint64), _unpack(row.numbers, "<u4")))
    if not held:
        return
    hashes = np.concatenate([h for h, _ in held])
    order = np.argsort(hashes, kind="stable")
    same = hashes[order[1:]] == hashes[order[:-1]]
    shared = np.zeros(len(hashes), bool)
    shared[order] = np.append(False, same) | np.append(same, False)
    start = 0
    for name, (its, numbers) in zip(chunk, held, strict=True):
        found = numbers[shared[start : start + len(its)] & (numbers > 0)]
        start += len(its)
        if len(found):
            yield pd.DataFrame({"chunk": [name], "numbers": [_pack(found - 1, "<u4")]}).reindex(columns=_TWICE_NAMES).replace({np.nan: None})


_PLACES = "k1 long, k2 long, places binary, before binary, n long"


def _places(key: tuple, frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of one chunk: per text the anchors whose grams occur twice."""
    listed, numbers = _listed(frames, "numbers")
    number = np.sort(np.concatenate([_unpack(n, "<u4") for n in numbers])).astype(np.int64)
    if not len(number):
        return
    keys, whose = _owners(listed, number)
    cuts = np.flatnonzero(np.diff(whose, prepend=-1))
    places = np.split(_unpack(listed.places, "<u8")[number], cuts)[1:]
    before = np.split(_unpack(listed.before, "<u4")[number], cuts)[1:]
    of = keys[whose[cuts]]
    yield pd.DataFrame(
        {
            "k1": of[:, 0],
            "k2": of[:, 1],
            "places": [p.tobytes() for p in places],
            "before": [b.tobytes() for b in before],
            "n": [len(p) for p in places],
        }
    )


def _listed(frames: Iterator[pd.DataFrame], name: str) -> tuple:
    """The row of a chunk that lists its texts, and the values that came back to it."""
    listed, values = None, []
    for frame in frames:
        for row in frame.itertuples(index=False):
            if row.keys is not None:
                listed = row
            if getattr(row, name) is not None:
                values.append(getattr(row, name))
    if listed is None:
        raise RuntimeError("The texts changed while they were read.")
    return listed, values


def _owners(listed: tuple, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The keys of a chunk's texts, and which text each of the numbered things is in."""
    ends = np.cumsum(_unpack(listed.counts, "<u4"), dtype=np.int64)
    return np.frombuffer(listed.keys, np.int64).reshape(-1, 2), np.searchsorted(ends, number, side="right")


# ---- second pass: contexts, their suffix array and its intervals ----

_CONTEXTS = "part int, chunk long, contexts binary, numbers binary, keys binary, counts binary, places binary, which binary"


def _send_contexts(length: int, ranges: int) -> Callable:
    """Per chunk and range its different contexts and how often it has them; one more row lists texts and places."""
    gram = gram_length(length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, done = TaskContext.get().partitionId(), 0
        known: dict[tuple[bytes, bytes], int] = {}
        keys, counts, places, which, size = [], [], [], [], 0

        def flush() -> pa.RecordBatch:
            numbers = np.concatenate([np.array(w, np.int64) for w in which])
            times = np.bincount(numbers, minlength=len(known))
            by_part: dict[int, list] = {}
            for context, number in known.items():
                part = xxhash.xxh3_64_intdigest(context[0][:gram]) * ranges >> 64
                by_part.setdefault(part, []).append((context, number))
            rows = []
            for part, held in by_part.items():
                held.sort()
                of = np.array([number for _, number in held])
                rows.append((part, _pack_contexts([c for c, _ in held]), _pack_pair(of, np.minimum(times[of], 2))))
            all_keys = b"".join(keys)
            chunk = xxhash.xxh3_64_intdigest(all_keys + b"%d,%d" % (task, done)) >> 1
            none = [None] * len(rows)
            columns = [
                [contexts for _, contexts, _ in rows] + [None],
                [pair for _, _, pair in rows] + [None],
                [*none, all_keys],
                [*none, _pack(np.array(counts), "<u4")],
                [*none, _pack(np.concatenate(places), "<u8")],
                [*none, _pack(numbers, "<u4")],
            ]
            for held in (known, keys, counts, places, which):
                held.clear()
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([*(part for part, _, _ in rows), chunk % ranges], pa.int32()),
                    pa.array([chunk] * (len(rows) + 1), pa.int64()),
                    *(pa.array(column, pa.binary()) for column in columns),
                ],
                names=[field.split()[0] for field in _CONTEXTS.split(", ")],
            )

        for batch in batches:
            batch_keys = _keys(batch)
            texts, at, before = (batch.column(name).to_pylist() for name in ("t", "places", "before"))
            for i, text in enumerate(texts):
                starts, back = np.frombuffer(at[i], "<u8"), np.frombuffer(before[i], "<u4")
                numbers = []
                for start, left in zip(starts.tolist(), back.tolist(), strict=True):
                    # The left context nearest byte first, so that both sides are compared by prefixes.
                    context = text[start : start + length], text[start - left : start][::-1]
                    number = known.setdefault(context, len(known))
                    if number == len(known) - 1:
                        size += length + left
                    numbers.append(number)
                keys.append(batch_keys[i].tobytes())
                counts.append(len(starts))
                places.append(starts)
                which.append(numbers)
                if size > CHUNK_CONTEXTS or sum(map(len, which[-1:])) > CHUNK_ANCHORS:
                    yield flush()
                    size, done = 0, done + 1
        if keys:
            yield flush()

    return run


def _pack_pair(numbers: np.ndarray, times: np.ndarray) -> bytes:
    return _pack(np.concatenate([numbers, times]), "<u4")


def _pack_contexts(contexts: list[tuple[bytes, bytes]]) -> bytes:
    sizes = np.array([[len(r) for r, _ in contexts], [len(l) for _, l in contexts]], "<u4").tobytes()
    return zstandard.ZstdCompressor(level=3).compress(
        np.uint32(len(contexts)).tobytes() + sizes + b"".join(r for r, _ in contexts) + b"".join(l for _, l in contexts)
    )


def _unpack_contexts(raw: bytes) -> Iterator[tuple[bytes, bytes]]:
    raw = zstandard.ZstdDecompressor().decompress(raw)
    n = int(np.frombuffer(raw[:4], "<u4")[0])
    ends = np.cumsum(np.frombuffer(raw[4 : 4 + 8 * n], "<u4"), dtype=np.int64) + 4 + 8 * n
    parts = [raw[s:e] for s, e in zip([4 + 8 * n, *ends[:-1].tolist()], ends.tolist())]
    return zip(parts[:n], parts[n:], strict=True)


def _common(a: bytes, b: bytes, least: int) -> int:
    """How long a prefix both share, or -1 if it is shorter than ``least``."""
    most = min(len(a), len(b))
    if most < least or a[:least] != b[:least]:
        return -1
    low, high = least, most
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def common_prefixes(suffixes: list[bytes], length: int) -> np.ndarray:
    """Of sorted suffixes: how many bytes each shares with the one before it."""
    sizes = np.array([len(s) for s in suffixes])
    table = np.frombuffer(b"".join(s.ljust(length, b"\0") for s in suffixes), np.uint8).reshape(len(suffixes), length)
    differs = table[1:] != table[:-1]
    shared = np.where(differs.any(axis=1), differs.argmax(axis=1), length)
    return np.concatenate([[0], np.minimum(shared, np.minimum(sizes[1:], sizes[:-1]))])


class Intervals:
    """Repeats among contexts, which are sorted by suffix and then left context and occur ``times`` each.

    ``left`` and ``right`` tell how far the repeats of a context reach before and after its anchor; 0 and 0: none.
    With ``listing`` each repeat is a row of ``groups``: its members, and how far these agree to both sides.
    """

    def __init__(self, contexts: list[tuple[bytes, bytes]], times: list[int], length: int, listing: bool = False) -> None:
        self.length, self.lefts = length, [left for _, left in contexts]
        self.left, self.right = [0] * len(contexts), [0] * len(contexts)
        self.groups: list[tuple[list[int], int, int]] | None = [] if listing else None
        suffixes = [suffix for suffix, _ in contexts]
        for i, count in enumerate(times):
            if count > 1 and len(suffixes[i]) + len(self.lefts[i]) >= length:
                self._reach(i, len(self.lefts[i]), len(suffixes[i]))
                if listing:
                    self.groups.append(([i], len(self.lefts[i]), len(suffixes[i])))
        self.rank = {left: i for i, left in enumerate(sorted(set(self.lefts)))}
        self._scan(common_prefixes(suffixes, length) if contexts else np.empty(0, np.int64))

    def _reach(self, i: int, left: int, right: int) -> None:
        self.left[i] = max(self.left[i], left)
        self.right[i] = max(self.right[i], right)

    def _scan(self, shared: np.ndarray) -> None:
        """Close the common-prefix intervals, children before parents, with a stack of those still open."""
        gram, open_ = gram_length(self.length), []
        child = None
        for i, prefix in enumerate([*shared.tolist(), -1]):
            if prefix < gram:
                prefix = -1
            while open_ and open_[-1][0] > prefix:
                depth, members = open_.pop()
                child = self._merged(members, child, depth)
            if prefix >= 0:
                if open_ and open_[-1][0] == prefix:
                    open_[-1][1] = self._merged(open_[-1][1], child, prefix)
                else:
                    open_.append([prefix, child])
            if i < len(self.lefts):
                child = [(self.rank[self.lefts[i]], i)]

    def _merged(self, large: list, small: list, depth: int) -> list:
        """The members of two children of an interval, in order of left contexts.

        Members of different children share just ``depth`` bytes from the anchor on. In order of left contexts no member
        has more in common with any other than with a neighbour.
        """
        if len(large) < len(small):
            large, small = small, large
        need = max(0, self.length - depth)
        new = []
        for member in small:
            at = bisect(large, member)
            for other in large[max(at - 1, 0) : at + 1]:
                left = _common(self.lefts[member[1]], self.lefts[other[1]], need)
                if left >= 0:
                    self._reach(member[1], left, depth)
                    self._reach(other[1], left, depth)
                    new.append(member)
            large.insert(at, member)
        if self.groups is not None and new:
            self._list(large, set(new), need, depth)
        return large

    def _list(self, members: list, new: set, need: int, depth: int) -> None:
        """Intervals of left contexts that agree far enough, where children meet."""
        shared = [_common(self.lefts[a[1]], self.lefts[b[1]], need) for a, b in zip(members, members[1:])]
        open_: list[tuple[int, int]] = []
        for i, left in enumerate([*shared, -1]):
            first = i
            while open_ and open_[-1][0] > left:
                least, first = open_.pop()
                some = members[first : i + 1]
                if not new.isdisjoint(some):
                    self.groups.append(([i for _, i in some], least, depth))
            if left >= 0 and not (open_ and open_[-1][0] == left):
                open_.append((left, first))


_FOUND = "chunk long, found binary, keys binary, counts binary, places binary, which binary"
_FOUND_NAMES = [field.split()[0] for field in _FOUND.split(", ")]
#: What comes back to a chunk: number of a context, how far to the left and to the right, and the repeat.
_REACH = np.dtype([("number", "<u4"), ("left", "<u4"), ("right", "<u4"), ("group", "<u8")])


def _intervals(length: int, listing: bool) -> Callable:
    def run(key: tuple, frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple[bytes, bytes], list] = {}
        for frame in frames:
            listed = frame["contexts"].isna()
            if listed.any():
                passed = frame[listed].assign(found=None)
                yield passed[_FOUND_NAMES]
            for row in frame[~listed].itertuples(index=False):
                numbers, times = _unpack(row.numbers, "<u4").reshape(2, -1).tolist()
                for context, number, count in zip(_unpack_contexts(row.contexts), numbers, times, strict=True):
                    held.setdefault(context, []).append((row.chunk, number, count))
        contexts = sorted(held)
        tree = Intervals(contexts, [sum(t for _, _, t in held[c]) for c in contexts], length, listing)
        back: dict[int, list] = {}
        if listing:
            for members, left, right in tree.groups:
                suffix, before = contexts[members[0]]
                group = xxhash.xxh3_64_intdigest(before[:left][::-1] + suffix[:right])
                for i in members:
                    for chunk, number, _ in held[contexts[i]]:
                        back.setdefault(chunk, []).append((number, left, right, group))
        else:
            for i, context in enumerate(contexts):
                if tree.right[i]:
                    for chunk, number, _ in held[context]:
                        back.setdefault(chunk, []).append((number, tree.left[i], tree.right[i], 0))
        pack = zstandard.ZstdCompressor(level=1).compress
        for chunk, rows in back.items():
            found = pack(np.array(rows, _REACH).tobytes())
            yield pd.DataFrame({"chunk": [chunk], "found": [found], **dict.fromkeys(_FOUND_NAMES[2:])}, columns=_FOUND_NAMES)

    return run


def _occurrences(frames: Iterator[pd.DataFrame]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of one chunk: keys of its texts; of each occurrence the text, the bytes from and to, and the repeat."""
    listed, found = _listed(frames, "found")
    rows = [np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), _REACH) for raw in found]
    rows = np.concatenate([np.empty(0, _REACH), *rows])
    which = _unpack(listed.which, "<u4")
    # All places of each context, in order of contexts.
    order = np.argsort(which, kind="stable")
    first = np.searchsorted(which[order], rows["number"], side="left")
    size = np.searchsorted(which[order], rows["number"], side="right") - first
    row = np.repeat(np.arange(len(rows)), size)
    at = order[np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())]
    places = _unpack(listed.places, "<u8").astype(np.int64)[at]
    keys, whose = _owners(listed, at)
    return keys, whose, places - rows["left"][row], places + rows["right"][row], rows["group"][row]


def merged_spans(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans that touch or overlap as one, in order."""
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(end[order])
    fresh = np.flatnonzero(np.append(True, start[1:] > reach[:-1]))
    return start[fresh], reach[np.append(fresh[1:], len(start)) - 1]


def _spans(key: tuple, frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of one chunk: per text the bytes that repeats cover, as pairs of start and end."""
    keys, whose, start, end, _ = _occurrences(frames)
    if not len(whose):
        return
    order = np.argsort(whose, kind="stable")
    cuts = np.flatnonzero(np.diff(whose[order], prepend=-1))
    spans = [np.stack(merged_spans(start[some], end[some]), axis=1).tobytes() for some in np.split(order, cuts)[1:]]
    of = keys[whose[order][cuts]]
    yield pd.DataFrame({"k1": of[:, 0], "k2": of[:, 1], "spans": spans})


def _members(key: tuple, frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of one chunk: the occurrences of all repeats."""
    keys, whose, start, end, group = _occurrences(frames)
    yield pd.DataFrame(
        {"k1": keys[whose, 0], "k2": keys[whose, 1], "group": group.view(np.int64), "start": start, "length": end - start}
    )


def _found(docs: DataFrame, doc_id: str, text: str, length: int, listing: bool) -> DataFrame:
    """What comes back to the chunks of the second pass."""
    in_small_batches(docs.sparkSession)
    size = docs.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0
    keyed = docs.select(F.col(text).cast("binary").alias("t"), *text_keys(F.col(doc_id), F.col(text)))
    ranges = max(1, -(-size // RANGE_BYTES))
    sent = keyed.mapInArrow(_send_grams(length, ranges), _SENT).repartition(ranges, "part")
    twice = sent.groupBy("part").applyInPandas(_twice, _TWICE).groupBy("chunk").applyInPandas(_places, _PLACES)
    # Rows with equal keys are equal texts with the same anchors.
    alike = [F.first(name).alias(name) for name in ("places", "before", "n")]
    anchors = stage(twice.groupBy("k1", "k2").agg(*alike), "repeats-anchors")
    ranges = max(1, -(-(anchors.agg(F.sum("n")).first()[0] or 0) // RANGE_CONTEXTS))
    joined = keyed.join(anchors, ["k1", "k2"]).select("k1", "k2", "t", "places", "before")
    contexts = joined.mapInArrow(_send_contexts(length, ranges), _CONTEXTS).repartition(ranges, "part")
    return contexts.groupBy("part").applyInPandas(_intervals(length, listing), _FOUND)


def repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """``group, length, doc_id, start``: all occurrences of the maximal repeats of ``length`` bytes or more.

    ``group`` is a hash of the repeated bytes. A repeat cannot be extended on either side without losing an
    occurrence, unless it ends ``length`` bytes after its anchor or at the first window of the anchor: longer ones are listed piece by
    piece, and the pieces overlap. NULL and short texts have none. Repeated rows are listed each.
    """
    found = _found(docs, doc_id, text, length, listing=True)
    members = found.groupBy("chunk").applyInPandas(_members, "k1 long, k2 long, group long, start long, length long")
    members = stage(members.distinct(), "repeats-members")
    rows = docs.select(F.col(doc_id).alias("doc_id"), *text_keys(F.col(doc_id), F.col(text)))
    return rows.join(members, ["k1", "k2"]).select("group", "length", "doc_id", "start")


_SPAN_LIST = ArrayType(StructType().add("start", "long").add("end", "long"))


def _cleaned(text: str) -> Callable:
    """Per text: the bytes outside the spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, total, removed, runs, digests, listed = [], [], [], [], [], []
            for content, raw in zip(texts_in(batch, "r", text).to_pylist(), batch.column("spans").to_pylist(), strict=True):
                spans = np.frombuffer(raw or b"", np.int64).reshape(-1, 2).tolist()
                size = len(content or b"")
                stays = content
                if spans:
                    edges = [0, *(edge for span in spans for edge in span), size]
                    stays = b"".join(content[s:e] for s, e in zip(edges[::2], edges[1::2]))
                kept.append(stays)
                total.append(size)
                removed.append(size - len(stays or b""))
                runs.append(len(spans))
                digests.append(hashlib.sha256(stays or b"").hexdigest())
                listed.append([{"start": s, "end": e} for s, e in spans])
            numbers = [pa.array(column, pa.int64()) for column in (total, removed, runs)]
            span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
            yield pa.RecordBatch.from_arrays(
                [batch.column("r"), pa.array(kept, pa.binary()), *numbers, pa.array(digests), pa.array(listed, pa.list_(span))],
                names=["r", "kept", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"],
            )

    return run


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """All columns of ``docs`` and a struct ``dedup`` of ``kept, n_bytes, n_removed, n_spans, kept_sha256, spans``.

    A byte of the UTF-8 text goes if any ``length`` bytes over it start anywhere else too, in the same text, in another
    row of the same id, or in a repeated row. ``kept`` holds the bytes that stay, NULL for NULL, which counts as
    empty; as a repeat may begin inside a character, they need not be UTF-8. ``spans`` are the maximal runs that go, ends
    excluded. Shorter texts are never changed. A column that is called ``dedup`` already is kept beside ``dedup_``.
    """
    found = _found(docs, doc_id, text, length, listing=False)
    spans = found.groupBy("chunk").applyInPandas(_spans, "k1 long, k2 long, spans binary")
    spans = stage(spans.groupBy("k1", "k2").agg(F.first("spans").alias("spans")), "repeats-spans")
    rows = docs.select(as_row(docs).alias("r"), *text_keys(F.col(doc_id), F.col(text)))
    joined = rows.join(spans, ["k1", "k2"], "left").select("r", "spans")
    out = joined.select("r").schema.add("kept", "binary")
    for name in ("n_bytes", "n_removed", "n_spans"):
        out = out.add(name, "long")
    out = out.add("kept_sha256", "string").add("spans", _SPAN_LIST)
    done = joined.mapInArrow(_cleaned(text), out)
    result = F.struct("kept", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans")
    return done.select(*from_row("r", docs), result.alias(free_name(docs, "dedup")))


def op12_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    columns = ["n_bytes", "n_removed", "n_spans", "kept_sha256"]
    return remove_repeats(docs).select("doc_id", *(f"dedup.{name}" for name in columns))
