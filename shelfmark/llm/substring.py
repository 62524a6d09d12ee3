"""Removal of passages that occur more than once, by a count-min sketch and exact grouping of what it lets through.

A window is 35 consecutive words. Three passes over the texts:

1. Every task takes its windows in chunks of bounded size. Of each window 32 bits of hash and its number in the chunk go
   to the task of its hash range, sorted, as differences. The ranges are as many as the texts need for a bounded
   number of windows in each. A range's task counts them in its own part of the sketch, so the cells for each window
   are the same at every size of the input, and no one holds all of it. As every window of a cell comes to the same task,
   a cell counts what all chunks together have; an estimate is never too low. The numbers of the windows that are
   estimated to repeat come back, by chunk, and become places in texts there.
2. Of the windows at these places 96 bits of hash are grouped exactly, in ranges again. The numbers of those that two
   chunks have, or one has twice, come back and become places.
3. The words of the windows at these places go.

The hash of a window is a polynomial over word hashes, computed for all windows of a chunk at once by doubling.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

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
    worker_memory,
)

WINDOW = 35
#: Rows of the sketch.
DEPTH = 2
#: Cells of all rows of a range's part of the sketch are a power of two: about CELLS_PER_WINDOW a window.
CELLS_PER_WINDOW = 8
MIN_CELL_BITS = 20
#: Distinct words that a worker remembers the hashes of.
KNOWN_WORDS = 1 << 18
#: Windows that a task sends at a time.
SENT = 1 << 20
#: Bytes of text for each hash range: about two million windows, six million if all words have one letter.
RANGE_BYTES = 12 << 20
#: Windows that the sketch lets through for each hash range of the exact pass.
RANGE_WINDOWS = 1 << 21

_BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
_ODD = np.arange(1, 2 * DEPTH, 2, dtype=np.uint64)[:, None]


class _WordHashes(dict):
    """Index of each word; two independent hashes by index."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[bytes] = []
        self.table = np.empty((0, 2), np.uint64)

    def __missing__(self, word: bytes) -> int:
        index = len(self)
        self[word] = index
        self.new.append(xxhash.xxh3_128_digest(word))
        return index

    def lanes(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        if len(self) > KNOWN_WORDS:
            self.clear()
            self.table = self.table[:0]
        index = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        if self.new:
            fresh = np.frombuffer(b"".join(self.new), np.uint64).reshape(-1, 2)
            self.table = np.concatenate([self.table, fresh])
            self.new.clear()
        return self.table[index, 0], self.table[index, 1]


def _mix(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(29))


def _rolling(hashes: np.ndarray, window: int, base: np.uint64) -> np.ndarray:
    """Hash of every run of ``window`` word hashes, built from runs of powers of two."""
    run, length, power = hashes, 1, np.array([base])  # arrays wrap around silently
    total, done = None, 0
    left = window
    while True:
        if left & 1:
            part = run[done:] if done else run
            total = part if total is None else total[: len(part)] * power + part
            done += length
        left >>= 1
        if not left:
            return _mix(total[: len(hashes) - window + 1])
        run = run[:-length] * power + run[length:]
        power, length = power * power, 2 * length


def _words(texts: list[bytes]) -> tuple[list[list[bytes]], np.ndarray, np.ndarray]:
    """The words of each text, how many they are, and where they start among all."""
    words = [text.split() for text in texts]
    counts = np.array([len(w) for w in words], np.int64)
    return words, counts, np.concatenate([[0], np.cumsum(counts)])


class Windows:
    """The windows of some texts: two hash lanes, and for each the word it starts at."""

    def __init__(self, texts: list[bytes], window: int, known: _WordHashes) -> None:
        self.words, self.counts, self.starts = _words(texts)
        flat = [word for words in self.words for word in words]
        if len(flat) < window:
            self.at = np.empty(0, np.int64)
            self.lanes = (np.empty(0, np.uint64), np.empty(0, np.uint64))
        else:
            lanes = known.lanes(flat)
            # A window may not run into the next text.
            room = np.repeat(self.starts[1:], self.counts) - np.arange(len(flat))
            self.at = np.flatnonzero(room >= window)
            self.lanes = tuple(
                _rolling(lane, window, base)[self.at] for lane, base in zip(lanes, _BASES, strict=True)
            )


class Sketch:
    """A count-min sketch of the windows of one hash range, whose cells count to two.

    ``cell_bits`` is the base-2 logarithm of all its cells. Rows are counted one after the other in the same memory.
    """

    def __init__(self, cell_bits: int, depth: int = DEPTH) -> None:
        self.depth, self.bits = depth, max(1, cell_bits - (depth - 1).bit_length())

    def _cells(self, hashes: np.ndarray, row: int) -> np.ndarray:
        # Of 64 bits the upper ones; the rows use different mixes.
        return (_mix(hashes * _BASES[0] + _BASES[1] * _ODD[row]) >> np.uint64(64 - self.bits)).astype(np.int64)

    def repeated(self, hashes: np.ndarray) -> np.ndarray:
        """Which of the hashes are estimated to be there more than once: all that are, and some others."""
        found, number = np.ones(len(hashes), bool), np.arange(len(hashes), dtype=np.int32)
        last = np.empty(1 << self.bits, np.int32)
        for row in range(self.depth):
            cells = self._cells(hashes, row)
            # Of all that write their number to a cell the last one is read back; the others show that there are two.
            last[cells] = number
            twice = np.zeros(len(last), bool)
            twice[cells[last[cells] != number]] = True
            found &= twice[cells]
        return found


def cell_bits(windows: int, most: int | None = None) -> int:
    """For so many windows: the base-2 logarithm of the cells."""
    wanted = max(MIN_CELL_BITS, (CELLS_PER_WINDOW * windows).bit_length())
    return wanted if most is None else min(wanted, most)


def _order(hi: np.ndarray, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order by hash, and which of the ordered hashes equal the one before."""
    order = np.argsort(hi)
    tied = hi[order[1:]] == hi[order[:-1]]
    among = np.flatnonzero(np.concatenate([tied, [False]]) | np.concatenate([[False], tied]))
    some = order[among]
    order[among] = some[np.lexsort((lo[some], hi[some]))]
    return order, tied & (lo[order[1:]] == lo[order[:-1]])


def _planes(values: np.ndarray) -> bytes:
    """Numbers byte by byte: those that are alike stand together."""
    return values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()


_SENT = "part int, chunk long, windows binary, keys binary, counts binary, repeated binary"
_SENT_NAMES = [field.split()[0] for field in _SENT.split(", ")]


class _Chunk:
    """The windows of some texts until they are sent."""

    def __init__(self, window: int) -> None:
        self.window, self.known = window, _WordHashes()
        self.task, self.flushed = TaskContext.get().partitionId(), 0
        self.clear()

    def clear(self) -> None:
        self.hashes, self.keys, self.counts, self.size = [], [], [], 0

    def take(self, texts: list[bytes], keys: np.ndarray, places: list[bytes] | None = None) -> None:
        """All windows of the texts, or those at some places, which come as steps."""
        found = Windows(texts, self.window, self.known)
        hi, lo = found.lanes
        # The windows of a text start at consecutive words: a number tells text and place.
        number = np.arange(self.size, self.size + len(hi), dtype=np.int64)
        many = np.maximum(found.counts - self.window + 1, 0)
        if places is not None:
            starts = np.cumsum(many) - many
            at = [s + np.cumsum(np.frombuffer(p, "<u4"), dtype=np.int64) for s, p in zip(starts, places, strict=True)]
            at = np.concatenate([np.empty(0, np.int64), *at])
            hi, lo, number = hi[at], lo[at], number[at]
        some = np.flatnonzero(many)
        self.hashes.append((hi, lo.astype("<u4"), number))
        self.counts.append(many[some])
        self.keys.append(keys[some].tobytes())
        self.size += len(found.at)

    def send(self, payloads: Callable) -> Iterator[pa.RecordBatch]:
        """What goes to the hash ranges, and a row of the keys of the texts, how many windows these have, and the
        numbers of those that the chunk itself repeats."""
        if any(len(h[0]) for h in self.hashes):
            parts, packed, repeated, groups = payloads(*(np.concatenate(column) for column in zip(*self.hashes)))
            pack = zstandard.ZstdCompressor(level=1).compress
            # The same for a task that runs again, but for one that then meets other texts.
            all_keys = b"".join(self.keys)
            chunk = xxhash.xxh3_64_intdigest(all_keys + b"%d,%d" % (self.task, self.flushed)) >> 1
            none = [None] * len(parts)
            columns = [
                pa.array([*parts, chunk % groups], pa.int32()),
                pa.array([chunk] * (len(parts) + 1), pa.int64()),
                pa.array([*packed, None], pa.binary()),
                pa.array([*none, all_keys], pa.binary()),
                pa.array([*none, pack(np.concatenate(self.counts).astype("<u4").tobytes())], pa.binary()),
                pa.array([*none, pack(repeated.astype("<u4").tobytes())], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=_SENT_NAMES)
        self.clear()
        self.flushed += 1


def _parts(hi: np.ndarray, groups: int) -> np.ndarray:
    """Ranges of the upper lane, equally wide."""
    return (hi >> np.uint64(32)) * np.uint64(groups) >> np.uint64(32)


def _cell_payloads(groups: int) -> Callable:
    """Per hash range: 32 bits of hash and the numbers of all windows, sorted by hash."""

    def run(hi: np.ndarray, lo: np.ndarray, number: np.ndarray) -> tuple:
        part = _parts(hi, groups)
        order = np.argsort((part << np.uint64(32)) | (hi & np.uint64(0xFFFFFFFF)))
        part, low, number = part[order], hi[order].astype("<u4"), number[order].astype("<u4")
        cuts = np.searchsorted(part, np.arange(groups + 1, dtype=np.uint64))
        parts, pack = np.flatnonzero(np.diff(cuts)).tolist(), zstandard.ZstdCompressor(level=1).compress
        some = [slice(cuts[p], cuts[p + 1]) for p in parts]
        packed = [pack(_planes(np.diff(low[s], prepend=np.uint32(0))) + _planes(number[s])) for s in some]
        return parts, packed, np.empty(0, np.int64), groups

    return run


def _exact_payloads(groups: int) -> Callable:
    """Per hash range: 96 bits of hash and the numbers of the windows, each of the chunk once, sorted by hash.

    Windows that the chunk itself repeats carry no number.
    """

    def run(hi: np.ndarray, lo: np.ndarray, number: np.ndarray) -> tuple:
        order, same = _order(hi, lo)
        hi, lo, number = hi[order], lo[order], number[order]
        first = np.concatenate([[True], ~same])
        alone = first & np.concatenate([~same, [True]])
        repeated = np.sort(number[~alone])
        hi, lo, number = hi[first], lo[first], np.where(alone, number + 1, 0)[first].astype("<u4")
        cuts = np.searchsorted(_parts(hi, groups), np.arange(groups + 1, dtype=np.uint64))
        parts, pack = np.flatnonzero(np.diff(cuts)).tolist(), zstandard.ZstdCompressor(level=1).compress
        packed = []
        for some in (slice(cuts[p], cuts[p + 1]) for p in parts):
            steps = np.diff(hi[some], prepend=np.uint64(0))
            packed.append(pack(_planes(steps) + lo[some].tobytes() + _planes(number[some])))
        return parts, packed, repeated, groups

    return run


def _send(window: int, payloads: Callable) -> Callable:
    """Sends the windows of texts, or those at the ``places`` that come with them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_memory("substring")
        chunk = _Chunk(window)
        for batch in batches:
            done = 0
            keys = np.stack([batch.column(k).to_numpy() for k in ("k1", "k2")], axis=1)
            places = batch.column("places").to_pylist() if "places" in batch.schema.names else None
            for texts in chunks(batch.column("t").to_pylist()):
                some = slice(done, done + len(texts))
                chunk.take(texts, keys[some], places and places[some])
                done += len(texts)
                if chunk.size > SENT:
                    yield from chunk.send(payloads)
        yield from chunk.send(payloads)

    return run


def _read_sent(payload: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(payload), np.uint8)
    n = len(raw) // 16
    steps = np.ascontiguousarray(raw[: 8 * n].reshape(8, n).T).view("<u8").ravel()
    number = np.ascontiguousarray(raw[12 * n :].reshape(4, n).T).view("<u4").ravel()
    return np.cumsum(steps, dtype=np.uint64), raw[8 * n : 12 * n].view("<u4"), number


_FOUND = "chunk long, keys binary, counts binary, repeated binary"
_FOUND_NAMES = [field.split()[0] for field in _FOUND.split(", ")]


def _read_cells(payload: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(payload), np.uint8)
    steps, numbers = (np.ascontiguousarray(half.reshape(4, -1).T).view("<u4").ravel() for half in np.split(raw, 2))
    return np.cumsum(steps, dtype=np.uint64), numbers


def _estimated(most: int | None) -> Callable:
    """Of one hash range: the numbers, by chunk, of the windows that the sketch takes for repeated. Rows of keys pass."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        chunk, read = [], []
        for batch in batches:
            known = batch["windows"].isna()
            if known.any():
                yield batch.loc[known, _FOUND_NAMES]
            for number, payload in batch.loc[~known, ["chunk", "windows"]].itertuples(index=False):
                chunk.append(number)
                read.append(_read_cells(payload))
        if not read:
            return
        ends = np.cumsum([len(hashes) for hashes, _ in read])
        repeated = Sketch(cell_bits(int(ends[-1]), most)).repeated(np.concatenate([hashes for hashes, _ in read]))
        pack = zstandard.ZstdCompressor(level=1).compress
        for name, (_, numbers), mine in zip(chunk, read, np.split(repeated, ends[:-1]), strict=True):
            some = np.sort(numbers[mine])
            if len(some):
                row = {"chunk": [name], "keys": None, "counts": None, "repeated": [pack(some.tobytes())]}
                yield pd.DataFrame(row, columns=_FOUND_NAMES)

    return run


def _repeated(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of one hash range: the numbers, by chunk, of the windows that several chunks have. Rows of keys pass."""
    chunk, read = [], []
    for batch in batches:
        known = batch["windows"].isna()
        if known.any():
            yield batch.loc[known, _FOUND_NAMES]
        for number, payload in batch.loc[~known, ["chunk", "windows"]].itertuples(index=False):
            chunk.append(number)
            read.append(_read_sent(payload))
    if not read:
        return
    sizes = [len(hi) for hi, _, _ in read]
    hi, lo, number = (np.concatenate(column) for column in zip(*read))
    read.clear()
    order, same = _order(hi, lo)
    found = order[np.concatenate([[False], same]) | np.concatenate([same, [False]])]
    found = np.sort(found[number[found] > 0])  # by chunk again
    cuts = np.searchsorted(found, np.concatenate([[0], np.cumsum(sizes)]))
    some = np.flatnonzero(np.diff(cuts)).tolist()
    pack = zstandard.ZstdCompressor(level=1).compress
    rows = [pack((number[found[cuts[i] : cuts[i + 1]]] - np.uint32(1)).tobytes()) for i in some]
    yield pd.DataFrame({"chunk": [chunk[i] for i in some], "keys": None, "counts": None, "repeated": rows}, columns=_FOUND_NAMES)


def _by_text(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of one chunk: per text the places of its repeated windows, as steps from one to the next."""
    keys, counts, numbers = None, None, []
    unpack = zstandard.ZstdDecompressor().decompress
    for frame in frames:
        for row in frame.itertuples(index=False):
            if row.keys is not None:
                keys, counts = row.keys, row.counts
            numbers.append(np.frombuffer(unpack(row.repeated), "<u4"))
    if keys is None:
        raise RuntimeError("The texts changed while they were read.")
    number = np.sort(np.concatenate(numbers)).astype(np.int64)
    if not len(number):
        return
    keys = np.frombuffer(keys, np.int64).reshape(-1, 2)
    starts = np.concatenate([[0], np.cumsum(np.frombuffer(unpack(counts), "<u4"), dtype=np.int64)])
    text = np.searchsorted(starts, number, side="right") - 1
    at = number - starts[text]
    cuts = np.flatnonzero(np.diff(text, prepend=-1)) if len(text) else np.empty(0, np.int64)
    places = [np.diff(part, prepend=0).astype("<u4").tobytes() for part in np.split(at, cuts)[1:]]
    whose = keys[text[cuts]]
    yield pd.DataFrame({"k1": whose[:, 0], "k2": whose[:, 1], "places": places})


def _cleaned(window: int, text: str) -> Callable:
    """Per text: its words without those that a repeated window covers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_memory("substring")
        for batch in batches:
            texts = texts_in(batch, "r", text).to_pylist()
            places = batch.column("places").to_pylist()
            kept, total, removed, done = [], [], [], 0
            for part in chunks(texts):
                split, _, starts = _words(part)
                hit = np.zeros(starts[-1] + 1, np.int64)
                for number in range(len(part)):
                    packed = places[done + number]
                    if packed:
                        hit[starts[number] + np.cumsum(np.frombuffer(packed, "<u4"), dtype=np.int64)] = 1
                # Covered: a window starts at the word or at one of the 34 before it.
                running = np.concatenate([[0], np.cumsum(hit[:-1])])
                first = np.maximum(np.arange(len(hit) - 1) - window + 1, 0)
                covered = running[1:] > running[first]
                # Windows never start within 34 words of a text's end, so none reaches into the next text.
                gone = np.concatenate([[0], np.cumsum(covered)])[starts]
                for number, words in enumerate(split):
                    start, end = starts[number], starts[number + 1]
                    lost = int(gone[number + 1] - gone[number])
                    if texts[done + number] is None:
                        kept.append(None)
                    elif not lost:
                        kept.append((part[number], words))
                    else:
                        kept.append((None, [words[i] for i in np.flatnonzero(~covered[start:end]).tolist()]))
                    total.append(int(end - start))
                    removed.append(lost)
                done += len(part)
            clean = [None if k is None else k[0] if k[0] is not None else b" ".join(k[1]) for k in kept]
            digests = [hashlib.sha256(b" ".join(k[1]) if k else b"").hexdigest() for k in kept]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("r"),
                    pa.array(clean, pa.binary()).cast(pa.string()),
                    pa.array(total, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(digests, pa.string()),
                ],
                names=["r", "clean", "n_words", "n_removed", "kept_sha256"],
            )

    return run


def _ranges(size: int) -> int:
    """Hash ranges for texts of that many bytes."""
    return max(1, -(-size // RANGE_BYTES))


def _places(sent: DataFrame, find: Callable, label: str) -> DataFrame:
    """Per text the places of the windows that are found in the hash ranges, as steps."""

    def in_range(key: tuple, parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from find(parts)

    def by_text(key: tuple, parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from _by_text(parts)

    found = sent.groupBy("part").applyInPandas(in_range, _FOUND)
    by_key = found.groupBy("chunk").applyInPandas(by_text, "k1 long, k2 long, places binary")
    # All windows of a repeated row are repeated: whichever row of a key stays has all places.
    return stage(by_key.groupBy("k1", "k2").agg(F.first("places").alias("places")), label)


def remove_repeated(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    max_cell_bits: int | None = None,
) -> DataFrame:
    """All columns of ``docs`` and a struct ``dedup`` of ``text, n_words, n_removed, kept_sha256``.

    A word is removed if any window over it has the words of a window elsewhere, in the same text, in another
    row of the same id, or in a repeated row. ``dedup.text`` is the text as it is if nothing is removed, else the
    words that stay, joined by blanks. NULL stays NULL, with no words; ``kept_sha256`` is of the words that
    stay, joined by blanks, also where nothing was removed. Texts with fewer words than a window are never
    changed. A column that is called ``dedup`` already is kept beside ``dedup_``. ``max_cell_bits`` bounds the cells of
    each range's part of the sketch, by two to the power of that; the result is the same.
    """
    in_small_batches(docs.sparkSession)
    keyed = docs.select(F.col(text).cast("binary").alias("t"), *text_keys(F.col(doc_id), F.col(text)))
    size = docs.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0
    sent = keyed.mapInArrow(_send(window, _cell_payloads(_ranges(size))), _SENT).repartition(_ranges(size), "part")
    maybe = _places(sent, _estimated(max_cell_bits), "windows-estimated")
    n = maybe.agg(F.sum(F.octet_length("places")) / 4).first()[0] or 0
    groups = max(1, -(-int(n) // RANGE_WINDOWS))
    # Places take few bytes in files and many in memory: none are broadcast.
    joined = keyed.join(maybe.hint("merge"), ["k1", "k2"]).select("t", "k1", "k2", "places")
    exact = joined.mapInArrow(_send(window, _exact_payloads(groups)), _SENT).repartition(groups, "part")
    places = _places(exact, _repeated, "windows-repeated")
    rows = docs.select(as_row(docs).alias("r"), *text_keys(F.col(doc_id), F.col(text)))
    joined = rows.join(places.hint("merge"), ["k1", "k2"], "left").select("r", "places")
    out = joined.select("r").schema.add("clean", "string").add("n_words", "long").add("n_removed", "long")
    done = joined.mapInArrow(_cleaned(window, text), out.add("kept_sha256", "string"))
    result = F.struct(F.col("clean").alias("text"), "n_words", "n_removed", "kept_sha256")
    return done.select(
        *from_row("r", docs), result.alias(free_name(docs, "dedup"))
    )


def op8_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    cleaned = remove_repeated(docs)
    return cleaned.select("doc_id", "dedup.n_words", "dedup.n_removed", "dedup.kept_sha256")
