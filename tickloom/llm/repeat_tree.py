"""Maximal repeats across documents, from common-prefix interval trees over enhanced suffix arrays, and their removal.

A repeat is a byte string of at least `size` bytes. Every window of `size` bytes has a smallest hash among its 16-byte strings;
equal windows have the same one, wherever they stand. Texts are cut into runs of windows with one smallest hash, hashes that occur in
one document only are dropped, and the strings of the others meet in the task of their hash. There all their suffixes of at least `size` bytes are sorted,
the lengths of their common prefixes are scanned with a stack, and every interval of suffixes with a common prefix that
could not be extended to the left as one (different bytes stand before it) is a group: a length and all its occurrences.
As strings reach as far as their windows, a repeat that is longer gives a chain of overlapping groups.

Texts are stored once, in compressed blocks of bounded size, and read three times: for the hashes, for the strings, and to apply the groups. What moves
between is combined per block before: a hash or a string goes out once per block however often the block holds it, so copies cost
little. A hash with very many occurrences is split: its windows are dealt by their own content instead. Strings are told apart by 128 bits of
hash; everything else compares bytes.

Null texts are empty. A null key counts as larger than any other. Documents with equal keys are not before one another, so they
remove nothing from each other, but both are documents of a group. Texts shorter than `size` have no repeats. An empty table gives no rows. Other
columns are not read.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.common import as_text, slices, text_buffers
from tickloom.session import scratch_path

SIZE = 50
# Bytes of the strings whose hashes are compared; a window holds size - GRAM + 1 of them.
GRAM = 16
# Text bytes in a block, and text bytes for which one bucket of hashes is provided.
BLOCK_BYTES = 4 << 20
BUCKET_BYTES = 8 << 20
# Windows in a string at most.
WINDOWS = 64
# Occurrences (to a power of two per block) from which a hash is split by window.
HOT = 1 << 15
# Suffixes sorted at a time; strings of one hash stay together.
SORTED = 100_000
CHUNK = 1 << 18
LAST = 2**63 - 1
C1, C2, C3 = (np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93))
# The low bits of a hash are free for notes.
LOW = np.uint64(15)
# To find hashes that documents share, their bucket and 36 bits are compared; one more that seems shared does no harm.
SHORT = 36


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x *= C3
    x ^= x >> np.uint64(29)
    x *= C1
    x ^= x >> np.uint64(32)
    return x


def words_of(raw: np.ndarray, more: int, order: str = "<") -> tuple[np.ndarray, np.ndarray]:
    """The bytes with `more` zeros behind them, and the 8 bytes from every place as a number."""
    padded = np.zeros(len(raw) + more, np.uint8)
    padded[: len(raw)] = raw
    return padded, np.ndarray((len(padded) - 8,), f"{order}u8", padded, strides=(1,))


def gram_hashes(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Hashes of 16 bytes, given as two numbers."""
    turned = second * C2
    return mixed(first * C1 ^ (turned << np.uint64(31) | turned >> np.uint64(33)))


def spread(least: np.ndarray) -> np.ndarray:
    """Smallest hashes are small; mixed again they are even."""
    return mixed(least) & ~LOW


def hash_bytes(words: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    state = sizes.astype(np.uint64) * C2
    for at in range(0, int(sizes.max()) if len(sizes) else 0, 8):
        own = np.flatnonzero(sizes > at)
        left = np.minimum(sizes[own] - at, 8).astype(np.uint64)
        word = words[starts[own] + at] & (~np.uint64(0) >> (np.uint64(64) - np.uint64(8) * left))
        state[own] = mixed(state[own] * C3 ^ word)
    return state


def gathered(raw: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    stops = np.cumsum(sizes)
    return raw[np.repeat(starts - stops + sizes, sizes) + np.arange(stops[-1] if len(stops) else 0)]


def packed(arrays: list[np.ndarray]) -> bytes:
    raw = b"".join(np.array([x.nbytes], "<u8").tobytes() + np.ascontiguousarray(x).tobytes() for x in arrays)
    return zstandard.ZstdCompressor(level=1).compress(raw)


def unpacked(blob: bytes, kinds: list) -> list[np.ndarray]:
    raw, at, out = zstandard.ZstdDecompressor().decompress(blob), 0, []
    for kind in kinds:
        size = int(np.frombuffer(raw, "<u8", 1, at)[0])
        out.append(np.frombuffer(raw, kind, size // np.dtype(kind).itemsize, at + 8))
        at += 8 + size
    return out


def _least(a: np.ndarray, width: int) -> np.ndarray:
    """Least of every `width` neighbours."""
    done = 1
    while 2 * done <= width:
        a = np.minimum(a[:-done], a[done:])
        done *= 2
    return np.minimum(a[: len(a) - (width - done)], a[width - done :]) if done < width else a


class Texts:
    """The distinct texts of a block laid end to end, and the runs of windows with one smallest hash."""

    def __init__(self, raw: np.ndarray, doc_sizes: np.ndarray, size: int) -> None:
        self.size = size
        stops = np.cumsum(doc_sizes)
        whole = raw.tobytes()
        seen: dict[bytes, int] = {}
        self.text_of = np.array(
            [seen.setdefault(whole[a:b], len(seen)) for a, b in zip((stops - doc_sizes).tolist(), stops.tolist(), strict=True)], np.int64
        )
        self.sizes = np.array([len(t) for t in seen], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.raw, self.words = words_of(np.frombuffer(b"".join(seen), np.uint8), size + 256)
        self.total = int(self.sizes.sum())
        windows = np.maximum(self.sizes - size + 1, 0)
        self.inside = np.repeat(np.tile([True, False], len(seen)), np.stack([windows, self.sizes - windows], 1).ravel())
        parts = [self._runs(at, min(at + CHUNK, self.total)) for at in range(0, self.total, CHUNK)]
        empty = [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)]
        self.at, self.windows, self.hash = (np.concatenate(c) for c in zip(empty, *parts, strict=True)) if parts else empty
        self.text = np.searchsorted(self.starts, self.at, "right") - 1

    def _runs(self, begin: int, end: int):
        width = self.size - GRAM + 1
        words = self.words[begin : end + width + 7]
        grams = len(words) - 8
        least = _least(gram_hashes(words[:grams], words[8:]), width)
        inside = self.inside[begin:end]
        edge = np.empty(end - begin, bool)
        edge[0] = True
        np.not_equal(least[1:], least[:-1], out=edge[1:])
        edge[1:] |= ~inside[:-1]
        edge |= ~inside
        edges = np.flatnonzero(edge)
        own = inside[edges]
        stops = np.append(edges[1:], end - begin)[own]
        starts = edges[own]
        return starts + begin, stops - starts, spread(least[starts])

    def documents(self) -> tuple[np.ndarray, np.ndarray]:
        """Documents in order of their text, and the first of each text (one more at the end)."""
        order = np.argsort(self.text_of, kind="stable")
        return order, np.searchsorted(self.text_of[order], np.arange(len(self.sizes) + 1))

    def strings(self, chosen: np.ndarray, hot: np.ndarray):
        """Start, bytes, hash, hash of the bytes and text of the strings of the chosen runs; a window each where hot."""
        most = np.where(hot, 1, WINDOWS)
        windows = self.windows[chosen]
        many = -(-windows // most)
        of = np.repeat(np.arange(len(chosen)), many)
        turn = np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many)
        skipped = turn * most[of]
        starts = self.at[chosen][of] + skipped
        sizes = np.minimum(windows[of] - skipped, most[of]) + self.size - 1
        return starts, sizes, self.hash[chosen][of], hash_bytes(self.words, starts, sizes), self.text[chosen][of], hot[of]


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _short(hashes: np.ndarray) -> np.ndarray:
    return hashes >> np.uint64(4) & np.uint64((1 << SHORT) - 1)


def _five_bytes(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values, "<u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes()


def _from_five(blob: bytes) -> np.ndarray:
    wide = np.zeros((len(blob) // 5, 8), np.uint8)
    wide[:, :5] = np.frombuffer(blob, np.uint8).reshape(-1, 5)
    return wide.view("<u8").ravel()


def _by_bucket(bucket: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(bucket, kind="stable")
    bounds = np.searchsorted(bucket[order], np.arange(buckets + 1))
    for i in np.flatnonzero(np.diff(bounds)).tolist():
        yield i, order[bounds[i] : bounds[i + 1]]


# ---- Suffixes and their tree


def clear_bytes(x: np.ndarray) -> np.ndarray:
    """Leading zero bytes of 64-bit numbers."""
    return sum((x < np.uint64(1 << 8 * i)).astype(np.int64) for i in range(1, 8)) + (x == 0)


def sorted_suffixes(raw: np.ndarray, at: np.ndarray, sizes: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the strings `raw[at : at + sizes]`, and how long a prefix each shares with the one before (0: under `least`)."""
    _, words = words_of(raw, int(sizes.max()) + 16, ">")

    def word(own: np.ndarray, j: int) -> np.ndarray:
        value = words[at[own] + 8 * j].astype(np.uint64)
        if 8 * (j + 1) <= least:
            return value
        left = np.clip(sizes[own] - 8 * j, 0, 8)
        shift = np.minimum(64 - 8 * left, 56).astype(np.uint64)
        return np.where(left > 0, value >> shift << shift, np.uint64(0))

    head, most = -(-least // 8), -(-int(sizes.max()) // 8)
    keys = [word(slice(None), j) for j in range(head)]
    order = np.lexsort(keys[::-1])
    shared = np.zeros(len(at), np.int64)
    same = np.ones(len(at), bool)
    same[0] = False
    for j, key in enumerate(keys):
        key = key[order]
        apart = np.flatnonzero(same & np.append(False, key[1:] != key[:-1]))
        if 8 * (j + 1) > least:
            shared[apart] = 8 * j + clear_bytes(key[apart] ^ key[apart - 1])
        same[apart] = False
    del keys
    tied = same.copy()
    tied[:-1] |= same[1:]
    places = np.flatnonzero(tied)
    own, group = order[places], np.cumsum(~same)[places]
    order[places] = own[np.lexsort([sizes[own], *(word(own, j) for j in range(most - 1, head - 1, -1)), group])]
    # Ties may have changed places, but only among equal beginnings.
    left = np.flatnonzero(same)
    for j in range(head, most):
        apart = word(order[left - 1], j) ^ word(order[left], j)
        ends = apart != 0
        shared[left[ends]] = 8 * j + clear_bytes(apart[ends])
        left = left[~ends]
    shared[left] = 8 * most
    shared[1:] = np.minimum(shared[1:], np.minimum(sizes[order[1:]], sizes[order[:-1]]))
    shared[shared < least] = 0
    return order, shared


MIXED = 256


def scan_intervals(shared: list[int], before: list[int], low: list[int]) -> list[tuple[int, int, int, int]]:
    """(first, last, length, least key) of the intervals that cannot be extended to the left, children before parents.

    `shared[i]` is the common prefix of suffixes i - 1 and i, `before` the byte in front of a suffix or MIXED, `low` its least key.
    """
    found, stack = [], []
    count = len(before)
    for i in range(1, count + 1):
        length = shared[i] if i < count else 0
        first, byte, least = i - 1, before[i - 1], low[i - 1]
        while stack and stack[-1][0] > length:
            depth, first, own_byte, own_least = stack.pop()
            if own_byte != byte:
                byte = MIXED
            if own_least < least:
                least = own_least
            if byte == MIXED:
                found.append((first, i - 1, depth, least))
        if stack and stack[-1][0] == length:
            top = stack[-1]
            if top[2] != byte:
                top[2] = MIXED
            if least < top[3]:
                top[3] = least
        elif length:
            stack.append([length, first, byte, least])
    return found


def interval_groups(raw: np.ndarray, starts: np.ndarray, sizes: np.ndarray, low: np.ndarray, several: np.ndarray, least: int):
    """Groups of the maximal repeats of distinct strings: per occurrence (string, offset, length, least key, group).

    A string held by `several` documents is itself a repeat, as what stands before it is not known here.
    """
    windows = sizes - least + 1
    of = np.repeat(np.arange(len(starts)), windows)
    offset = np.arange(len(of)) - np.repeat(np.cumsum(windows) - windows, windows)
    at = starts[of] + offset
    order, shared = sorted_suffixes(raw, at, sizes[of] - offset, least)
    before = np.where(offset > 0, raw[np.maximum(at - 1, 0)].astype(np.int64), MIXED)[order]
    # Suffixes with a common prefix make a tree each; in one with a single byte in front nothing is maximal.
    heads = np.flatnonzero(shared == 0)
    ends = np.append(heads[1:], len(order))
    lows, highs = np.minimum.reduceat(before, heads), np.maximum.reduceat(before, heads)
    found: list[tuple[int, int, int, int]] = []
    key = low[of[order]]
    for i in np.flatnonzero((ends - heads > 1) & ((lows != highs) | (highs == MIXED))).tolist():
        a, b = int(heads[i]), int(ends[i])
        found += [
            (a + x, a + y, length, k)
            for x, y, length, k in scan_intervals(shared[a:b].tolist(), before[a:b].tolist(), key[a:b].tolist())
        ]
    whole = np.flatnonzero(several)
    if found:
        first, last, length, lowest = np.array(found, np.int64).T
        many = last - first + 1
        group = np.repeat(np.arange(len(first)), many)
        place = order[np.arange(len(group)) + np.repeat(first - np.cumsum(many) + many, many)]
        inner = [of[place], offset[place], length[group], lowest[group], group]
    else:
        inner = [np.empty(0, np.int64)] * 5
    leaf = [whole, np.zeros(len(whole), np.int64), sizes[whole], low[whole], len(found) + np.arange(len(whole))]
    return [np.concatenate([x, y]) for x, y in zip(inner, leaf, strict=True)]


# ---- The passes over blocks


def stored_blocks(docs: DataFrame, key: str, text: str) -> DataFrame:
    source = docs.select(F.col(key).alias("_key"), as_text(text).alias("_text"))
    kind = source.schema["_key"].dataType
    if not isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        raise ValueError("keys must be whole numbers")
    schema = "block long, keys array<long>, sizes array<long>, bytes long, data binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        keys, sizes, raws, held = [], [], [], 0

        def closed() -> pa.RecordBatch:
            nonlocal keys, sizes, raws, held, number
            own, every = pa.concat_arrays(keys).cast(pa.int64()), np.concatenate(sizes)
            data = zstandard.ZstdCompressor(level=3).compress(b"".join(raws))
            row = [
                pa.array([number], pa.int64()), pa.ListArray.from_arrays([0, len(own)], own),
                pa.ListArray.from_arrays([0, len(every)], pa.array(every, pa.int64())), pa.array([held], pa.int64()), pa.array([data], pa.binary()),
            ]
            keys, sizes, raws, held, number = [], [], [], 0, number + 1
            return pa.RecordBatch.from_arrays(row, ["block", "keys", "sizes", "bytes", "data"])

        for batch in batches:
            for part in slices(batch, "_text"):
                raw, offsets = text_buffers(part.column("_text"))
                keys.append(part.column("_key"))
                sizes.append(np.diff(offsets))
                raws.append(raw.tobytes())
                held += len(raw)
                if held >= BLOCK_BYTES:
                    yield closed()
        if keys:
            yield closed()

    path = scratch_path(docs.sparkSession, "repeat-blocks")
    source.mapInArrow(run, schema).write.parquet(path)
    return docs.sparkSession.read.parquet(path)


def _block(row: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys (the largest for null), sizes and bytes of a block's documents."""
    keys = row.column("keys").flatten().fill_null(LAST).to_numpy(zero_copy_only=False)
    data = zstandard.ZstdDecompressor().decompress(row.column("data")[0].as_py())
    return keys, row.column("sizes").flatten().to_numpy(zero_copy_only=False), np.frombuffer(data, np.uint8)


def _hand_back() -> None:
    """Freed memory goes back to the system; a worker would otherwise keep the most that it ever held."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1)
            _hand_back()


def _sent_hashes(size: int, buckets: int):
    """Per bucket a block's hashes, shortened; bit 0 is set if several documents hold it, bits 1 to 3 say how often it occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            _, sizes, raw = _block(row)
            texts = Texts(raw, sizes, size)
            if not len(texts.hash):
                continue
            copies = np.bincount(texts.text_of, minlength=len(texts.sizes))
            order = np.argsort(texts.hash, kind="stable")
            hashes, own = texts.hash[order], texts.text[order]
            heads = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1]))
            several = (np.minimum.reduceat(own, heads) != np.maximum.reduceat(own, heads)) | (np.maximum.reduceat(copies[own], heads) > 1)
            often = np.add.reduceat(texts.windows[order], heads)
            power = np.minimum(np.log2(often).astype(np.uint64) // np.uint64(2), np.uint64(7))
            noted = _short(hashes[heads]) << np.uint64(4) | power << np.uint64(1) | several.astype(np.uint64)
            names, blobs = [], []
            for bucket, at in _by_bucket(_bucket(hashes[heads], buckets), buckets):
                names.append(bucket)
                blobs.append(_five_bytes(noted[at]))
            block = row.column("block")[0].as_py()
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.int64()), pa.array([block] * len(names), pa.int64()), pa.array(blobs, pa.binary())],
                ["bucket", "block", "hashes"],
            )

    return run


def _shared_hashes(hot: int):
    """Of the hashes of a bucket, those that several documents hold, per block; the lowest bit is set where one is hot."""

    def run(table: pa.Table) -> pa.Table:
        parts = [_from_five(x) for x in table.column("hashes").to_pylist()]
        sent = np.concatenate(parts)
        order = np.argsort(sent >> np.uint64(4), kind="stable")
        own = sent[order]
        heads = np.flatnonzero(np.append(True, own[1:] >> np.uint64(4) != own[:-1] >> np.uint64(4)))
        many = np.diff(np.append(heads, len(own)))
        shared = (many > 1) | np.maximum.reduceat(own & np.uint64(1), heads).astype(bool)
        often = np.add.reduceat(1 << (2 * (own >> np.uint64(1) & np.uint64(7)).astype(np.int64)), heads) >= hot
        keep, flag = np.empty(len(own), bool), np.empty(len(own), np.uint64)
        keep[order], flag[order] = np.repeat(shared, many), np.repeat(often, many)
        cuts = np.cumsum([len(p) for p in parts])[:-1]
        back = [
            _five_bytes(((p & ~LOW) | f)[k]) for p, k, f in zip(parts, np.split(keep, cuts), np.split(flag, cuts), strict=True)
        ]
        return table.drop_columns("hashes").append_column("hashes", pa.array(back, pa.binary()))

    return run


STRING_KINDS = ["<i8", "<i8", "u1", "<u2", "u1"]
SEVERAL, SPLIT = 1, 2


def _sent_strings(size: int, buckets: int):
    """Per bucket a block's distinct strings with shared hashes: least and largest key, notes, length and bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            parts = [(np.uint64(k["bucket"] << SHORT), _from_five(k["hashes"])) for k in row.column("known")[0].as_py()]
            known = np.sort(np.concatenate([(base + (x >> np.uint64(4))) << np.uint64(1) | x & np.uint64(1) for base, x in parts]))
            if not len(known):
                continue
            keys, sizes, raw = _block(row)
            texts = Texts(raw, sizes, size)
            asked = (_bucket(texts.hash, buckets).astype(np.uint64) << np.uint64(SHORT)) + _short(texts.hash)
            place = np.minimum(np.searchsorted(known, asked << np.uint64(1)), len(known) - 1)
            chosen = np.flatnonzero(known[place] >> np.uint64(1) == asked)
            starts, lengths, hashes, names, text, hot = texts.strings(chosen, known[place[chosen]] & np.uint64(1) != 0)
            order, first = texts.documents()
            low, high = np.minimum.reduceat(keys[order], first[:-1]), np.maximum.reduceat(keys[order], first[:-1])
            copies = np.diff(first)
            by = np.lexsort([names, hashes])
            heads = np.flatnonzero(np.append(True, (hashes[by][1:] != hashes[by][:-1]) | (names[by][1:] != names[by][:-1])))
            own, text = by[heads], text[by]
            least, most = np.minimum.reduceat(low[text], heads), np.maximum.reduceat(high[text], heads)
            # More than one document: two texts, or a text with copies.
            several = (np.minimum.reduceat(text, heads) != np.maximum.reduceat(text, heads)) | (np.maximum.reduceat(copies[text], heads) > 1)
            hashes, names, lengths, starts, hot = hashes[own], names[own], lengths[own], starts[own], hot[own]
            notes = SEVERAL * several.astype(np.uint8) + SPLIT * hot.astype(np.uint8)
            out: list[list] = [[], []]
            for bucket, at in _by_bucket(_bucket(np.where(hot, names, hashes), buckets), buckets):
                # Like beginnings side by side compress better.
                at = at[np.argsort(texts.words[starts[at]].byteswap())]
                content = gathered(texts.raw, starts[at], lengths[at])
                out[0].append(bucket)
                out[1].append(packed([least[at], most[at], notes[at], lengths[at].astype("<u2"), content]))
            block = row.column("block")[0].as_py()
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.int64()), pa.array([block] * len(out[0]), pa.int64()), pa.array(out[1], pa.binary())],
                ["bucket", "block", "strings"],
            )

    return run


OCCURRENCE_KINDS = ["<u8", "<u8", "<u2", "<u2", "<i8", "<i8"]


def _grouped(size: int, everything: bool):
    """Groups of a bucket's strings, sent back to the blocks that hold them: for each string of a block and each group in it
    (hash, hash of the bytes, offset, length, least key, group). Unless `everything`, only where the block has a larger key."""

    def run(name: tuple, table: pa.Table) -> pa.Table:
        (bucket,) = (n.as_py() for n in name)
        parts = [unpacked(x, STRING_KINDS) for x in table.column("strings").to_pylist()]
        least, most, notes, sizes, raw = (np.concatenate(c) for c in zip(*parts, strict=True))
        block = np.repeat(np.arange(len(parts)), [len(p[0]) for p in parts])
        sizes, several, hot = sizes.astype(np.int64), notes & SEVERAL != 0, notes & SPLIT != 0
        starts = np.cumsum(sizes) - sizes
        _, words = words_of(raw, size + 256)
        names = hash_bytes(words, starts, sizes)
        smallest = gram_hashes(words[starts], words[starts + 8])
        for at in range(1, size - GRAM + 1):
            smallest = np.minimum(smallest, gram_hashes(words[starts + at], words[starts + at + 8]))
        marked = spread(smallest) | hot.astype(np.uint64)
        # Strings in order of what they are dealt by, so that equal windows stay together.
        dealt = np.where(hot, names, marked)
        order = np.lexsort([names, dealt])
        new = np.append(True, (names[order][1:] != names[order][:-1]) | (marked[order][1:] != marked[order][:-1]))
        heads = np.flatnonzero(new)
        entry = np.cumsum(new) - 1
        own = order[heads]
        low, many = np.minimum.reduceat(least[order], heads), np.diff(np.append(heads, len(order)))
        held = (many > 1) | np.maximum.reduceat(several[order], heads).astype(bool)
        windows, dealt = sizes[own] - size + 1, dealt[own]
        runs = np.flatnonzero(np.append(True, dealt[1:] != dealt[:-1]))
        turn = (np.cumsum(windows) - windows)[runs] // SORTED
        cuts = np.append(runs[np.append(True, turn[1:] != turn[:-1])], len(own)).tolist()
        bounds = np.append(heads, len(order))

        def sent_back(got: list[np.ndarray], begin: int, end: int, groups: int) -> list[np.ndarray]:
            """Each of a string's occurrences in groups for each of its blocks."""
            string, offset, length, lowest, group = got
            by = np.argsort(string, kind="stable")
            first = np.searchsorted(string[by], np.arange(end - begin + 1))
            rows = order[bounds[begin] : bounds[end]]
            own = entry[bounds[begin] : bounds[end]] - begin
            per = np.diff(first)[own]
            of = np.repeat(np.arange(len(rows)), per)
            at = by[np.arange(len(of)) - np.repeat(np.cumsum(per) - per, per) + first[own][of]]
            if not everything:
                keep = lowest[at] < most[rows][of]
                of, at = of[keep], at[keep]
            number = group[at] + groups if everything else group[:0]
            return [rows[of].astype(np.int32), offset[at].astype("<u2"), length[at].astype("<u2"), lowest[at], number]

        found, groups = [], 0
        for begin, end in zip(cuts, cuts[1:], strict=False):
            part = own[begin:end]
            length = sizes[part]
            content = gathered(raw, starts[part], length)
            got = interval_groups(content, np.cumsum(length) - length, length, low[begin:end], held[begin:end], size)
            found.append(sent_back(got, begin, end, groups))
            groups += int(got[4].max(initial=-1)) + 1
        del raw, words, starts, least, notes
        _hand_back()
        row, offset, length, lowest, group = (np.concatenate(c) for c in zip(*found, strict=True))
        back, kept, blocks = [], [], table.column("block").to_pylist()
        for i, at in _by_bucket(block[row], len(parts)):
            kept.append(blocks[i])
            number = (bucket << 32) + group[at] if everything else group
            back.append(packed([marked[row[at]], names[row[at]], offset[at], length[at], lowest[at], number]))
        return pa.table({"block": pa.array(kept, pa.int64()), "found": pa.array(back, pa.binary())})

    return run


def _occurrences(row: pa.RecordBatch, texts: Texts, keys: np.ndarray):
    """(document, start in the text, length, least key, group) of all groups found for a block."""
    parts = [unpacked(x, OCCURRENCE_KINDS) for x in row.column("found")[0].as_py() or []]
    if not parts:
        return [np.empty(0, np.int64)] * 5
    marked, names, offset, length, lowest, group = (np.concatenate(c) for c in zip(*parts, strict=True))
    order = np.lexsort([names, marked])
    marked, names, offset, length, lowest = (c[order] for c in (marked, names, offset, length, lowest))
    group = group[order] if len(group) else np.zeros(len(order), np.int64)
    heads = np.flatnonzero(np.append(True, (marked[1:] != marked[:-1]) | (names[1:] != names[:-1])))
    many = np.diff(np.append(heads, len(names)))
    known = np.unique(marked)
    place = np.minimum(np.searchsorted(known, texts.hash), len(known) - 1)
    chosen = np.flatnonzero(known[place] & ~LOW == texts.hash)
    starts, _, hashes, own, text, hot = texts.strings(chosen, known[place[chosen]] & LOW != 0)
    # Looked up by a hash of both hashes, then compared by both.
    both = mixed(marked[heads] * C1 ^ names[heads])
    by = np.argsort(both)
    asked = mixed((hashes | hot.astype(np.uint64)) * C1 ^ own)
    entry = by[np.minimum(np.searchsorted(both[by], asked), len(by) - 1)]
    hit = np.flatnonzero((marked[heads][entry] & ~LOW == hashes) & (names[heads][entry] == own))
    entry = entry[hit]
    # Every string's occurrences in groups, for every document of its text.
    docs, first = texts.documents()
    per = np.diff(first)[text[hit]]
    of = np.repeat(np.arange(len(hit)), per * many[entry])
    turn = np.arange(len(of)) - np.repeat(np.cumsum(per * many[entry]) - per * many[entry], per * many[entry])
    copy, which = np.divmod(turn, many[entry][of])
    doc = docs[first[text[hit]][of] + copy]
    at = heads[entry][of] + which
    start = (starts[hit] - texts.starts[text[hit]])[of] + offset[at]
    return [doc, start.astype(np.int64), length[at].astype(np.int64), lowest[at], group[at]]


def _merged(doc: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, begin, end) of the runs that overlapping or touching spans of a document make."""
    if not len(doc):
        return doc, begin, end
    order = np.lexsort([begin, doc])
    doc, begin = doc[order], begin[order]
    # Documents stand one after another, so the furthest end so far is of this document or before it.
    furthest = np.maximum.accumulate(end[order])
    heads = np.flatnonzero(np.append(True, (begin[1:] > furthest[:-1]) | (doc[1:] != doc[:-1])))
    return doc[heads], begin[heads], furthest[np.append(heads[1:], len(doc)) - 1]


SPANS = "array<struct<start:long,end:long>>"


def _removed(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            keys, sizes, raw = _block(row)
            texts = Texts(raw, sizes, size) if row.column("found")[0].as_py() else None
            doc, start, length, low, _ = _occurrences(row, texts, keys) if texts else [np.empty(0, np.int64)] * 5
            later = low < keys[doc]
            stops = np.cumsum(sizes)
            firsts = stops - sizes
            begin = firsts[doc[later]] + start[later]
            owner, a, b = _merged(doc[later], begin, begin + length[later])
            offsets = np.searchsorted(owner, np.arange(len(sizes) + 1))
            spans = pa.StructArray.from_arrays([pa.array(a - firsts[owner]), pa.array(b - firsts[owner])], ["start", "end"])
            bounds = np.concatenate([[0], np.stack([a, b], 1).ravel(), [len(raw)]])
            kept = b"".join([raw[i:j].tobytes() for i, j in zip(bounds[::2].tolist(), bounds[1::2].tolist(), strict=True)])
            left = np.append(0, np.cumsum(sizes - _sums(b - a, owner, len(sizes))))
            rest = [kept[i:j] for i, j in zip(left.tolist(), left[1:].tolist(), strict=False)]
            yield pa.RecordBatch.from_arrays(
                [
                    row.column("keys").flatten(), pa.array(sizes, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), spans), pa.array(rest, pa.binary()),
                ],
                ["key", "n_bytes", "removed", "kept"],
            )

    return run


def _sums(values: np.ndarray, owner: np.ndarray, count: int) -> np.ndarray:
    out = np.zeros(count, np.int64)
    np.add.at(out, owner, values)
    return out


def _listed(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            keys, sizes, raw = _block(row)
            if not row.column("found")[0].as_py():
                continue
            doc, start, length, _, group = _occurrences(row, Texts(raw, sizes, size), keys)
            own = row.column("keys").flatten().take(pa.array(doc, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(group, pa.int64()), pa.array(length, pa.int64()), own, pa.array(start, pa.int64())],
                ["group", "length", "key", "start"],
            )

    return run


def _applied(docs: DataFrame, key: str, text: str, size: int, everything: bool, last: Callable, schema: str) -> DataFrame:
    if size <= GRAM:
        raise ValueError(f"repeats must be longer than {GRAM} bytes")
    blocks = stored_blocks(docs, key, text)
    total = blocks.agg(F.sum("bytes")).first()[0] or 0
    buckets = max(1, -(-total // BUCKET_BYTES))
    # Both joins move the blocks alike, so Spark moves them once.
    own = blocks.where(F.col("block").isNotNull()).select("block", "keys", "sizes", "data")
    sent = own.mapInArrow(_sent_hashes(size, buckets), "bucket long, block long, hashes binary")
    shared = sent.groupBy("bucket").applyInArrow(_shared_hashes(HOT), "bucket long, block long, hashes binary")
    known = shared.groupBy("block").agg(F.collect_list(F.struct("bucket", "hashes")).alias("known"))
    asked = own.join(known, "block")
    strings = asked.mapInArrow(_sent_strings(size, buckets), "bucket long, block long, strings binary")
    found = strings.groupBy("bucket").applyInArrow(_grouped(size, everything), "block long, found binary")
    answers = found.groupBy("block").agg(F.collect_list("found").alias("found"))
    return own.join(answers, "block", "left").mapInArrow(last(size), schema)


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SIZE) -> DataFrame:
    """A row per document: the key, `n_bytes`, the `removed` byte spans (each byte of an occurrence of a group that a document with
    a smaller key is in), and the bytes `kept`."""
    schema = f"key long, n_bytes long, removed {SPANS}, kept binary"
    kind = docs.schema[key].dataType
    done = _applied(docs, key, text, size, False, _removed, schema)
    return done.select(F.col("key").cast(kind).alias(key), "n_bytes", "removed", "kept")


def repeat_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SIZE) -> DataFrame:
    """A row per occurrence of a maximal repeat: its `group` and `length`, the key, and the byte at which it starts in the text."""
    kind = docs.schema[key].dataType
    done = _applied(docs, key, text, size, True, _listed, "group long, length long, key long, start long")
    return done.select("group", "length", F.col("key").cast(kind).alias(key), "start")
