"""SentencePiece encoding that knows where every piece came from, and decoding.

A text is normalised by longest-prefix matches in the model's compiled character map, and every normalised
byte records the offset of the source bytes it was made from. The normalised text is cut before each run of
word marks where no piece of the vocabulary crosses, each chunk is segmented once and remembered, and the
pieces' normalised lengths are projected through the alignment onto byte spans of the original text.

Null or empty texts have no pieces but the end id. Repeated rows are encoded each. A span is empty for the end
id, for an inserted word mark, and for all byte pieces of one character but its last, which holds the character.
"""

from __future__ import annotations

import re
import struct
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.common import list_array, map_text

MARK = "▁"
BROKEN = "�".encode()
# Chunks remembered per Python worker; the memory starts anew when it is full, nothing is lost.
CACHE_CHUNKS = 400_000
# Ids decoded at a time; more only if one text has more.
DECODE_IDS = 200_000
# Appended to a model file, these fields override its normaliser: no map, no inserted mark, nothing collapsed.
PLAIN_NORMALIZER = bytes([0x1A, 8, 0x12, 0, 0x18, 0, 0x20, 0, 0x28, 0])
INTS = T.ArrayType(T.IntegerType(), False)


def _fields(message: bytes):
    """(number, value) of each field of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(message):
        key = varint()
        wire = key & 7
        if wire == 0:
            yield key >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(wire) or varint()
            yield key >> 3, message[at : at + size]
            at += size


class CharacterMap:
    """Longest-prefix replacement through a compiled map: a double-array trie and its replacement strings."""

    def __init__(self, blob: bytes) -> None:
        self.units: tuple[int, ...] = ()
        self.strings = b""
        if blob:
            (size,) = struct.unpack_from("<I", blob)
            self.units = struct.unpack_from(f"<{size // 4}I", blob, 4)
            self.strings = blob[4 + size :]

    def match(self, text: bytes, start: int) -> tuple[bytes, int]:
        """Replacement of the longest key at `start`, and the key's length; (b"", 0) without one."""
        units = self.units
        if not units:
            return b"", 0
        found, value = 0, 0
        node = _offset(units[0])
        for at in range(start, len(text)):
            byte = text[at]
            node ^= byte
            if node >= len(units):
                break
            unit = units[node]
            if unit & 0x800000FF != byte:
                break
            node ^= _offset(unit)
            if unit >> 8 & 1:
                found, value = at + 1 - start, units[node] & 0x7FFFFFFF
        if not found:
            return b"", 0
        return self.strings[value : self.strings.index(0, value)], found


def _offset(unit: int) -> int:
    return unit >> 10 << ((unit & 512) >> 6)


class Normalizer:
    """Normalised bytes of a text, and for each of them (and the end) the source offset."""

    def __init__(self, spec: bytes, suffix_mark: bool = False, verbatim: list[bytes] | None = None) -> None:
        values = dict(_fields(spec))
        self.map = CharacterMap(values.get(2, b""))
        self.dummy = bool(values.get(3, 1))
        self.collapse = bool(values.get(4, 1))
        self.space = MARK.encode() if values.get(5, 1) else b" "
        self.suffix_mark = suffix_mark
        self.verbatim = sorted(verbatim or [], key=len, reverse=True)
        # Only inserted and escaped marks change such a text, so spans follow from lengths alone.
        self.plain = (
            not self.map.units and self.dummy and not self.collapse and self.space != b" "
            and not suffix_mark and not self.verbatim
        )

    def step(self, text: bytes, at: int) -> tuple[bytes, int]:
        for symbol in self.verbatim:
            if text.startswith(symbol, at):
                return symbol, len(symbol)
        made, used = self.map.match(text, at)
        if used:
            return made, used
        lead = text[at]
        size = 1 if lead < 128 else 2 if lead >> 5 == 6 else 3 if lead >> 4 == 14 else 4 if lead >> 3 == 30 else 0
        char = text[at : at + size]
        try:
            return char.decode() and char or BROKEN, size or 1
        except UnicodeDecodeError:
            return BROKEN, 1

    def __call__(self, text: bytes) -> tuple[bytes, np.ndarray]:
        out, source, at = bytearray(), [], 0

        def put(made: bytes) -> None:
            out.extend(made)
            source.extend([at] * len(made))

        if self.collapse:
            while at < len(text):
                made, used = self.step(text, at)
                if made != b" ":
                    break
                at += used
        if at == len(text):
            return b"", np.array([at], np.int64)
        if self.dummy and not self.suffix_mark:
            put(self.space)
        after_space = self.collapse
        while at < len(text):
            made, used = self.step(text, at)
            if after_space:
                made = made.lstrip(b" ")
            if made:
                put(made.replace(b" ", self.space))
                after_space = self.collapse and made.endswith(b" ")
            at += used
        if self.collapse:
            while out.endswith(self.space):
                at = source[len(out) - len(self.space)]
                del out[-len(self.space) :], source[-len(self.space) :]
        if self.dummy and self.suffix_mark:
            put(self.space)
        source.append(at)
        return bytes(out), np.array(source, np.int64)


class _Chunks(dict):
    """Chunk to the bytes of its (id, normalised length) pairs."""

    def __init__(self, codec: PieceCodec) -> None:
        super().__init__()
        self.codec = codec

    def spell(self, cuts: list[list[str]]) -> list[bytes]:
        """The pairs of each text, given as chunks."""
        flat = list(chain.from_iterable(cuts))
        values = list(map(self.get, flat))
        missing = [at for at, value in enumerate(values) if value is None]
        if missing:
            self.learn({flat[at] for at in missing})
            for at in missing:
                values[at] = self[flat[at]]
        stops = np.cumsum([len(c) for c in cuts]).tolist()
        return [b"".join(values[a:b]) for a, b in zip([0, *stops], stops, strict=False)]

    def learn(self, chunks: set[str]) -> None:
        new = list(chunks)
        if len(self) + len(new) > CACHE_CHUNKS:
            self.clear()
        if not new:
            return
        codec = self.codec
        marked = [c.replace(" ", MARK) for c in new]
        found = codec.segmenter.encode(marked, num_threads=1)
        counts = np.fromiter(map(len, found), np.int64, len(found))
        ends = np.cumsum(counts)
        pairs = np.empty((int(ends[-1]), 2), np.int32)
        pairs[:, 0] = np.fromiter(chain.from_iterable(found), np.int32, len(pairs))
        pairs[:, 1] = codec.sizes[pairs[:, 0]]
        odd = np.unique(np.searchsorted(ends, np.flatnonzero(pairs[:, 1] <= 0), "right"))
        for at in odd.tolist():
            codec.place_bytes(marked[at].encode(), pairs[ends[at] - counts[at] : ends[at]])
        raw = pairs.tobytes()
        stops = (8 * ends).tolist()
        for key, start, stop in zip(new, [0, *stops], stops, strict=False):
            self[key] = raw[start:stop]


class PieceCodec:
    def __init__(self, model: bytes) -> None:
        import sentencepiece

        processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.segmenter = sentencepiece.SentencePieceProcessor(model_proto=model + PLAIN_NORMALIZER)
        pieces = [processor.id_to_piece(i) for i in range(processor.get_piece_size())]
        self.pieces = pieces
        spec, trainer, defined = b"", {}, []
        for number, value in _fields(model):
            if number == 3:
                spec += value
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 1:
                piece = dict(_fields(value))
                if piece.get(3) == 4:
                    defined.append(piece[1])
        self.normalizer = Normalizer(spec, bool(trainer.get(24, 0)), defined)
        self.eos = processor.eos_id()
        self.unknown = processor.unk_id()
        self.is_byte = np.array([processor.is_byte(i) for i in range(len(pieces))])
        control = [processor.is_control(i) for i in range(len(pieces))]
        # 0 marks an unknown piece, -1 a byte piece; both are placed from the text itself.
        self.sizes = np.array([len(p.encode()) for p in pieces], np.int32)
        self.sizes[self.is_byte] = -1
        self.sizes[self.unknown] = 0
        self.marks = np.array([p.count(MARK) for p in pieces], np.int32)
        self.marks[self.is_byte] = 0
        unk = trainer.get(44, " ⁇ ".encode())
        self.surface = [
            b"" if control[i] else unk if i == self.unknown else bytes([int(p[3:5], 16)]) if self.is_byte[i]
            else p.replace(MARK, " ").encode()
            for i, p in enumerate(pieces)
        ]
        self.surface_pool = np.frombuffer(b"".join(self.surface), np.uint8)
        self.surface_sizes = np.array([len(x) for x in self.surface], np.int64)
        self.surface_starts = np.cumsum(self.surface_sizes) - self.surface_sizes
        self.opens_with_mark = np.array([p.startswith(MARK) for p in pieces])
        # Cutting before a run of marks is exact only if no piece has a mark behind another character.
        crossing = any(MARK in p.lstrip(MARK) for p in pieces)
        self.cut = None if crossing or self.normalizer.suffix_mark else re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
        self.cut_plain = re.compile(" *[^ ]+| +")
        self.chunks = _Chunks(self)

    def place_bytes(self, chunk: bytes, pairs: np.ndarray) -> None:
        """Lengths of byte pieces and unknown pieces, read off the chunk they spell."""
        at = 0
        row = 0
        while row < len(pairs):
            size = pairs[row, 1]
            if size > 0:
                at += size
                row += 1
                continue
            lead = chunk[at]
            char = 1 if lead < 128 else 2 if lead < 224 else 3 if lead < 240 else 4
            if size == 0:
                # The unknown piece spans everything up to the next known one.
                known = pairs[row + 1 :, 1]
                rest = int(known[known > 0].sum()) if len(known) and (known > 0).all() else None
                pairs[row, 1] = len(chunk) - at - rest if rest is not None else char
                at += pairs[row, 1]
                row += 1
                continue
            pairs[row : row + char - 1, 1] = 0
            pairs[row + char - 1, 1] = char
            at += char
            row += char

    def encode_many(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Without end ids: all ids, where each ends in its text's bytes, and the number of ids per text.

        A piece begins where the one before it ended.
        """
        plain = self.normalizer.plain
        cuts: list[list[str]] = []
        aligned: dict[int, np.ndarray] = {}
        for at, text in enumerate(texts):
            if not text:
                cuts.append([])
            elif plain and self.cut and MARK not in text:
                # The inserted mark belongs to the first chunk.
                cuts.append(self.cut_plain.findall(f" {text}"))
            else:
                normal, aligned[at] = self.normalizer(text.encode())
                whole = normal.decode()
                cuts.append(self.cut.findall(whole) if self.cut else [whole] * bool(whole))
        raw = self.chunks.spell(cuts)
        counts = np.fromiter(map(len, raw), np.int64, len(raw)) // 8
        pairs = np.frombuffer(b"".join(raw), np.int32).reshape(-1, 2)
        ids = pairs[:, 0]
        # A mark stands for one space, but for the first, which was inserted.
        sums = np.append(0, np.cumsum(pairs[:, 1] - 2 * self.marks[ids], dtype=np.int64))
        first = np.cumsum(counts) - counts
        ends = sums[1:] - np.repeat(sums[first] + 1, counts)
        for at, source in aligned.items():
            own = slice(first[at], first[at] + counts[at])
            ends[own] = source[np.cumsum(pairs[own, 1], dtype=np.int64)]
        return ids, ends, counts

    def decode_many(self, ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
        """Texts of runs of ids."""
        sizes = self.surface_sizes[ids]
        stops = np.append(0, np.cumsum(sizes))
        place = np.repeat(self.surface_starts[ids] - stops[:-1], sizes) + np.arange(stops[-1])
        raw = self.surface_pool[place]
        try:
            str(raw.data, "utf-8")
        except UnicodeDecodeError:
            return pa.array([self.decode(ids[a:b].tolist()) for a, b in zip(offsets, offsets[1:], strict=False)], pa.string())
        # Bytes that make up whole characters only by meeting across texts would have failed in neither.
        bounds = stops[offsets]
        inner = bounds[(bounds > 0) & (bounds < len(raw))]
        if ((raw[inner] & 0xC0) == 0x80).any():
            return pa.array([self.decode(ids[a:b].tolist()) for a, b in zip(offsets, offsets[1:], strict=False)], pa.string())
        if self.normalizer.dummy or self.normalizer.collapse:
            # Only a mark that opens the first piece with any text was inserted.
            owner = np.flatnonzero(sizes > 0)
            first = owner[np.minimum(np.searchsorted(stops[owner], bounds[:-1]), len(owner) - 1)] if len(owner) else None
            if first is not None:
                opens = (bounds[:-1] < bounds[1:]) & self.opens_with_mark[ids[first]]
                drop = np.zeros(len(raw), bool)
                drop[bounds[:-1][opens]] = True
                raw = raw[~drop]
                bounds = bounds - np.append(0, np.cumsum(opens))
        return pa.Array.from_buffers(
            pa.string(), len(offsets) - 1, [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(raw))]
        )

    def decode(self, ids: list[int]) -> str:
        if not ids:
            return ""
        surface = self.surface
        raw = b"".join([surface[i] for i in ids])
        try:
            text = raw.decode()
        except UnicodeDecodeError:
            text = "".join(self._runs(ids))
        norm = self.normalizer
        if (norm.dummy or norm.collapse) and text.startswith(" "):
            first = next(i for i in ids if surface[i])
            if self.opens_with_mark[first]:
                return text[1:]
        return text

    def _runs(self, ids: list[int]):
        """Pieces' texts; a byte of a run that belongs to no whole character becomes the replacement character."""
        at = 0
        while at < len(ids):
            if not self.is_byte[ids[at]]:
                yield self.surface[ids[at]].decode()
                at += 1
                continue
            stop = at
            while stop < len(ids) and self.is_byte[ids[stop]]:
                stop += 1
            run = b"".join(self.surface[i] for i in ids[at:stop])
            at = stop
            place = 0
            while place < len(run):
                for size in (1, 2, 3, 4):
                    try:
                        yield run[place : place + size].decode()
                        place += size
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    yield "\N{REPLACEMENT CHARACTER}"
                    place += 1


@lru_cache(maxsize=4)
def load_codec(path: str) -> PieceCodec:
    with open(path, "rb") as file:
        return PieceCodec(file.read())


def encode_pieces(
    docs: DataFrame, model_path: str, text: str = "text", keep: list[str] | None = None, end_id: bool = True
) -> DataFrame:
    """Kept columns, `ids`, and the byte span `[begins, ends)` in the original text of every piece."""

    def make():
        codec = load_codec(model_path)

        def work(column: pa.Array) -> list[pa.Array]:
            ids, stops, counts = codec.encode_many(column.to_pylist())
            first = np.cumsum(counts) - counts
            starts = np.append(0, stops)[:-1]
            starts[first[counts > 0]] = 0
            if not end_id:
                offsets = np.append(0, np.cumsum(counts))
                return [list_array(x.astype(np.int32), offsets, pa.int32()) for x in (ids, starts, stops)]
            offsets = np.append(0, np.cumsum(counts + 1))
            last = offsets[1:] - 1
            size = np.zeros(len(counts), np.int64)
            size[counts > 0] = stops[(first + counts - 1)[counts > 0]]
            inside = np.ones(offsets[-1], bool)
            inside[last] = False
            made = []
            for own, tail in ((ids, codec.eos), (starts, size), (stops, size)):
                whole = np.empty(offsets[-1], np.int32)
                whole[inside] = own
                whole[last] = tail
                made.append(list_array(whole, offsets, pa.int32()))
            return made

        return work

    fields = [T.StructField(n, INTS, False) for n in ("ids", "begins", "ends")]
    return map_text(docs, text, keep or ["doc_id"], fields, make)


def decode_pieces(encoded: DataFrame, model_path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """All columns of the input but the spans, and the text that the ids spell; null ids spell nothing."""
    kept = [c for c in encoded.columns if c not in ("begins", "ends")]
    if out in kept:
        raise ValueError(f"columns would clash: [{out!r}]")
    source = encoded.select(*kept).withColumn("_ids", F.coalesce(ids, F.array().cast("array<int>")))
    schema = T.StructType([*source.drop("_ids").schema.fields, T.StructField(out, T.StringType(), False)])

    def run(batches):
        codec = load_codec(model_path)
        for batch in batches:
            ends = batch.column("_ids").offsets.to_numpy()
            start = 0
            while start < batch.num_rows:
                stop = max(start + 1, int(np.searchsorted(ends, ends[start] + DECODE_IDS, "right")) - 1)
                part = batch.slice(start, stop - start)
                own = part.column("_ids")
                offsets = own.offsets.to_numpy().astype(np.int64)
                texts = codec.decode_many(own.flatten().to_numpy(), offsets - offsets[0])
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), texts], [*kept, out])
                start = stop

    return source.mapInArrow(run, schema)
