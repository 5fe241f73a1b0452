"""Packing token ids into windows of several context sizes.

Each task reads its texts, turns them into ids and packs them in blocks. Full windows of the longest size are cut off a
document first. What is left goes to the smallest tier that holds it, and tiers are packed from long to short: a window opens
with a document of its tier, its gap takes the largest shorter pieces that fit, and the last gap is filled by
cutting a piece off a document that is too long for it. Windows are therefore full but for the last of a task, whose
pieces are dealt to windows of the powers of two that add up to it, so none is padded. All tier sizes are powers of two.

Windows of a block are dealt to step groups so that each group has about as many of every tier: every `step` windows
of a tier, in order of how many pieces they have, one goes to each group and the direction turns.

Ids are those of the library's default call without special tokens put in; the name of an added token inside a text is
that token. Null or empty texts consist of the end id. Null keys and repeated rows are packed like others. Sequence ids are the task's
number times 2**40 plus a counter, so a task that runs again gives the same ones.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.common import as_text, slices

TIERS = (1024, 512, 256, 128)
# Documents packed together, and the ids at which a block is closed before it has as many; both bound what a task holds.
BLOCK = 4096
BLOCK_IDS = 4 << 20
# Pieces written in one batch.
BATCH_PIECES = 2048
# Fixed value: how byte-level vocabularies of this kind split a text into words.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Characters whose classes may differ between editions of Unicode, and white space of a length that look-ahead is
# slow on. Such texts are left to the tokenizer's own library.
UNUSUAL = re.compile("[^\t\n\r\x20-\x7e\xa1-\u017f]|[\t\n\r ]{400}")
END_ID = 0


def _byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in such a vocabulary: printable ones for themselves, others moved up in order."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    moved = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + at): b for at, b in enumerate(moved)}


class TextIds:
    """Ids of whole texts as little-endian 32-bit numbers, exactly as the tokenizers library gives them.

    Names of added tokens inside a text are the tokens themselves, as is the library's default, or text without `added`.
    If the file is a plain byte-level vocabulary whose merges are ranked by their ids, common texts go through a faster
    implementation of the same merges.
    """

    def __init__(self, path: str, added: bool = True) -> None:
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = not added
        with open(path, encoding="utf-8") as file:
            made = json.load(file)
        names = [t["content"] for t in made.get("added_tokens", []) if t["content"]] if added else []
        # Texts that hold such a token are left to the library.
        self.added = re.compile("|".join(map(re.escape, names))) if names else None
        ranks = self._ranks(made)
        self.fast = None
        if ranks:
            import tiktoken

            self.fast = tiktoken.Encoding("ranks", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})

    @staticmethod
    def _ranks(made: dict) -> dict[bytes, int] | None:
        step, model = made.get("pre_tokenizer") or {}, made["model"]
        plain = (
            step.get("type") == "ByteLevel" and step.get("use_regex", True) and not step.get("add_prefix_space")
            and not made.get("normalizer") and model.get("type") == "BPE" and not model.get("ignore_merges")
            and not model.get("continuing_subword_prefix") and not model.get("end_of_word_suffix")
        )
        if not plain:
            return None
        special = {t["content"] for t in made.get("added_tokens", [])}
        letters = _byte_letters()
        names = {k: v for k, v in model["vocab"].items() if k not in special}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        if any(names.get(a + b) != 256 + at for at, (a, b) in enumerate(pairs)):
            return None
        if len(names) != 256 + len(pairs) or any(c not in letters for name in names for c in name):
            return None
        return {bytes(letters[c] for c in name): rank for name, rank in names.items()}

    def encode(self, texts: list[str]) -> list[bytes]:
        fast = [
            self.fast is not None and not UNUSUAL.search(t) and not (self.added and self.added.search(t)) for t in texts
        ]
        rest = [t for t, ok in zip(texts, fast, strict=True) if not ok]
        slow = iter(self.library.encode_batch_fast(rest, add_special_tokens=False))
        return [
            self.fast.encode_to_numpy(t, disallowed_special=()).astype("<u4").tobytes()
            if ok
            else np.array(next(slow).ids, "<u4").tobytes()
            for t, ok in zip(texts, fast, strict=True)
        ]


@lru_cache(maxsize=2)
def load_ids(path: str, added: bool = True) -> TextIds:
    return TextIds(path, added)


class Pool:
    """Pieces (document, start, length) by length, with the largest one up to a size at hand."""

    def __init__(self) -> None:
        self.by_length: dict[int, list[tuple[int, int]]] = {}
        self.lengths = 0

    def put(self, doc: int, start: int, length: int) -> None:
        self.by_length.setdefault(length, []).append((doc, start))
        self.lengths |= 1 << length

    def _take(self, length: int) -> tuple[int, int, int]:
        row = self.by_length[length]
        doc, start = row.pop()
        if not row:
            self.lengths &= ~(1 << length)
        return doc, start, length

    def largest(self, most: int, least: int = 1) -> tuple[int, int, int] | None:
        """The longest piece of `least` to `most` ids."""
        fitting = self.lengths & ((1 << most + 1) - 1)
        length = fitting.bit_length() - 1
        return self._take(length) if length >= least else None

    def cut(self, size: int) -> tuple[int, int, int] | None:
        """The first `size` ids of the shortest longer piece; the rest goes back."""
        longer = self.lengths >> size + 1
        if not longer:
            return None
        length = size + (longer & -longer).bit_length()
        doc, start, _ = self._take(length)
        self.put(doc, start + size, length - size)
        return doc, start, size


Window = tuple[int, list[tuple[int, int, int]]]


def pack_block(sizes: list[int], tiers: tuple[int, ...] = TIERS) -> list[Window]:
    """(tier, pieces) of windows that hold documents of the given sizes; every window is full."""
    top = tiers[0]
    windows: list[Window] = []
    pool = Pool()
    for doc, size in enumerate(sizes):
        whole = size // top
        windows += [(top, [(doc, i * top, top)]) for i in range(whole)]
        if size % top:
            pool.put(doc, whole * top, size % top)
    tail: list[tuple[int, int, int]] = []
    for place, tier in enumerate(tiers):
        below = tiers[place + 1] if place + 1 < len(tiers) else 0
        while opened := pool.largest(tier, below + 1):
            pieces, gap = [opened], tier - opened[2]
            while gap and (more := pool.largest(gap)):
                pieces.append(more)
                gap -= more[2]
            if gap and (more := pool.cut(gap)):
                pieces.append(more)
                gap = 0
            if gap:
                tail = pieces
            else:
                windows.append((tier, pieces))
    # What is left of the block fills windows of the powers of two that add up to it.
    left = sum(length for _, _, length in tail)
    while tail:
        size = 1 << left.bit_length() - 1
        left -= size
        pieces, gap = [], size
        while gap:
            doc, start, length = tail.pop(0)
            used = min(length, gap)
            pieces.append((doc, start, used))
            gap -= used
            if used < length:
                tail.insert(0, (doc, start + used, length - used))
        windows.append((size, pieces))
    return windows


def step_groups(windows: list[Window], step: int) -> list[int]:
    """Group of each window: `step` windows make a group, tiers and crowded windows spread evenly."""
    groups = max(1, -(-len(windows) // step))
    order = sorted(range(len(windows)), key=lambda i: (-windows[i][0], -len(windows[i][1]), i))
    group = [0] * len(windows)
    for place, i in enumerate(order):
        turn, at = divmod(place, groups)
        group[i] = at if turn % 2 == 0 else groups - 1 - at
    return group


def pack_documents(
    docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", tiers: tuple[int, ...] = TIERS,
    block: int = BLOCK, step: int = 64, block_ids: int = BLOCK_IDS,
) -> DataFrame:
    """A row per piece: the key, `start` and `length` in its document's ids, `ids` (little-endian 32-bit numbers),
    `doc_tokens`, `sequence_id`, `offset` there, `tier` (the window's size) and `step_group`."""
    if any(t & t - 1 for t in tiers) or list(tiers) != sorted(tiers, reverse=True):
        raise ValueError("tiers must be falling powers of two")
    source = docs.select(F.col(key).alias("_key"), as_text(text).alias("_text"))
    long = [(n, T.LongType()) for n in ("start", "length")]
    more = [("ids", T.BinaryType()), *((n, T.LongType()) for n in ("doc_tokens", "sequence_id", "offset"))]
    last = [("tier", T.IntegerType()), ("step_group", T.LongType())]
    kind = source.schema["_key"].dataType
    schema = T.StructType([T.StructField(key, kind), *(T.StructField(n, k, False) for n, k in [*long, *more, *last])])
    arrow = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = load_ids(tokenizer)
        base = TaskContext.get().partitionId() << 40
        end = np.array([END_ID], "<u4").tobytes()
        keys: list[pa.Array] = []
        held: list[bytes] = []
        size = sequence = group_base = 0

        def packed() -> Iterator[pa.RecordBatch]:
            nonlocal size, sequence, group_base, keys, held
            sizes = [len(ids) // 4 for ids in held]
            windows = pack_block(sizes, tiers)
            groups = step_groups(windows, step)
            block_keys = pa.concat_arrays(keys)
            rows, owner = [], []

            def batch() -> pa.RecordBatch:
                own = block_keys.take(pa.array(owner, pa.int64()))
                columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), arrow, strict=True)]
                return pa.RecordBatch.from_arrays([own, *columns], [f.name for f in schema.fields])

            for (tier, pieces), group in zip(windows, groups, strict=True):
                at = 0
                for doc, start, length in pieces:
                    owner.append(doc)
                    ids = held[doc][4 * start : 4 * (start + length)]
                    rows.append((start, length, ids, sizes[doc], base + sequence, at, tier, base + group_base + group))
                    at += length
                sequence += 1
                if len(rows) >= BATCH_PIECES:
                    yield batch()
                    rows, owner = [], []
            if rows:
                yield batch()
            group_base += max(groups) + 1
            keys, held, size = [], [], 0

        for batch in batches:
            for part in slices(batch, "_text"):
                keys.append(part.column("_key"))
                made = [ids + end for ids in ids_of.encode(part.column("_text").to_pylist())]
                held += made
                size += sum(map(len, made)) // 4
                if len(held) >= block or size >= block_ids:
                    yield from packed()
        if held:
            yield from packed()

    return source.mapInArrow(run, schema)
