"""Quality rules: plain counts, and the perplexity of a text under a model of the whole corpus.

Spark counts every byte sequence of length ORDER in all texts, per language. Modified Kneser-Ney smoothing is worked out
on those counts with windows and joins: each length has three discounts from its counts of counts, and shorter
sequences count the distinct ones they end. A longest sequence that occurs once in all texts is scored as unseen, or
every text would vouch for its own oddities.

Nothing of the model passes through the driver or is broadcast. Texts are dealt to blocks of about BLOCK_BYTES; a block hands
on its distinct sequences once, which are counted for the model and joined with the model's values, and the values of a
block come back to it as arrays sorted by language and sequence, compared in full on look-up. A block's distinct sequences
are at most its bytes.

A text's perplexity is the median over stretches of it, and must lie in its language's band. On the log scale the band
begins BELOW times the distance of the quartiles under the lower one and ends ABOVE times it over the upper one. Null or
empty texts have no words and perplexity 1; they fail the plain rules. Languages are told apart by
the whole tag.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tickloom.llm.common import as_text, byte_texts, slices, text_buffers
from tickloom.llm.text_counts import duplicate_lines, repeated_words, symbol_count, word_chars, word_ids
from tickloom.session import broadcast_if_small, drop_path, materialize, scratch_path

ORDER = 4
# Text of a block; one longer text makes a block of its own.
BLOCK_BYTES = 8 << 20
# Spark allows 100,000 buckets; blocks are spread over fewer, whatever their number.
MOST_BUCKETS = 50_000
# Bytes of a stretch; a text's perplexity is that of its middle stretch.
STRETCH = 128
# How far a band reaches beyond the quartiles, in their distance. Copies of a text make it look likelier, so the band
# reaches farther down.
BELOW, ABOVE = 8.0, 4.0
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def language_id(lang: str = "lang") -> Column:
    """A 64-bit number for the whole tag, whatever its case; null counts as empty."""
    return F.xxhash64(F.lower(F.coalesce(F.col(lang).cast("string"), F.lit(""))))


def grams(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each byte, the ORDER bytes that end with it as one number; zeros stand before a text's start."""
    whole = raw.astype(np.uint32)
    for back in range(1, ORDER):
        whole[back:] |= raw[: max(len(raw) - back, 0)].astype(np.uint32) << np.uint32(8 * back)
    # What reaches back into the text before is cut off.
    for ahead in range(ORDER - 1):
        at = offsets[:-1][np.diff(offsets) > ahead] + ahead
        whole[at] &= np.uint32((1 << 8 * (ahead + 1)) - 1)
    return whole


def _slots(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys * _SPREAD >> np.uint64(64 - bits)).astype(np.int64)


class _Block:
    """Distinct sequences of the texts met so far, by language in order of appearance, and how often each occurs."""

    def __init__(self) -> None:
        self.places: dict[int, int] = {}
        self.keys: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.bytes = 0

    def add(self, raw: np.ndarray, offsets: np.ndarray, lang: np.ndarray) -> None:
        self.bytes += len(raw)
        tags, at = np.unique(lang, return_inverse=True)
        own = np.array([self.places.setdefault(tag, len(self.places)) for tag in tags.tolist()], np.uint64)
        distinct, n = np.unique(_keys(np.repeat(own[at], np.diff(offsets)), grams(raw, offsets)), return_counts=True)
        self.keys.append(distinct)
        self.counts.append(n)

    def sequences(self) -> list[np.ndarray]:
        """Languages, sequences and counts, sorted by place of the language and sequence."""
        distinct, at = np.unique(np.concatenate(self.keys), return_inverse=True)
        n = np.bincount(at, np.concatenate(self.counts), len(distinct)).astype(np.int64)
        tags = np.array([*self.places], np.int64)
        return [tags[(distinct >> np.uint64(32)).astype(np.int64)], (distinct & np.uint64(0xFFFFFFFF)).astype(np.int64), n]


LISTS = ("langs", "grams", "counts")


def text_blocks(docs: DataFrame, text: str, lang: str, keep: list[str]) -> DataFrame:
    """Every row with the `_block` it is dealt to, and after a block's rows one with its distinct sequences in `langs`,
    `grams` and `counts`, which are null elsewhere. Kept columns are named `_k0` and so on, a kept text only has `_null`."""
    kept = [F.col(n).alias(f"_k{i}") for i, n in enumerate(keep) if n != text]
    source = docs.select(
        *kept, language_id(lang).alias("lang_id"), F.col(text).isNull().alias("_null"), as_text(text).alias("_text")
    )
    longs = T.ArrayType(T.LongType(), False)
    lists = [T.StructField(n, longs) for n in LISTS]
    loose = [T.StructField(f.name, f.dataType) for f in source.schema.fields]
    schema = T.StructType([T.StructField("_block", T.LongType(), False), *loose, *lists])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        block, kinds = _Block(), []

        def closed() -> pa.RecordBatch:
            nonlocal block, number
            rows = [pa.ListArray.from_arrays([0, len(x)], pa.array(x, pa.int64())) for x in block.sequences()]
            columns = [pa.array([number], pa.int64()), *(pa.nulls(1, kind) for kind in kinds), *rows]
            block, number = _Block(), number + 1
            return pa.RecordBatch.from_arrays(columns, schema.names)

        for batch in batches:
            kinds = batch.schema.types
            for part in slices(batch, "_text"):
                block.add(*text_buffers(part.column("_text")), part.column("lang_id").to_numpy())
                none = [pa.nulls(part.num_rows, pa.list_(pa.int64()))] * len(LISTS)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(part.num_rows, number)), *part.columns, *none], schema.names)
                if block.bytes >= BLOCK_BYTES:
                    yield closed()
        if block.bytes:
            yield closed()

    return source.mapInArrow(run, schema)


def _sequences(blocks: DataFrame) -> DataFrame:
    """(_block, at, lang, gram, n): the distinct sequences of each block and their places in its lists."""
    listed = blocks.where(F.col("grams").isNotNull())
    zipped = listed.select("_block", F.posexplode(F.arrays_zip(*LISTS)).alias("at", "s"))
    return zipped.select("_block", "at", F.col("s.langs").alias("lang"), F.col("s.grams").alias("gram"), F.col("s.counts").alias("n"))


def count_grams(sequences: DataFrame) -> DataFrame:
    """(lang, gram, c) over all texts; each block has added up its own before Spark adds up all."""
    return sequences.groupBy("lang", "gram").agg(F.sum("n").alias("c"))


def _keys(language: np.ndarray, gram: np.ndarray) -> np.ndarray:
    """Place of the language and the sequence as one number; no two pairs share one."""
    return language.astype(np.uint64) << np.uint64(32) | gram.astype(np.uint64)


@dataclass(frozen=True)
class SequenceModel:
    """Tables by sequence length: (lang, gram, context, c, back, p) with the probability `p` of a sequence's last byte after the
    others and the weight `back` of falling back from its context."""

    made: dict[int, DataFrame]

    def values(self, wanted: DataFrame) -> DataFrame:
        """`wanted`, which has `lang` and `gram`, with the log probability `v` of each longest sequence."""
        longest = self.made[ORDER].select("lang", "gram", F.log("p").cast("float").alias("v"))
        return wanted.join(longest, ["lang", "gram"], "left")

    def unseen_values(self, wanted: DataFrame) -> DataFrame:
        """(lang, gram, v) for sequences that no text had: fall back to shorter ones, byte by byte."""
        rows = wanted.select("lang", "gram").distinct().select(
            "lang", "gram", F.lit(None).cast("double").alias("v"), F.lit(0.0).alias("weight")
        )
        for size in range(ORDER - 1, -1, -1):
            # From size + 1 bytes to size: the weight of the context, then the shorter sequence.
            mask = (1 << 8 * size) - 1
            back = self.made[size + 1].groupBy("lang", "context").agg(F.log(F.max("back")).alias("more"))
            rows = rows.withColumn("context", F.shiftright("gram", 8).bitwiseAND(mask)).join(back, ["lang", "context"], "left")
            weight = F.col("weight") + F.coalesce("more", F.lit(0.0))
            rows = rows.select("lang", "gram", "v", F.when(F.col("v").isNull(), weight).otherwise(F.col("weight")).alias("weight"))
            if size:
                shorter = self.made[size].select("lang", F.col("gram").alias("suffix"), F.log("p").alias("own"))
                rows = rows.withColumn("suffix", F.col("gram").bitwiseAND(mask)).join(shorter, ["lang", "suffix"], "left")
                rows = rows.select("lang", "gram", F.coalesce("v", F.col("own") + F.col("weight")).alias("v"), "weight")
        return rows.select("lang", "gram", F.coalesce("v", F.col("weight") - F.log(F.lit(256.0))).cast("float").alias("v"))


class BlockValues:
    """A block's sequences and their log probabilities, with places by a hash of the key for the many look-ups."""

    def __init__(self, langs: np.ndarray, gram: np.ndarray, values: np.ndarray) -> None:
        new = np.flatnonzero(np.append(True, langs[1:] != langs[:-1])) if len(langs) else np.empty(0, np.int64)
        self.places = {tag: i for i, tag in enumerate(langs[new].tolist())}
        size = np.diff(np.append(new, len(langs)))
        self.keys, self.values = _keys(np.repeat(np.arange(len(new)), size), gram), values
        self.bits = len(gram).bit_length() + 1
        self.table = np.zeros(1 << self.bits, np.int32)
        self.table[_slots(self.keys, self.bits)] = np.arange(len(gram))

    def log_probs(self, raw: np.ndarray, offsets: np.ndarray, lang: np.ndarray) -> np.ndarray:
        """Log probability of each byte after those before it, in texts of this block."""
        place = np.array([self.places.get(tag, 0) for tag in lang.tolist()], np.int64)
        wanted = _keys(np.repeat(place, np.diff(offsets)), grams(raw, offsets))
        at = self.table[_slots(wanted, self.bits)]
        # Keys that share a slot are searched for.
        other = np.flatnonzero(self.keys[at] != wanted)
        at[other] = np.searchsorted(self.keys, wanted[other])
        return self.values[at]


def _discounts(types: DataFrame) -> list[float]:
    """Discounts of counts 1, 2 and 3 or more, from how many sequences were counted 1 to 4 times."""
    once = [F.sum((F.col("c") == n).cast("long")).alias(f"n{n}") for n in (1, 2, 3, 4)]
    n1, n2, n3, n4 = [v or 0 for v in types.agg(*once).first()]
    if not (n1 and n2):
        return [0.5, 0.75, 0.9]
    y = n1 / (n1 + 2 * n2)
    made = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.0]
    return [min(max(d, 0.05), limit) for d, limit in zip(made, (0.95, 1.9, 2.9), strict=True)]


def train_model(docs: DataFrame, text: str = "text", lang: str = "lang") -> SequenceModel:
    """Count all texts and smooth the counts."""
    return smoothed(count_grams(_sequences(text_blocks(docs, text, lang, []))))


def smoothed(counts: DataFrame) -> SequenceModel:
    """The model of counted longest sequences (lang, gram, c)."""
    types = {ORDER: materialize(counts)}
    for size in range(ORDER - 1, 0, -1):
        suffix = F.col("gram").bitwiseAND((1 << 8 * size) - 1)
        types[size] = types[size + 1].groupBy("lang", suffix.alias("gram")).agg(F.count(F.lit(1)).alias("c"))
    made = {}
    for size in range(1, ORDER + 1):
        one, two, more = _discounts(types[size])
        c = F.col("c")
        cut = F.when(c == 1, one).when(c == 2, two).otherwise(more)
        # A context has at most 256 sequences, so no window holds more rows.
        context = Window.partitionBy("lang", "context")
        rows = types[size].withColumn("context", F.shiftright("gram", 8)).select(
            "lang",
            "gram",
            "context",
            "c",
            ((c - cut) / F.sum("c").over(context)).alias("own"),
            (F.sum(cut).over(context) / F.sum("c").over(context)).alias("back"),
        )
        if size == 1:
            rows = rows.withColumn("p", F.col("own") + F.col("back") / 256)
        else:
            # Seen once, a longest sequence is the scored text's own: it counts as unseen.
            alone = (c == 1) & F.lit(size == ORDER)
            shorter = made[size - 1].select("lang", F.col("gram").alias("suffix"), F.col("p").alias("lower"))
            rows = (
                rows.withColumn("suffix", F.col("gram").bitwiseAND((1 << 8 * (size - 1)) - 1))
                .join(shorter, ["lang", "suffix"])
                .withColumn("p", F.when(alone, 0.0).otherwise(F.col("own")) + F.col("back") * F.col("lower"))
            )
        made[size] = materialize(rows.select("lang", "gram", "context", "c", "back", "p"))
    return SequenceModel(made)


SCORE_FIELDS = [
    T.StructField("n_words", T.LongType(), False),
    T.StructField("word_chars", T.LongType(), False),
    T.StructField("n_symbols", T.LongType(), False),
    T.StructField("n_dup_lines", T.LongType(), False),
    T.StructField("n_repeat_words", T.LongType(), False),
    T.StructField("log_perplexity", T.DoubleType(), False),
]


def _log_perplexity(column: pa.Array, lang: np.ndarray, model: BlockValues) -> np.ndarray:
    """Middle value over a text's stretches, so that a quotation in another tongue does not decide."""
    raw, offsets = text_buffers(column)
    value = np.zeros(len(column))
    if not len(raw):
        return value
    size = np.diff(offsets)
    # Stretches of about equal length, none shorter than STRETCH unless the text is.
    parts = np.maximum(size // STRETCH, 1) * (size > 0)
    doc = np.repeat(np.arange(len(size)), parts)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(parts) - parts, parts)
    start = offsets[doc] + nth * size[doc] // parts[doc]
    length = np.diff(np.append(start, len(raw)))
    mean = -np.add.reduceat(model.log_probs(raw, offsets, lang).astype(np.float64), start) / length
    order = np.lexsort((mean, doc))
    first = np.cumsum(parts) - parts
    some = np.flatnonzero(parts)
    low, high = first[some] + (parts[some] - 1) // 2, first[some] + parts[some] // 2
    value[some] = (mean[order[low]] + mean[order[high]]) / 2
    return value


def score_blocks(blocks: DataFrame, valued: DataFrame, text: str, keep: list[str], kinds: dict[str, T.DataType]) -> DataFrame:
    """Kept columns, `lang_id`, the plain counts and the log perplexity of each text of written blocks, whose
    sequences come with their values `v`."""
    clash = {"lang_id", *(f.name for f in SCORE_FIELDS)} & set(keep)
    if clash:
        raise ValueError(f"columns would clash: {sorted(clash)}")
    rows = blocks.where(F.col("grams").isNull()).drop(*LISTS)
    schema = T.StructType([*(T.StructField(n, kinds[n]) for n in keep), T.StructField("lang_id", T.LongType(), False), *SCORE_FIELDS])

    def run(docs: pa.Table, values: pa.Table) -> pa.Table:
        values = values.sort_by("at")
        block = BlockValues(*(values.column(n).to_numpy() for n in ("lang", "gram", "v")))
        made = []
        for batch in docs.combine_chunks().to_batches():
            for part in slices(batch, "_text"):
                column, tags = part.column("_text"), part.column("lang_id")
                rows = []
                for raw in byte_texts(column):
                    words = raw.split()
                    repeats = repeated_words(word_ids(words)) if len(words) > 3 else 0
                    rows.append((len(words), word_chars(raw), symbol_count(raw), duplicate_lines(raw), repeats))
                counts = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
                given = pa.array(column.to_pylist(), mask=part.column("_null").to_numpy(zero_copy_only=False), type=column.type)
                kept = [given if n == text else part.column(f"_k{i}") for i, n in enumerate(keep)]
                value = pa.array(_log_perplexity(column, tags.to_numpy(), block))
                made.append(pa.RecordBatch.from_arrays([*kept, tags, *counts, value], schema.names))
        if made:
            return pa.Table.from_batches(made)
        return pa.table([[] for _ in schema.names], names=schema.names).cast(to_arrow_schema(schema))

    own = valued.select(F.col("_block").alias("_of"), "at", "lang", "gram", "v")
    return rows.groupBy("_block").cogroup(own.groupBy("_of")).applyInArrow(run, schema)


def _written_blocks(docs: DataFrame, text: str, lang: str, keep: list[str]) -> tuple[str, str]:
    """Name and path of the blocks as a table in buckets by block, so that texts need not move again to meet their values."""
    spark = docs.sparkSession
    name, path = f"text_blocks_{uuid.uuid4().hex}", scratch_path(spark, "text-blocks")
    buckets = min(2 * max(docs.rdd.getNumPartitions(), 1), MOST_BUCKETS)
    writer = text_blocks(docs, text, lang, keep).write.option("compression", "zstd").option("path", path)
    writer.bucketBy(buckets, "_block").saveAsTable(name)
    return name, path


def _scored(blocks: tuple[str, str], valued: DataFrame, text: str, keep: list[str], docs: DataFrame) -> DataFrame:
    """Scores of written blocks, which are deleted then."""
    spark, (name, path) = docs.sparkSession, blocks
    made = scratch_path(spark, "scored-texts")
    score_blocks(spark.table(name), valued, text, keep, _kinds(docs, text)).write.option("compression", "zstd").parquet(made)
    spark.sql(f"DROP TABLE {name}")
    drop_path(spark, path)
    return spark.read.parquet(made)


def _kinds(docs: DataFrame, text: str) -> dict[str, T.DataType]:
    return {f.name: T.StringType() if f.name == text else f.dataType for f in docs.schema.fields}


def score_texts(
    docs: DataFrame, model: SequenceModel, text: str = "text", lang: str = "lang", keep: list[str] | None = None
) -> DataFrame:
    """Kept columns, `lang_id`, the plain counts and the log perplexity of each text, seen before or not."""
    names = list(keep or [])
    blocks = _written_blocks(docs, text, lang, names)
    valued = materialize(model.values(_sequences(docs.sparkSession.table(blocks[0]))))
    missing = valued.where(F.col("v").isNull()).drop("v")
    late = missing.join(model.unseen_values(missing), ["lang", "gram"])
    valued = valued.where(F.col("v").isNotNull()).unionByName(late)
    return _scored(blocks, valued, text, names, docs)


def perplexity_bands(scored: DataFrame, below: float, above: float) -> DataFrame:
    """(lang_id, lower, upper) of the log perplexity, from the quartiles over all texts that are not empty."""
    some = scored.where("log_perplexity > 0")
    quartiles = some.groupBy("lang_id").agg(F.percentile_approx("log_perplexity", [0.25, 0.75], 2000).alias("q"))
    low, high = F.col("q")[0], F.col("q")[1]
    return quartiles.select(
        "lang_id", (low - below * (high - low)).alias("lower"), (high + above * (high - low)).alias("upper")
    )


def judge_quality(
    docs: DataFrame, text: str = "text", lang: str = "lang", keep: list[str] | None = None,
    below: float = BELOW, above: float = ABOVE,
) -> DataFrame:
    """Kept columns, the plain counts, `perplexity`, its band, `base_failed` and `kept`."""
    names = list(keep or ["doc_id"])
    blocks = _written_blocks(docs, text, lang, names)
    sequences = _sequences(docs.sparkSession.table(blocks[0]))
    model = smoothed(count_grams(sequences))
    # The model was made of these texts, so it has a value for each of their sequences.
    scored = _scored(blocks, model.values(sequences), text, names, docs)
    bands = perplexity_bands(scored, below, above)
    bands = materialize(bands.select("lang_id", F.array("lower", "upper").alias("_band")))
    bands = broadcast_if_small(bands, bands.count())
    columns = [F.col(f.name) for f in SCORE_FIELDS[:-1]]
    n_words, repeats, value = F.col("n_words"), F.col("n_repeat_words"), F.col("log_perplexity")
    failed = (n_words < 50) | (100 * repeats > 50 * n_words)
    inside = F.coalesce(value.between(F.col("_band")[0], F.col("_band")[1]), F.lit(False))
    return scored.join(bands, "lang_id", "left").select(
        *names,
        *columns,
        failed.alias("base_failed"),
        (~failed & inside).alias("kept"),
        F.exp(value).alias("perplexity"),
        F.exp(F.col("_band")[0]).alias("lower_band"),
        F.exp(F.col("_band")[1]).alias("upper_band"),
    )


def keep_quality(
    docs: DataFrame, text: str = "text", lang: str = "lang", below: float = BELOW, above: float = ABOVE
) -> DataFrame:
    """The rows that `judge_quality` keeps, with the columns they came with, whatever their names."""
    names = [f"_c{i}" for i in range(len(docs.columns))]
    own = dict(zip(docs.columns, names, strict=True))
    judged = judge_quality(docs.toDF(*names), own[text], own[lang], names, below, above)
    return judged.where("kept").select(*names).toDF(*docs.columns)
