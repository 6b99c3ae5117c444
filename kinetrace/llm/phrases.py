"""Phrases that hold together: frequent n-grams by level-wise passes, each scored at its weakest cut.

Level 1 counts words. At level k a block emits only k-grams whose both overlapping (k-1)-grams may be
frequent; it asks a bit array of fixed size, made of the frequent (k-1)-grams and broadcast whatever their
number. A bit set by another n-gram lets one more candidate be counted, and the count decides. Counts are
summed in each block before they are shuffled. A cut's parts are looked up in the level tables, and a
phrase goes if a longer candidate around it is nearly as frequent.

Everything is per language. Defined cases: a null lang counts as `und`; a null or empty text has no
words; repeated rows count as often as they stand; n-grams never leave their piece; long texts are read in
parts that overlap by the longest phrase; an empty table, or one without frequent words, gives an empty
result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import Scratch, dense, join_groups, mix
from .words import BLOCK, Block, blocks, chained, classes, fingerprints

SIGNS, BREAKS = b" \t", b".,;:!?\n\x0b\x0c\r"
KIND = classes(SIGNS, BREAKS)
UNKNOWN = "und"
#: Bits of the broadcast array; 32,768 of them make one row of Spark's bitmap functions.
FILTER_BITS = 1 << 27
CHUNK_BITS = 32_768


@dataclass(frozen=True)
class Options:
    order: int = 4
    min_count: int = 30
    #: A longer candidate with this percentage of a phrase's count takes its place.
    cover: int = 80
    top: int = 2000
    scale: int = 2_000_000


def bit_of(phrases: np.ndarray, langs: np.ndarray) -> np.ndarray:
    """The bit of each phrase of a language, given both fingerprints."""
    return (mix(phrases ^ langs) % np.uint64(FILTER_BITS)).astype(np.int64)


def frequent_bits(level: DataFrame) -> np.ndarray:
    """The bit array of a level's phrases: set on the executors, FILTER_BITS / 8 bytes on the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = pc.split_pattern(batch.column(1), " ")  # all phrases of a level are of one length
            own = fingerprints(words.flatten()).reshape(batch.num_rows, -1)
            yield pa.RecordBatch.from_arrays([pa.array(bit_of(chained(list(own.T)), fingerprints(batch.column(0))))], names=["bit"])

    bits = level.select("lang", "phrase").mapInArrow(run, "bit long")
    chunk = F.floor(F.col("bit") / CHUNK_BITS).cast("int")
    chunks = bits.groupBy(chunk.alias("chunk")).agg(F.bitmap_construct_agg((F.col("bit") % CHUNK_BITS).cast("int")).alias("bits"))
    out = np.zeros((FILTER_BITS // CHUNK_BITS, CHUNK_BITS // 8), np.uint8)
    for chunk, own in chunks.toPandas().itertuples(index=False):
        out[chunk] = np.frombuffer(own, np.uint8)
    return out.ravel()


def set_in(bits: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0


def unit_langs(block: Block) -> tuple[pa.Array, np.ndarray]:
    """The block's languages, and for each word the number of its language."""
    coded = pa.array([u.tag for u in block.units], pa.string()).dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)[block.unit]


#: Phrases that a block sends at a time.
SENT_ROWS = 50_000


def grams(block: Block, n: int, bits: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    """(lang, phrase, n) of the block's n-grams whose (n-1)-grams are in `bits`; None asks nothing."""
    langs, lang = unit_langs(block)
    place = block.counted(n)
    words, spelled = block.ids()
    if bits is not None and len(place):
        own = fingerprints(spelled, 1)
        first = np.zeros(len(block) - n + 2, bool)  # where an (n-1)-gram is wanted
        first[place] = first[place + 1] = True
        wanted = np.flatnonzero(first)
        first[wanted] = set_in(bits, bit_of(chained([own[words[wanted + k]] for k in range(n - 1)]), fingerprints(langs)[lang[wanted]]))
        place = place[first[place] & first[place + 1]]
    # Ids of whole n-grams from the ids of their words: equal for equal n-grams and for no others.
    key = lang[place]
    for k in range(n):
        key = np.unique(key * len(spelled) + words[place + k], return_inverse=True)[1]
    count = np.bincount(key)
    one = np.empty(len(count), np.int64)
    one[key] = place
    for i in range(0, len(one), SENT_ROWS):
        first, total = one[i : i + SENT_ROWS], count[i : i + SENT_ROWS]
        size = block.at[first + n] - 1 - block.at[first]
        at = np.concatenate([[0], np.cumsum(size)])
        data = block.data[np.repeat(block.at[first] - at[:-1], size) + np.arange(at[-1])]
        phrase = pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(at), pa.py_buffer(data)).cast(pa.string())
        yield pa.RecordBatch.from_arrays([langs.take(pa.array(lang[first])), phrase, pa.array(total, pa.int64())], names=["lang", "phrase", "n"])


def count_level(docs: DataFrame, n: int, options: Options, bits: Broadcast | None, limit: int) -> DataFrame:
    """(lang, phrase, a) of all n-grams that may be frequent; words come all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mask = None if bits is None else bits.value
        for block in blocks(batches, 1, KIND, lambda b: b.column(0).to_pylist(), limit, options.order - 1):
            yield from grams(block, n, mask)

    texts = dense(docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"), "text"))
    return texts.mapInArrow(run, "lang string, phrase string, n long").groupBy("lang", "phrase").agg(F.sum("n").alias("a"))


def levels(scratch: Scratch, docs: DataFrame, options: Options, limit: int) -> tuple[DataFrame, list[DataFrame]]:
    """(lang, n) with all words counted, and the stored frequent n-grams of each size. `overlap` of a part
    is the longest phrase less one word, so smaller n-grams start late enough to be counted once."""
    spark = scratch.spark
    words = scratch.keep(count_level(docs, 1, options, None, limit), "words")
    totals = scratch.store(words.groupBy("lang").agg(F.sum("a").alias("n")), "totals", rows=0)
    found = [scratch.store(words.where(F.col("a") >= options.min_count), "level1")]
    scratch.drop("words")
    for n in range(2, options.order + 1):
        bits = spark.sparkContext.broadcast(frequent_bits(found[-1]))
        level = count_level(docs, n, options, bits, limit).where(F.col("a") >= options.min_count)
        found.append(scratch.store(level, f"level{n}"))
        bits.unpersist()
    return totals, found


def part(first: int, n: int):
    """Words first to first + n - 1 of `words`, joined."""
    return F.array_join(F.slice("words", first, n), " ")


def weakest_cuts(scratch: Scratch, found: list[DataFrame], options: Options) -> DataFrame:
    """(lang, phrase, size, a, k, l, r, score) of each phrase at its lowest-scoring cut, ties to the smallest k."""
    phrases = reduce(DataFrame.unionByName, [t.withColumn("size", F.lit(n)) for n, t in enumerate(found[1:], 2)])
    phrases = phrases.withColumn("words", F.split("phrase", " "))
    cuts = phrases.select("lang", "phrase", "size", "a", "words", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    sides = cuts.select("lang", "phrase", "size", "a", "k", F.explode(F.array(F.struct(F.lit(True).alias("left"), part(1, F.col("k")).alias("part")), F.struct(F.lit(False).alias("left"), part(F.col("k") + 1, F.col("size") - F.col("k")).alias("part")))).alias("s")).select("lang", "phrase", "size", "a", "k", "s.left", "s.part")
    # A frequent word is a part of many phrases: parts are counted first, so that large groups are known.
    asked = sides.groupBy("lang", "part").agg(F.count("*").alias("asked"))
    table = reduce(DataFrame.unionByName, found[:-1]).select("lang", F.col("phrase").alias("part"), F.col("a").alias("f"))
    groups = scratch.store(asked.join(table, ["lang", "part"]), "parts")
    total = groups.agg(F.coalesce(F.sum("asked"), F.lit(0))).first()[0]
    joined = join_groups(sides, groups, ["lang", "part"], "asked", total, "inner")
    both = joined.groupBy("lang", "phrase", "size", "a", "k").agg(F.max(F.when(F.col("left"), F.col("f"))).alias("l"), F.max(F.when(~F.col("left"), F.col("f"))).alias("r"))
    score = F.expr(f"(CAST(a AS DECIMAL(20,0)) * CAST({options.scale} AS DECIMAL(10,0))) div CAST(l + r AS DECIMAL(20,0))")
    one = both.withColumn("score", score.cast("long")).groupBy("lang", "phrase", "size", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("x"))
    return one.select("lang", "phrase", "size", "a", "x.k", "x.l", "x.r", "x.score")


def uncovered(scored: DataFrame, options: Options) -> DataFrame:
    """Phrases that lie in no longer candidate with `cover` per cent of their count or more."""
    longer = scored.where("size > 2").select("lang", "size", "a", F.split("phrase", " ").alias("words"))
    spans = F.flatten(F.transform(F.sequence(F.lit(2), F.col("size") - 1), lambda n: F.transform(F.sequence(F.lit(1), F.col("size") - n + 1), lambda i: F.array_join(F.slice("words", i, n), " "))))
    inside = longer.select("lang", "a", F.explode(spans).alias("phrase")).groupBy("lang", "phrase").agg(F.max("a").alias("around"))
    return scored.join(inside, ["lang", "phrase"], "left").where(F.col("around").isNull() | (F.col("around").cast("decimal(20,0)") * 100 < F.col("a").cast("decimal(20,0)") * options.cover)).drop("around")


def collocations(spark: SparkSession, docs: DataFrame, options: Options = Options(), limit: int = BLOCK // 2) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first `top` phrases of each language."""
    scratch = Scratch(spark, "phrases", docs)
    totals, found = levels(scratch, docs, options, limit)
    scored = scratch.store(weakest_cuts(scratch, found, options), "scored")
    ranked = uncovered(scored, options).withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")))
    top = scratch.store(ranked.where(F.col("rank") <= options.top), "top")  # each task sends its own first rows only
    out = top.join(totals, "lang")
    return scratch.finish(out.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))
