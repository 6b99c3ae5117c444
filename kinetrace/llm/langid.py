"""Language identification: multinomial naive Bayes over hashed character n-grams.

N-grams of 1 to 3 characters, lower-cased, with every character that is no letter read as a space,
are hashed to a fixed number of buckets; two spaces stand before and after each text. Counts per language are summed on the executors; the matrix
of log-probabilities (languages x buckets) is broadcast; texts are scored in numpy, batch by batch,
as sums of gathered rows. The model may be fitted on a bounded sample of the labelled rows, of every
language an equal share of `train_docs` at most, so rare languages train with all they have; priors
come from all labelled rows. Every text is scored whole, long ones in segments that count each n-gram
once.

Defined cases: texts null or without a letter are `und` with score 0; rows with a null lang don't
train; a null doc_id counts as an empty text in the hold-out rule; without any training row all
texts are `und`; repeated rows each get a row; an empty table gives an empty result; other columns
ride along, and the added ones take the names given for them.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import dense, fresh

BUCKET_BITS = 14
SIZES = (1, 2, 3)
#: Documents that train the model, about, at most.
TRAIN_DOCS = 20_000
#: Languages learned at most, the most frequent: what is collected and broadcast is languages x buckets
#: numbers.
MAX_LANGS = 1000
SMOOTHING = 0.5
#: N-grams' worth of evidence behind a score, at most: naive Bayes takes each as independent.
EVIDENCE = 200
UNKNOWN = "und"
SEGMENT = 1 << 18


@cache
def letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def held_out_column():
    return (F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(4)) == 2).alias("held_out")


def buckets_of(points: np.ndarray) -> Iterator[np.ndarray]:
    """For each n-gram size the bucket of the n-gram that starts at each position; the array is cut
    to positions that have a whole n-gram."""
    shift = np.uint32(32 - BUCKET_BITS)
    h = np.zeros(len(points), np.uint32)
    for n in range(1, max(SIZES) + 1):
        tail = points[n - 1 :]
        h = h[: len(tail)] * np.uint32(0x01000193) + tail * np.uint32(0x9E3779B1)
        if n in SIZES:
            yield ((h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA6B)) >> shift


def blank_buckets() -> list[int]:
    return [int(b[0]) for b in buckets_of(np.full(max(SIZES), 32, np.uint32)) if len(b)]


def segments(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(points, rows, starts): the code points of several texts, or a part of one, with the row of
    each and where it starts. The first two points of each are context: n-grams count where they end,
    from the third point on, so none joins two texts and none of a long text counts twice."""
    rows, parts, size = [], [], 0
    pad = np.full(2, 32, np.uint32)

    def ready():
        points = np.concatenate(parts)
        starts = np.cumsum([0, *map(len, parts[:-1])])
        return points, np.array(rows), starts

    for row, text in enumerate(texts):
        text = text.lower()
        for at in range(0, max(len(text), 1), SEGMENT):
            piece = np.frombuffer(text[max(0, at - 2) : at + SEGMENT].encode("utf-32-le", "surrogatepass"), np.uint32)
            piece = np.where(letters()[piece], piece, np.uint32(32))
            ahead = pad if at == 0 else pad[:0] if at > 1 else pad[:1]
            behind = pad if at + SEGMENT >= len(text) else pad[:0]
            rows.append(row)
            parts.append(np.concatenate([ahead, piece, behind]))
            size += len(parts[-1])
            if size >= SEGMENT:
                yield ready()
                rows, parts, size = [], [], 0
    if parts:
        yield ready()


def sums_by_row(texts: list[str], table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sum of table rows over each text's n-grams, the number of their ends, and whether it has letters."""
    n, width = len(texts), table.shape[1]
    total, count, alpha = np.zeros((n, width)), np.zeros(n), np.zeros(n, bool)
    for points, rows, starts in segments(texts):
        ends = np.append(starts[1:], len(points))
        np.add.at(count, rows, ends - starts - 2)
        np.logical_or.at(alpha, rows, np.add.reduceat((points != 32).astype(np.int64), starts) > 0)
        for size, bucket in zip(SIZES, buckets_of(points)):
            # N-grams that end from the third point of a piece to its last, by where they start.
            cuts = np.stack([starts + 3 - size, ends + 1 - size], axis=1).ravel()
            cuts = cuts[:-1] if cuts[-1] == len(bucket) else cuts
            got = np.add.reduceat(table.take(bucket, axis=0), cuts, axis=0, dtype=np.float64)[::2]
            np.add.at(total, rows, got)
    return total, count, alpha


def count_ngrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, bucket, n) sums of this task's training texts."""
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = batch.column(0).to_pylist()
        texts = batch.column(1).to_pylist()
        for lang in sorted(set(langs)):
            own = sums.setdefault(lang, np.zeros(1 << BUCKET_BITS, np.int64))
            for points, _, starts in segments([t for t, x in zip(texts, langs) if x == lang]):
                counts = np.ones(len(points), bool)
                counts[starts] = counts[starts + 1] = False
                for size, bucket in zip(SIZES, buckets_of(points)):
                    own += np.bincount(bucket[counts[size - 1 :]], minlength=1 << BUCKET_BITS)
    for lang, own in sums.items():
        at = np.flatnonzero(own)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at, pa.int32()), pa.array(own[at])], names=["lang", "bucket", "n"])


class Model:
    def __init__(self, langs: list[str], log_prob: np.ndarray, prior: np.ndarray):
        self.langs, self.log_prob, self.prior = langs, log_prob, prior

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        texts = [t or "" for t in texts]
        if not self.langs:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        total, count, alpha = sums_by_row(texts, self.log_prob)
        z = total / np.maximum(count, 1)[:, None] * np.minimum(count, EVIDENCE)[:, None] + self.prior
        z -= z.max(axis=1, keepdims=True) if len(z) else 0
        p = np.exp(z)
        p /= p.sum(axis=1, keepdims=True)
        best = p.argmax(axis=1)
        names = [self.langs[k] if a else UNKNOWN for k, a in zip(best, alpha)]
        return names, np.where(alpha, p[np.arange(len(p)), best], 0.0)


def fit(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> Model:
    """Learn from (text, lang) of rows outside the hold-out, about train_docs of them at most, taken by a
    hash of doc_id. What comes to the driver is one number per language and bucket."""
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).where(~held_out_column())
    usable = usable.select(F.col("lang").cast("string").alias("lang"), "text", F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(5)).alias("pick"))
    held = usable.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(MAX_LANGS).toPandas()
    langs = sorted(held["lang"])
    if not langs:
        return Model([], np.zeros((1 << BUCKET_BITS, 0), np.float32), np.zeros(0))
    rows = held.set_index("lang")["n"]
    if rows.sum() > train_docs or len(langs) == MAX_LANGS:
        parts, each = 1 << 30, train_docs / len(langs)
        spare = train_docs - rows.clip(upper=each).sum()  # what rare languages leave to the others
        large = (rows > each).sum()
        take = {x: min(1.0, (each + spare / max(large, 1)) / n) for x, n in rows.items()}
        share = usable.sparkSession.createDataFrame([(x, int(parts * t)) for x, t in take.items()], "lang string, share long")
        usable = usable.join(F.broadcast(share), "lang").where(F.pmod("pick", F.lit(parts)) < F.col("share"))
    counts = usable.select("lang", "text").mapInArrow(count_ngrams, "lang string, bucket int, n long")
    found = counts.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    index = found["lang"].map({x: i for i, x in enumerate(langs)}).to_numpy(np.int64)
    table = np.full((1 << BUCKET_BITS, len(langs)), SMOOTHING)
    table[found["bucket"].to_numpy(np.int64), index] += found["n"].to_numpy(np.float64)
    log_prob = np.log(table / table.sum(axis=0))
    log_prob[blank_buckets()] = 0.0
    prior = rows[langs].to_numpy(np.float64)
    return Model(langs, log_prob.astype(np.float32), np.log(prior / prior.sum()))


def identify(spark: SparkSession, docs: DataFrame, model: Model, lang: str = "lang_pred", score: str = "score") -> DataFrame:
    """docs' columns with `lang` and `score` added, which must be new names; the prediction sees the
    text alone."""
    if fresh(docs, lang) != lang or fresh(docs, score) != score:
        raise ValueError(f"the table has a column {lang} or {score} already: name others")
    shared = spark.sparkContext.broadcast(model)
    names = docs.columns
    at = names.index("text")
    schema = docs.select("*", F.lit("").cast("string").alias(lang), F.lit(0.0).alias(score)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 2048):
                part = batch.slice(i, 2048)
                langs, scores = shared.value.predict(part.column(at).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=[*names, lang, score])

    return dense(docs).mapInArrow(run, schema)
