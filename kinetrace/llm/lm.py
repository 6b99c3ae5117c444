"""Language-model scores by deleted interpolation: n-gram shares, mixed by how often the context was seen.

Texts become blocks of token ids, written to the shared folder. Each block counts its own n-grams, so a
frequent one is counted once a block and never once a document; counts meet under a 64-bit fingerprint, in
parts by its remainder that travel as arrays, are added up over the blocks that learn, and go back to the
blocks that can't know the total by themselves.
An n-gram's share of its context is its maximum-likelihood estimate; the estimates of all sizes and an even
share for every word, known or not, are mixed. The weights depend on the longest context that was seen and
on how often it was (by powers of two), and are learned by expectation-maximisation on documents set apart
from those that give the counts; the score then counts both.

Defined cases: a null or empty text is one end token; a null doc_id counts as an empty text in the
hold-out rule; rows that repeat a doc_id are scored each; texts longer than a block are scored in parts,
each with the words before it as context; without documents to learn from all estimates are the even share
of one unknown word (N and V are 0, base_score and score are 0); without documents set apart the weights stay even; an empty
table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BASE, Scratch, dense, mix, utf8
from .words import BLOCK, Block, blocks, classes, fingerprints

KIND = classes(b" \t\n\x0b\x0c\r")
#: Bytes of text in a block. Arrays of a block's tokens and n-grams are some times that long, in Python and,
#: as rows, in the heap.
LIMIT = BLOCK // 4
#: Roles of documents: counts for the weights come from the first, the weights from the second; both are
#: training documents. The role is a block id's last two bits.
ESTIMATE, DELETED, TEST = 0, 1, 2


@dataclass(frozen=True)
class Options:
    order: int = 2
    #: Documents whose crc32(doc_id) leaves `rest` modulo `folds` are held out.
    folds: int = 7
    rest: int = 2
    #: One training document in so many is set apart for the weights.
    deleted: int = 10
    turns: int = 20
    tolerance: float = 1e-3


def role_column(options: Options):
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    held_out = F.pmod(F.crc32(key.cast("binary")), F.lit(options.folds)) == options.rest
    apart = F.pmod(F.xxhash64(key, F.lit(29)), F.lit(options.deleted)) == 0
    return F.when(held_out, TEST).when(apart, DELETED).otherwise(ESTIMATE).cast("int")


#: Rows that are read from a stored table at a time; a block's row takes some MB.
READ_ROWS = 4


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Python workers get so many rows at a time: few for blocks, more for the packs that meet them. Stored
    rows are read few at a time: thousands of them, as Spark reads by default, would fill the heap."""
    held = {"spark.sql.execution.arrow.maxRecordsPerBatch": rows, "spark.sql.parquet.columnarReaderBatchSize": READ_ROWS}
    before = {key: spark.conf.get(key) for key in held}
    for key, value in held.items():
        spark.conf.set(key, str(value))
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


#: Bytes before a packed value that tell its unpacked size.
HEAD = np.dtype(np.int64).itemsize


def planes(values: np.ndarray) -> bytes:
    """Integers by byte planes, compressed: most are small, and rows stay short wherever Spark holds them."""
    raw = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1).T.tobytes()
    return len(raw).to_bytes(HEAD, "little") + pa.compress(raw, "zstd", asbytes=True)


def unplaned(packed: bytes, kind: type) -> np.ndarray:
    raw = pa.decompress(memoryview(packed)[HEAD:], int.from_bytes(packed[:HEAD], "little"), "zstd")
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, -1).T).view(kind).ravel()


BLOCKS = "block long, docs array<long>, doc_ids array<{}>, lengths array<int>, leads array<int>, pads array<int>, tokens long, ids binary, words binary"


def token_row(block: Block, number: int, order: int) -> dict:
    """One stored row: for each unit its row, its tokens, and how many of them only lead in (pads before
    a text's first word, words of the part before). Ids below `order` are the pads and, last, the end."""
    ids, words = block.ids()
    own = np.concatenate([mix(np.arange(1, order + 1, dtype=np.uint64)), fingerprints(words, 1)])
    context = np.fromiter((u.context for u in block.units), np.int64, len(block.units))
    ends = np.fromiter((u.last for u in block.units), np.int64, len(block.units))
    pads = order - 1 - context
    lengths = pads + np.diff(block.bounds) + ends
    starts = np.cumsum(lengths) - lengths
    out = np.full(int(lengths.sum()), order - 1, np.int32)
    for k in range(order - 1):
        # A part with fewer words before it than the longest context takes the last pads.
        own_pad = pads > k
        out[starts[own_pad] + k] = order - 1 - pads[own_pad] + k
    if len(ids):
        out[(starts + pads)[block.unit] + np.arange(len(ids)) - block.bounds[block.unit]] = ids + order
    return {
        "block": number, "docs": [u.tag[0] for u in block.units], "doc_ids": [u.tag[1] for u in block.units], "lengths": lengths, "leads": pads + context, "pads": pads * np.fromiter((u.first for u in block.units), np.int64, len(block.units)),
        "tokens": int((lengths - pads - context).sum()), "ids": planes(out), "words": own.tobytes(),
    }


def tokenised(docs: DataFrame, order: int, limit: int) -> DataFrame:
    """docs (doc, role, doc_id, text) as rows of BLOCKS."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ints = pa.list_(pa.int32())
        first, known = TaskContext.get().partitionId() << 24, None

        def tags(batch: pa.RecordBatch) -> list:
            nonlocal known
            known = batch.schema.field(2).type
            return list(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()))

        for i, block in enumerate(blocks(batches, 3, KIND, tags, limit, order - 1, groups=lambda b: b.column(1).to_pylist())):
            schema = pa.schema([("block", pa.int64()), ("docs", pa.list_(pa.int64())), ("doc_ids", pa.list_(known)), ("lengths", ints), ("leads", ints), ("pads", ints), ("tokens", pa.int64()), ("ids", pa.binary()), ("words", pa.binary())])
            yield pa.RecordBatch.from_pylist([token_row(block, first + i << 2 | block.group, order)], schema)

    return dense(docs).mapInArrow(run, BLOCKS.format(kind))


class Grams:
    """The n-grams of one stored block: for each size the number of the n-gram that ends at each token
    (-1 where it would leave the unit), their fingerprints, and the block's own counts; up to `size` words."""

    def __init__(self, row: dict, order: int, size: int | None = None):
        ids = unplaned(row["ids"], np.int32).astype(np.int64)
        words = np.frombuffer(row["words"], np.uint64)
        lengths, leads, pads = (np.array(row[k], np.int64) for k in ("lengths", "leads", "pads"))
        starts = np.cumsum(lengths) - lengths
        self.unit = np.repeat(np.arange(len(lengths)), lengths)
        place = np.arange(len(ids)) - starts[self.unit]
        self.scored = place >= leads[self.unit]
        padding = place < pads[self.unit]
        self.at, self.keys, self.counts = [ids], [mix(words + np.uint64(1))], []
        for m in range(2, (size or order) + 1):
            fits = np.flatnonzero((place >= m - 1) & (self.scored if m == order else True))
            key, inverse = np.unique(self.at[-1][fits - 1] * len(words) + ids[fits], return_inverse=True)
            at = np.full(len(ids), -1, np.int64)
            at[fits] = inverse
            self.keys.append(mix(self.keys[-1][key // len(words)] * np.uint64(BASE) + self.keys[0][key % len(words)] + np.uint64(m)))
            self.at.append(at)
        for m, (at, keys) in enumerate(zip(self.at, self.keys), 1):
            counted = self.scored | (padding & (place >= m - 1)) if m < order else self.scored
            self.counts.append(np.bincount(at[counted], minlength=len(keys)))


def rows_of(table: pa.RecordBatch | pa.Table) -> list[dict]:
    return table.select(["block", "lengths", "leads", "pads", "ids", "words"]).to_pylist()


#: N-grams, about, whose totals are made together.
PART_GRAMS = 1_000_000


def parts_of(keys: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """An order of n-grams by part, and their parts in that order."""
    part = (keys % np.uint64(parts)).astype(np.int64)
    by = np.argsort(part, kind="stable")
    return by, part[by]


def gram_rows(stored: DataFrame, size: int, order: int, parts: int) -> DataFrame:
    """(part, block, keys, counts): each block's counts of its n-grams of one size, packed by the keys'
    remainder. Pads come too, as contexts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in rows_of(batch):
                own = Grams(row, order, size)
                keys, n = own.keys[size - 1], own.counts[size - 1].astype(np.int32)
                by, part = parts_of(keys, parts)
                keys, n = keys[by], n[by]
                cuts = np.flatnonzero(np.diff(part, prepend=-1))
                runs = [slice(*x) for x in zip(cuts.tolist(), [*cuts[1:].tolist(), len(part)])]
                yield pa.RecordBatch.from_arrays([pa.array(part[cuts], pa.int32()), pa.array([row["block"]] * len(runs), pa.int64()), pa.array([keys[x].tobytes() for x in runs], pa.binary()), pa.array([planes(n[x]) for x in runs], pa.binary())], names=["part", "block", "keys", "counts"])

    return stored.mapInArrow(run, "part int, block long, keys binary, counts binary")


TOTALS = "part int, block long, learned binary, estimated binary, n_learned long, n_estimated long"


def part_totals(packed: pa.Table) -> pa.Table:
    """For each block of one part, in the order of its n-grams there, the counts over all learning blocks,
    and for blocks set apart those over blocks that estimate; 0 where no other block has the n-gram. The
    last two columns share out the numbers of distinct ones."""
    raw, at = utf8(packed.column("keys"))
    keys = raw.view(np.uint64)
    n = np.concatenate([unplaned(raw, np.int32) for raw in packed.column("counts").to_pylist()]).astype(np.int64)
    blocks_, sizes = packed.column("block").to_numpy(), np.diff(at) // 8
    role = np.repeat(blocks_ & 3, sizes)
    by = np.argsort(keys, kind="stable")
    starts = np.flatnonzero(np.diff(keys[by], prepend=~keys[by[:1]]))
    lengths = np.diff(np.append(starts, len(by)))
    sums = [np.add.reduceat(np.where(use, n, 0)[by], starts) for use in (role != TEST, role == ESTIMATE)]
    spread = [np.empty(len(keys), np.int64) for _ in sums]
    for x, total in zip(spread, sums):
        x[by] = np.repeat(np.where(lengths > 1, total, 0), lengths)
    out, edges = [], np.concatenate([[0], np.cumsum(sizes)])
    for i, (part, block) in enumerate(zip(packed.column("part").to_pylist(), blocks_.tolist())):
        own = slice(edges[i], edges[i + 1])
        kinds = [int((x > 0).sum()) if i == 0 else 0 for x in sums]
        out.append((part, block, planes(spread[0][own]), planes(spread[1][own]) if block & 3 == DELETED else b"", *kinds))
    names = [f.split()[0] for f in TOTALS.split(", ")]
    kinds = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64()]
    return pa.table([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)


def completed(grams: Grams, role: int, answers: pa.Table, column: str, parts: int) -> list[np.ndarray]:
    """Counts of the block's n-grams of each size in the documents that learn: the totals that came back,
    and else the block's own."""
    own = role != TEST if column == "learned" else role == ESTIMATE
    found: dict[int, list] = {}
    for size, part, raw in zip(*(answers.column(c).to_pylist() for c in ("size", "part", column))):
        found.setdefault(size, []).append((part, raw))
    out = []
    for m, (keys, n) in enumerate(zip(grams.keys, grams.counts), 1):
        total = np.zeros(len(keys), np.int64)
        total[parts_of(keys, parts)[0]] = np.concatenate([unplaned(raw, np.int64) for _, raw in sorted(found[m], key=lambda x: x[0])])
        out.append(np.where(total > 0, total, n if own else 0))
    return out


#: Groups of contexts by count: 0 is for counts of 0, then one for each power of two.
DEPTHS = 64


def estimates(grams: Grams, counts: list[np.ndarray], tokens: int) -> tuple[np.ndarray, np.ndarray]:
    """For each scored token the group of its context, and the shares by size, 1 first."""
    at = np.flatnonzero(grams.scored)
    shares = np.zeros((len(counts), len(at)))
    shares[0] = counts[0][grams.at[0][at]] / max(tokens, 1)
    group = np.zeros(len(at), np.int64)
    for m in range(2, len(counts) + 1):
        context = counts[m - 2][grams.at[m - 2][at - 1]]
        seen = context > 0
        shares[m - 1, seen] = counts[m - 1][grams.at[m - 1][at[seen]]] / context[seen]
        group[seen] = (m - 1) * DEPTHS + 1 + np.floor(np.log2(context[seen])).astype(np.int64)
    return group, shares


def start_weights(order: int) -> np.ndarray:
    """For each group of contexts even weights of the shares that exist there; column 0 is the even share."""
    out = np.zeros((order * DEPTHS, order + 1))
    for m in range(order):
        out[m * DEPTHS : (m + 1) * DEPTHS, : m + 2] = 1 / (m + 2)
    return out


def learn_weights(events: DataFrame, options: Options, even: float) -> np.ndarray:
    """Expectation-maximisation: a turn is one pass over the stored events, whose sums, one row a group and
    share, come back."""
    weights = start_weights(options.order)

    def turn(weights: np.ndarray) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros_like(weights)
            for batch in batches:
                for group, shares in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    group = np.frombuffer(group, np.uint16).astype(np.int64)
                    shares = np.frombuffer(shares, np.float32).reshape(options.order, -1)
                    part = weights[group].T.copy()
                    part[0] *= even
                    part[1:] *= shares
                    part /= np.maximum(part.sum(axis=0), 1e-300)
                    for k in range(options.order + 1):
                        total[:, k] += np.bincount(group, part[k], len(weights))
            group, k = np.nonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(group.astype(np.int32)), pa.array(k.astype(np.int32)), pa.array(total[group, k])], names=["group", "k", "n"])

        sums = events.mapInArrow(run, "group int, k int, n double").groupBy("group", "k").agg(F.sum("n").alias("n")).toPandas()
        found = np.zeros_like(weights)
        found[sums["group"].to_numpy(np.int64), sums["k"].to_numpy(np.int64)] = sums["n"].to_numpy()
        return found

    sums = np.zeros_like(weights)
    for _ in range(options.turns):
        sums = turn(weights)
        seen = sums.sum(axis=1) > 0
        new = weights.copy()
        # A little of the start stays, so no share that exists is ruled out by few events.
        base = start_weights(options.order)[seen]
        new[seen] = (sums[seen] + base) / (sums[seen].sum(axis=1, keepdims=True) + 1)
        moved = np.abs(new - weights).max()
        weights = new
        if moved < options.tolerance:
            break
    # A group without events takes the weights of the next group below it with events, if one is there.
    heard = sums.sum(axis=1) > 0
    for g in range(1, len(weights)):
        if not heard[g] and g % DEPTHS > 1 and heard[g - g % DEPTHS : g].any():
            weights[g] = weights[g - 1]
    return weights


def scores(spark: SparkSession, docs: DataFrame, options: Options = Options(), limit: int = LIMIT) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row of docs; scores
    are logarithms to base 10."""
    order = options.order
    scratch = Scratch(spark, "lm", docs)
    rows = docs.select(F.monotonically_increasing_id().alias("doc"), role_column(options).alias("role"), "doc_id", "text")
    stored = scratch.store(tokenised(rows, order, limit), "blocks", long_rows=True)
    role = F.col("block").bitwiseAND(F.lit(3))
    sums = stored.agg(*[F.coalesce(F.sum(F.when(test, F.col("tokens"))), F.lit(0)).alias(k) for k, test in (("all", F.lit(True)), ("learned", role != TEST), ("estimated", role == ESTIMATE))]).first()
    n_parts = max(scratch.width, sums["all"] // PART_GRAMS)
    answers = []
    for size in range(1, order + 1):
        with batches_of(spark, 2):
            packed = gram_rows(stored, size, order, n_parts).groupBy("part").applyInArrow(part_totals, TOTALS).withColumn("size", F.lit(size))
            answers.append(scratch.store(packed, f"answers{size}", long_rows=True))
    kinds = answers[0].agg(F.sum("n_learned").alias("learned"), F.sum("n_estimated").alias("estimated")).first()
    size_of = {k: (sums[k], max(0, kinds[k] - (order - 1)) if sums[k] else 0) for k in ("learned", "estimated")}
    asked = answers[0].drop("n_learned", "n_estimated")
    for other in answers[1:]:
        asked = asked.unionByName(other.drop("n_learned", "n_estimated"))

    def meet(part: DataFrame, run, schema: str) -> DataFrame:
        same = asked if part is stored else asked.where(role == DELETED)
        return part.groupBy("block").cogroup(same.groupBy("block")).applyInArrow(run, schema)

    def events(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for row in rows_of(left):
            grams = Grams(row, order)
            group, shares = estimates(grams, completed(grams, row["block"] & 3, right, "estimated", n_parts), size_of["estimated"][0])
            out.append({"group": group.astype(np.uint16).tobytes(), "shares": shares.astype(np.float32).tobytes()})
        return pa.Table.from_pylist(out, pa.schema([("group", pa.binary()), ("shares", pa.binary())]))

    with batches_of(spark, 256):
        apart = scratch.store(meet(stored.where(role == DELETED), events, "group binary, shares binary"), "events", long_rows=True)
        apart = apart.coalesce(max(1, min(scratch.width, apart.count())))
    with batches_of(spark, 1):
        weights = learn_weights(apart, options, 1 / (size_of["estimated"][1] + 1))
    scratch.delete("events")
    n, v = size_of["learned"]
    if not n:
        weights[:] = np.eye(order + 1)[0]

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        ids = left.schema.field("doc_ids").type.value_type
        schema = pa.schema([("doc", pa.int64()), ("doc_id", ids), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])
        out = []
        for row in left.to_pylist():
            grams = Grams(row, order)
            counts = completed(grams, row["block"] & 3, right, "learned", n_parts)
            group, shares = estimates(grams, counts, n)
            mixed = weights[group, 0] / (v + 1)
            for k in range(order):
                mixed += weights[group, k + 1] * shares[k]
            unit, width = grams.unit[grams.scored], len(row["docs"])
            count = counts[0][grams.at[0][grams.scored]]
            add = lambda values: np.bincount(unit, values, width)
            found = [row["docs"], row["doc_ids"], [row["block"] & 3 == TEST] * width, add(None).astype(np.int64), add(count > 0).astype(np.int64), add(np.log10((count + 1) / (n + v + 1))), add(np.log10(mixed))]
            out.append(pa.table([pa.array(x, f.type) for x, f in zip(found, schema)], schema))
        return pa.concat_tables(out) if out else schema.empty_table()

    kind = docs.schema["doc_id"].dataType.simpleString()
    with batches_of(spark, 256):
        parts = scratch.store(meet(stored, score, f"doc long, doc_id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double"), "parts")
    out = parts.groupBy("doc").agg(F.first("doc_id").alias("doc_id"), F.first("held_out").alias("held_out"), *[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")])
    return scratch.finish(out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score"))
