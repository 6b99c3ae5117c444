"""Best-fit packing of documents into fixed-size sequences under conflicts.

A bin may hold at most one piece of each source and of each duplicate cluster. Bins stand in the
order of what room they have left; a piece looks for the successor of its own size in that order and
goes on until a bin's source and cluster bitmaps share no bit with its own: the tightest compatible
bin. Pieces come largest first. Documents longer than a bin are cut into full pieces and a rest.

Documents are dealt to packing groups by a hash, each of about `group_rows` documents, so the work of
a group is bounded; a hot source is spread over all groups, and so are rows without an id. A group that
repeated ids make larger is packed `2 * group_rows` documents at a time, with bins of its own each time.

Defined cases: null and empty texts have one piece of length 0, placed like any other; a null source
conflicts with nothing; repeated rows are separate documents of one cluster and so never share a bin;
an empty table gives no bins; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, dense

CAPACITY = 8192
GROUP_ROWS = 4096
RESULT = "group_id int, bin_id int, bin_pos int, doc_id long, piece int, start long, length long, bin_room long"


def best_fit(pieces: Iterable[tuple], capacity: int) -> list[list]:
    """pieces: (length, source, cluster, ...), largest first. Bins: [room, source bits, cluster bits,
    pieces]."""
    bits: dict = {}
    bins: list[list] = []
    order: list[tuple[int, int]] = []  # (room, bin)
    for piece in pieces:
        length, source, cluster = piece[:3]
        mine = 0 if source is None else 1 << bits.setdefault(("s", source), len(bits))
        twin = 1 << bits.setdefault(("c", cluster), len(bits)) if cluster is not None else 0
        at = bisect_left(order, (length, -1))
        while at < len(order):
            held = bins[order[at][1]]
            if not (held[1] & mine or held[2] & twin):
                break
            at += 1
        if at < len(order):
            _, k = order.pop(at)
        else:
            k = len(bins)
            bins.append([capacity, 0, 0, []])
        held = bins[k]
        held[0] -= length
        held[1] |= mine
        held[2] |= twin
        held[3].append(piece)
        insort(order, (held[0], k))
    return bins


def items(docs: DataFrame, capacity: int) -> DataFrame:
    """(doc_id, size, source, cluster): the size is the text's length in characters, the cluster the
    hash of the text with A-Z lower-cased."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.char_length(text).cast("long").alias("size"), F.xxhash64(F.col("source").cast("string")).alias("source_key"), F.col("source").isNull().alias("no_source"), F.xxhash64(ascii_lower(text)).alias("cluster"))


def pack(spark: SparkSession, docs: DataFrame, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS) -> DataFrame:
    """One row per piece (see RESULT): the pieces of a document, in order, cover its text once."""
    rows = items(dense(docs), capacity)
    total = docs.count()
    n_groups = max(1, -(-total // group_rows))
    nameless = F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id())
    rows = rows.withColumn("group_id", F.pmod(F.xxhash64("doc_id", "cluster", nameless, F.lit(3)), F.lit(n_groups)).cast("int"))
    spread = rows.repartition(min(n_groups, max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))), "group_id")
    ordered = spread.sortWithinPartitions("group_id", "doc_id", "size", "cluster")

    def packed(group: int, members: list[tuple], done: int) -> tuple[pa.RecordBatch, int]:
        """Rows of one lot of a group whose earlier lots took `done` bins, and the bins that it took."""
        pieces = []
        for doc, size, source, none, cluster in members:
            full, rest = divmod(size, capacity)
            for k in range(full):
                pieces.append((capacity, None if none else source, cluster, doc, k, k * capacity))
            if rest or not full:
                pieces.append((rest, None if none else source, cluster, doc, full, full * capacity))
        pieces.sort(key=lambda p: (-p[0], p[3] is None, p[3] or 0, p[4]))
        bins = best_fit(pieces, capacity)
        flat = [(group, done + k, i, p[3], p[4], p[5], p[0], b[0]) for k, b in enumerate(bins) for i, p in enumerate(b[3])]
        kinds = [pa.int32()] * 3 + [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        names = [x.split()[0] for x in RESULT.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*flat), kinds)], names=names), len(bins)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, members, done = None, [], 0
        for batch in batches:
            cols = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("group_id", "doc_id", "size", "source_key", "no_source", "cluster")]
            for group, *row in zip(*cols):
                if members and (group != now or len(members) >= 2 * group_rows):
                    out, bins = packed(now, members, done)
                    yield out
                    members, done = [], done + bins
                if group != now:
                    now, done = group, 0
                members.append(tuple(row))
        if members:
            yield packed(now, members, done)[0]

    return ordered.mapInArrow(run, RESULT)


def fill(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(bins, filled): the bins and the share of their room that is taken."""
    bins = packed.groupBy("group_id", "bin_id").agg(F.first("bin_room").alias("room"))
    return bins.agg(F.count("*").alias("bins"), (1 - F.avg("room") / capacity).alias("filled"))
