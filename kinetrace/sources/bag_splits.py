"""Scans of bags whose files are cut into blocks, so that one bag gives many tasks.

A block is a range of row ids of a SQLite file or a run of chunks of an mcap file. The times at which
blocks begin cut a file's time into slices; one pass over times and topics counts the messages of each
block in each slice. Sums over earlier slices tell where a topic's sequence numbers go on, and each slice
is then read from the blocks that have messages in it, in order of time. Rows and numbers equal those of
the scan in one piece. Blocks of a live recording overlap at their ends alone, so nearly all is read once;
in a file without any order of time a slice meets many blocks.

What can't be cut is one block: packed SQLite files, and mcap files that have messages outside of chunks
or whose summary lacks chunk indexes or channels.
"""

from __future__ import annotations

import heapq
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from . import bag, mcap

SPLIT_BYTES = 64 << 20
#: Bytes of payloads and rows in one batch that a task hands on, at most, but for a single message.
BATCH_BYTES, BATCH_ROWS = 8 << 20, 4096

BLOCK = pa.struct([("a", pa.int64()), ("b", pa.int64()), ("chunks", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))])
CHANNEL = pa.struct([("number", pa.int32()), ("topic", pa.string()), ("kind", pa.string())])
FILE = [("bag", pa.string()), ("file", pa.int32()), ("path", pa.string()), ("backend", pa.string()), ("channels", pa.list_(CHANNEL)), ("cuts", pa.list_(pa.int64()))]
PLANNED = pa.schema([*FILE, ("blocks", pa.list_(BLOCK))])
COUNTED = pa.schema([*FILE, ("block", BLOCK), ("slice", pa.int32()), ("topic", pa.string()), ("n", pa.int64())])
ROWS = pa.schema([
    ("bag", pa.string()), ("topic", pa.string()), ("message_type", pa.string()), ("sequence", pa.int64()), ("header_time_ns", pa.int64()), ("bag_time_ns", pa.int64()),
    ("frame_id", pa.string()), ("values", pa.list_(pa.float64())), ("names", pa.list_(pa.string())), ("image", pa.binary()), ("image_format", pa.string()), ("error", pa.string()),
])
BLOCK_SQL = "struct<a: bigint, b: bigint, chunks: array<struct<start: bigint, stop: bigint>>>"
FILE_SQL = "bag string, file int, path string, backend string, channels array<struct<number: int, topic: string, kind: string>>, cuts array<bigint>"


def batches_of(rows: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows in batches bounded by rows and by the bytes of their images."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row.get("image") or b"")
        if size >= BATCH_BYTES or len(held) >= BATCH_ROWS:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def sqlite_blocks(path: Path, split: int) -> tuple[list[dict], list[int]]:
    """Equal ranges of row ids, and the time of the first message of each."""
    con, held = bag.open_storage(path)
    try:
        lo, hi = con.execute("SELECT min(rowid), max(rowid) FROM messages").fetchone()
        if lo is None:
            return [], []
        parts = 1 if held else min(-(-path.stat().st_size // split), hi - lo + 1)
        edges = [lo + (hi - lo + 1) * k // parts for k in range(parts + 1)]
        first = [con.execute("SELECT timestamp FROM messages WHERE rowid >= ? ORDER BY rowid LIMIT 1", (a,)).fetchone()[0] for a in edges[1:-1]]
        return [{"a": a, "b": b - 1, "chunks": []} for a, b in zip(edges, edges[1:])], first
    finally:
        con.close()
        if held:
            held.cleanup()


def mcap_blocks(path: Path, split: int) -> tuple[list[dict], list[int], list[dict]]:
    """Runs of chunks of about `split` bytes, the earliest time of each but the first, and the channels."""
    found = mcap.summary(path)
    if found is None:
        return [{"a": 0, "b": 0, "chunks": []}], [], []
    channels, chunks = found
    blocks, first, size = [], [], split
    for start, stop, earliest in chunks:
        if size >= split:
            blocks.append({"a": len(blocks), "b": len(blocks), "chunks": []})
            first.append(earliest)
            size = 0
        blocks[-1]["chunks"].append({"start": start, "stop": stop})
        first[-1] = min(first[-1], earliest)
        size += stop - start
    return blocks, first[1:], [{"number": k, "topic": t, "kind": v} for k, (t, v) in channels.items()]


def block_times(row: dict, block: dict, topics: list[str] | None) -> Iterator[tuple[str, int]]:
    """(topic, time) of a block's messages, without their payloads."""
    if row["backend"] == "mcap":
        channels = {c["number"]: (c["topic"], c["kind"]) for c in row["channels"]}
        chunks = [(c["start"], c["stop"]) for c in block["chunks"]]
        yield from mcap.times(row["path"], topics, channels if chunks else None, chunks or None)
        return
    con, held = bag.open_storage(Path(row["path"]))
    try:
        sql = "SELECT t.name, m.timestamp FROM messages m JOIN topics t ON t.id = m.topic_id WHERE m.rowid BETWEEN ? AND ?"
        for topic, stamp in con.execute(sql, (block["a"], block["b"])):
            if topics is None or topic in topics:
                yield topic, stamp
    finally:
        con.close()
        if held:
            held.cleanup()


def block_messages(row: dict, block: dict, topics: list[str] | None, lo: int | None, hi: int | None) -> Iterator[tuple]:
    """(time, place, topic, type, payload) of a block's messages with lo <= time < hi, in order."""
    if row["backend"] == "mcap":
        channels = {c["number"]: (c["topic"], c["kind"]) for c in row["channels"]}
        chunks = [(c["start"], c["stop"]) for c in block["chunks"]]
        for place, (topic, kind, stamp, data) in mcap.placed(row["path"], topics, channels if chunks else None, chunks or None, lo, hi):
            yield stamp, place, topic, kind, data
        return
    con, held = bag.open_storage(Path(row["path"]))
    try:
        # A plus sign keeps SQLite from walking an index on time over the whole file.
        sql = "SELECT m.timestamp, m.id, t.name, t.type, m.data FROM messages m JOIN topics t ON t.id = m.topic_id WHERE m.rowid BETWEEN ? AND ?"
        given: list = [block["a"], block["b"]]
        for sign, bound in ((">=", lo), ("<", hi)):
            if bound is not None:
                sql += f" AND +m.timestamp {sign} ?"
                given.append(bound)
        if topics is not None:
            sql += f" AND t.name IN ({', '.join('?' * len(topics))})"
            given += topics
        for stamp, place, topic, kind, data in con.execute(sql + " ORDER BY +m.timestamp, m.id", given):
            yield stamp, (place,), topic, kind, bytes(data)
    finally:
        con.close()
        if held:
            held.cleanup()


def storage_files(root: str) -> list[tuple[str, int, str, str, int]]:
    """(bag, number, path, backend, bytes) of the storage files of all bags under root: the catalogue."""
    out = []
    for b in bag.bags_under(root):
        meta = bag.bag_metadata(b)
        out += [(str(b), k, str(f), bag.backend_of(f, meta["storage"]), f.stat().st_size) for k, f in enumerate(meta["files"])]
    return out


def scan(spark: SparkSession, root: str, topics: list[str] | None = None, split_bytes: int = SPLIT_BYTES, adapters: dict | None = None) -> DataFrame:
    """The rows of all bags under root, by blocks of about `split_bytes`."""
    files = storage_files(root)
    adapters = dict(adapters or bag.ADAPTERS)
    tasks = sum(max(1, -(-f[4] // split_bytes)) for f in files) or 1

    def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                channels: list[dict] = []
                if row["backend"] == "mcap":
                    blocks, first, channels = mcap_blocks(Path(row["path"]), split_bytes)
                else:
                    blocks, first = sqlite_blocks(Path(row["path"]), split_bytes)
                yield pa.RecordBatch.from_pylist([{**row, "channels": channels, "cuts": sorted(set(first)), "blocks": blocks}], PLANNED)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                found = Counter((bisect_right(row["cuts"], stamp), topic) for topic, stamp in block_times(row, row["block"], topics))
                yield from batches_of(({**row, "slice": s, "topic": t, "n": n} for (s, t), n in found.items()), COUNTED)

    def messages(row: dict) -> Iterator[dict]:
        cuts, k = row["cuts"], row["slice"]
        lo, hi = cuts[k - 1] if k else None, cuts[k] if k < len(cuts) else None
        following = {o["topic"]: o["start"] for o in row["offsets"]}
        parts = [block_messages(row, b, topics, lo, hi) for b in row["blocks"]]
        for stamp, _, topic, kind, data in heapq.merge(*parts, key=lambda m: m[:2]):
            yield {"bag": row["bag"], "topic": topic, "message_type": kind, "sequence": following[topic], "bag_time_ns": stamp, **bag.decoded(kind, data, adapters)}
            following[topic] += 1

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield from batches_of(messages(row), ROWS)

    listed = spark.createDataFrame([f[:4] for f in files], "bag string, file int, path string, backend string")
    planned = listed.repartition(max(1, len(files))).mapInArrow(plan, FILE_SQL + f", blocks array<{BLOCK_SQL}>")
    blocks = planned.withColumn("block", F.explode("blocks")).drop("blocks").repartition(tasks)
    counted = blocks.mapInArrow(count, FILE_SQL + f", block {BLOCK_SQL}, slice int, topic string, n long")
    shared = [F.first(c).alias(c) for c in ("path", "backend", "channels", "cuts")]
    topical = counted.groupBy("bag", "file", "slice", "topic").agg(*shared, F.sum("n").alias("n"), F.collect_list("block").alias("blocks"))
    before = W.partitionBy("bag", "topic").orderBy("file", "slice").rowsBetween(W.unboundedPreceding, -1)
    topical = topical.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0)))
    slices = topical.groupBy("bag", "file", "slice").agg(*shared, F.collect_list(F.struct("topic", "start")).alias("offsets"), F.array_distinct(F.flatten(F.collect_list("blocks"))).alias("blocks"))
    return slices.repartition(tasks).mapInArrow(read, bag.SCHEMA)
