"""Sharding by fixed virtual slots, with DataFrame functions only.

A record is hashed to one of thousands of virtual slots by its text, so equal texts share a slot.
Bytes are added up per slot, and a versioned map sends each slot to a shard; rebalancing edits that
map and moves whole slots. A slot heavier than the share of a shard (a group of copies with a third
of all rows, say) is first cut into parts by the rows' place in the table. Maps lie in the shared folder under the name of
what they shard, one folder a version; a later run reads the last version, and writes a next one only
where slots move.

Defined cases: a null text has no bytes and size 1; rows without an id, or that repeat one id and text, are
spread like others; repeated rows are placed as rows, each with its own position; an empty table gives an empty
result; further columns are ignored. Positions are gapless from 0 in each shard.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..session import shared_dir
from .common import Scratch

N_SLOTS = 4096
#: Rows, about, that are numbered together: a cell of a shard.
CELL_ROWS = 50_000


def records(docs: DataFrame, n_slots: int = N_SLOTS, n_cells: int = 1024) -> DataFrame:
    """The narrow columns that placing a row needs; the text is read here only."""
    key = F.xxhash64("text")
    place = F.monotonically_increasing_id()
    return docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        F.pmod(key, F.lit(n_slots)).cast("int").alias("slot"),
        F.xxhash64(place, F.lit(7)).alias("spread"),
        F.pmod(F.xxhash64(place, F.lit(13)), F.lit(n_cells)).cast("int").alias("cell"),
    )


def slot_loads(rows: DataFrame, n_shards: int) -> DataFrame:
    """(slot, part, parts, bytes): slots cut into parts of a quarter of a shard's fair share where
    they exceed that share. At most n_slots + 4 * n_shards rows."""
    sums = rows.groupBy("slot").agg(F.sum("size").alias("load"))
    fair = F.sum("load").over(W.partitionBy()) / n_shards
    sums = sums.withColumn("parts", F.when(F.col("load") > fair, F.ceil(F.col("load") * 4 / fair)).otherwise(F.lit(1)).cast("int"))
    cut = rows.join(F.broadcast(sums.select("slot", "parts")), "slot")
    part = F.pmod("spread", F.col("parts")).cast("int")
    return cut.groupBy("slot", part.alias("part"), "parts").agg(F.sum("size").alias("load"))


def balanced_map(loads: DataFrame, n_shards: int, version: int = 1) -> DataFrame:
    """The slot-to-shard map (version, slot, part, parts, load, shard): heaviest slot first, each to
    the lightest shard. The slots are a bounded array and one fold over it keeps the shards' loads."""
    item = F.struct((-F.col("load")).alias("order"), "slot", "part", "parts", "load")
    start = F.struct(
        F.array_repeat(F.lit(0).cast("long"), n_shards).alias("held"),
        F.array().cast("array<int>").alias("to"),
    )

    def put(acc, x):
        at = F.array_position(acc["held"], F.array_min(acc["held"])).cast("int")
        held = F.transform(acc["held"], lambda v, i: F.when(i + 1 == at, v + x["load"]).otherwise(v))
        return F.struct(held.alias("held"), F.concat(acc["to"], F.array(at - 1)).alias("to"))

    one = loads.groupBy().agg(F.array_sort(F.collect_list(item)).alias("slots"))
    one = one.withColumn("to", F.aggregate("slots", start, put, lambda acc: acc["to"]))
    pair = one.select(F.explode(F.arrays_zip("slots", "to")).alias("x"))
    return pair.select(F.lit(version).alias("version"), *[F.col(f"x.slots.{c}").alias(c) for c in ("slot", "part", "parts", "load")], F.col("x.to").alias("shard"))


def rebalanced_map(held: DataFrame, loads: DataFrame, n_shards: int, tolerance: float = 0.05) -> DataFrame:
    """The next version of a stored map for new loads or more shards. Slots stay unless their shard
    is over its fair share by more than `tolerance`; of those shards the lightest slots leave, in
    order, until it is not, and each goes to the lightest shard. Slots new to the map do so too."""
    now = loads.join(F.broadcast(held.select("slot", "part", "parts", "shard")), ["slot", "part", "parts"], "left")
    fair = F.sum("load").over(W.partitionBy()) / n_shards
    kept = F.sum("load").over(W.partitionBy("shard").orderBy(F.desc("load"), "slot", "part").rowsBetween(W.unboundedPreceding, 0))
    now = now.withColumn("stays", F.col("shard").isNotNull() & (F.col("shard") < n_shards) & (kept <= fair * (1 + tolerance)))
    item = F.struct((~F.col("stays")).alias("moves"), (-F.col("load")).alias("order"), "slot", "part", "parts", "load", "shard")
    start = F.struct(F.array_repeat(F.lit(0).cast("long"), n_shards).alias("held"), F.array().cast("array<int>").alias("to"))

    def put(acc, x):
        light = F.array_position(acc["held"], F.array_min(acc["held"])).cast("int") - 1
        at = F.when(x["moves"], light).otherwise(x["shard"])
        held_now = F.transform(acc["held"], lambda v, i: F.when(i == at, v + x["load"]).otherwise(v))
        return F.struct(held_now.alias("held"), F.concat(acc["to"], F.array(at)).alias("to"))

    one = now.groupBy().agg(F.array_sort(F.collect_list(item)).alias("slots"))
    one = one.withColumn("to", F.aggregate("slots", start, put, lambda acc: acc["to"]))
    pair = one.select(F.explode(F.arrays_zip("slots", "to")).alias("x"))
    version = held.agg((F.coalesce(F.max("version"), F.lit(0)) + 1).alias("version"))
    out = pair.select(*[F.col(f"x.slots.{c}").alias(c) for c in ("slot", "part", "parts", "load")], F.col("x.to").alias("shard"))
    return out.join(F.broadcast(version)).select("version", "slot", "part", "parts", "load", "shard")


def place(rows: DataFrame, slot_map: DataFrame) -> DataFrame:
    """Each row with its shard; the map has a bounded number of slots and is broadcast."""
    sizes = slot_map.groupBy("slot").agg(F.max("parts").alias("parts"))
    rows = rows.join(F.broadcast(sizes), "slot")
    rows = rows.withColumn("part", F.pmod("spread", F.col("parts")).cast("int"))
    return rows.join(F.broadcast(slot_map.select("slot", "part", "shard", "version")), ["slot", "part"])


def numbered(placed: DataFrame) -> DataFrame:
    """Adds `position`, gapless from 0 in each shard. Rows are counted by cell, cells get offsets by
    a prefix sum over a bounded table, and rows are numbered within their cell."""
    counts = placed.groupBy("shard", "cell").agg(F.count("*").alias("n"))
    before = F.sum("n").over(W.partitionBy("shard").orderBy("cell").rowsBetween(W.unboundedPreceding, -1))
    offsets = counts.select("shard", "cell", F.coalesce(before, F.lit(0)).alias("before"))
    within = F.row_number().over(W.partitionBy("shard", "cell").orderBy("doc_id", "size", "text_crc32")) - 1
    return placed.withColumn("within", within).join(F.broadcast(offsets), ["shard", "cell"]).withColumn("position", (F.col("before") + F.col("within")).cast("long"))


def map_versions(spark: SparkSession, path: str) -> list[int]:
    """The versions of a stored map, none if there is no such map."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not fs.exists(folder):
        return []
    whole = [f"{path}/version={x.getPath().getName().removeprefix('version=')}" for x in fs.listStatus(folder) if x.getPath().getName().startswith("version=")]
    return sorted(int(p.rsplit("=", 1)[1]) for p in whole if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{p}/_SUCCESS")))


def claimed(spark: SparkSession, path: str, version: int) -> int:
    """The first version from `version` on that no other run writes: its claim is a file made only once."""
    while True:
        claim = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/claim-{version}")
        if claim.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).createNewFile(claim):
            return version
        version += 1


def read_map(spark: SparkSession, path: str, version: int) -> DataFrame:
    return spark.read.schema(MAP).parquet(f"{path}/version={version}")


MAP = "version int, slot int, part int, parts int, load long, shard int"


def current_map(spark: SparkSession, loads: DataFrame, n_shards: int, path: str) -> DataFrame:
    """The stored map for these loads: the first version where there is none, else the last one, which
    a next version follows if slots have to move."""
    versions = map_versions(spark, path)
    columns = [c.split()[0] for c in MAP.split(", ")]
    if not versions:
        now, version = balanced_map(loads, n_shards), 1
    else:
        held = read_map(spark, path, versions[-1])
        place = ["slot", "part", "parts", "shard"]
        now, version = rebalanced_map(held, loads, n_shards, 0.01), versions[-1] + 1
        if now.select(*place).exceptAll(held.select(*place)).isEmpty():
            return held
    version = claimed(spark, path, version)
    now = now.withColumn("version", F.lit(version))
    now.select(*columns).coalesce(1).write.mode("overwrite").parquet(f"{path}/version={version}")
    return read_map(spark, path, version)


def shard_documents(spark: SparkSession, docs: DataFrame, n_shards: int = 8, n_slots: int = N_SLOTS, name: str | None = None) -> DataFrame:
    """Rows (doc_id, size, text_crc32, shard, position, virtual_slot, part, version). The map is kept
    under `name` in the shared folder, or with this run's tables where none is given."""
    scratch = Scratch(spark, "sharding", docs)
    n_cells = max(64, docs.count() // (n_shards * CELL_ROWS))
    rows = scratch.keep(records(docs, n_slots, n_cells), "records")
    path = f"{shared_dir(spark)}/slot-maps/{name}" if name else f"{scratch.root}/slot-map"
    slot_map = current_map(spark, scratch.keep(slot_loads(rows, n_shards), "loads", rows=0), n_shards, path)
    out = numbered(place(rows, slot_map))
    return scratch.finish(out.select("doc_id", "size", "text_crc32", "shard", "position", F.col("slot").alias("virtual_slot"), "part", "version"))
