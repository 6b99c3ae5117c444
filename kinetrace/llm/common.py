"""Helpers the training-data operators share: scratch tables, skew-safe joins, UTF-8 buffers."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """name, with underscores added until df has no such column."""
    while name.lower() in (c.lower() for c in df.columns):
        name += "_"
    return name


def ascii_lower(col):
    """Lower-case A-Z only; every other character stays. Texts of one byte a character take Spark's
    lower, which works on bytes and says the same there."""
    col = F.col(col) if isinstance(col, str) else col
    return F.when(F.octet_length(col) == F.char_length(col), F.lower(col)).otherwise(F.translate(col, ASCII_UPPER, ASCII_LOWER))


#: Input bytes for each file of a stored table, and the least number of files.
FILE_BYTES, MIN_FILES = 32 << 20, 12


def width_of(source: DataFrame) -> int:
    """Partitions enough for tables made from `source`, by the size its plan knows. Large inputs have
    fewer partitions than that; small ones in many partitions would give as many tiny files."""
    size = int(str(source._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return min(max(MIN_FILES, -(-size // FILE_BYTES)), 1_000_000)


#: Rows of texts that go to a Python worker at a time; both sides hold a batch outside the JVM's heap.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batches to BATCH_ROWS, for texts of several thousand bytes each."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def dense(docs: DataFrame) -> DataFrame:
    """docs with tiny partitions put together, without a shuffle, for Arrow batches of few rows."""
    small_batches(docs.sparkSession)
    return docs.coalesce(width_of(docs))


#: Pages of few rows and small row groups: Parquet's writer else looks at the size of either after 100
#: rows only, and both sides hold a page whole.
LONG_ROWS = {"parquet.page.row.count.limit": "4", "parquet.block.size": str(16 << 20), "parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "64"}


class Scratch:
    """Intermediate tables of one operator run, and its result.

    `keep` holds a table on the executors' disks, where it is computed again if an executor is lost;
    `store` writes it to the shared folder, which cuts lineage and plan, as iterations need. `source` is
    the operator's input; tables get no more partitions than its size calls for.
    """

    def __init__(self, spark: SparkSession, name: str, source: DataFrame):
        self.spark, self.root = spark, f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
        small_batches(spark)
        self.width = width_of(source)
        self.kept: dict[str, DataFrame] = {}
        self.stored: set[str] = set()

    def pack(self, df: DataFrame, rows: int | None = None) -> DataFrame:
        """df in fewer partitions, without a shuffle; `rows` is a known bound of its narrow rows."""
        return df.coalesce(self.width if rows is None else min(self.width, max(4, rows // 250_000)))

    @contextmanager
    def freeing(self) -> Iterator[None]:
        """Shuffle files of queries that run in here go when the query ends, as its rows are stored then;
        where rows are lost later Spark makes the files again."""
        key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
        before = self.spark.conf.get(key, "false")
        self.spark.conf.set(key, "true")
        try:
            yield
        finally:
            self.spark.conf.set(key, before)

    def keep(self, df: DataFrame, table: str, rows: int | None = None) -> DataFrame:
        """df, computed now and read from disk by what follows."""
        out = self.pack(df, rows).persist(StorageLevel.DISK_ONLY)
        out.count()
        self.kept[table] = out
        return out

    def drop(self, *tables: str) -> None:
        """Free tables that no later plan reads."""
        for table in tables:
            if table in self.kept:
                self.kept.pop(table).unpersist()

    def store(self, df: DataFrame, table: str, rows: int | None = None, long_rows: bool = False) -> DataFrame:
        """df as a table in the shared folder; `long_rows` says that a row may take some MB."""
        self.stored.add(table)
        with self.freeing():
            self.pack(df, rows).write.mode("overwrite").options(compression="zstd", **(LONG_ROWS if long_rows else {})).parquet(f"{self.root}/{table}")
        return self.spark.read.schema(df.schema).parquet(f"{self.root}/{table}").coalesce(self.width)

    def finish(self, df: DataFrame, table: str = "result") -> DataFrame:
        """The result as a stored table; all intermediates are freed, stored ones deleted."""
        out = self.store(df, table)
        self.drop(*list(self.kept))
        self.delete(*(self.stored - {table}))
        return out

    def delete(self, *tables: str) -> None:
        """Remove stored tables that no later plan reads."""
        jvm, conf = self.spark._jvm, self.spark._jsparkSession.sessionState().newHadoopConf()
        for table in tables:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{table}")
            path.getFileSystem(conf).delete(path, True)
            self.stored.discard(table)


#: Rows of narrow keys that may be broadcast; beyond it the same join is made by a shuffle.
BROADCAST_ROWS = 1_000_000


def small(df: DataFrame) -> DataFrame:
    """df, marked for broadcast if its counted rows stay within BROADCAST_ROWS. df is a stored table
    of a few narrow columns."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


#: A group is hot when it holds more than this share of all rows, so at most 1,000 groups are.
HOT_SHARE = 1000


def join_groups(rows: DataFrame, groups: DataFrame, keys: Sequence[str], size: str, total: int, how: str = "left") -> DataFrame:
    """Join rows to one row per group without sending a large group's rows to one task.

    groups holds a column `size`, its number of rows. Groups with over total / HOT_SHARE rows are
    HOT_SHARE at most whatever the data, so that table is broadcast; the others are small and
    joined by a shuffle. groups should be a stored table, since it is read twice.
    """
    limit = max(total // HOT_SHARE, 64)
    keys = list(keys)
    names = [c for c in groups.columns if c not in keys]
    hot = groups.where(F.col(size) > limit)
    if how == "inner":  # Spark may split a large partition of the second join, whose sides it deals itself
        cold = groups.where(F.col(size) <= limit)
        return rows.join(F.broadcast(hot), keys).unionByName(rows.join(cold, keys)).select(*rows.columns, *names)
    cold = groups.where(F.col(size) <= limit).select(*keys, *[F.col(c).alias(f"__cold_{c}") for c in names])
    first = rows.join(F.broadcast(hot), keys, "left")
    # A row that found its hot group must not be dealt by that key again.
    salt = [F.when(F.col(size).isNull(), F.col(k)).alias(f"__key_{k}") for k in keys]
    first = first.select("*", *salt).withColumn("__spread", F.when(F.col(size).isNotNull(), F.monotonically_increasing_id()).otherwise(F.lit(-1)))
    cold = cold.select(*[F.col(k).alias(f"__key_{k}") for k in keys], *[f"__cold_{c}" for c in names], F.lit(-1).cast("long").alias("__spread"))
    out = first.join(cold, [*[f"__key_{k}" for k in keys], "__spread"], "left")
    return out.select(*rows.columns, *[F.coalesce(F.col(c), F.col(f"__cold_{c}")).alias(c) for c in names])


def utf8(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """An Arrow string column as one byte array and its n+1 offsets; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_binary())
    if col.null_count:
        col = col.fill_null(b"")
    n = len(col)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = col.buffers()
    at = np.frombuffer(offsets, np.int64, n + 1, col.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def spans_of(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Runs [i, j) of rows with `limit` bytes at most, or one longer row."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
#: A random 64-bit value for each byte.
BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0, 1, ... n - 1, modulo 2 ** 64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        step = np.full(max(n, 1 << 16), base, np.uint64)
        step[0] = 1
        have = _powers[base] = np.multiply.accumulate(step)
    return have[:n]


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """Sums c with c[j] - c[i] = sum of values[k] * BASE ** k for k in [i, j)."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(BASE, len(values)), out=out[1:])
    return out


def prefix_hash(data: np.ndarray) -> np.ndarray:
    return prefix_sums(BYTE_VALUE[data])


def range_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Fingerprints of the byte ranges [start, end), the same wherever the bytes stand."""
    return mix((sums[end] - sums[start]) * powers(INVERSE, len(sums))[start])
