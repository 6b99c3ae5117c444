"""What the query modules share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import micros, table

Query = Callable[[SparkSession, str], DataFrame]
SECOND = 1_000_000
HOUR = 3600 * SECOND
DAY = 24 * HOUR


def events(spark: SparkSession, sf: str) -> DataFrame:
    """(event_id, t, user_id, event_type, value), t in microseconds."""
    return table(spark, sf, "events").select("event_id", micros("ts").alias("t"), "user_id", "event_type", "value")


def shard_lists(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """(dataset, shard_id, size) and (dataset, weight): nations are datasets, their customers shards, of a
    row an order and one more."""
    orders = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("shard_id")).agg(F.count("*").alias("n"))
    own = table(spark, sf, "customer").select(F.col("c_nationkey").alias("dataset"), F.col("c_custkey").alias("shard_id"))
    own = own.join(orders, "shard_id", "left").select("dataset", "shard_id", (1 + F.coalesce("n", F.lit(0))).alias("size"))
    return own, table(spark, sf, "nation").select(F.col("n_nationkey").alias("dataset"), (F.col("n_regionkey") + 1).alias("weight"))


#: The same in SQL.
SHARD_LISTS = """own AS (SELECT c_nationkey AS dataset, c_custkey AS shard_id, 1 + count(o_orderkey) AS size FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY ALL),
    weights AS (SELECT n_nationkey AS dataset, n_regionkey + 1 AS weight FROM nation)"""

#: Events in SQL.
EVENTS = "SELECT event_id, epoch_us(ts) AS t, user_id, event_type, value FROM events"


def stream(df: DataFrame, kind: str) -> DataFrame:
    return df.where(F.col("event_type") == kind)


def r6(x: str | Column) -> Column:
    return F.round(F.col(x) if isinstance(x, str) else x, 6)


def registry() -> tuple[dict[str, Query], dict[str, str], Callable]:
    queries: dict[str, Query] = {}
    oracle: dict[str, str] = {}

    def query(sql: str | None = None, name: str | None = None):
        def add(f: Query) -> Query:
            queries[name or f.__name__] = f
            if sql:
                oracle[name or f.__name__] = sql
            return f

        return add

    return queries, oracle, query


def digest_sql(seed: str, *keys: str, digits: int = 15) -> str:
    """shards.digest_number in SQL."""
    text = " || ':' || ".join([f"'{seed}'", *[f"CAST({k} AS VARCHAR)" for k in keys]])
    return f"CAST('0x' || substr(md5({text}), 1, {digits}) AS BIGINT)"


def permuted_sql(source: str, index: str, n: str, key: str, name: str, rounds: int) -> str:
    """shards.permuted in SQL: tables, one a turn, that end in `name` with the place as column x."""

    def scrambled(x: str, turn: int) -> str:
        h = f"(({x}) * 73244475 + {turn * 40503} & 2147483647)"
        return f"(xor({h}, {h} >> 15) * 46557901 & 2147483647)"

    tables, last = [], f"(SELECT *, CAST({index} AS BIGINT) AS x FROM {source})"
    for turn in range(rounds):
        y = f"(SELECT *, (({scrambled(key, turn)} - x) % {n} + {n}) % {n} AS y FROM {last})"
        own = name if turn == rounds - 1 else f"{name}{turn}"
        swaps = f"({scrambled(f'{key} + greatest(x, y)', turn + rounds)} >> 16) & 1 = 1"
        tables.append(f"{own} AS MATERIALIZED (SELECT * EXCLUDE (x, y), CASE WHEN {swaps} THEN y ELSE x END AS x FROM {y})")
        last = own
    return ", ".join(tables)
