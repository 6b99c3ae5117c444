"""Running values of a key whose rows are cut into time buckets.

Each bucket sums up its own rows and keeps one summary (its total, and its first and last row). The
summaries of a key, one row a bucket, are scanned in order, with what happens between the last row of one
bucket and the first of the next, and go back to the rows. So a key's rows are never in one task; without
`bucket` a key is one window partition.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

CELL = "__cell"


def celled(df: DataFrame, order: Sequence[str], bucket: int | float | None) -> DataFrame:
    """df with the number of each row's bucket, by the order's first column."""
    return df.withColumn(CELL, F.lit(0).cast("long") if bucket is None else F.floor(F.col(order[0]) / bucket))


def within(by: Sequence[str], order: Sequence[str]):
    """The window of a bucket of a key."""
    return W.partitionBy(*by, CELL).orderBy(*order)


def with_cells(rows: DataFrame, cells: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows with the columns of their bucket's summary; null keys are a key."""
    keys = [*by, CELL]
    right = cells.select(*[F.col(c).alias(f"__k{i}") for i, c in enumerate(keys)], *[c for c in cells.columns if c not in keys])
    same = [F.col(c).eqNullSafe(F.col(f"__k{i}")) for i, c in enumerate(keys)]
    return rows.join(right, same).drop(*[f"__k{i}" for i in range(len(keys))])


def running_total(df: DataFrame, by: Sequence[str], order: Sequence[str], amount: Callable[[Column | None], Column], name: str, bucket: int | float | None = None, edge: Sequence[str] = ()) -> DataFrame:
    """df with `name`, the sum of amounts up to and including each row. amount(before) is a row's amount
    given the struct of the `edge` columns of the row before it, which is null for a key's first row;
    without `edge` it is given nothing."""
    if bucket is None:
        w = W.partitionBy(*by).orderBy(*order)
        before = F.lag(F.struct(*edge)).over(w) if edge else None
        rows = df.withColumn("__amount", amount(before))
        return rows.withColumn(name, F.sum("__amount").over(w.rowsBetween(W.unboundedPreceding, 0))).drop("__amount")
    rows, w = celled(df, order, bucket), None
    w = within(by, order)
    if edge:
        rows = rows.withColumn("__first", F.row_number().over(w) == 1).withColumn("__before", F.lag(F.struct(*edge)).over(w))
        # What a bucket's first row adds needs the bucket before, so it waits for the scan of summaries.
        rows = rows.withColumn("__amount", F.when(F.col("__first"), F.lit(0)).otherwise(amount(F.col("__before"))))
    else:
        rows = rows.withColumn("__amount", amount(None))
    rows = rows.withColumn("__own", F.sum("__amount").over(w.rowsBetween(W.unboundedPreceding, 0)))
    at = F.struct(*order)
    ends = [F.min_by(F.struct(*edge), at).alias("__head"), F.max_by(F.struct(*edge), at).alias("__tail")] if edge else []
    cells = rows.groupBy(*by, CELL).agg(F.sum("__amount").alias("__sum"), *ends)
    scan = W.partitionBy(*by).orderBy(CELL)
    carried = F.coalesce(F.sum("__sum").over(scan.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    if edge:
        head = cells.withColumn("__last", F.lag("__tail").over(scan)).select("*", *[F.col(f"__head.{c}").alias(c) for c in edge if c not in by])
        cells = head.withColumn("__step", amount(F.col("__last")))
        carried += F.sum("__step").over(scan.rowsBetween(W.unboundedPreceding, 0))
    cells = cells.withColumn("__carried", carried).select(*by, CELL, "__carried")
    out = with_cells(rows, cells, by).withColumn(name, F.col("__own") + F.col("__carried"))
    return out.select(*[f"`{c}`" for c in df.columns if c != name], name)


def row_numbers(df: DataFrame, by: Sequence[str], order: Sequence[str], name: str, bucket: int | float | None = None) -> DataFrame:
    """df with `name`, 1, 2, 3 and so on per key."""
    if bucket is None:
        return df.withColumn(name, F.row_number().over(W.partitionBy(*by).orderBy(*order)).cast("long"))
    return running_total(df, by, order, lambda before: F.lit(1).cast("long"), name, bucket)


def previous(df: DataFrame, by: Sequence[str], order: Sequence[str], value: str, name: str, bucket: int | float | None = None) -> DataFrame:
    """df with `name`, the value of the row before of the key, or null."""
    if bucket is None:
        return df.withColumn(name, F.lag(value).over(W.partitionBy(*by).orderBy(*order)))
    rows = celled(df, order, bucket)
    w = within(by, order)
    rows = rows.withColumn("__first", F.row_number().over(w) == 1).withColumn("__lag", F.lag(value).over(w))
    cells = rows.groupBy(*by, CELL).agg(F.max_by(F.struct(value), F.struct(*order)).alias("__tail"))
    cells = cells.withColumn("__last", F.lag("__tail").over(W.partitionBy(*by).orderBy(CELL))).drop("__tail")
    out = with_cells(rows, cells, by).withColumn(name, F.when(F.col("__first"), F.col(f"__last.{value}")).otherwise(F.col("__lag")))
    return out.select(*[f"`{c}`" for c in df.columns if c != name], name)
