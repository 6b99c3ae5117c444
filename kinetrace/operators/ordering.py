"""Row numbers, running sums and order statistics over a whole table, without a task that holds it.

Rows are dealt by ranges of the order, numbered within their range, and the ranges' totals, one row each,
are added up before it. `order` should end in a column that tells rows apart, since equal rows stay in
one range.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..session import staged

#: monotonically_increasing_id: the partition above, the row's place in it below.
PLACE_BITS = 33


def numbered(df: DataFrame, order: Sequence[str | Column], number: str = "number", sums: Mapping[str, str] | None = None, ranges: int | None = None) -> DataFrame:
    """df with `number`, 0, 1, 2 and so on in the order, and for each (name, column) of `sums` the sum of
    the column over all rows before, 0 for the first. df is sorted once and kept in the shared folder; Spark
    picks the number of ranges where none is given."""
    spark, sums = df.sparkSession, dict(sums or {})
    rows = df.repartitionByRange(*([ranges] if ranges else []), *order).sortWithinPartitions(*order)
    rows = staged(rows.withColumn("__at", F.monotonically_increasing_id()), "ranges")
    part = F.shiftright("__at", PLACE_BITS)
    totals = rows.groupBy(part.alias("__part")).agg(F.count("*").alias("__n"), *[F.sum(c).alias(f"__{k}") for k, c in sums.items()])
    names = ["__n", *[f"__{k}" for k in sums]]
    before, found = [0] * len(names), []
    for row in sorted(totals.collect(), key=lambda r: r["__part"]):  # one row a range
        found.append((row["__part"], *before))
        before = [b + (row[n] or 0) for b, n in zip(before, names)]
    kinds = [f.dataType.simpleString() for f in totals.schema.fields[1:]]
    offsets = spark.createDataFrame(found, ", ".join(["__part long", *[f"{n} {k}" for n, k in zip(names, kinds)]]))
    rows = rows.withColumn("__part", part)
    own = W.partitionBy("__part").orderBy("__at").rowsBetween(W.unboundedPreceding, -1)
    for k, c in sums.items():
        rows = rows.withColumn(f"__own_{k}", F.coalesce(F.sum(c).over(own), F.lit(0)))
    rows = rows.join(F.broadcast(offsets), "__part")
    added = [(F.col(f"__{k}") + F.col(f"__own_{k}")).alias(k) for k in sums]
    place = F.col("__at").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    return rows.select(*[f"`{c}`" for c in df.columns], (F.col("__n") + place).cast("long").alias(number), *added)


def group_numbers(df: DataFrame, by: Sequence[str], order: Sequence[str | Column], number: str = "number", size: str = "size") -> DataFrame:
    """df with `number`, 0, 1, 2 and so on in the order within each group, and the group's `size`. Groups
    are cut by ranges like any rows, so one may hold all of them; null keys are a group."""
    rows = numbered(df, [*by, *order], "__all")
    groups = rows.groupBy(*[F.col(c).alias(f"__g{i}") for i, c in enumerate(by)]).agg(F.min("__all").alias("__low"), F.count("*").alias(size))
    same = [F.col(c).eqNullSafe(F.col(f"__g{i}")) for i, c in enumerate(by)]
    out = rows.join(groups, same).withColumn(number, F.col("__all") - F.col("__low"))
    return out.select(*[f"`{c}`" for c in df.columns], number, size)


def group_quantile(df: DataFrame, by: Sequence[str], value: str, q: float, name: str) -> DataFrame:
    """(by, name): the exact q-quantile of each group's values that are not null, linear between the two
    beside it."""
    rows = df.where(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias("__v"), F.monotonically_increasing_id().alias("__place"))
    rows = group_numbers(rows, by, ["__v", "__place"], "__n", "__size")
    at = F.lit(q) * (F.col("__size") - 1)
    rows = rows.where((F.col("__n") == F.floor(at)) | (F.col("__n") == F.ceil(at)))
    out = rows.groupBy(*by).agg(F.min("__v").alias("__l"), F.max("__v").alias("__r"), F.max(at - F.floor(at)).alias("__f"))
    return out.select(*by, (F.col("__l") + F.col("__f") * (F.col("__r") - F.col("__l"))).alias(name))
