"""Exact deduplication by progressive refinement: length, then prefix hash, then full hash.

Texts are equal when identical after lower-casing A-Z. The row with the largest doc_id of a group
stays. Defined cases: a null text counts as empty; null ids come before all others, and a group that
has only null ids keeps its rows; rows that repeat a kept doc_id and its text all count as kept in
the report, and `drop_duplicates` leaves one of them; an empty table gives an empty result; other
columns ride along untouched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, Scratch, ascii_lower, fresh, join_groups, small

PREFIX_CHARS = 64


def fingerprints(docs: DataFrame, full: bool, prefix_chars: int = PREFIX_CHARS) -> DataFrame:
    """(doc_id, len, prefix[, sha]): lower-casing A-Z keeps the length in bytes, so length comes
    from the text as it is, and the prefix hash reads its first characters only."""
    text = F.coalesce("text", F.lit(""))
    cols = ["doc_id", F.octet_length(text).alias("len"), F.xxhash64(ascii_lower(F.substring(text, 1, prefix_chars))).alias("prefix")]
    if full:
        cols.append(F.sha2(ascii_lower(text), 256).alias("sha"))
    return docs.select(*cols)


def survivors(narrow: DataFrame) -> DataFrame:
    """(len, prefix, n_prefix) of groups that length, then length and prefix, leave with two rows or
    more. Counting by both gives the counts by length, so one shuffle with partial sums serves both."""
    both = narrow.groupBy("len", "prefix").agg(F.count("*").alias("n_prefix"))
    alike = both.groupBy("len").agg(F.sum("n_prefix").alias("n_len")).where("n_len > 1")
    return both.where("n_prefix > 1").join(alike.select("len"), "len", "left_semi")


def group_report(spark: SparkSession, docs: DataFrame, all_digests: bool = True) -> tuple[DataFrame, Scratch]:
    """(doc_id, keep_id, group_size, kept, sha): without all_digests only rows that refinement leaves,
    which alone are hashed in full; with it all rows, where the other texts are hashed for their digest
    only. Texts aren't moved.
    """
    scratch = Scratch(spark, "exact-dedup", docs)
    narrow = scratch.keep(fingerprints(docs, False), "narrow")
    total = narrow.count()
    alive = scratch.keep(survivors(narrow), "alive")
    # While the surviving keys are few they travel to the texts, and only texts with such a key are
    # hashed in full; beyond that bound every text is hashed where it is read.
    text = F.coalesce("text", F.lit(""))
    keyed = docs.select("doc_id", F.octet_length(text).alias("len"), F.xxhash64(ascii_lower(F.substring(text, 1, PREFIX_CHARS))).alias("prefix"), text.alias("body"))
    sha = F.sha2(ascii_lower(F.col("body")), 256).alias("sha")
    if alive.count() <= BROADCAST_ROWS:
        full = keyed.join(F.broadcast(alive.select("len", "prefix")), ["len", "prefix"], "left_semi").select("doc_id", "len", "prefix", sha)
    else:
        full = join_groups(keyed.select("doc_id", "len", "prefix", sha), alive, ["len", "prefix"], "n_prefix", total, "inner").drop("n_prefix")
    full = scratch.keep(full, "full")
    groups = full.groupBy("len", "prefix", "sha").agg(F.count("*").alias("group_size"), F.max("doc_id").alias("keep_id"))
    groups = scratch.keep(groups.where("group_size > 1"), "groups")
    rows = scratch.keep(fingerprints(docs, True), "digests") if all_digests else full
    out = join_groups(rows, groups, ["sha", "len", "prefix"], "group_size", total)
    size = F.coalesce("group_size", F.lit(1)).cast("long")
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    out = out.select("doc_id", keep.alias("keep_id"), size.alias("group_size"), keep.eqNullSafe(F.col("doc_id")).alias("kept"), "sha", "len")
    return scratch.finish(out), scratch


def drop_duplicates(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """docs without the rows that exact deduplication drops, all columns as they were. Up to
    BROADCAST_ROWS dropped ids travel to the texts; beyond that the join shuffles the texts once."""
    report, scratch = group_report(spark, docs, all_digests=False)
    gone, digest, mark = fresh(docs, "lost"), fresh(docs, "lost_sha"), fresh(docs, "mark")
    lost = report.where(~F.col("kept")).select(F.col("doc_id").alias(gone), F.col("sha").alias(digest)).distinct()
    lost = scratch.store(lost, "lost")
    repeats = report.where("kept and group_size > 1").groupBy("doc_id", "sha").agg(F.count("*").alias("n")).where("n > 1")
    # Dropping by id alone is right only if every row with such an id is itself dropped; unique texts are not in the report.
    lost_rows = docs.select("doc_id").join(small(lost.select(gone).distinct()), F.col(gone).eqNullSafe(F.col("doc_id")), "left_semi").count()
    clash = lost_rows != report.where(~F.col("kept")).count()
    sha = F.sha2(ascii_lower(F.coalesce("text", F.lit(""))), 256)
    if clash:  # an id that names several texts: decide by id and text
        out = docs.withColumn(mark, sha).join(small(lost), F.col(gone).eqNullSafe(F.col("doc_id")) & (F.col(mark) == F.col(digest)), "left_anti").drop(mark)
    else:
        out = docs.join(small(lost.select(gone)), F.col(gone).eqNullSafe(F.col("doc_id")), "left_anti")
    if not repeats.isEmpty():
        out = out.withColumn(mark, sha).dropDuplicates(["doc_id", mark]).drop(mark)
    return out
