"""The corpus pipeline: language ID, exact dedup, near dedup, secret redaction, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinetrace.llm import exact_dedup, langid, minhash, packing, secrets
from kinetrace.llm.common import Scratch, fresh, read_table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; texts without a letter go. Where no row is labelled there is
    nothing to tell languages by, and every text with a letter stays."""
    names = docs.columns
    model = langid.fit(docs)
    if not model.langs:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    lang, score = fresh(docs, "lang_pred"), fresh(docs, "score")
    found = langid.identify(spark, docs, model, lang, score)
    return found.where(F.col(lang) != langid.UNKNOWN).select(*[f"`{c}`" for c in names])


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id."""
    return exact_dedup.drop_duplicates(spark, docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts with a similarity of 0.8 or more on five-word shingles the row with the smallest doc_id."""
    return minhash.drop_near_duplicates(spark, docs)


def secret(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced in the texts."""
    return secrets.redact(spark, docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of each piece of each document in a bin."""
    return packing.pack(spark, docs)


STAGES = [("language", language), ("exact", exact), ("near", near), ("secrets", secret), ("packing", pack)]

#: SQL can express neither the trained stages nor packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents; each stage's rows are written to the shared folder and read again. `texts`
    names the table of the redacted texts that the bins' pieces are cut from."""
    scratch = Scratch(spark, "pipeline", read_table(spark, sf_dir, "documents"))
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch.store(stage(spark, docs, sf_dir), name)
    return docs.withColumn(fresh(docs, "texts"), F.lit(f"{scratch.root}/{STAGES[-2][0]}"))
