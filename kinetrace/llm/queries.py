"""The operators applied to their whole tables, and the SQL that says the same where SQL can."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import exact_dedup, langid, lm, minhash, packing, phrases, pieces, resampling, secrets, sharding, suffix_dedup, token_counts, topk
from .common import read_table

Query = Callable[[SparkSession, str], DataFrame]


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The map of a folder's documents is kept, and edited where a later run finds other loads."""
    name = f"documents-{hashlib.sha256(sf_dir.encode()).hexdigest()}"
    out = sharding.shard_documents(spark, read_table(spark, sf_dir, "documents"), name=name)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("position").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", "part", "version")


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(spark, read_table(spark, sf_dir, "documents"), words=2)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(spark, read_table(spark, sf_dir, "documents"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of every text, after two edits to its middle, and after two more that go on from the leaves
    which those left: one to its start, one that takes out a fifth."""
    tokenizer = token_counts.Tokenizer(spark)
    rows = token_counts.with_trees(read_table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text"), tokenizer)
    n = F.char_length(F.coalesce("text", F.lit("")))

    def edits(*each: tuple) -> Column:
        return F.array(*[F.struct(a.cast("long").alias("start"), b.cast("long").alias("stop"), F.lit(new).alias("text")) for a, b, new in each])

    middle = F.floor(n / 2)
    first = edits((middle, middle + 16, "[edited] the middle"), (middle + 5, middle + 9, ""))
    rows = rows.select("*", n.cast("long").alias("n_chars"), F.size("leaf_chars").alias("n_leaves"), F.col("n_tokens").alias("before"), first.alias("first"))
    rows = token_counts.edited(rows, tokenizer, "first", "encoded_1")
    second = edits((F.lit(0), F.lit(0), "A new start. "), (F.floor(n / 5), F.floor(2 * n / 5), " "))
    rows = rows.select("*", n.cast("long").alias("chars_1"), F.col("n_tokens").alias("tokens_1"), second.alias("second"))
    rows = token_counts.edited(rows, tokenizer, "second", "encoded_2")
    return rows.select(
        "doc_id", "n_chars", "n_leaves", F.col("before").alias("n_tokens"),
        F.col("chars_1").alias("edited_chars"), F.col("tokens_1").alias("edited_tokens"), F.col("encoded_1").alias("chars_encoded"),
        n.cast("long").alias("again_chars"), F.col("n_tokens").alias("again_tokens"), F.size("leaf_chars").alias("again_leaves"), F.col("encoded_2").alias("again_encoded"),
    )


def op5_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    found = langid.identify(spark, docs.select("doc_id", "text"), langid.fit(docs))
    return found.select("doc_id", langid.held_out_column(), "lang_pred", "score")


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = topk.top_k(spark, read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)
    return found.select("query_id", "rank", "vec_id", "score")


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(spark, read_table(spark, sf_dir, "documents"))


def op8_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_documents(spark, read_table(spark, sf_dir, "documents"), pieces.Model(spark))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(spark, read_table(spark, sf_dir, "documents"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, _ = exact_dedup.group_report(spark, read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.col("sha").alias("text_sha256"))


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resampling.resample(spark, read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank", "n_words")


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(spark, read_table(spark, sf_dir, "documents"))


def op13_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.scores(spark, read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_sharding": op1_sharding,
    "op2_minhash": op2_minhash,
    "op3_packing": op3_packing,
    "op4_token_counts": op4_token_counts,
    "op5_langid": op5_langid,
    "op6_topk": op6_topk,
    "op7_secrets": op7_secrets,
    "op8_pieces": op8_pieces,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_resampling": op11_resampling,
    "op12_phrases": op12_phrases,
    "op13_lm": op13_lm,
}

ORACLE_SQL: dict[str, str] = {
    "op6_topk": """
        WITH v AS (
            SELECT vec_id, [floor(1024 * x::DOUBLE) FOR x IN embedding] AS e
            FROM embeddings
            WHERE embedding IS NOT NULL
              AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
        ), s AS (
            SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
                   CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
        )
        SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score
        FROM s
        WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
        QUALIFY row_number() OVER w <= 10""",
    "op10_exact_dedup": """
        WITH d AS (
            SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
            FROM documents
        )
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = max(doc_id) OVER g AS kept, sha256(t) AS text_sha256
        FROM d WINDOW g AS (PARTITION BY t)""",
    "op12_phrases": r"""
        WITH d AS (
            SELECT coalesce(lang, 'und') AS lang,
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
            FROM documents
        ), p AS (
            SELECT lang, unnest(string_split_regex(t, '[.,;:!?\n-\r]')) AS piece FROM d
        ), w AS (
            SELECT lang, [x FOR x IN string_split_regex(piece, '[ \t]+') IF x <> ''] AS w FROM p
        ), totals AS (
            SELECT lang, sum(len(w)) AS n FROM w GROUP BY lang
        ), g AS (
            SELECT lang, unnest(flatten([[w[i:i + k - 1] FOR i IN range(1, len(w) - k + 2)] FOR k IN range(1, 5)])) AS g FROM w
        ), f AS (
            SELECT lang, g, count(*) AS f FROM g GROUP BY lang, g HAVING count(*) >= 30
        ), cuts AS (
            SELECT lang, g, f AS a, unnest(range(1, len(g))) AS k FROM f WHERE len(g) > 1
        ), scored AS (
            SELECT c.lang, c.g, c.a, c.k, x.f AS l, y.f AS r,
                   CAST((2000000::HUGEINT * c.a) // (x.f + y.f) AS BIGINT) AS score
            FROM cuts c
            JOIN f x ON x.lang = c.lang AND x.g = c.g[1:c.k]
            JOIN f y ON y.lang = c.lang AND y.g = c.g[c.k + 1:len(c.g)]
        ), weakest AS (
            SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1
        ), around AS (
            SELECT lang, g[i:j] AS g, max(a) AS a
            FROM (SELECT lang, g, a, unnest(range(1, len(g))) AS i FROM weakest) s, LATERAL (SELECT unnest(range(s.i + 1, len(s.g) + 1)) AS j) e
            WHERE j - i + 1 < len(g)
            GROUP BY ALL
        ), left_over AS (
            SELECT w.* FROM weakest w LEFT JOIN around o ON o.lang = w.lang AND o.g = w.g
            WHERE o.a IS NULL OR 100 * o.a::HUGEINT < 80 * w.a::HUGEINT
        )
        SELECT x.lang, row_number() OVER o AS rank, array_to_string(g, ' ') AS phrase, a, l, r, n::BIGINT AS n, score
        FROM left_over x JOIN totals USING (lang)
        WINDOW o AS (PARTITION BY x.lang ORDER BY score DESC, a DESC, array_to_string(g, ' '))
        QUALIFY row_number() OVER o <= 2000""",
}
