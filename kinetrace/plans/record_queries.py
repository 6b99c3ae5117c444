"""Scalars, messages, metadata, checks, stores and streams as queries: what reads, writes and judges
episodes around the time joins. Catalogues of a few rows are made on the driver, as in use."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions import rotations as R
from ..functions import scalars
from ..functions import vectors as V
from ..operators import audit, etl, processors, records, shards
from ..operators.ordering import numbered
from ..session import shared_dir, staged, table
from ..sources import config, episodes, mp4, sides, video
from ..streaming import live
from . import legacy
from .common import EVENTS, events, r6, registry, shard_lists, stream

QUERIES, ORACLE_SQL, query = registry()
E = f"WITH e AS ({EVENTS})"
#: Events as messages: header times of zero or none, rows numbered per user.
M = E + """, m AS (SELECT *, CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 5 = 0 THEN 0 ELSE t - 11 END AS header,
    row_number() OVER (PARTITION BY user_id ORDER BY t, event_id) - 1 AS seq FROM e)"""


def messages(spark, sf):
    header = F.when(F.col("event_id") % 7 == 0, None).when(F.col("event_id") % 5 == 0, 0).otherwise(F.col("t") - 11)
    seq = (F.row_number().over(W.partitionBy("user_id").orderBy("t", "event_id")) - 1).cast("long")
    return events(spark, sf).withColumn("header", header).withColumn("seq", seq)


def joined(c):
    return F.array_join(F.transform(c, lambda x: x.cast("string")), ",")


# Scalars and messages


@query("SELECT l_orderkey, l_linenumber, l_orderkey * 1000000000 + l_linenumber AS ns FROM lineitem")
def stamp_decode(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", scalars.stamp_ns("l_orderkey", "l_linenumber").alias("ns"))


@query(M + "SELECT event_id, coalesce(nullif(header, 0), t) AS chosen, t AS forced FROM m")
def chosen_time(spark, sf):
    return messages(spark, sf).select("event_id", scalars.chosen_time("header", "t").alias("chosen"), scalars.chosen_time("header", "t", "bag").alias("forced"))


@query(M + "SELECT event_id, CASE WHEN event_id % 3 = 1 THEN value WHEN event_id % 3 = 2 THEN value + 1 ELSE -1 END AS position FROM m")
def joint_fields(spark, sf):
    """The first of several fields that a message has."""
    rows = events(spark, sf).select("event_id", *[F.when(F.col("event_id") % 3 == k, F.col("value") + k - 1).alias(n) for k, n in ((1, "position"), (2, "positions"))], F.lit(-1.0).alias("q"))
    return rows.select("event_id", scalars.first_field("position", "positions", "q").alias("position"))


@query("SELECT event_id, least(value / 10, (event_id % 300 - 0.5) / 30) AS clamped, CAST(round_even(value / 10 * 30, 0) AS BIGINT) AS frame FROM events")
def video_clamp(spark, sf):
    e = table(spark, sf, "events").withColumn("n", F.col("event_id") % 300).withColumn("s", F.col("value") / 10)
    return e.select("event_id", scalars.clamp_to_video("s", "n", 30.0).alias("clamped"), scalars.frame_at("s", 30.0).alias("frame"))


@query("SELECT c_custkey, printf('episode_%06d', c_custkey) AS file, CAST(regexp_extract(c_name, '(\\d+)$', 1) AS BIGINT) AS number, row_number() OVER (ORDER BY CAST(regexp_extract(c_name, '(\\d+)$', 1) AS BIGINT) DESC) AS place FROM customer")
def roster_order(spark, sf):
    """Names by the number they end in, not by their letters."""
    rows = table(spark, sf, "customer").select("c_custkey", scalars.episode_file("c_custkey").alias("file"), scalars.trailing_number("c_name").alias("number"))
    return numbered(rows, [F.desc("number")], "before").select("c_custkey", "file", "number", (F.col("before") + 1).alias("place"))


@query("SELECT c_custkey, CASE lower(c_mktsegment) WHEN 'furniture' THEN 'gr_f' WHEN 'building' THEN 'gr_b' WHEN 'gr_x' THEN 'gr_x' END AS tag, split_part(c_name, '#', 1) || '/' AS env, split_part(c_name || '/pick', '/', 1) AS prefix FROM customer")
def enum_resolve(spark, sf):
    c = table(spark, sf, "customer")
    tag = scalars.resolve("c_mktsegment", {"Furniture": "gr_f", "BUILDING": "gr_b", "other": "gr_x"})
    return c.select("c_custkey", tag.alias("tag"), F.concat(F.split_part("c_name", F.lit("#"), F.lit(1)), F.lit("/")).alias("env"), scalars.env_prefix(F.concat("c_name", F.lit("/pick"))).alias("prefix"))


@query(M + """SELECT user_id, count(*) AS n, count(CASE WHEN value > 150 THEN 1 END) AS n_non_finite, count(CASE WHEN event_id % 50 = 0 AND seq > 0 AND f <> 'b' OR event_id % 50 <> 0 AND f = 'b' THEN 1 END) AS n_name_change,
        count(CASE WHEN event_type <> 'view' THEN 1 END) AS n_type_mismatch
    FROM (SELECT *, CASE WHEN first_value(event_id) OVER (PARTITION BY user_id ORDER BY seq) % 50 = 0 THEN 'b' ELSE 'a' END AS f FROM m) GROUP BY user_id""")
def payload_checks(spark, sf):
    """Non-finite values, joint names that change from the first message, wrong message types."""
    rows = messages(spark, sf)
    v = F.array(F.when(F.col("value") > 150, float("inf")).otherwise(F.col("value")), F.lit(0.0))
    names = F.when(F.col("event_id") % 50 == 0, F.array(F.lit("j1"), F.lit("j3"))).otherwise(F.array(F.lit("j1"), F.lit("j2")))
    rows = rows.select("user_id", "seq", v.alias("v"), names.alias("names"), F.col("event_type").alias("message_type"))
    out = audit.payload_faults(rows, ["user_id"], "seq", "v", "names", "view")
    return out.join(rows.groupBy("user_id").agg(F.count("*").alias("n")), "user_id").select("user_id", "n", "n_non_finite", "n_name_change", "n_type_mismatch")


@query(M + """SELECT user_id, count(CASE WHEN h <> f THEN 1 END) AS n_changed, min(CASE WHEN h <> f THEN seq END) AS first_changed
    FROM (SELECT *, first_value(h) OVER (PARTITION BY user_id ORDER BY seq) AS f FROM (SELECT *, CAST(floor(value / 100) AS INT) AS h FROM m)) GROUP BY user_id""")
def image_format_changes(spark, sf):
    rows = messages(spark, sf).select("user_id", "seq", F.floor(F.col("value") / 100).alias("height"), F.lit("jpeg").alias("format"))
    return audit.format_changes(rows, ["user_id"], "seq", ["height", "format"])


@query(E + "SELECT event_id, sqrt(power(value / 200, 2) + 0.16) BETWEEN 0.5 AND 1.5 AS valid FROM e")
def quaternion_valid(spark, sf):
    q = F.array(F.lit(0.0), F.lit(0.4), F.lit(0.0), F.col("value") / 200)
    return events(spark, sf).select("event_id", R.quat_valid(q).alias("valid"))


@query(E + "SELECT event_type, count(*) AS n FROM e WHERE event_type IN ('view', 'click', 'none') GROUP BY event_type")
def topic_filter(spark, sf):
    wanted = spark.createDataFrame([(x,) for x in ("view", "click", "none")], "event_type string")
    return events(spark, sf).join(wanted, "event_type", "left_semi").groupBy("event_type").agg(F.count("*").alias("n"))


@query("SELECT c_nationkey, count(*) AS n FROM customer WHERE c_nationkey IN (SELECT DISTINCT c_nationkey FROM customer WHERE c_nationkey IN (1, 3, 4, 9, 12) ORDER BY 1 LIMIT 3) GROUP BY c_nationkey")
def episode_selection(spark, sf):
    """Three at most of the episodes asked for, in order."""
    frames = table(spark, sf, "customer").select(F.col("c_nationkey").cast("long").alias("k"))
    known = [r.k for r in frames.where(F.col("k").isin(1, 3, 4, 9, 12)).distinct().collect()]  # five ids
    out = etl.selected_episodes(frames, known, 3, by="k").groupBy("k").agg(F.count("*").alias("n"))
    return out.select(F.col("k").cast("int").alias("c_nationkey"), "n")


# Layout


@query("SELECT r_name AS name, CAST(coalesce(sum(n) OVER (ORDER BY r_name ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start, CAST(sum(n) OVER (ORDER BY r_name) AS BIGINT) AS stop FROM (SELECT r_name, count(*) AS n FROM region JOIN nation ON r_regionkey = n_regionkey GROUP BY r_name)")
def feature_ranges(spark, sf):
    """Ranges of groups laid one after the other; regions stand for groups, nations for dimensions."""
    sizes = table(spark, sf, "region").join(table(spark, sf, "nation"), F.col("r_regionkey") == F.col("n_regionkey")).groupBy("r_name").agg(F.count("*").alias("n"))
    got = V.ranges({r.r_name: r.n for r in sizes.orderBy("r_name").collect()})  # a modality's groups
    return spark.createDataFrame([(n, a, b) for n, (a, b) in got.items()], "name string, start long, stop long")


@query("SELECT conv_id, count(*) AS n, string_agg(role, ',' ORDER BY turn) AS roles, string_agg(CAST(turn AS VARCHAR), ',' ORDER BY turn) AS turns FROM conversations GROUP BY conv_id")
def records_to_columns(spark, sf):
    """Lists of records as lists per field, and back."""
    c = table(spark, sf, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role"))).alias("r"))
    c = c.select("conv_id", *records.columns_of("r", ["turn", "role"]))
    c = c.withColumn("back", records.records_of({"turn": "turn", "role": "role"}))
    return c.select("conv_id", F.size("back").cast("long").alias("n"), joined("role").alias("roles"), joined(F.transform("back", lambda x: x["turn"])).alias("turns"))


@query("""WITH s AS (SELECT vec_id, k, embedding[1 + k * 16:16 + k * 16]::DOUBLE[] AS v FROM embeddings, (SELECT unnest(range(0, 3)) AS k)) 
    SELECT vec_id, k AS step, round(list_sum(v[1:7]), 5) AS arm, round(list_sum(v[8:13]), 5) AS hand, round(list_sum(v[14:16]), 5) AS base FROM s WHERE k < 2""")
def decode_action(spark, sf):
    """Flat chunks of three steps, cut to two steps and to three groups."""
    chunk = F.array(*[V.part(V.doubles("embedding"), k * 16, k * 16 + 16) for k in range(3)])
    rows = table(spark, sf, "embeddings").select("vec_id", chunk.alias("c"))
    rows = rows.select("vec_id", *V.decoded_groups("c", {"arm": 7, "hand": 6, "base": 3}, 2))
    total = lambda v: F.aggregate(v, F.lit(0.0), lambda a, x: a + x)
    rows = rows.select("vec_id", F.posexplode(F.arrays_zip("arm", "hand", "base")).alias("step", "x"))
    return rows.select("vec_id", F.col("step").cast("long").alias("step"), *[F.round(total(F.col(f"x.{c}")), 5).alias(c) for c in ("arm", "hand", "base")])


@query("SELECT o_orderkey AS episode_index, o_orderkey * 3 AS dataset_from_index, o_orderkey * 3 + o_custkey % 9 AS dataset_to_index, o_custkey % 9 AS length FROM orders")
def consolidated_episodes(spark, sf):
    o = table(spark, sf, "orders")
    meta = o.select(F.col("o_orderkey").alias("episode_index"), (F.col("o_orderkey") * 3).alias("dataset_from_index"), (F.col("o_orderkey") * 3 + F.col("o_custkey") % 9).alias("dataset_to_index"), F.lit(0).alias("data/chunk_index"), F.lit(0).alias("meta/x"), F.lit(1.0).alias("stats/a/mean"), F.lit("v").alias("videos/k/file"))
    return etl.consolidated_episodes(meta)


@query("SELECT o_orderkey AS episode_index, feature, stat, round(value, 6) AS value FROM (SELECT o_orderkey, 'a/b' AS feature, 'mean' AS stat, o_totalprice AS value FROM orders UNION ALL SELECT o_orderkey, 'c', 'max', o_totalprice * 2 FROM orders)")
def unflattened_stats(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("episode_index"), F.array("o_totalprice").alias("stats/a/b/mean"), F.array(F.col("o_totalprice") * 2).alias("stats/c/max"))
    return etl.unflattened_stats(o).select("episode_index", "feature", "stat", r6(F.get("values", F.lit(0))).alias("value"))


@query("SELECT o_custkey % 50 AS chunk, o_orderkey % 3 AS file, count(*) AS n, string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey) AS episodes FROM orders GROUP BY ALL")
def files_of_episodes(spark, sf):
    o = table(spark, sf, "orders").select((F.col("o_custkey") % 50).alias("chunk"), (F.col("o_orderkey") % 3).alias("file"), F.col("o_orderkey").alias("episode_index"))
    return etl.files_of(o).select("chunk", "file", F.size("episodes").cast("long").alias("n"), joined("episodes").alias("episodes"))


@query("SELECT conv_id, string_agg(CAST(turn AS VARCHAR), ',' ORDER BY turn) AS last_turns FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS r FROM conversations) WHERE r <= 3 GROUP BY conv_id")
def take_last_n(spark, sf):
    c = table(spark, sf, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list("turn")).alias("t"))
    return c.select("conv_id", joined(V.last_n("t", 3)).alias("last_turns"))


@query("SELECT o_orderpriority, count(*) AS n, min(place) AS lo, max(place) AS hi, CAST(sum(place) AS BIGINT) AS total FROM (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS place FROM orders) GROUP BY o_orderpriority")
def seeded_shuffle(spark, sf):
    """A seeded order is a permutation of each key's rows; SQL gives the sums that any permutation has."""
    w = W.partitionBy("o_orderpriority").orderBy(shards.seeded_order(42, "o_orderkey"), "o_orderkey")
    rows = table(spark, sf, "orders").withColumn("place", F.row_number().over(w))
    return rows.groupBy("o_orderpriority").agg(F.count("*").alias("n"), F.min("place").alias("lo"), F.max("place").alias("hi"), F.sum("place").alias("total"))


@query("SELECT k, count(*) AS n, round(sum(v), 4) AS total FROM (SELECT o_custkey % 10 AS k, o_totalprice AS v FROM orders UNION ALL SELECT c_custkey % 10, c_acctbal FROM customer) GROUP BY k")
def concat_frames(spark, sf):
    a = table(spark, sf, "orders").select((F.col("o_custkey") % 10).alias("k"), F.col("o_totalprice").alias("v"))
    b = table(spark, sf, "customer").select(F.col("c_acctbal").alias("v"), (F.col("c_custkey") % 10).alias("k"))
    return a.unionByName(b).groupBy("k").agg(F.count("*").alias("n"), F.round(F.sum("v"), 4).alias("total"))


@query("""WITH f AS (SELECT CAST(c_nationkey % 2 AS INT) AS dataset, c_nationkey AS old_episode, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS frame_index, c_mktsegment AS task, c_custkey FROM customer),
    l AS (SELECT dataset, old_episode, count(*) AS n FROM f GROUP BY ALL),
    o AS (SELECT *, row_number() OVER (ORDER BY dataset, old_episode) - 1 AS episode_index, CAST(coalesce(sum(n) OVER (ORDER BY dataset, old_episode ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start FROM l)
    SELECT c_custkey, episode_index, frame_index, start + frame_index AS index, f.task FROM f JOIN o USING (dataset, old_episode)""")
def merged_frames(spark, sf):
    """Two datasets with tasks numbered in their own ways, merged: one numbering of episodes and frames,
    tasks matched by text."""
    c = table(spark, sf, "customer")
    i = (F.row_number().over(W.partitionBy("c_nationkey").orderBy("c_custkey")) - 1).cast("long")
    rows = c.select((F.col("c_nationkey") % 2).alias("d"), F.col("c_nationkey").cast("long").alias("episode_index"), i.alias("frame_index"), F.col("c_mktsegment").alias("task"), "c_custkey")

    def dataset(k):
        own = rows.where(F.col("d") == k)
        order = F.asc("task") if k else F.desc("task")
        tasks = numbered(own.select("task").distinct(), [order], "task_index")
        frames = own.join(tasks, "task").select("episode_index", "frame_index", "task_index", "c_custkey", F.lit(0).alias("index"))
        return {"frames": frames, "tasks": tasks.select("task_index", "task"), "episodes": own.groupBy("episode_index").agg(F.count("*").alias("length"))}

    out = etl.merged([dataset(0), dataset(1)])
    return etl.with_tasks(out["frames"], out["tasks"]).select("c_custkey", "episode_index", "frame_index", "index", "task")


@query("""WITH f AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY epoch_us(ts), event_id) - 1 AS frame_index FROM events)
    SELECT user_id, event_id, frame_index FROM f WHERE frame_index < user_id % 50""")
def cut_to_length(spark, sf):
    """Frames within the nominal length of their episode."""
    i = (F.row_number().over(W.partitionBy("user_id").orderBy("t", "event_id")) - 1).cast("long")
    frames = events(spark, sf).select(F.col("user_id").alias("episode_index"), "event_id", i.alias("frame_index"))
    nominal = frames.select("episode_index").distinct().withColumn("length", F.col("episode_index") % 50)
    out = etl.cut_to_length(frames, nominal)
    return out.select(F.col("episode_index").alias("user_id"), "event_id", "frame_index")


@query("""WITH f AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY epoch_us(ts), event_id) - 1 AS frame_index FROM events)
    SELECT user_id, frame_index, CASE WHEN (frame_index + 4) % 20 < 12 AND frame_index // 20 * 20 < 1000000 THEN 'part ' || CAST((frame_index + 4) // 20 AS VARCHAR) ELSE '' END AS text FROM f""")
def subtask_choice(spark, sf):
    """Frames with the text of their interval, widened by half the horizon; none gives an empty text."""
    i = (F.row_number().over(W.partitionBy("user_id").orderBy("t", "event_id")) - 1).cast("long")
    frames = events(spark, sf).select(F.col("user_id").alias("episode_index"), i.alias("frame_index"))
    last = frames.groupBy("episode_index").agg(F.max("frame_index").alias("n"))
    k = last.select("episode_index", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") + 4) / 20))).alias("k"))
    intervals = k.select("episode_index", F.concat(F.lit("part "), F.col("k").cast("string")).alias("text"), (F.col("k") * 20).alias("start"), (F.col("k") * 20 + 8).alias("stop"))
    out = etl.subtask_text(frames, intervals, 8, 1)
    return out.select(F.col("episode_index").alias("user_id"), "frame_index", "text")


# Checks


@query(E + """, q AS (SELECT user_id, count(*) AS n, avg(abs(value - 50)) AS mean_skew, quantile_cont(abs(value - 50), 0.9) AS p90_skew, max(abs(value - 50)) AS max_skew FROM e GROUP BY user_id)
    SELECT user_id, n, round(mean_skew, 6) AS mean_skew, round(p90_skew, 6) AS p90_skew, round(max_skew, 6) AS max_skew,
           concat_ws(',', CASE WHEN max_skew > 170 THEN 'skew' END, CASE WHEN n < 30 THEN 'too_short' END, 'no_motion') AS reasons FROM q""")
def legacy_quality(spark, sf):
    """The older conversion's verdicts; without payloads nothing moves."""
    i = F.row_number().over(W.partitionBy("user_id").orderBy("t", "event_id"))
    rows = events(spark, sf).select(F.col("user_id").alias("episode"), F.col("event_type").alias("stream"), "t", i.alias("frame_index"), F.lit(None).cast("array<double>").alias("v"), (F.col("value") - 50).alias("skew"))
    out = legacy.quality(rows, 1e6, 170.0)
    return out.select(F.col("episode").alias("user_id"), "n", *[r6(c).alias(c) for c in ("mean_skew", "p90_skew", "max_skew")], F.array_join("reasons", ",").alias("reasons"))


@query(M + """SELECT user_id, count(*) AS n, concat_ws(',', CASE WHEN count(CASE WHEN event_id % 13 <> 0 THEN 1 END) <> count(*) THEN 'frame_count_mismatch' END, CASE WHEN min(value) < 0.5 THEN 'future_action_violation' END,
        CASE WHEN max(value) > 190 THEN 'non_finite_payload' END, CASE WHEN max(CASE WHEN seq = 40 THEN 1 ELSE 0 END) = 1 THEN 'output_timestamp_mismatch' END) AS reasons FROM m GROUP BY user_id""")
def aligned_checks(spark, sf):
    """Times of frames, finite values, ages that aren't negative, and one image a frame."""
    rows = messages(spark, sf)
    at = scalars.logical_time("seq", 30.0)
    rows = rows.select("user_id", F.col("seq").alias("frame_index"), F.when(F.col("seq") == 40, at + 1).otherwise(at).alias("timestamp"), F.array("value").alias("state"), F.array(F.when(F.col("value") > 190, float("nan")).otherwise(0.0)).alias("action"), F.when(F.col("value") < 0.5, -1).otherwise(5).alias("age"), F.when(F.col("event_id") % 13 != 0, "image").alias("image"))
    out = audit.aligned_checks(rows, ["user_id"], 30.0, "image")
    return out.select("user_id", "n", F.array_join("reasons", ",").alias("reasons"))


@query("""SELECT c_custkey, concat_ws(',', CASE WHEN c_custkey % 3 = 0 THEN 'chunks_size' END, CASE WHEN c_nationkey % 2 = 1 THEN 'features' END, CASE WHEN c_nationkey % 3 = 0 THEN 'modality' END) AS keys FROM customer""")
def dataset_compatibility(spark, sf):
    """Metadata of each customer's dataset against a first: chunk sizes, shapes, modalities differ, and frame
    rates, which may."""
    info = """{"codebase_version": "v2.1", "chunks_size": %d, "features": {"video": {"shape": [%d], "info": {"video.fps": %d}}}, "modality": {%s}}"""
    first = json.loads(info % (1000, 4, 30, '"a": 1'))
    pick = lambda when, a, b: F.when(when, a).otherwise(b)
    text = F.format_string(info, pick(F.col("c_custkey") % 3 == 0, 500, 1000), pick(F.col("c_nationkey") % 2 == 1, 5, 4), pick(F.col("c_custkey") % 2 == 0, 15, 30), pick(F.col("c_nationkey") % 3 == 0, F.lit(""), F.lit('"a": 1')))
    rows = table(spark, sf, "customer").select("c_custkey", text.alias("info"))
    return records.judged(rows, "info", lambda x: ",".join(etl.incompatible(first, x)), "keys").drop("info")


@query("SELECT vec_id, embedding IS NOT NULL AND vec_id % 3 <> 0 AS complete, embedding IS NOT NULL AND vec_id % 3 <> 0 AND vec_id % 2 = 0 AS chunked FROM embeddings")
def stats_validity(spark, sf):
    """Statistics a vector, some without a quantile, some of three steps where four are asked for."""
    v = F.when(F.col("vec_id") % 2 == 0, F.slice("embedding", 1, 4)).otherwise(F.slice("embedding", 1, 3))
    fields = [(F.when(F.col("vec_id") % 3 != 0, v) if k == "q01" else v).alias(k) for k in records.STATISTICS]
    rows = table(spark, sf, "embeddings").select("vec_id", F.to_json(F.struct(F.struct(*fields).alias("a"))).alias("stats"))
    rows = records.judged(rows, "stats", lambda x: records.complete_stats(x, ["a"]), "complete")
    rows = records.judged(rows, "stats", lambda x: records.complete_stats(x, ["a"], 4), "chunked")
    return rows.select("vec_id", *[F.col(c).cast("boolean").alias(c) for c in ("complete", "chunked")])


@query("SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 OR c_nationkey % 4 = 0 THEN 'error' ELSE 'language,state' END AS kept FROM customer")
def modality_checks(spark, sf):
    """A configuration a customer, some without a language key, some that look at two steps."""
    keys = F.when(F.col("c_custkey") % 5 != 0, F.array("c_mktsegment")).otherwise(F.array().cast("array<string>"))
    steps = F.when(F.col("c_nationkey") % 4 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    language = F.struct(keys.alias("modality_keys"), steps.alias("delta_indices")).alias("language")
    empty = F.create_map().cast("map<string,string>")
    rows = table(spark, sf, "customer").select("c_custkey", F.to_json(F.struct(language, empty.alias("state"), empty.alias("sound"))).alias("config"))
    return records.judged(rows, "config", lambda x: ",".join(sorted(config.check_modality(x))), "kept").drop("config")


@query("SELECT DISTINCT '/data/' || c_nationkey AS outer_path, '/data/' || c_nationkey || '/' || c_custkey AS inner_path FROM customer WHERE c_nationkey % 2 = 0")
def path_overlaps(spark, sf):
    """Folders of customers that lie in a folder of a nation; names that only begin alike do not."""
    c, n = table(spark, sf, "customer"), table(spark, sf, "nation")
    inner = c.select(F.concat(F.lit("/data/"), "c_nationkey", F.lit("/"), "c_custkey").alias("path"))
    outer = n.where("n_nationkey % 2 = 0").select(F.concat(F.lit("/data/"), "n_nationkey", F.lit("/")).alias("path"))
    return records.nested_paths(inner.union(outer), "path")


@query("""SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN c_name || '=' || c_name WHEN c_custkey % 5 = 0 THEN 'error' ELSE 'head=' || c_mktsegment || ',wrist=' || c_name END AS names FROM customer""")
def positional_join(spark, sf):
    """Configured keys against a customer's: by name, by position, or of another number."""
    id = F.col("c_custkey")
    wanted = F.when(id % 4 == 0, F.array("c_name")).otherwise(F.array(F.lit("head"), F.lit("wrist")))
    there = F.when(id % 5 == 0, F.array("c_mktsegment", "c_name", F.lit("more"))).otherwise(F.array("c_mktsegment", "c_name"))
    rows = table(spark, sf, "customer").select("c_custkey", F.to_json(F.struct(wanted.alias("wanted"), there.alias("there"))).alias("keys"))
    return records.judged(rows, "keys", lambda x: ",".join("=".join(p) for p in records.positional_names(x["wanted"], x["there"]).items()), "names").drop("keys")


@query("SELECT label, count(CASE WHEN vec_id % 5 = 0 THEN 1 END) AS n_v, count(CASE WHEN vec_id % 7 = 0 THEN 1 END) AS n_w FROM embeddings GROUP BY label")
def shape_faults(spark, sf):
    x = table(spark, sf, "embeddings").select("label", F.when(F.col("vec_id") % 5 == 0, F.slice("embedding", 1, 9)).otherwise(F.slice("embedding", 1, 10)).alias("v"), F.when(F.col("vec_id") % 7 != 0, F.slice("embedding", 1, 4)).alias("w"))
    return records.shape_faults(x, {"v": 10, "w": 4}, ["label"])


@query("SELECT vec_id // 10 AS g, count(DISTINCT vec_id % 3) AS sizes FROM embeddings WHERE vec_id // 10 % 2 = 0 GROUP BY ALL HAVING count(DISTINCT vec_id % 3) > 1")
def size_equality(spark, sf):
    """Streams whose vectors differ in size."""
    g = F.floor(F.col("vec_id") / 10)
    n = F.when(g % 2 == 0, F.col("vec_id") % 3 + 2).otherwise(2)
    x = table(spark, sf, "embeddings").select(g.alias("g"), F.slice("embedding", F.lit(1), n.cast("int")).alias("v"))
    return records.one_size(x, ["g"], "v")


@query(E + "SELECT user_id, count(*) AS n, string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY event_id) AS kept FROM e WHERE value < 100 GROUP BY user_id")
def valid_rollouts(spark, sf):
    """Lists of one rollout without its invalid episodes, all lists in lock-step."""
    packed = events(spark, sf).groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("event_id", "value"))).alias("x"))
    lists = packed.select("user_id", F.col("x.event_id").alias("ids"), F.transform("x", lambda r: r["value"] < 100).alias("ok"))
    out = records.valid_only(lists, "ok", ["ids"])
    return records.valid_only(out.withColumn("some", F.size("ids") > 0), "some").select("user_id", F.size("ok").cast("long").alias("n"), joined("ids").alias("kept"))


@query(E + """SELECT reason, count(*) AS n FROM (SELECT 'skew' AS reason FROM e WHERE value > 150 UNION ALL SELECT 'short' FROM e WHERE value > 180) GROUP BY reason""")
def report_merge(spark, sf):
    """Counts over accepted and rejected report lines, whose fields differ."""
    e = events(spark, sf)
    root = f"{shared_dir(spark)}/staged/reports-{uuid.uuid4().hex[:12]}"
    reasons = F.array_compact(F.array(F.when(F.col("value") > 150, "skew"), F.when(F.col("value") > 180, "short")))
    e.where("value <= 150").select("event_id", F.lit("PASS").alias("status")).write.json(f"{root}/accepted")
    e.where("value > 150").select("user_id", reasons.alias("reasons")).write.json(f"{root}/rejected")
    return records.merged_reports(spark, [f"{root}/accepted", f"{root}/rejected"])


@query("""WITH f AS (SELECT user_id, CAST(floor(value / 40) AS INT) AS d, row_number() OVER w - 1 AS i, count(*) OVER (PARTITION BY user_id) AS n, lead(CAST(floor(value / 40) AS INT)) OVER w AS nx FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
    p AS (SELECT DISTINCT user_id, CASE WHEN least(n - 1, 20) > 1 THEN CAST(floor(j * (n - 2)::DOUBLE / (least(n - 1, 20) - 1)) AS BIGINT) ELSE 0 END AS i FROM (SELECT DISTINCT user_id, n FROM f WHERE n > 1), (SELECT unnest(range(0, 20)) AS j) WHERE j < least(n - 1, 20))
    SELECT user_id, round(avg(CASE WHEN d = nx THEN 1.0 ELSE 0.0 END), 6) AS ratio, count(*) AS pairs FROM f JOIN p USING (user_id, i) GROUP BY user_id""")
def repeat_ratio(spark, sf):
    """Share of evenly spaced neighbours with equal payloads."""
    rows = table(spark, sf, "events").select("user_id", "event_id", F.floor(F.col("value") / 40).alias("digest"))
    out = records.sampled_repeat_ratio(rows, ["user_id"], "event_id", "digest", 20)
    return out.select("user_id", r6("ratio").alias("ratio"), "pairs")


# Rotations and actions


@query(E + "SELECT event_id, 0.6::DOUBLE AS w, CASE WHEN value > 100 THEN 0.8::DOUBLE ELSE -0.8::DOUBLE END AS x, 0.0::DOUBLE AS y FROM e")
def canonical_quaternion(spark, sf):
    """Unit quaternions with a real part that isn't negative."""
    s = F.when(F.col("value") > 100, 3.0).otherwise(-3.0)
    q = R.quat_unit_wxyz(F.array(s, F.lit(4.0), F.lit(0.0), F.lit(0.0)))
    return events(spark, sf).select("event_id", q.alias("q")).select("event_id", *[r6(F.get("q", F.lit(i)) + 0.0).alias(n) for i, n in enumerate("wxy")])


ANGLES = E + ", a AS (SELECT event_id, radians(value) AS x, radians(value / 20) AS y, radians(value / 3) AS z FROM e)"


@query(ANGLES + """SELECT event_id, round(cos(y) * cos(z), 6) AS m00, round(sin(x) * sin(y) * cos(z) - cos(x) * sin(z), 6) AS m01, round(-sin(y), 6) AS m20, round(cos(x) * cos(y), 6) AS m22,
    round(sin(y), 6) AS sine_y, round(cos(z), 6) AS cos_z FROM a""")
def euler_conversions(spark, sf):
    """Angles about fixed axes to a matrix, to a quaternion, and back to angles."""
    e = events(spark, sf).select("event_id", F.array(F.col("value"), F.col("value") / 20, F.col("value") / 3).alias("a"))
    m = e.withColumn("m", R.euler_matrix("a", "xyz"))
    m = m.withColumn("q", R.matrix_quat("m")).withColumn("m2", R.quat_matrix("q")).withColumn("back", R.matrix_euler("m2", degrees=False))
    at = lambda c, i: F.get(c, F.lit(i))
    return m.select("event_id", r6(at("m", 0)).alias("m00"), r6(at("m2", 1)).alias("m01"), r6(at("m2", 6)).alias("m20"), r6(at("m", 8)).alias("m22"), r6(F.sin(at("back", 1))).alias("sine_y"), r6(F.cos(at("back", 2))).alias("cos_z"))


@query(E + """, a AS (SELECT event_id, value, radians(value % 170) AS t FROM e)
    SELECT event_id, round(value, 6) AS px, round(cos(t), 6) AS r0, round(-sin(t), 6) AS r1, round(t, 6) AS vz, round(cos(t), 6) AS h0 FROM a""")
def pose_formats(spark, sf):
    """A pose as translation and rotation vector, to 6D rotation, to a matrix, and back."""
    t = F.radians(F.col("value") % 170)
    rows = events(spark, sf).select("event_id", F.array(F.col("value"), F.lit(0.0), F.lit(1.0), F.lit(0.0), F.lit(0.0), t).alias("v"))
    rows = rows.withColumn("six", R.converted_pose("v", "xyz_rotvec", "xyz_rot6d"))
    rows = rows.withColumn("back", R.converted_pose("six", "xyz_rot6d", "xyz_rotvec")).withColumn("h", R.converted_pose("six", "xyz_rot6d", "matrix"))
    at = lambda c, i: r6(F.get(c, F.lit(i)))
    return rows.select("event_id", at("six", 0).alias("px"), at("six", 3).alias("r0"), at("six", 4).alias("r1"), at("back", 5).alias("vz"), at("h", 0).alias("h0"))


@query(ANGLES + """SELECT event_id, 1.0::DOUBLE AS px, round(cos(y) * sin(z), 6) AS r0, round(cos(y) * cos(z), 6) AS r1, round(sin(y), 6) AS r2 FROM a""")
def euler_eef9d(spark, sf):
    """Angles about moving axes, the frame turned by a fixed matrix on the right."""
    turn = [0.0, 1.0, 0.0, -1.0, 0.0, 0.0, 0.0, 0.0, 1.0]
    xyz = F.array(F.lit(1.0), F.lit(2.0), F.lit(3.0))
    angles = F.array(F.radians("value"), F.radians(F.col("value") / 20), F.radians(F.col("value") / 3))
    rows = events(spark, sf).select("event_id", R.euler_eef9d(xyz, angles, turn, "XYZ").alias("v"))
    at = lambda i: r6(F.get("v", F.lit(i)))
    return rows.select("event_id", at(0).alias("px"), at(3).alias("r0"), at(4).alias("r1"), at(5).alias("r2"))


@query(E + """, a AS (SELECT event_id, value, k FROM e, (SELECT unnest([0, 1, 2]) AS k))
    SELECT event_id, k AS step, round(least(1, greatest(-1, 2 * (value * k / 10 - value / 20 - 0) / 30 - 1)), 6) AS a, round(least(1, greatest(-1, (k - 1.0) / 0.5)), 6) AS b, round(least(value * k / 10, greatest(value / 20, value * k / 10)), 6) AS raw FROM a
    WHERE value * k / 10 - value / 20 BETWEEN 0 AND 30 AND value > 0""")
def action_processing(spark, sf):
    """Chunks relative to a reference, normalised, clipped, and back where nothing was clipped."""
    chunk = F.transform(F.array(*[F.lit(k) for k in range(3)]), lambda k: F.array(F.col("value") * k / 10, k.cast("double")))
    ref = F.array(F.col("value") / 20, F.lit(1.0))
    lo, hi = F.array(F.lit(0.0), F.lit(-1.0)), F.array(F.lit(30.0), F.lit(1.0))
    rows = events(spark, sf).where("value > 0").select("event_id", "value", chunk.alias("c"), ref.alias("r"))
    bounds = {"min": lo, "max": hi}
    rows = rows.withColumn("n", V.action_group("c", bounds, "min_max", F.col("r")))
    rows = rows.withColumn("s", V.action_group("c", {"mean": F.array(F.lit(0.0), F.lit(0.0)), "std": F.array(F.lit(1.0), F.lit(0.5))}, "mean_std", F.col("r")))
    rows = rows.withColumn("back", V.action_group_back("n", bounds, "min_max", F.col("r")))
    out = rows.select("event_id", "value", F.posexplode(F.arrays_zip("n", "s", "back")).alias("k", "z"))
    rel = F.col("value") * F.col("k") / 10 - F.col("value") / 20
    at = lambda c, i: F.get(F.col(f"z.{c}"), F.lit(i))
    return out.where((rel >= 0) & (rel <= 30)).select("event_id", F.col("k").cast("int").alias("step"), r6(at("n", 0)).alias("a"), r6(at("s", 1)).alias("b"), r6(at("back", 0)).alias("raw"))


@query("SELECT c_custkey, c_nationkey * (1 + c_custkey % 2) + c_custkey % 7 AS dims FROM customer")
def dimension_accounting(spark, sf):
    """Elements of a customer's state, of which a group may count twice."""
    sizes = F.struct(F.col("c_nationkey").alias("arm"), (F.col("c_custkey") % 7).alias("hand"))
    twice = F.when(F.col("c_custkey") % 2 == 1, F.array(F.lit("arm"))).otherwise(F.array().cast("array<string>"))
    rows = table(spark, sf, "customer").select("c_custkey", F.to_json(F.struct(sizes.alias("sizes"), twice.alias("twice"))).alias("state"))
    return records.judged(rows, "state", lambda x: V.dimensions(x["sizes"], x["twice"]), "dims").select("c_custkey", F.col("dims").cast("long").alias("dims"))


@query(E + "SELECT event_id, round(value * 0.5, 6) AS a, round(value * 1.5, 6) AS b FROM e")
def chunk_interpolation(spark, sf):
    """Chunks at times between their own; rows whose time doesn't rise go."""
    times = F.array(*[F.lit(x) for x in (0.0, 1.0, 1.0, 2.0)])
    chunk = F.array(*[F.array(F.col("value") * k) for k in (0, 1, 9, 2)])
    rows = events(spark, sf).select("event_id", times.alias("t"), chunk.alias("c"), F.array(F.lit(0.5), F.lit(1.5)).alias("at"))
    out = records.interpolated_chunks(rows, "t", "c", "at")
    return out.select("event_id", *[r6(F.get(F.get("interpolated", F.lit(i)), F.lit(0))).alias(n) for i, n in enumerate("ab")])


@query("SELECT vec_id, CASE WHEN CAST('0x' || substr(md5('9:' || CAST(vec_id AS VARCHAR)), 1, 8) AS BIGINT) / 4294967296.0 < 0.3 THEN 0 ELSE round(embedding[1]::DOUBLE, 6) END AS first FROM embeddings")
def state_dropout(spark, sf):
    x = table(spark, sf, "embeddings").select("vec_id", V.doubles("embedding").alias("v"))
    return x.select("vec_id", r6(F.get(shards.dropped_state("v", 0.3, 9, "vec_id"), F.lit(0)) + 0.0).alias("first"))


# Shards


@query("""WITH f AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY epoch_us(ts), event_id) - 1 AS i, value FROM events)
    SELECT (user_id + i) % 4 AS shard_id, count(*) AS n, round(sum(value), 4) AS total FROM f WHERE i % 3 = 0 GROUP BY ALL""")
def materialised_shards(spark, sf):
    """Frames dealt to the shards that an assignment names."""
    i = (F.row_number().over(W.partitionBy("user_id").orderBy("t", "event_id")) - 1).cast("long")
    frames = events(spark, sf).select(F.col("user_id").alias("episode_index"), i.alias("frame_index"), "value")
    plan = frames.where("frame_index % 3 = 0").select(((F.col("episode_index") + F.col("frame_index")) % 4).alias("shard_id"), F.col("episode_index"), F.col("frame_index").alias("step"))
    return shards.materialised(plan, frames, 4).groupBy("shard_id").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query("""WITH n AS (SELECT user_id, greatest(0, count(*) - 7) AS steps FROM events GROUP BY user_id)
    SELECT CAST(ceil(sum(steps) / 256.0) AS BIGINT) AS shards, CAST(sum(steps) AS BIGINT) AS steps, CAST(sum(steps) AS BIGINT) AS different, true AS close FROM n""")
def balanced_shard_totals(spark, sf):
    """What every balanced layout has: its number of shards, each step once, and sizes that differ by the
    largest part of an episode at most."""
    n = events(spark, sf).groupBy("user_id").agg(F.count("*").alias("n"))
    rows = staged(shards.balanced_shards(n, "user_id", "n", 8, shards.ShardOptions(shard_size=256)), "shards")
    part = n.agg(F.ceil(F.max("n") / 10).alias("part"))
    sizes = rows.groupBy("shard_id").agg(F.count("*").alias("n"))
    totals = rows.agg(F.count_distinct("shard_id").alias("shards"), F.count("*").alias("steps"), F.count_distinct("user_id", "step").alias("different"))
    close = sizes.agg((F.max("n") - F.min("n")).alias("gap")).join(part).select((F.col("gap") <= F.col("part")).alias("close"))
    return totals.join(close)


@query("SELECT count(*) AS n, count(*) AS places, true AS whole, true AS fair FROM customer JOIN nation ON c_nationkey = n_nationkey")
def mixture_schedule_totals(spark, sf):
    """A schedule gives each place once, draws from shards there are, repeats no shard of a dataset before
    its others came, and draws each dataset within five standard deviations of its share."""
    own, weights = shard_lists(spark, sf)
    length = own.count()
    rows = staged(shards.mixture_schedule(own, weights, length, seed=42), "schedule")
    times = own.join(rows, ["dataset", "shard_id"], "left").groupBy("dataset", "shard_id").agg(F.count("position").alias("k"))
    times = times.groupBy("dataset").agg((F.max("k") - F.min("k") <= 1).alias("even"), F.sum("k").alias("drawn"))
    shares = shards.dataset_shares(own, weights)
    p = (F.col("high") - F.col("low")) / F.lit(shares.agg(F.max("high")).first()[0] or 1)
    fair = F.abs(F.col("drawn") - length * p) <= 5 * F.sqrt(length * p * (1 - p)) + 1
    out = rows.agg(F.count("*").alias("n"), F.count_distinct("position").alias("places"))
    return out.join(times.join(shares, "dataset").agg(F.bool_and("even").alias("whole"), F.bool_and(fair).alias("fair")))


# Stores


def scratch(spark, name):
    return f"{shared_dir(spark)}/staged/{name}-{uuid.uuid4().hex[:12]}"


@query("SELECT c_nationkey AS episode_index, count(*) AS n, min(frame_index) AS lo, max(frame_index) AS hi, round(sum(x), 3) AS total FROM (SELECT c_nationkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS frame_index, CAST(c_acctbal AS FLOAT)::DOUBLE AS x FROM customer) WHERE c_nationkey IN (0, 2, 5, 7) GROUP BY c_nationkey")
def episode_store(spark, sf):
    """Frames written one file an episode, read back with the columns and episodes asked for."""
    i = (F.row_number().over(W.partitionBy("c_nationkey").orderBy("c_custkey")) - 1).cast("long")
    zero = F.lit(0).cast("long")
    c = table(spark, sf, "customer").withColumn("i", i)
    frames = c.select(F.array(F.col("c_acctbal").cast("float")).alias("observation.state"), F.array(F.lit(0.0).cast("float")).alias("action"), scalars.logical_time("i", 30.0).alias("timestamp"), F.col("i").alias("frame_index"), F.col("c_nationkey").cast("long").alias("episode_index"), F.col("c_custkey").alias("index"), zero.alias("task_index"), zero.alias("annotation.human.action.task_description"))
    root = scratch(spark, "store")
    episodes.write_frames(frames, root)
    back = episodes.read_frames(spark, root, ["episode_index", "frame_index", "observation.state"], [0, 2, 5, 7])
    x = F.get("`observation.state`", F.lit(0)).cast("double")
    return back.groupBy(F.col("episode_index").cast("int").alias("episode_index")).agg(F.count("*").alias("n"), F.min("frame_index").alias("lo"), F.max("frame_index").alias("hi"), F.round(F.sum(x), 3).alias("total"))


@query("SELECT o_orderkey AS episode_index, o_orderpriority AS task, o_custkey % 7 AS length, CAST(NULL AS VARCHAR) AS source_file FROM orders")
def metadata_lines(spark, sf):
    """Episodes as JSON lines and back, by the layout's schema."""
    root = scratch(spark, "meta")
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("episode_index"), F.array("o_orderpriority").alias("tasks"), (F.col("o_custkey") % 7).alias("length"))
    o.write.json(f"{root}/meta/episodes.jsonl")
    return episodes.read_episodes(spark, root).select("episode_index", F.get("tasks", F.lit(0)).alias("task"), "length", "source_file")


@query(E + """, f AS (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id, event_type ORDER BY t, event_id) - 1 AS frame, event_id FROM e)
    SELECT user_id, event_type, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids, max(frame) AS last FROM f GROUP BY ALL""")
def diagnostics_sidecar(spark, sf):
    """Per-frame diagnostics in long form, and as one JSON text per stream."""
    i = (F.row_number().over(W.partitionBy("user_id", "event_type").orderBy("t", "event_id")) - 1).cast("long")
    path = scratch(spark, "diagnostics")
    episodes.write_diagnostics(events(spark, sf).select("user_id", "event_type", i.alias("frame"), "event_id"), path)
    text = episodes.diagnostics_json(spark.read.parquet(path), ["user_id", "event_type"], "frame")
    x = F.from_json("json", "array<struct<frame:long,event_id:long>>")
    out = text.select("user_id", "event_type", x.alias("x"))
    total = F.aggregate("x", F.lit(0).cast("long"), lambda a, r: a + r["event_id"])
    return out.select("user_id", "event_type", F.size("x").cast("long").alias("n"), total.alias("ids"), F.element_at("x", -1)["frame"].alias("last"))


@query("SELECT CAST(label % 2 AS INT) AS dataset, CAST(label AS VARCHAR) AS trajectory, count(*) AS n, round(sum(embedding[1]::DOUBLE), 5) AS total FROM embeddings GROUP BY ALL")
def initial_actions(spark, sf):
    """A side table of initial actions, written, read, and put together per trajectory."""
    e = table(spark, sf, "embeddings")
    step = F.row_number().over(W.partitionBy("label").orderBy("vec_id")) - 1
    rows = e.select((F.col("label") % 2).cast("int").alias("dataset"), F.col("label").cast("string").alias("trajectory"), F.lit("arm").alias("action_key"), step.cast("int").alias("step"), V.part(V.doubles("embedding"), 0, 7).alias("action"))
    path = scratch(spark, "initial-actions")
    sides.write_initial_actions(rows, path)
    chunks = sides.initial_chunks(sides.read_initial_actions(spark, path))
    total = F.aggregate("actions", F.lit(0.0), lambda a, v: a + F.get(v, F.lit(0)))
    return chunks.select("dataset", "trajectory", F.size("actions").cast("long").alias("n"), F.round(total, 5).alias("total"))


# Video frames


VIDEO = E + ", f AS (SELECT CAST(user_id AS VARCHAR) AS video, row_number() OVER (PARTITION BY user_id ORDER BY t, event_id) - 1 AS frame_index, event_id FROM e)"


def frame_table(spark, sf):
    i = (F.row_number().over(W.partitionBy("user_id").orderBy("t", "event_id")) - 1).cast("long")
    return events(spark, sf).select(F.col("user_id").cast("string").alias("video"), i.alias("frame_index"), F.col("event_id").cast("string").cast("binary").alias("image"))


@query(VIDEO + "SELECT video, frame_index, CAST(event_id AS VARCHAR) AS image FROM f WHERE frame_index IN (0, 3, 17)")
def frames_by_index(spark, sf):
    frames = frame_table(spark, sf)
    asks = video.lengths(frames).select("video", F.explode(F.array(*[F.lit(k).cast("long") for k in (0, 3, 17, 1_000_000)])).alias("frame_index"))
    return video.at_indices(frames, asks).where("image is not null").select("video", "frame_index", F.col("image").cast("string").alias("image"))


@query(VIDEO + """, n AS (SELECT video, count(*) AS n FROM f GROUP BY video), a AS (SELECT video, n, unnest([0.0, 0.1001, 0.15, 0.5, 1e6]) AS seconds FROM n)
    SELECT a.video, seconds, CAST(f.event_id AS VARCHAR) AS image FROM a LEFT JOIN f ON f.video = a.video AND f.frame_index = round_even(seconds * 10, 0) AND abs(seconds * 10 - round_even(seconds * 10, 0)) <= 0.01""")
def frames_by_time(spark, sf):
    """The frame nearest to a time, within a hundredth of a frame."""
    frames = frame_table(spark, sf)
    asks = video.lengths(frames).select("video", F.explode(F.array(*[F.lit(x) for x in (0.0, 0.1001, 0.15, 0.5, 1e6)])).alias("seconds"))
    return video.at_times(frames, asks, 10.0, strict=False).select("video", "seconds", F.col("image").cast("string").alias("image"))


@query(VIDEO + """, n AS (SELECT video, count(*) AS n FROM f GROUP BY video)
    SELECT video, n AS n_frames, CASE WHEN CAST(video AS BIGINT) % 4 <> 3 THEN n + CASE WHEN CAST(video AS BIGINT) % 4 = 1 THEN 1 ELSE 0 END END AS found_frames,
           CASE CAST(video AS BIGINT) % 4 WHEN 3 THEN 'missing_file' WHEN 1 THEN 'frame_count_mismatch' WHEN 2 THEN 'frame_rate_mismatch' END AS fault FROM n""")
def encoding_faults(spark, sf):
    """Probes of encoded files against the frames that were meant."""
    frames = frame_table(spark, sf)
    k = F.col("video").cast("long") % 4
    probes = video.lengths(frames).where(k != 3).select("video", (F.col("n_frames") + F.when(k == 1, 1).otherwise(0)).alias("found_frames"), F.when(k == 2, 25.0).otherwise(30.0).alias("found_fps"))
    return video.encoding_faults(probes, frames, 30.0)


@query("""WITH l AS (SELECT l_orderkey AS video, row_number() OVER w - 1 AS sample, CAST(l_quantity AS BIGINT) AS size, l_returnflag = 'R' AS asked, l_linestatus = 'O' AS gap
        FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice)),
    s AS (SELECT *, sample // 4 * 4 AS grp, sum(size + CASE WHEN gap THEN 9 ELSE 0 END) OVER (PARTITION BY video ORDER BY sample) - size AS start FROM l),
    n AS (SELECT s.* FROM s JOIN (SELECT video, grp, max(sample) AS last FROM s WHERE asked GROUP BY ALL) USING (video, grp) WHERE sample <= last),
    i AS (SELECT *, start IS DISTINCT FROM lag(start + size) OVER (PARTITION BY video ORDER BY start, sample) AS fresh FROM n),
    r AS (SELECT *, count(CASE WHEN fresh THEN 1 END) OVER (PARTITION BY video ORDER BY start, sample) AS k FROM i)
    SELECT video, CAST(min(start) AS BIGINT) AS start, CAST(max(start + size) AS BIGINT) AS stop, count(*) AS n_samples FROM r GROUP BY video, k""")
def video_byte_ranges(spark, sf):
    """Orders as videos with their lines as samples, each fourth one a sync sample and some with other data
    before them: the bytes to read for the frames of returned lines."""
    w = W.partitionBy("video").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    rows = table(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "video").withColumn("sample", (F.row_number().over(w) - 1).cast("long"))
    size = F.col("l_quantity").cast("long")
    ahead = F.when(F.col("l_linestatus") == "O", 9).otherwise(0)
    start = F.sum(size + ahead).over(W.partitionBy("video").orderBy("sample").rowsBetween(W.unboundedPreceding, 0)) - size
    group = (F.floor(F.col("sample") / 4) * 4).cast("long")
    samples = rows.select("video", "sample", F.col("sample").alias("frame_index"), group.alias("group"), start.alias("start"), size.alias("size"), (F.col("l_returnflag") == "R").alias("asked"))
    return mp4.byte_ranges(mp4.needed(samples.drop("asked"), samples.where("asked")))


@query("""WITH s AS (SELECT conv_id, turn FROM conversations), r AS (SELECT conv_id, turn, 2 AS k, 'episode_step' AS type, CAST(NULL AS VARCHAR) AS role FROM s UNION ALL
        SELECT conv_id, turn, 1, 'text', role FROM conversations UNION ALL SELECT DISTINCT conv_id, NULL, 0, 'start_of_episode', NULL FROM s UNION ALL SELECT DISTINCT conv_id, NULL, 3, 'end_of_episode', NULL FROM s)
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY k = 3, k <> 0, turn, k) - 1 AS position, type, role FROM r""")
def conversation_rows(spark, sf):
    """Episodes as typed messages: a start, texts and steps in order, an end."""
    c = table(spark, sf, "conversations")
    out = processors.conversations(c.select("conv_id", "turn"), c.select("conv_id", "turn", "role", F.col("text").alias("content")), "conv_id", "turn")
    return out.select("conv_id", F.col("position").cast("long").alias("position"), "type", "role")


# Streams: each runs over the whole table and stops when it has read it


def drained(df, mode, name):
    """The rows that a stream has written when its input ends."""
    spark = df.sparkSession
    root = scratch(spark, name)

    def keep(batch, number):
        batch.write.parquet(f"{root}/rows/batch={number}")

    df.writeStream.outputMode(mode).foreachBatch(keep).option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{root}/rows")


def event_stream(spark, sf):
    schema = table(spark, sf, "events").schema
    raw = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    return raw.select(F.col("user_id").alias("episode"), F.col("event_type").alias("stream"), F.col("event_id").alias("seq"), F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("ts")).alias("t"), "value")


@query(E + """, s AS (SELECT *, t - lag(t) OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS dt FROM e)
    SELECT user_id AS episode, event_type AS stream, count(*) AS n, min(t) AS first_t, max(t) AS last_t, count(CASE WHEN dt = 0 THEN 1 END) AS n_duplicate, count(CASE WHEN dt < 0 THEN 1 END) AS n_backward, count(CASE WHEN dt > 86400000000 THEN 1 END) AS n_large_gap FROM s GROUP BY ALL""")
def stream_running_audit(spark, sf):
    """The audit as a stream with state per episode and stream; the last update of each counts."""
    rows = drained(live.running_audit(event_stream(spark, sf).select("episode", "stream", "seq", "t"), 86_400_000_000), "update", "audit")
    last = rows.groupBy("episode", "stream").agg(F.max_by(F.struct("n", "first_t", "last_t", "n_duplicate", "n_backward", "n_large_gap"), "n").alias("x"))
    return last.select("episode", "stream", "x.*")


@query("""WITH RECURSIVE s AS (SELECT user_id, value, epoch_us(ts) AS t, row_number() OVER (PARTITION BY user_id ORDER BY epoch_us(ts)) AS n FROM events WHERE event_type = 'view'),
    r AS (SELECT user_id, n, t, value AS y FROM s WHERE n = 1 UNION ALL SELECT s.user_id, s.n, s.t, r.y * 0.8::DOUBLE + s.value * 0.2::DOUBLE FROM r JOIN s ON s.user_id = r.user_id AND s.n = r.n + 1)
    SELECT user_id AS episode, count(*) AS n, round(max_by(y, t), 5) AS last_ema, round(max(y), 5) AS top FROM r GROUP BY user_id""")
def stream_running_ema(spark, sf):
    rows = drained(live.running_ema(event_stream(spark, sf).where("stream = 'view'").select("episode", "t", "value"), 0.2), "append", "ema")
    return rows.groupBy("episode").agg(F.count("*").alias("n"), F.round(F.max_by("ema", "t"), 5).alias("last_ema"), F.round(F.max("ema"), 5).alias("top"))


@query(E + """, s AS (SELECT user_id, t, event_type, max(CASE WHEN event_type = 'click' THEN (t, value) END) OVER (PARTITION BY user_id ORDER BY t, event_type ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS held FROM e WHERE event_type IN ('click', 'view'))
    SELECT user_id AS episode, t, CASE WHEN t - held[1] <= 172800000000 THEN held[2] END AS value, t - held[1] AS age FROM s WHERE event_type = 'view'""")
def stream_bounded_hold(spark, sf):
    """Views with the last click at or before them, two days old at most."""
    e = event_stream(spark, sf).where("stream in ('click', 'view')")
    rows = e.select("episode", "t", F.when(F.col("stream") == "view", "anchor").otherwise("command").alias("kind"), "value")
    return drained(live.running_hold(rows, 172_800_000_000), "append", "hold").select("episode", "t", "value", "age")


#: The watermark after all events have been read, in microseconds: a day behind, cut to milliseconds.
MARK = "(SELECT max(epoch_us(ts)) // 1000 * 1000 - 86400000000 FROM events)"


def timed_events(spark, sf):
    return event_stream(spark, sf).select("episode", "stream", F.timestamp_micros("t").alias("ts"), "t", "value")


@query(f"""WITH w AS (SELECT epoch_us(ts) // {6 * 3_600_000_000} * {6 * 3_600_000_000} AS start, event_type AS stream, value FROM events)
    SELECT start, stream, count(*) AS n, round(sum(value), 4) AS total FROM w WHERE start + {6 * 3_600_000_000} <= {MARK} GROUP BY start, stream""")
def stream_windows(spark, sf):
    """Counts of six-hour windows as a stream, each given out once the watermark has passed its end."""
    rows = drained(live.windowed_counts(timed_events(spark, sf), "ts", ["stream"], "6 hours", late="1 day"), "append", "windows")
    return rows.select(F.unix_micros("start").alias("start"), "stream", "n", F.round("total", 4).alias("total"))


@query(f"""WITH s AS (SELECT user_id, epoch_us(ts) AS t, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER w < {12 * 3_600_000_000} THEN 0 ELSE 1 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
    k AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY t) AS session FROM s)
    SELECT user_id AS episode, min(t) AS start, max(t) + {12 * 3_600_000_000} AS "end", count(*) AS n FROM k GROUP BY user_id, session HAVING max(t) + {12 * 3_600_000_000} <= {MARK}""")
def stream_sessions(spark, sf):
    """Sessions as a stream, each given out once no event can prolong it."""
    rows = drained(live.session_counts(timed_events(spark, sf), "ts", ["episode"], "12 hours", "1 day"), "append", "sessions")
    return rows.select("episode", F.unix_micros("start").alias("start"), F.unix_micros("end").alias("end"), "n")


@query("SELECT DISTINCT user_id AS episode, event_type AS stream FROM events")
def stream_distinct(spark, sf):
    """The kinds of events of each user, each once, as a stream whose state goes with the watermark."""
    rows = live.distinct_events(timed_events(spark, sf), "ts", ["episode", "stream"], "3650 days")
    return drained(rows, "append", "distinct").select("episode", "stream")


@query(E + f""", s AS (SELECT user_id, t, event_type, max(CASE WHEN event_type = 'click' THEN (t, value) END) OVER (PARTITION BY user_id ORDER BY t, event_type ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS held FROM e WHERE event_type IN ('click', 'view'))
    SELECT user_id AS episode, t, CASE WHEN t - held[1] <= 172800000000 THEN held[2] END AS value, t - held[1] AS age FROM s WHERE event_type = 'view'
    AND t <= (SELECT max(t) // 1000 * 1000 - 86400000000 FROM e WHERE event_type IN ('click', 'view'))""")
def stream_ordered_hold(spark, sf):
    """Views with the last click at or before them, whatever order they come in within a day; those that
    the watermark hasn't passed are still held back."""
    e = event_stream(spark, sf).where("stream in ('click', 'view')")
    rows = e.select("episode", "t", F.when(F.col("stream") == "view", "anchor").otherwise("command").alias("kind"), "value")
    with live.rocksdb_state(spark):
        return drained(live.ordered_hold(rows, 172_800_000_000, "1 day"), "append", "ordered").select("episode", "t", "value", "age")
