"""Vector columns: statistics, normalisation, layout, rotations, and evaluation reductions."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions import rotations as R
from ..functions import vectors as V
from ..operators import statistics as S
from ..session import table
from .common import EVENTS, events, r6, registry

QUERIES, ORACLE_SQL, query = registry()

LONG = "SELECT vec_id, label, generate_subscripts(embedding, 1) - 1 AS dim, unnest(embedding)::DOUBLE AS x FROM embeddings"
STATS = f"""WITH v AS ({LONG}), s AS (SELECT dim, count(*) AS n, avg(x) AS mean, stddev_pop(x) AS std, min(x) AS min, max(x) AS max,
        quantile_cont(x, 0.01) AS q01, quantile_cont(x, 0.99) AS q99 FROM v GROUP BY dim)"""


def vectors(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", "label", V.doubles("embedding").alias("v"))


def with_stats(spark, sf):
    rows = vectors(spark, sf)
    return rows.join(F.broadcast(S.as_vectors(S.vector_stats(rows, "v", exact=True))))  # one row of statistics


def exploded(df, column, digits=6):
    return df.select("vec_id", F.posexplode(column).alias("dim", "x")).select("vec_id", F.col("dim").cast("long").alias("dim"), F.round("x", digits).alias("x"))


@query(STATS + "SELECT dim, n, round(mean, 5) AS mean, round(std, 5) AS std, round(min, 6) AS min, round(max, 6) AS max, round(q01, 6) AS q01, round(q99, 6) AS q99 FROM s")
def vector_stats(spark, sf):
    s = S.vector_stats(vectors(spark, sf), "v", exact=True)
    return s.select(F.col("dim").cast("long").alias("dim"), "n", F.round("mean", 5).alias("mean"), F.round("std", 5).alias("std"), *[r6(c).alias(c) for c in ("min", "max", "q01", "q99")])


@query(f"""WITH v AS ({LONG}), s AS (SELECT label, dim, count(*) AS n, avg(x) AS mean, stddev_pop(x) AS std, min(x) AS min, max(x) AS max,
        quantile_cont(x, 0.01) AS q01, quantile_cont(x, 0.99) AS q99 FROM v GROUP BY ALL)
    SELECT dim, round(sum(n * mean) / sum(n), 5) AS mean, round(sqrt(greatest(0, sum(n * (std * std + mean * mean)) / sum(n) - power(sum(n * mean) / sum(n), 2))), 5) AS std,
           round(min(min), 6) AS min, round(max(max), 6) AS max, round(min(q01), 6) AS q01, round(max(q99), 6) AS q99 FROM s GROUP BY dim""")
def stats_merge_weighted(spark, sf):
    out = S.merged_stats(S.vector_stats(vectors(spark, sf), "v", ["label"], exact=True), "n", ["dim"])
    return out.select(F.col("dim").cast("long").alias("dim"), F.round("mean", 5).alias("mean"), F.round("std", 5).alias("std"), *[r6(c).alias(c) for c in ("min", "max", "q01", "q99")])


@query(STATS + """SELECT g.name AS "group", dim - g.a AS dim, round(mean, 5) AS mean, round(max, 6) AS max FROM s, (VALUES ('arm', 0, 7), ('hand', 7, 27)) g(name, a, b) WHERE dim >= a AND dim < b""")
def stats_slices(spark, sf):
    out = S.sliced_stats(S.vector_stats(vectors(spark, sf), "v", exact=True), {"arm": (0, 7), "hand": (7, 27)})
    return out.select("group", F.col("dim").cast("long").alias("dim"), F.round("mean", 5).alias("mean"), r6("max").alias("max"))


@query(STATS + """SELECT vec_id, dim, round(CASE WHEN abs(max - min) <= 1e-8 + 1e-5 * abs(min) THEN 0 ELSE 2 * (x - min) / (max - min) - 1 END, 6) AS x FROM v JOIN s USING (dim)""")
def minmax_normalize(spark, sf):
    return exploded(with_stats(spark, sf), V.min_max("v", "min", "max"))


@query(STATS + "SELECT vec_id, dim, round(x, 6) AS x FROM v JOIN s USING (dim)")
def minmax_round_trip(spark, sf):
    return exploded(with_stats(spark, sf), V.min_max_back(V.min_max("v", "min", "max"), "min", "max"))


@query(STATS + "SELECT vec_id, dim, round(CASE WHEN std = 0 THEN x ELSE (x - mean) / std END, 5) AS x FROM v JOIN s USING (dim)")
def meanstd_normalize(spark, sf):
    return exploded(with_stats(spark, sf), V.mean_std("v", "mean", "std"), 5)


@query(STATS + "SELECT vec_id, dim, round(x, 6) AS x FROM v JOIN s USING (dim)")
def meanstd_round_trip(spark, sf):
    return exploded(with_stats(spark, sf), V.mean_std_back(V.mean_std("v", "mean", "std"), "mean", "std"))


@query(STATS + "SELECT vec_id, dim, round(greatest(-1, least(1, 2 * (x - q01) / (q99 - q01) - 1)), 6) AS x FROM v JOIN s USING (dim)")
def percentile_normalize_clip(spark, sf):
    return exploded(with_stats(spark, sf), V.state_group("v", {"min": "q01", "max": "q99"}, "min_max"))


@query(f"WITH v AS ({LONG}) SELECT vec_id, dim, round(sin(x), 6) AS x FROM v UNION ALL SELECT vec_id, dim + 64, round(cos(x), 6) AS x FROM v")
def sincos(spark, sf):
    return exploded(vectors(spark, sf), V.sin_cos("v"))


@query("""SELECT vec_id, generate_subscripts(e, 1) - 1 AS dim, round(unnest(e), 6) AS x FROM (SELECT vec_id, list_concat(embedding[11:15], embedding[1:3])::DOUBLE[] AS e FROM embeddings)""")
def vector_slice_concat(spark, sf):
    return exploded(vectors(spark, sf), V.joined(V.part("v", 10, 15), V.part("v", 0, 3)))


@query("""SELECT vec_id, generate_subscripts(e, 1) - 1 AS dim, round(unnest(e), 6) AS x FROM (SELECT vec_id, [embedding[8], embedding[1], embedding[64]]::DOUBLE[] AS e FROM embeddings)""")
def column_gather(spark, sf):
    return exploded(vectors(spark, sf), V.gather("v", [7, 0, 63]))


@query("""SELECT vec_id, generate_subscripts(e, 1) - 1 AS dim, round(unnest(e), 6) AS x FROM (SELECT vec_id, [embedding[3], embedding[1], embedding[2]]::DOUBLE[] AS e FROM embeddings)""")
def named_reorder(spark, sf):
    names = F.array(*[F.lit(n) for n in ("a", "b", "c")])
    return exploded(vectors(spark, sf), V.reordered(names, V.part("v", 0, 3), ["c", "a", "b"]))


@query(f"""WITH v AS ({LONG}) SELECT d.vec_id, d.dim, round(coalesce(x, 0), 6) AS x, CASE WHEN x IS NULL THEN 0 ELSE 1 END AS mask
    FROM (SELECT vec_id, unnest(range(0, 80)) AS dim FROM embeddings) d LEFT JOIN v ON v.vec_id = d.vec_id AND v.dim = d.dim""")
def pad_and_mask(spark, sf):
    both = F.arrays_zip(V.padded("v", 80).alias("x"), V.pad_mask("v", 80).alias("mask"))
    rows = vectors(spark, sf).select("vec_id", F.posexplode(both).alias("dim", "z"))
    return rows.select("vec_id", F.col("dim").cast("long").alias("dim"), r6("z.x").alias("x"), F.col("z.mask").alias("mask"))


@query("""SELECT vec_id, round(list_cosine_similarity(embedding::DOUBLE[], lag(embedding::DOUBLE[]) OVER (PARTITION BY label ORDER BY vec_id)), 6) AS cosine FROM embeddings""")
def cosine_similarity(spark, sf):
    rows = vectors(spark, sf).withColumn("p", F.lag("v").over(W.partitionBy("label").orderBy("vec_id")))
    return rows.select("vec_id", r6(V.cosine("v", "p")).alias("cosine"))


@query("""WITH p AS (SELECT vec_id, label, embedding::DOUBLE[] AS a, lag(embedding::DOUBLE[]) OVER (PARTITION BY label ORDER BY vec_id) AS b FROM embeddings),
    u AS (SELECT label, unnest(a) - unnest(b) AS d FROM p WHERE b IS NOT NULL), m AS (SELECT label, avg(d * d) AS mse, avg(abs(d)) AS mae FROM u GROUP BY label)
    SELECT round(avg(mse), 6) AS mse, round(avg(mae), 6) AS mae, count(*) AS n FROM m""")
def mse_mae(spark, sf):
    rows = vectors(spark, sf).withColumn("p", F.lag("v").over(W.partitionBy("label").orderBy("vec_id"))).where("p is not null")
    return S.mean_errors(S.errors(rows, "v", "p", ["label"])).select(r6("mse").alias("mse"), r6("mae").alias("mae"), "n")


@query("""SELECT l_returnflag, round(sum(power(l_quantity - 25, 2) * m) / (sum(m) + 1e-6), 6) AS mse
    FROM (SELECT *, CASE WHEN l_discount > 0.05 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS m FROM lineitem) GROUP BY l_returnflag""")
def masked_mse(spark, sf):
    rows = table(spark, sf, "lineitem").withColumn("m", F.when(F.col("l_discount") > 0.05, 1.0).otherwise(0.0))
    return rows.groupBy("l_returnflag").agg(r6(S.masked_mean(F.pow(F.col("l_quantity") - 25, 2), F.col("m"))).alias("mse"))


TOKENS = f"""WITH e AS ({EVENTS}), k AS (SELECT user_id, event_id, CASE WHEN event_type = 'error' THEN -100 ELSE event_id % 5 END AS label, (event_id * 7) % 5 AS pred FROM e),
    n AS (SELECT user_id, pred, lead(label) OVER (PARTITION BY user_id ORDER BY event_id) AS nxt FROM k)"""


@query(TOKENS + "SELECT user_id, count(*) AS n, count_if(pred = nxt) AS correct FROM n WHERE nxt IS NOT NULL AND nxt <> -100 GROUP BY user_id")
def token_accuracy(spark, sf):
    rows = events(spark, sf).withColumn("label", F.when(F.col("event_type") == "error", F.lit(-100).cast("long")).otherwise(F.col("event_id") % 5)).withColumn("pred", (F.col("event_id") * 7) % 5)
    return S.token_accuracy(rows, ["user_id"], ["event_id"], "pred", "label")


@query(f"WITH e AS ({EVENTS}) SELECT event_type, round(max(value), 6) AS max, round(min(value), 6) AS min, round(avg(value), 6) AS mean, round(sum(value), 4) AS sum FROM e GROUP BY event_type")
def reward_aggregates(spark, sf):
    aggs = [F.round(S.reward_over(m, "value"), 4 if m == "sum" else 6).alias(m) for m in ("max", "min", "mean", "sum")]
    return events(spark, sf).groupBy("event_type").agg(*aggs)


@query(f"""WITH e AS ({EVENTS}), d AS (SELECT user_id, t - lag(t) OVER (PARTITION BY user_id ORDER BY t) AS dt FROM e),
    f AS (SELECT user_id, coalesce(1000000.0::DOUBLE / quantile_cont(CASE WHEN dt > 0 THEN dt END, 0.5), 30) AS fps FROM d GROUP BY user_id) SELECT user_id, round(fps, 9) AS fps FROM f""")
def median_fps(spark, sf):
    return S.median_fps(events(spark, sf), ["user_id"], "t", 1_000_000.0).select("user_id", F.round("fps", 9).alias("fps"))


Q = "SELECT vec_id, label, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y, embedding[3]::DOUBLE AS z, embedding[4]::DOUBLE AS w FROM embeddings"
UNIT = f"""WITH q AS ({Q}), n AS (SELECT *, sqrt(x*x + y*y + z*z + w*w) AS n FROM q),
    u AS (SELECT vec_id, label, x / n AS x, y / n AS y, z / n AS z, w / n AS w FROM n)"""


def quats(spark, sf):
    rows = vectors(spark, sf).select("vec_id", "label", F.col("v").alias("full"), R.quat_unit(V.part("v", 0, 4)).alias("q"))
    return rows


def columns(df, column, names, keep=("vec_id",)):
    return df.select(*keep, *[r6(F.get(column, F.lit(i))).alias(c) for i, c in enumerate(names)])


@query(UNIT + """SELECT vec_id, round(1 - 2*(y*y + z*z), 6) AS a, round(2*(x*y - z*w), 6) AS b, round(2*(x*z + y*w), 6) AS c,
    round(2*(x*y + z*w), 6) AS d, round(1 - 2*(x*x + z*z), 6) AS e, round(2*(y*z - x*w), 6) AS f FROM u""")
def quat_to_rot6d(spark, sf):
    return columns(quats(spark, sf), R.quat_rot6d("q"), "abcdef")


@query(UNIT + """SELECT vec_id, round(x * k, 6) AS x, round(y * k, 6) AS y, round(z * k, 6) AS z FROM (SELECT *, 2 * atan2(sqrt(x*x + y*y + z*z), w) / sqrt(x*x + y*y + z*z) AS k FROM u)""")
def quat_to_rotvec(spark, sf):
    return columns(quats(spark, sf), R.quat_rotvec("q"), "xyz")


@query(UNIT + """, p AS (SELECT vec_id, x, y, z, w, lag(x) OVER o AS a, lag(y) OVER o AS b, lag(z) OVER o AS c, lag(w) OVER o AS d FROM u WINDOW o AS (PARTITION BY label ORDER BY vec_id)),
    t AS (SELECT *, a*x + b*y + c*z + d*w AS dt FROM p WHERE a IS NOT NULL), s AS (SELECT *, CASE WHEN dt < 0 THEN -1 ELSE 1 END AS g, acos(least(1, abs(dt))) AS th, abs(dt) > 0.9995 AS lin FROM t),
    k AS (SELECT *, CASE WHEN lin THEN 0.75 ELSE sin(0.75 * th) / sin(th) END AS ka, CASE WHEN lin THEN 0.25 ELSE sin(0.25 * th) / sin(th) END * g AS kb FROM s),
    r AS (SELECT vec_id, a*ka + x*kb AS x, b*ka + y*kb AS y, c*ka + z*kb AS z, d*ka + w*kb AS w FROM k)
    SELECT vec_id, round(x/sqrt(x*x+y*y+z*z+w*w), 6) AS x, round(y/sqrt(x*x+y*y+z*z+w*w), 6) AS y, round(z/sqrt(x*x+y*y+z*z+w*w), 6) AS z, round(w/sqrt(x*x+y*y+z*z+w*w), 6) AS w FROM r""")
def quat_slerp(spark, sf):
    rows = quats(spark, sf).withColumn("p", F.lag("q").over(W.partitionBy("label").orderBy("vec_id"))).where("p is not null")
    return columns(rows, R.slerp("p", "q", F.lit(0.25)), "xyzw")


@query(f"""WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings), a AS (SELECT vec_id, e[1] AS a, e[2] AS b, e[3] AS c, e[4] AS d, e[5] AS f, e[6] AS g FROM e),
    n AS (SELECT vec_id, a/sqrt(a*a+b*b+c*c) AS a, b/sqrt(a*a+b*b+c*c) AS b, c/sqrt(a*a+b*b+c*c) AS c, d, f, g FROM a),
    o AS (SELECT vec_id, a, b, c, d - a*(a*d+b*f+c*g) AS d, f - b*(a*d+b*f+c*g) AS f, g - c*(a*d+b*f+c*g) AS g FROM n),
    m AS (SELECT vec_id, a, b, c, d/sqrt(d*d+f*f+g*g) AS d, f/sqrt(d*d+f*f+g*g) AS f, g/sqrt(d*d+f*f+g*g) AS g FROM o)
    SELECT vec_id, round(a,6) AS a, round(b,6) AS b, round(c,6) AS c, round(d,6) AS d, round(f,6) AS f, round(g,6) AS g, round(b*g-c*f,6) AS h, round(c*d-a*g,6) AS i, round(a*f-b*d,6) AS j FROM m""")
def rot6d_to_matrix(spark, sf):
    return columns(vectors(spark, sf), R.rot6d_matrix(V.part("v", 0, 6)), "abcdfghij")


@query("SELECT vec_id, round(embedding[1]::DOUBLE, 5) AS x, round(embedding[2]::DOUBLE, 5) AS y, round(embedding[3]::DOUBLE, 5) AS z FROM embeddings")
def relative_pose_round_trip(spark, sf):
    """A pose relative to another and back again."""
    ref = F.concat(V.part("v", 20, 23), V.part("v", 30, 36))
    back = R.absolute_flat(R.relative_flat(V.part("v", 0, 9), ref, "xyz_rot6d"), ref, "xyz_rot6d")
    return vectors(spark, sf).select("vec_id", *[F.round(F.get(back, F.lit(i)), 5).alias(c) for i, c in enumerate("xyz")])
