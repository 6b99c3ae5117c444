"""Ordered operators: differences, smoothing, runs, chunks, replay."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..operators import asof, sequences, statistics
from ..session import table
from .common import DAY, EVENTS, HOUR, SECOND, events, r6, registry, stream

QUERIES, ORACLE_SQL, query = registry()
BY = ["user_id"]
E = f"WITH e AS ({EVENTS})"


@query(E + """, f AS (SELECT *, sum(CASE WHEN value > 20 THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY t, event_id ROWS UNBOUNDED PRECEDING) AS run FROM e),
    c AS (SELECT user_id, run, count_if(value > 20) AS n FROM f GROUP BY ALL) SELECT user_id, max(n) AS longest FROM c GROUP BY user_id""")
def max_consecutive_run(spark, sf):
    return sequences.longest_run(events(spark, sf), BY, ["t", "event_id"], F.col("value") > 20)


SPEED = E + f""", s AS (SELECT *, t - lag(t) OVER w AS dt, abs(value - lag(value) OVER w) AS d FROM e WINDOW w AS (PARTITION BY user_id ORDER BY t)),
    b AS (SELECT user_id FROM s GROUP BY user_id HAVING count_if(dt <= 0) = 0),
    v AS (SELECT s.user_id, event_id, event_type, t, t - dt / 2 AS t_mid, d / (dt / {HOUR}::DOUBLE) AS speed FROM s JOIN b USING (user_id) WHERE dt IS NOT NULL)"""


def speeds(spark, sf):
    return sequences.speed(events(spark, sf), BY, "t", "value", float(HOUR))


@query(SPEED + f"""SELECT user_id, event_id, round(speed, 6) AS speed, round(avg(speed) OVER (PARTITION BY user_id ORDER BY CAST(floor(t_mid) AS BIGINT)
        RANGE BETWEEN {DAY} PRECEDING AND {DAY} FOLLOWING), 6) AS mean FROM v""")
def speed_windowed_mean(spark, sf):
    rows = speeds(spark, sf).withColumn("m", F.floor("t_mid").cast("long"))
    return sequences.windowed_mean(rows, BY, "m", "speed", 2 * DAY).select("user_id", "event_id", r6("speed").alias("speed"), r6("mean").alias("mean"))


@query(SPEED + f""", m AS (SELECT *, CAST(floor(t_mid) AS BIGINT) AS x, avg(speed) OVER (PARTITION BY user_id ORDER BY CAST(floor(t_mid) AS BIGINT)
        RANGE BETWEEN {12 * HOUR} PRECEDING AND {12 * HOUR} FOLLOWING) AS mean FROM v),
    r AS (SELECT user_id, event_type, min(t) AS lo, max(t) AS hi FROM e GROUP BY ALL), w AS (SELECT user_id, max(lo) AS start, min(hi) AS stop FROM r GROUP BY user_id),
    a AS (SELECT user_id, min(x) AS a, max(x) AS b FROM m WHERE mean >= 30 GROUP BY user_id), j AS (SELECT *, greatest(a, start) AS s, least(b, stop) AS f FROM a JOIN w USING (user_id))
    SELECT user_id, s AS active_start, f AS active_stop, greatest(s - {HOUR}, start) AS padded_start, least(f + {HOUR}, stop) AS padded_stop FROM j WHERE s < f""")
def activity_interval(spark, sf):
    v = speeds(spark, sf).withColumn("stream", F.lit("all"))
    ranges = asof.common_window(events(spark, sf), BY, "event_type")
    return sequences.activity_interval(v, ranges, BY, 30.0, DAY, HOUR)


@query(E + """, m AS (SELECT user_id, event_id, avg(value) OVER (PARTITION BY user_id ORDER BY t, event_id ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) AS mean,
        row_number() OVER (PARTITION BY user_id ORDER BY t, event_id) AS i, count(*) OVER (PARTITION BY user_id) AS n FROM e)
    SELECT user_id, event_id, round(mean, 6) AS mean FROM m WHERE i <= greatest(1, n - 4)""")
def sliding_mean_valid(spark, sf):
    out = sequences.sliding_mean_valid(events(spark, sf), BY, ["t", "event_id"], "value", 5)
    return out.select("user_id", "event_id", r6("mean").alias("mean"))


@query(E + """, g AS (SELECT user_id, event_id, value, lag(value) OVER w AS a, lead(value) OVER w AS b FROM e WINDOW w AS (PARTITION BY user_id ORDER BY t, event_id))
    SELECT user_id, event_id, round(CASE WHEN a IS NULL THEN b - value WHEN b IS NULL THEN value - a ELSE (b - a) / 2 END, 6) AS gradient FROM g""")
def gradient(spark, sf):
    out = sequences.gradient(events(spark, sf), BY, ["t", "event_id"], "value")
    return out.select("user_id", "event_id", r6("gradient").alias("gradient"))


@query(f"""WITH RECURSIVE s AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY epoch_us(ts), event_id) AS n FROM events),
    r AS (SELECT user_id, n, value AS y FROM s WHERE n = 1 UNION ALL
          SELECT s.user_id, s.n, r.y * 0.7::DOUBLE + s.value * 0.3::DOUBLE FROM r JOIN s ON s.user_id = r.user_id AND s.n = r.n + 1)
    SELECT user_id, n, round(y, 6) AS ema FROM r""")
def ema(spark, sf):
    return sequences.ema(events(spark, sf), BY, ["t", "event_id"], "value", 0.3).select("user_id", "n", r6("ema").alias("ema"))


@query(E + """, a AS (SELECT user_id, event_id, t, value % (2 * pi()) - pi() AS angle FROM e),
    d AS (SELECT *, angle - lag(angle) OVER (PARTITION BY user_id ORDER BY t, event_id) AS d FROM a),
    k AS (SELECT *, CASE WHEN abs(d) > pi() THEN -floor((d + pi()) / (2 * pi())) ELSE 0 END AS turns FROM d)
    SELECT user_id, event_id, round(angle + 2 * pi() * sum(turns) OVER (PARTITION BY user_id ORDER BY t, event_id ROWS UNBOUNDED PRECEDING), 6) AS unwrapped FROM k""")
def phase_unwrap(spark, sf):
    rows = events(spark, sf).withColumn("angle", F.col("value") % (2 * F.pi()) - F.pi())
    out = sequences.unwrapped(rows, BY, ["t", "event_id"], "angle")
    return out.select("user_id", "event_id", r6("unwrapped").alias("unwrapped"))


@query("""WITH q AS (SELECT vec_id, label, embedding[1:4]::DOUBLE[] AS q FROM embeddings),
    d AS (SELECT *, list_dot_product(q, lag(q) OVER (PARTITION BY label ORDER BY vec_id)) AS d FROM q),
    s AS (SELECT *, 1 - 2 * (sum(CASE WHEN d < 0 THEN 1 ELSE 0 END) OVER (PARTITION BY label ORDER BY vec_id ROWS UNBOUNDED PRECEDING) % 2) AS s FROM d)
    SELECT vec_id, label, round(q[1] * s, 6) AS x, round(q[2] * s, 6) AS y, round(q[3] * s, 6) AS z, round(q[4] * s, 6) AS w FROM s""")
def sign_continuity(spark, sf):
    rows = table(spark, sf, "embeddings").select("vec_id", "label", F.slice("embedding", 1, 4).alias("q"))
    out = sequences.sign_continuous(rows, ["label"], ["vec_id"], "q")
    return out.select("vec_id", "label", *[r6(F.get("continuous", F.lit(i))).alias(c) for i, c in enumerate("xyzw")])


@query(E + """, h AS (SELECT user_id, event_id, value, lag(value, 1) OVER w AS a, lag(value, 3) OVER w AS b, first_value(value) OVER w AS f FROM e
        WINDOW w AS (PARTITION BY user_id ORDER BY t, event_id))
    SELECT user_id, event_id, coalesce(b, f) AS minus_3, coalesce(a, f) AS minus_1, value AS now FROM h""")
def observation_history(spark, sf):
    out = sequences.history(events(spark, sf), BY, ["t", "event_id"], "value", [-3, -1, 0])
    return out.select("user_id", "event_id", *[F.get("history", F.lit(i)).alias(c) for i, c in enumerate(("minus_3", "minus_1", "now"))])


STEP = E + ", f AS (SELECT user_id, value, event_id, row_number() OVER (PARTITION BY user_id ORDER BY t, event_id) - 1 AS step, count(*) OVER (PARTITION BY user_id) AS n FROM e)"


def steps(spark, sf):
    i = (F.row_number().over(W.partitionBy("user_id").orderBy("t", "event_id")) - 1).cast("long")
    return events(spark, sf).withColumn("step", i)


@query(STEP + """SELECT b.user_id, b.step, d.delta, v.value FROM f b, (SELECT unnest([-4, 0, 3]) AS delta) d
    JOIN f v ON v.user_id = b.user_id AND v.step = greatest(0, least(b.n - 1, b.step + d.delta))""")
def delta_gather_clamp(spark, sf):
    return sequences.delta_gather(steps(spark, sf), BY, "step", "value", [-4, 0, 3])


@query(STEP + """SELECT b.user_id, b.step, d.delta, v.value FROM f b, (SELECT unnest([-2, 0]) AS delta) d
    JOIN f v ON v.user_id = b.user_id AND v.step = CASE WHEN b.step + d.delta < 0 THEN b.step + d.delta + b.n ELSE b.step + d.delta END""")
def delta_gather_wrap(spark, sf):
    return sequences.delta_gather(steps(spark, sf), BY, "step", "value", [-2, 0], boundary="wrap")


CHUNK = STEP + """, c AS (SELECT b.user_id, b.step, k.k, v.value FROM f b, (SELECT unnest(range(0, 8)) AS k) k
    JOIN f v ON v.user_id = b.user_id AND v.step = least(b.n - 1, b.step + k.k)), z AS (SELECT *, first_value(value) OVER (PARTITION BY user_id, step ORDER BY k) AS ref,
    lag(value) OVER (PARTITION BY user_id, step ORDER BY k) AS before FROM c)"""


def chunked(spark, sf):
    rows = steps(spark, sf).withColumn("v", F.array("value"))
    return sequences.chunks(rows, BY, ["t", "event_id"], "v", 8)


def unpacked(df, chunk, name):
    rows = df.select("user_id", "step", F.posexplode(chunk).alias("k", "x"))
    return rows.select("user_id", "step", F.col("k").cast("long").alias("k"), r6(F.get("x", F.lit(0))).alias(name))


@query(CHUNK + "SELECT user_id, step, k, round(value, 6) AS value FROM z")
def action_chunk(spark, sf):
    return unpacked(chunked(spark, sf), "chunk", "value")


@query(CHUNK + "SELECT user_id, step, k, round(value, 6) AS value FROM z WHERE step % 4 = 0")
def action_chunk_replay(spark, sf):
    rows = steps(spark, sf).withColumn("v", F.array("value"))
    return unpacked(sequences.chunks(rows, BY, ["t", "event_id"], "v", 8, every=4), "chunk", "value")


@query(CHUNK + "SELECT user_id, step, k, round(value - ref, 6) AS value FROM z")
def relative_chunk(spark, sf):
    return unpacked(chunked(spark, sf), sequences.relative_chunk("chunk"), "value")


@query(CHUNK + "SELECT user_id, step, k, round(value - coalesce(before, value), 6) AS value FROM z")
def delta_chunk(spark, sf):
    return unpacked(chunked(spark, sf), sequences.delta_chunk("chunk"), "value")


@query(CHUNK + "SELECT user_id, step, k, round(value, 6) AS value FROM z")
def absolute_chunk(spark, sf):
    back = sequences.absolute_chunk(sequences.relative_chunk("chunk"), F.get("chunk", F.lit(0)))
    return unpacked(chunked(spark, sf), back, "value")


@query(CHUNK + """SELECT k AS step, 0 AS dim, count(*) AS n, round(avg(value - ref), 5) AS mean, round(stddev_pop(value - ref), 5) AS std, round(min(value - ref), 6) AS min,
    round(max(value - ref), 6) AS max, round(quantile_cont(value - ref, 0.01), 6) AS q01, round(quantile_cont(value - ref, 0.99), 6) AS q99 FROM z WHERE step + 8 <= (SELECT max(n) FROM f WHERE f.user_id = z.user_id) GROUP BY k""")
def relative_stats(spark, sf):
    rows = steps(spark, sf).withColumn("v", F.array("value"))
    whole = sequences.chunks(rows, BY, ["t", "event_id"], "v", 8, pad=False).where(F.size("chunk") == 8)
    s = statistics.chunk_stats(whole.select(sequences.relative_chunk("chunk").alias("c")), "c", exact=True)
    return s.select(F.col("step").cast("long").alias("step"), "dim", "n", F.round("mean", 5).alias("mean"), F.round("std", 5).alias("std"), *[r6(c).alias(c) for c in ("min", "max", "q01", "q99")])


@query(STEP + "SELECT user_id, 2 + unnest(range(0, greatest(0, max(n) - 2 - 1 - 8 + 1))) AS step FROM f GROUP BY user_id")
def step_windows(spark, sf):
    n = events(spark, sf).groupBy("user_id").agg(F.count("*").alias("n"))
    from ..operators.shards import step_windows as windows

    return windows(n, BY, "n", 8, 2, 1)


@query(E + """, d AS (SELECT user_id, event_id, t, event_type = 'purchase' AS done FROM e),
    k AS (SELECT *, coalesce(lag(done::INT) OVER (PARTITION BY user_id ORDER BY t, event_id), 0) AS b FROM d),
    x AS (SELECT k.*, value, event_type, sum(b) OVER (PARTITION BY user_id ORDER BY k.t, k.event_id ROWS UNBOUNDED PRECEDING) AS episode FROM k JOIN (SELECT event_id, value, event_type FROM e) USING (event_id))
    SELECT user_id, CAST(episode AS BIGINT) AS episode, bool_or(done) AS success, round(sum(value), 6) AS reward, count(*) AS steps, arg_max(value, t) AS progress, max(value) AS best,
           bool_and(event_type <> 'error') AS valid FROM x GROUP BY ALL""")
def rollout_success(spark, sf):
    rows = events(spark, sf).withColumn("done", F.col("event_type") == "purchase").withColumn("ok", F.col("event_type") != "error")
    ep = sequences.done_episodes(rows, BY, ["t", "event_id"], "done")
    out = statistics.rollouts(ep, ["user_id", "episode"], "t", "done", "value", "value", "value", "ok")
    return out.withColumn("reward", r6("reward"))


@query(E + """, s AS (SELECT user_id, t, event_id, value, abs(value - lag(value) OVER (PARTITION BY user_id ORDER BY t)) AS d,
        row_number() OVER (PARTITION BY user_id ORDER BY t) - 1 AS pos, count(*) OVER (PARTITION BY user_id) AS n FROM e WHERE event_type = 'view'),
    k AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY t) AS i, count(*) OVER (PARTITION BY user_id) AS m,
          avg(greatest(d / 10, value / 60)) OVER (PARTITION BY user_id ORDER BY t ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING) AS mean FROM s WHERE d IS NOT NULL),
    h AS (SELECT user_id, min(pos) AS a, max(pos) + 3 AS b FROM k WHERE i <= greatest(1, m - 2) AND mean > 1 GROUP BY user_id),
    z AS (SELECT user_id, max(n) AS n FROM s GROUP BY user_id)
    SELECT user_id, CASE WHEN a IS NOT NULL AND least(b, n) - a >= 3 THEN a ELSE 0 END AS start, CASE WHEN a IS NOT NULL AND least(b, n) - a >= 3 THEN least(b, n) ELSE n END AS stop
    FROM z LEFT JOIN h USING (user_id)""")
def motion_window(spark, sf):
    rows = stream(events(spark, sf), "view")
    w = W.partitionBy("user_id").orderBy("t")
    d = F.abs(F.col("value") - F.lag("value").over(w))
    rows = rows.withColumn("d", d).withColumn("v", F.when(F.col("d").isNotNull(), F.col("value")))
    return sequences.motion_window(rows, BY, "t", {"d": 10.0, "v": 60.0}, 3, minimum=3)
