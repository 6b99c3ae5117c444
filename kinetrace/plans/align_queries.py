"""Time joins, gates and audits."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions.scalars import sorted_reasons, status
from ..operators import asof, audit, sequences, statistics
from ..session import table
from .common import DAY, EVENTS, HOUR, SECOND, events, r6, registry, stream

QUERIES, ORACLE_SQL, query = registry()
ANCHORS = ["event_id", "user_id", "t"]


def anchors_of(spark, sf):
    return stream(events(spark, sf), "view").select(*ANCHORS)


def commands_of(spark, sf):
    return stream(events(spark, sf), "click").select("user_id", "t", "value")


HELD = f"""
    WITH e AS ({EVENTS}), a AS (SELECT * FROM e WHERE event_type = 'view'),
    c AS (SELECT * FROM e WHERE event_type = 'click')
"""


@query(HELD + """SELECT a.event_id, a.user_id, a.t, c.t AS src_t, c.value AS src_value, a.t - c.t AS age
    FROM a ASOF LEFT JOIN c ON a.user_id = c.user_id AND a.t >= c.t""")
def asof_backward(spark, sf):
    out = asof.backward(anchors_of(spark, sf), commands_of(spark, sf), ["user_id"])
    return out.select(*ANCHORS, F.col("src.t").alias("src_t"), F.col("src.value").alias("src_value"), (F.col("t") - F.col("src.t")).alias("age"))


@query(ORACLE_SQL["asof_backward"])
def asof_backward_bucketed(spark, sf):
    """The same with each key cut into days, for keys too long for one task."""
    out = asof.backward(anchors_of(spark, sf), commands_of(spark, sf), ["user_id"], bucket=DAY)
    return out.select(*ANCHORS, F.col("src.t").alias("src_t"), F.col("src.value").alias("src_value"), (F.col("t") - F.col("src.t")).alias("age"))


@query(HELD + """, l AS (SELECT a.event_id, a.user_id, a.t, c.t AS lt, c.value AS lv FROM a ASOF LEFT JOIN c ON a.user_id = c.user_id AND a.t > c.t),
    b AS (SELECT l.*, c.t AS rt, c.value AS rv FROM l ASOF LEFT JOIN c ON l.user_id = c.user_id AND l.t <= c.t)
    SELECT event_id, user_id, t, CASE WHEN rt IS NULL OR t - lt <= rt - t THEN lt ELSE rt END AS src_t,
           CASE WHEN rt IS NULL OR t - lt <= rt - t THEN lv ELSE rv END AS src_value FROM b""")
def asof_nearest(spark, sf):
    out = asof.nearest(anchors_of(spark, sf), commands_of(spark, sf), ["user_id"])
    return out.select(*ANCHORS, F.col("src.t").alias("src_t"), F.col("src.value").alias("src_value"))


@query(HELD + """, l AS (SELECT a.event_id, a.user_id, a.t, c.t AS lt, c.value AS lv FROM a ASOF LEFT JOIN c ON a.user_id = c.user_id AND a.t > c.t),
    b AS (SELECT l.*, c.t AS rt, c.value AS rv FROM l ASOF LEFT JOIN c ON l.user_id = c.user_id AND l.t <= c.t)
    SELECT event_id, user_id, t, round(CASE WHEN rt = t THEN rv ELSE lv + (t - lt)::DOUBLE / (rt - lt)::DOUBLE * (rv - lv) END, 6) AS v,
           CASE WHEN rt = t THEN 0 ELSE rt - lt END AS gap FROM b""")
def asof_linear(spark, sf):
    out = asof.linear(anchors_of(spark, sf), commands_of(spark, sf), ["user_id"], value="value")
    return out.select(*ANCHORS, r6("value").alias("v"), "gap")


@query(HELD + f""", h AS (SELECT a.user_id, a.t - c.t AS age FROM a ASOF LEFT JOIN c ON a.user_id = c.user_id AND a.t >= c.t)
    SELECT user_id, count(*) AS n, count_if(age IS NULL) AS n_missing, count_if(age < 0) AS n_future, count_if(age > {DAY}) AS n_old,
           round(avg(age), 2) AS age_mean, round(quantile_cont(age, 0.95), 2) AS age_p95, max(age) AS age_max,
           CASE WHEN count_if(age IS NULL) > 0 THEN 'action_missing_history' WHEN count_if(age < 0) > 0 THEN 'future_action_violation'
                WHEN count_if(age > {DAY}) > 0 THEN 'action_age_exceeded' END AS reason
    FROM h GROUP BY user_id HAVING count(*) >= 5""")
def asof_age_policy(spark, sf):
    """The causal hold, its age gate, and a least number of frames."""
    out = asof.backward(anchors_of(spark, sf), commands_of(spark, sf), ["user_id"])
    gate = audit.age_gate(out, ["user_id"], F.col("t") - F.col("src.t"), DAY)
    return gate.where("n >= 5").select("user_id", "n", "n_missing", "n_future", "n_old", F.round("age_mean", 2).alias("age_mean"), F.round("age_p95", 2).alias("age_p95"), "age_max", "reason")


@query(f"""WITH e AS ({EVENTS}), s AS (SELECT user_id, event_type, min(t) AS lo, max(t) AS hi FROM e GROUP BY ALL)
    SELECT user_id, max(lo - CASE WHEN event_type = 'view' THEN {HOUR} ELSE 0 END) AS start,
           min(CASE WHEN event_type <> 'click' THEN hi + CASE WHEN event_type = 'view' THEN {HOUR} ELSE 0 END END) AS stop,
           count(*) AS n_streams FROM s GROUP BY user_id""")
def common_time_window(spark, sf):
    return asof.common_window(events(spark, sf), ["user_id"], "event_type", start_only=["click"], slack={"view": HOUR})


@query(f"""WITH e AS ({EVENTS}), s AS (SELECT user_id, event_type, min(t) AS lo, max(t) AS hi FROM e GROUP BY ALL),
    w AS (SELECT user_id, max(lo) AS a, min(hi) AS b FROM s GROUP BY user_id)
    SELECT e.event_id, e.user_id, e.t FROM e JOIN w USING (user_id) WHERE event_type = 'view' AND t BETWEEN a AND b""")
def anchors_in_window(spark, sf):
    rows = events(spark, sf)
    return asof.within(stream(rows, "view").select(*ANCHORS), asof.common_window(rows, ["user_id"], "event_type"), ["user_id"]).select(*ANCHORS)


STEPS = f"""WITH e AS ({EVENTS}), s AS (
        SELECT *, lag(t) OVER w AS prev_t, t - lag(t) OVER w AS dt FROM e WINDOW w AS (PARTITION BY user_id, event_type ORDER BY event_id)),
    m AS (SELECT user_id, event_type, quantile_cont(CASE WHEN dt > 0 THEN dt END, 0.5) AS med FROM s GROUP BY ALL)"""


@query(STEPS + f""", d AS (SELECT user_id, event_type, CAST(sum(greatest(0, round_even(dt / med, 0) - 1)) AS BIGINT) AS n_dropped
        FROM s JOIN m USING (user_id, event_type) WHERE dt > 0 GROUP BY ALL)
    SELECT s.user_id, s.event_type, count(*) AS n, min(t) AS first_t, max(t) AS last_t, round(any_value(med), 2) AS interval_median,
           round(quantile_cont(CASE WHEN dt > 0 THEN dt END, 0.95), 2) AS interval_p95, max(CASE WHEN dt > 0 THEN dt END) AS interval_max,
           count_if(t = 0) AS n_zero, count_if(dt = 0) AS n_duplicate, count_if(dt < 0) AS n_backward, count_if(dt > {DAY}) AS n_large_gap,
           arg_max(prev_t, CASE WHEN dt > 0 THEN dt END) AS largest_gap_at, coalesce(any_value(n_dropped), 0) AS n_dropped,
           round({SECOND}::DOUBLE / any_value(med), 6) AS frequency
    FROM s JOIN m USING (user_id, event_type) LEFT JOIN d USING (user_id, event_type) GROUP BY s.user_id, s.event_type""")
def stream_audit(spark, sf):
    out = audit.stream_audit(events(spark, sf), ["user_id", "event_type"], SECOND, DAY, seq="event_id")
    digits = {"interval_median": 2, "interval_p95": 2, "frequency": 6}
    return out.select(*[F.round(c, digits[c]).alias(c) if c in digits else c for c in out.columns])


@query(STEPS + """, d AS (SELECT user_id, event_type, dt / med AS periods FROM s JOIN m USING (user_id, event_type) WHERE dt > 0)
    SELECT event_type, CAST(sum(greatest(0, round_even(periods, 0) - 1)) AS BIGINT) AS dropped, count(*) AS intervals FROM d GROUP BY event_type""")
def dropped_messages(spark, sf):
    out = audit.stream_audit(events(spark, sf), ["user_id", "event_type"], SECOND, DAY, seq="event_id")
    n = audit.with_steps(events(spark, sf), ["user_id", "event_type"], "event_id").where("dt > 0").groupBy("event_type").agg(F.count("*").alias("intervals"))
    return out.groupBy("event_type").agg(F.sum("n_dropped").alias("dropped")).join(n, "event_type")


@query(STEPS + f""", a AS (SELECT user_id, event_type, count_if(t = 0) AS z, count_if(dt <= 0) AS o, count_if(dt > {DAY}) AS g FROM s GROUP BY ALL)
    SELECT user_id, event_type, CASE WHEN z > 0 OR o > 0 THEN 'REJECT' WHEN g > 0 THEN 'PASS_WITH_WARNING' ELSE 'PASS' END AS status,
           array_to_string(list_sort([x FOR x IN [CASE WHEN z > 0 THEN 'zero_header_timestamp' END, CASE WHEN o > 0 THEN 'non_monotonic_header_timestamp' END] IF x IS NOT NULL]), ',') AS reasons
    FROM a""")
def stream_status(spark, sf):
    by = ["user_id", "event_type"]
    found = audit.stream_reasons(audit.stream_audit(events(spark, sf), by, SECOND, DAY, seq="event_id"), by)
    return found.select(*by, status("reasons", "warnings").alias("status"), F.array_join("reasons", ",").alias("reasons"))


@query(f"""WITH e AS ({EVENTS}), w AS (SELECT user_id, min(t) + {DAY} AS start, max(t) - {DAY} AS stop FROM e GROUP BY user_id),
    g AS (SELECT user_id, t AS gap_start, lead(t) OVER (PARTITION BY user_id ORDER BY t) AS gap_stop FROM e)
    SELECT user_id, gap_start, gap_stop FROM g JOIN w USING (user_id)
    WHERE gap_stop - gap_start > {12 * HOUR} AND gap_start < stop AND gap_stop > start""")
def gap_overlap(spark, sf):
    rows = events(spark, sf)
    w = rows.groupBy("user_id").agg((F.min("t") + DAY).alias("start"), (F.max("t") - DAY).alias("stop"))
    return audit.gaps_in_interval(rows, w, ["user_id"], "t", 12 * HOUR).select("user_id", "gap_start", "gap_stop")


SKEW = ORACLE_SQL["asof_nearest"]


@query(f"""WITH x AS ({SKEW}), s AS (SELECT *, abs(src_t - t) AS k FROM x WHERE src_t IS NOT NULL),
    r AS (SELECT *, sum(CASE WHEN k > {6 * HOUR} THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY t, event_id ROWS UNBOUNDED PRECEDING) AS run FROM s),
    l AS (SELECT user_id, max(c) AS soft_run FROM (SELECT user_id, run, count_if(k > {6 * HOUR}) AS c FROM r GROUP BY ALL) GROUP BY user_id),
    a AS (SELECT user_id, count(*) AS n, count_if(k > {6 * HOUR}) AS n_soft, count_if(k > {2 * DAY}) AS n_hard, round(avg(k), 2) AS skew_mean,
          round(quantile_cont(k, 0.95), 2) AS skew_p95, max(k) AS skew_max FROM s GROUP BY user_id)
    SELECT a.*, soft_run, CASE WHEN n_hard > 0 OR soft_run > 5 OR n_soft / n > 0.8 THEN 'wrist_camera_skew_exceeded' END AS reason,
           CASE WHEN NOT (n_hard > 0 OR soft_run > 5 OR n_soft / n > 0.8) AND n_soft > 0 THEN 'wrist_camera_skew_warning' END AS warning
    FROM a JOIN l USING (user_id)""")
def skew_policy(spark, sf):
    rows = asof_nearest(spark, sf).where("src_t is not null").withColumn("skew", F.col("src_t") - F.col("t"))
    out = audit.skew_gate(rows, ["user_id"], ["t", "event_id"], "skew", 6 * HOUR, 2 * DAY, 5, 0.8)
    return out.select("user_id", "n", "n_soft", "n_hard", F.round("skew_mean", 2).alias("skew_mean"), F.round("skew_p95", 2).alias("skew_p95"), "skew_max", "soft_run", "reason", "warning")


@query(f"""WITH x AS ({SKEW}), s AS (SELECT user_id, event_id, t, src_t FROM x WHERE src_t IS NOT NULL),
    f AS (SELECT *, coalesce(src_t = lag(src_t) OVER (PARTITION BY user_id ORDER BY t, event_id), false) AS again FROM s)
    SELECT user_id, count_if(again) AS reused, round(count_if(again) / count(*), 6) AS ratio FROM f GROUP BY user_id""")
def frame_reuse(spark, sf):
    rows = sequences.reused(asof_nearest(spark, sf).where("src_t is not null"), ["user_id"], ["t", "event_id"], "src_t")
    return rows.groupBy("user_id").agg(F.count_if("reused").alias("reused"), r6(F.count_if("reused") / F.count("*")).alias("ratio"))


@query(f"""WITH e AS ({EVENTS}) SELECT user_id, count(*) AS n, min(t) AS t, arg_min(event_id, t) AS event_id, arg_min(value, t) AS value
    FROM e WHERE value > 100 GROUP BY user_id""")
def first_violation(spark, sf):
    return audit.first_violation(events(spark, sf), ["user_id"], "t", F.col("value") > 100, ["event_id", "value"])


REASONS = f"""WITH e AS ({EVENTS}), r AS (SELECT event_id, user_id, list_sort([x FOR x IN [
        CASE WHEN value > 100 THEN 'value_range_exceeded' END, CASE WHEN event_type = 'error' THEN 'camera_decode_failure' END,
        CASE WHEN value < 5 THEN 'non_finite_payload' END] IF x IS NOT NULL]) AS reasons FROM e)"""


def flagged(spark, sf):
    kinds = F.array(F.when(F.col("value") > 100, audit.VALUE_RANGE), F.when(F.col("event_type") == "error", audit.DECODE_FAILURE), F.when(F.col("value") < 5, audit.NOT_FINITE))
    return events(spark, sf).withColumn("reasons", sorted_reasons(kinds))


@query(REASONS + "SELECT reason, count(*) AS n FROM (SELECT unnest(reasons) AS reason FROM r) GROUP BY reason")
def reason_histogram(spark, sf):
    return audit.histogram(flagged(spark, sf), "reasons")


@query(REASONS + """, u AS (SELECT user_id, unnest(reasons) AS reason FROM r), k AS (SELECT user_id, list_sort(list(DISTINCT reason)) AS reasons FROM u GROUP BY user_id)
    SELECT DISTINCT e.user_id, CASE WHEN len(reasons) > 0 THEN 'REJECT' ELSE 'PASS' END AS status, coalesce(array_to_string(reasons, ','), '') AS reasons
    FROM e LEFT JOIN k USING (user_id)""")
def episode_status(spark, sf):
    each = flagged(spark, sf).groupBy("user_id").agg(sorted_reasons(F.flatten(F.collect_set("reasons"))).alias("r"))
    return each.select("user_id", status("r", F.array()).alias("status"), F.array_join("r", ",").alias("reasons"))


@query(f"""WITH e AS ({EVENTS}), k AS (SELECT *, row_number() OVER w AS r, count(*) OVER (PARTITION BY user_id) AS n FROM e WHERE value > 50 WINDOW w AS (PARTITION BY user_id ORDER BY event_id))
    SELECT user_id, any_value(n) AS n, array_to_string(list(event_id ORDER BY event_id), ',') AS first_20 FROM k WHERE r <= 20 GROUP BY user_id""")
def capped_details(spark, sf):
    out = audit.capped_details(events(spark, sf).where("value > 50"), ["user_id"], "event_id", ["t"])
    return out.select("user_id", "n", F.array_join(F.transform("details", lambda d: d["event_id"].cast("string")), ",").alias("first_20"))


@query("""WITH d AS (SELECT doc_id, source, sha256(text) AS h FROM documents), f AS (
        SELECT *, h IS DISTINCT FROM lag(h) OVER (PARTITION BY source ORDER BY doc_id) AS fresh FROM d),
    r AS (SELECT *, sum(CASE WHEN fresh THEN 1 ELSE 0 END) OVER (PARTITION BY source ORDER BY doc_id ROWS UNBOUNDED PRECEDING) AS run FROM f),
    l AS (SELECT source, run, count(*) AS c FROM r GROUP BY ALL)
    SELECT d.source, count(*) - count(DISTINCT d.h) AS n_seen_before, (SELECT max(CASE WHEN c >= 2 THEN c ELSE 0 END) FROM l WHERE l.source = d.source) AS frozen
    FROM d GROUP BY d.source""")
def frozen_payload(spark, sf):
    rows = table(spark, sf, "documents").select("doc_id", "source", F.sha2("text", 256).alias("digest"))
    return audit.image_faults(rows, ["source"], "doc_id", "digest")


@query("""SELECT l.r AS user_id, l.k AS event_type FROM (SELECT DISTINCT user_id AS r, t.k FROM events, (SELECT unnest(['click', 'view', 'lidar']) AS k) t) l
    ANTI JOIN events e ON e.user_id = l.r AND e.event_type = l.k""")
def missing_topics(spark, sf):
    rows = table(spark, sf, "events").select("user_id", "event_type")
    need = rows.select("user_id").distinct().withColumn("event_type", F.explode(F.array(*[F.lit(x) for x in ("click", "view", "lidar")])))
    return audit.missing_topics(need, rows.distinct(), ["user_id", "event_type"])


@query(f"""WITH e AS ({EVENTS}), s AS (SELECT user_id, list_sort(list(value)) AS v FROM e GROUP BY user_id)
    SELECT user_id, v[1 + CAST(round_even(0.01 * (len(v) - 1), 0) AS INT)] AS p01, v[1 + CAST(round_even(0.5 * (len(v) - 1), 0) AS INT)] AS p50,
           v[1 + CAST(round_even(0.99 * (len(v) - 1), 0) AS INT)] AS p99 FROM s""")
def nearest_rank_percentile(spark, sf):
    return statistics.nearest_ranks(events(spark, sf), ["user_id"], "value", {f"p{int(p * 100):02d}": p for p in (0.01, 0.5, 0.99)})


@query(f"""WITH e AS ({EVENTS}) SELECT event_type, min(value) AS min, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.95), 6) AS p95, max(value) AS max
    FROM e GROUP BY event_type""")
def processing_summary(spark, sf):
    out = events(spark, sf).groupBy("event_type").agg(*statistics.spread("value"))
    return out.select("event_type", "min", r6("p50").alias("p50"), r6("p95").alias("p95"), "max")


GRID = f"""WITH e AS ({EVENTS}), c AS (SELECT * FROM e WHERE event_type = 'click'), k AS (SELECT user_id, min(t) AS lo, max(t) AS hi FROM c GROUP BY user_id),
    g AS (SELECT user_id, unnest(range(lo, hi + 1, {6 * HOUR})) AS t, lo FROM k)"""


@query(GRID + f""", l AS (SELECT g.user_id, g.t, g.lo, c.t AS lt, c.value AS lv FROM g ASOF LEFT JOIN c ON g.user_id = c.user_id AND g.t > c.t),
    b AS (SELECT l.*, c.t AS rt, c.value AS rv FROM l ASOF LEFT JOIN c ON l.user_id = c.user_id AND l.t <= c.t)
    SELECT user_id, CAST((t - lo) / {6 * HOUR} AS INT) AS k, t, round(CASE WHEN rt = t THEN rv ELSE lv + (t - lt)::DOUBLE / (rt - lt)::DOUBLE * (rv - lv) END, 6) AS value FROM b""")
def regular_resample(spark, sf):
    out = asof.resampled(commands_of(spark, sf), ["user_id"], value="value", step=6 * HOUR)
    return out.select("user_id", "k", "t", r6("value").alias("value"))


@query(f"""WITH e AS ({EVENTS}), c AS (SELECT * FROM e WHERE event_type = 'click'), b AS (
        SELECT user_id, t, value, CAST(floor((t - min(t) OVER (PARTITION BY user_id)) / {DAY}) AS BIGINT) AS bucket FROM c),
    h AS (SELECT user_id, bucket, min(t) AS t, arg_min(value, t) AS value FROM b GROUP BY ALL),
    n AS (SELECT *, coalesce(lead(bucket) OVER (PARTITION BY user_id ORDER BY bucket), bucket + 1) AS nxt FROM h)
    SELECT user_id, unnest(range(bucket, nxt)) AS bucket, t, value FROM n""")
def bucket_first(spark, sf):
    return asof.first_in_bucket(commands_of(spark, sf), ["user_id"], "t", DAY, ["value"])


@query(f"""WITH e AS ({EVENTS}), f AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY t, event_id) - 1 AS frame FROM e),
    n AS (SELECT user_id, count(*) AS n FROM f GROUP BY user_id), i AS (SELECT user_id, k, k * 10 AS start, k * 10 + 15 AS stop FROM (SELECT user_id, unnest(range(0, CAST(ceil(n / 10) AS BIGINT))) AS k FROM n))
    SELECT f.user_id, frame, k, event_id FROM f JOIN i ON f.user_id = i.user_id AND frame >= start AND frame < stop""")
def subtask_range_join(spark, sf):
    rows = events(spark, sf)
    frame = (F.row_number().over(W.partitionBy("user_id").orderBy("t", "event_id")) - 1).cast("long")
    frames = rows.select("user_id", "event_id", frame.alias("frame"))
    n = frames.groupBy("user_id").agg(F.count("*").alias("n"))
    k = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / 10)))
    intervals = n.select("user_id", k.alias("k")).selectExpr("user_id", "k", "k * 10 start", "k * 10 + 15 stop")
    return asof.in_intervals(frames, intervals, ["user_id"], "frame", "start", "stop").select("user_id", "frame", "k", "event_id")
