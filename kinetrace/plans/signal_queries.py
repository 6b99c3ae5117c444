"""Signals: lags and trends in columns, and grouped functions that SQL can't express."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..operators import asof, lags, signal
from .common import DAY, EVENTS, HOUR, SECOND, events, r6, registry, stream

QUERIES, ORACLE_SQL, query = registry()
N = f"WITH e AS ({EVENTS}), s AS (SELECT user_id, event_id, t, value, (event_id % 97)::DOUBLE + value / 10 AS b, row_number() OVER (PARTITION BY user_id ORDER BY t, event_id) AS n FROM e)"


def numbered(spark, sf):
    n = F.row_number().over(W.partitionBy("user_id").orderBy("t", "event_id"))
    return events(spark, sf).withColumn("n", n).withColumn("b", (F.col("event_id") % 97).cast("double") + F.col("value") / 10)


@query(N + """, c AS (SELECT l.user_id, k.shift, corr(l.value, r.b) AS corr, count(*) AS pairs FROM s l, (SELECT unnest([0, 1, 2, 3, 4, 5]) AS shift) k
        JOIN s r ON r.user_id = l.user_id AND r.n = l.n + k.shift GROUP BY ALL)
    SELECT user_id, shift, round(corr, 6) AS corr, pairs FROM c QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY corr DESC NULLS LAST, shift) = 1""")
def lag_correlation(spark, sf):
    out = lags.lag_correlation(numbered(spark, sf), ["user_id"], "n", "value", "b", range(6))
    return out.select("user_id", "shift", r6("corr").alias("corr"), "pairs")


@query(N + """, d AS (SELECT *, abs(value - lag(value) OVER (PARTITION BY user_id ORDER BY n)) AS st FROM s), m AS (SELECT user_id, median(value) AS med FROM s GROUP BY user_id)
    SELECT d.user_id, round(any_value(med), 6) AS median, round(max(value) - min(value), 6) AS range, round(regr_slope(value, n), 6) AS slope, round(max(st), 6) AS max_step,
           round(median(abs(value - med)), 6) AS mad FROM d JOIN m USING (user_id) GROUP BY d.user_id""")
def window_trend(spark, sf):
    out = lags.window_trend(numbered(spark, sf), ["user_id"], "n", "value")
    return out.select("user_id", *[r6(c).alias(c) for c in ("median", "range", "slope", "max_step", "mad")])


def series(spark, sf):
    return stream(events(spark, sf), "view").select("user_id", "t", F.array("value").alias("v"))


CUTOFF = 1 / (96 * 3600)


@query()
def zero_phase_filter(spark, sf):
    """Each user's views, filtered below one cycle in four days."""
    return signal.filtered(series(spark, sf), ["user_id"], "t", "v", float(SECOND), cutoff=CUTOFF, order=4)


@query()
def power_retention(spark, sf):
    """The high band starts at the cutoff: many series are sampled too rarely to reach one and a half times it."""
    both = signal.filtered(series(spark, sf), ["user_id"], "t", "v", float(SECOND), cutoff=CUTOFF, order=4, into="w")
    return signal.filter_report(both, ["user_id"], "t", "v", "w", float(SECOND), cutoff=CUTOFF, high=CUTOFF)


LAG_RULES = lags.LagRules(max_lag=5 * 86400.0, rate=1 / 21600, excitation=1e-9, window=20 * 86400.0)


@query()
def lag_audit(spark, sf):
    """Each user's clicks as actions, views as states, on a grid of six hours."""
    e = events(spark, sf)
    actions, states = (stream(e, k).select("user_id", "t", F.array("value", F.sin("value")).alias("v")) for k in ("click", "view"))
    return lags.lag_audit(actions, states, ["user_id"], per_second=float(SECOND), rules=LAG_RULES)


@query()
def lag_consensus(spark, sf):
    return lags.consensus(lag_audit(spark, sf), ["user_id"])


@query(f"""WITH e AS ({EVENTS}) SELECT user_id, round(median(CASE WHEN value >= 20 THEN value / 100 END), 6) AS lag, count(CASE WHEN value >= 20 THEN 1 END) AS active_axes FROM e GROUP BY user_id""")
def consensus_of_lags(spark, sf):
    found = events(spark, sf).select("user_id", F.when(F.col("value") >= 20, F.col("value") / 100).alias("lag"))
    return lags.consensus(found, ["user_id"]).select("user_id", r6("lag").alias("lag"), "active_axes")


@query(f"""WITH e AS ({EVENTS}), i AS (SELECT user_id, min(t) AS a, min(t) + {30 * DAY} AS b FROM e GROUP BY user_id),
    p AS (SELECT * FROM (VALUES ('arm', 'action', 'click', 2), ('arm', 'state', 'view', 2), ('eef', 'action', 'purchase', 1), ('eef', 'state', 'view', 1)) v(pair, role, event_type, width))
    SELECT user_id, pair, role, count(*) AS n, min(t) AS first_t, max(t) AS last_t, CAST(sum(width) AS BIGINT) AS elements FROM e JOIN i USING (user_id) JOIN p USING (event_type) WHERE t BETWEEN a AND b GROUP BY ALL""")
def lag_pairs(spark, sf):
    """Pairs of streams inside an interval; of poses only the first elements."""
    e = events(spark, sf).select("user_id", F.col("event_type").alias("stream"), "t", F.array("value", "value").alias("v"))
    bounds = e.groupBy("user_id").agg(F.min("t").alias("active_start"), (F.min("t") + 30 * DAY).alias("active_stop"))
    pairs = (("arm", "click", "view", "joint"), ("eef", "purchase", "view", "joint"))
    found = lags.paired(e, bounds, ["user_id"], pairs)
    rows = found[0].withColumn("role", F.lit("action")).unionByName(found[1].withColumn("role", F.lit("state")))
    width = F.when(F.col("pair") == "eef", 1).otherwise(F.size("v"))
    return rows.groupBy("user_id", "pair", "role").agg(F.count("*").alias("n"), F.min("t").alias("first_t"), F.max("t").alias("last_t"), F.sum(width).alias("elements"))


@query()
def pose_interpolation(spark, sf):
    """Poses made of the events' values, at the times of views."""
    rows = stream(events(spark, sf), "click")
    a = F.col("value") / 100
    poses = rows.select("user_id", "t", F.array(F.col("value"), F.lit(0.0), F.lit(0.8), F.lit(0.0), F.lit(0.0), F.sin(a), F.cos(a)).alias("v"))
    return asof.pose(stream(events(spark, sf), "view").select("event_id", "user_id", "t"), poses, ["user_id"])
