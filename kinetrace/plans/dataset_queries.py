"""Datasets: merging, splitting, sampling, text, summaries, and what Spark gives beyond."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions import scalars
from ..operators import etl, shards, sketches
from ..operators.ordering import numbered
from ..session import micros, table
from .common import DAY, EVENTS, HOUR, SHARD_LISTS, digest_sql, events, permuted_sql, r6, registry, shard_lists

QUERIES, ORACLE_SQL, query = registry()


def order_sets(spark, sf):
    """Orders as two datasets of episodes with the order priority as their task."""
    o = table(spark, sf, "orders")
    return o.select((F.col("o_orderkey") % 2).cast("int").alias("dataset"), F.col("o_orderkey").alias("old_episode"), F.col("o_orderpriority").alias("task"), (F.col("o_custkey") % 7 + 1).alias("length"))


ORDER_SETS = "WITH o AS (SELECT CAST(o_orderkey % 2 AS INTEGER) AS dataset, o_orderkey AS old_episode, o_orderpriority AS task, o_custkey % 7 + 1 AS length FROM orders)"


@query(ORDER_SETS + """SELECT dataset, old_episode, length, row_number() OVER w - 1 AS episode_index,
    CAST(coalesce(sum(length) OVER (ORDER BY dataset, old_episode ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start FROM o WINDOW w AS (ORDER BY dataset, old_episode)""")
def merge_datasets(spark, sf):
    rows = order_sets(spark, sf).select("dataset", "old_episode", "length")
    return etl.episode_offsets(rows, ["dataset", "old_episode"])


TASKS = ORDER_SETS + """, t AS (SELECT dataset, task, row_number() OVER (PARTITION BY dataset ORDER BY min(old_episode)) - 1 AS task_index FROM o GROUP BY dataset, task)"""


@query(TASKS + """, f AS (SELECT task, row_number() OVER (ORDER BY min((dataset, task_index))) - 1 AS new_index FROM t GROUP BY task)
    SELECT dataset, task_index, task, new_index FROM t JOIN f USING (task)""")
def task_mapping(spark, sf):
    seen = order_sets(spark, sf).groupBy("dataset", "task").agg(F.min("old_episode").alias("m"))
    i = (F.row_number().over(W.partitionBy("dataset").orderBy("m")) - 1).cast("long")
    return etl.task_mapping(seen.select("dataset", "task", i.alias("task_index"))).select("dataset", "task_index", "task", "new_index")


@query("""WITH l AS (SELECT row_number() OVER (ORDER BY l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_shipdate) - 1 AS index, l_quantity FROM lineitem),
    e AS (SELECT i AS episode, i * 1000 AS from_index, i * 1000 + 700 AS to_index FROM (SELECT unnest(range(0, CAST(ceil((SELECT count(*) FROM lineitem) / 1000) AS BIGINT))) AS i))
    SELECT episode, count(*) AS n, sum(l_quantity) AS quantity FROM l JOIN e ON index >= from_index AND index < to_index GROUP BY episode""")
def split_ranges(spark, sf):
    lines = table(spark, sf, "lineitem")
    order = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate"]
    rows = numbered(lines.select(*order), order, "index")
    e = spark.range(-(-lines.count() // 1000)).selectExpr("id episode", "id * 1000 from_index", "id * 1000 + 700 to_index")
    return etl.split_ranges(rows, e).groupBy("episode").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("quantity"))


@query("""SELECT n_nationkey, n_name FROM nation SEMI JOIN (SELECT c_nationkey FROM customer WHERE c_acctbal > 9500) c ON n_nationkey = c_nationkey""")
def semi_tasks(spark, sf):
    rich = table(spark, sf, "customer").where("c_acctbal > 9500").select(F.col("c_nationkey").alias("task_index"))
    tasks = table(spark, sf, "nation").select(F.col("n_nationkey").alias("task_index"), "n_name")
    return etl.used_tasks(tasks, rich).select(F.col("task_index").alias("n_nationkey"), "n_name")


@query("SELECT o_orderkey, n_name AS task FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey")
def task_lookup(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    c = table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("task_index"))
    tasks = table(spark, sf, "nation").select(F.col("n_nationkey").alias("task_index"), F.col("n_name").alias("task"))
    return etl.with_tasks(o.join(c, "c_custkey"), tasks).select("o_orderkey", "task")


@query("SELECT o_orderpriority, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) <= 3")
def top_n_per_task(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderpriority", "o_orderkey", "o_totalprice")
    return etl.first_n(rows, ["o_orderpriority"], ["o_orderkey"], 3)


@query("SELECT o_orderkey, o_orderkey % 6 AS worker FROM orders")
def round_robin_split(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", shards.worker_of("o_orderkey", 3, 2).alias("worker"))


@query("""WITH s AS (SELECT c_mktsegment AS spec, c_nationkey AS dataset, count(*) AS n_shards FROM customer GROUP BY ALL)
    SELECT spec, dataset, n_shards, round(n_shards / sum(n_shards) OVER (PARTITION BY spec) * 0.25, 6) AS weight FROM s""")
def mixture_weights(spark, sf):
    s = table(spark, sf, "customer").groupBy(F.col("c_mktsegment").alias("spec"), F.col("c_nationkey").alias("dataset")).agg(F.count("*").alias("n_shards")).withColumn("mix_ratio", F.lit(0.25))
    return shards.mixture_weights(s).select("spec", "dataset", "n_shards", r6("weight").alias("weight"))


@query("SELECT doc_id, regexp_replace(translate(lower(text), '', ''), '[^\\w\\s]', '', 'g') AS instruction FROM documents WHERE regexp_full_match(text, '[ -~\\s]*')")
def normalize_instruction(spark, sf):
    rows = table(spark, sf, "documents").where(F.col("text").rlike(r"\A[ -~\s]*\z"))
    return rows.select("doc_id", scalars.instruction("text").alias("instruction"))


@query()
def normalize_instruction_unicode(spark, sf):
    """Every document's text; no SQL, as the engines' word characters differ beyond ASCII."""
    return table(spark, sf, "documents").select("doc_id", scalars.instruction("text").alias("instruction"))


@query("SELECT source, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS chars, round(avg(n_chars), 6) AS mean_length, round(median(n_chars), 6) AS median_length, count(DISTINCT lang) AS langs FROM documents GROUP BY source")
def dataset_summary(spark, sf):
    d = table(spark, sf, "documents")
    return d.groupBy("source").agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"), r6(F.avg("n_chars")).alias("mean_length"), r6(F.median("n_chars")).alias("median_length"), F.count_distinct("lang").alias("langs"))


@query("SELECT CAST(0 AS BIGINT) AS n, 0.0::DOUBLE AS mean_length, 0.0::DOUBLE AS max_length")
def empty_summary(spark, sf):
    """The summary of no episodes is a row of zeros."""
    d = table(spark, sf, "documents").where("doc_id < 0")
    zero = lambda x: F.coalesce(x, F.lit(0)).cast("double")
    return d.agg(F.count("*").alias("n"), zero(F.avg("n_chars")).alias("mean_length"), zero(F.max("n_chars")).alias("max_length"))


@query("SELECT o_orderkey, CAST(floor(o_orderkey / 1000) AS BIGINT) AS chunk, printf('episode_%06d', o_orderkey) AS file FROM orders")
def chunk_directories(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", shards.chunk_of("o_orderkey").alias("chunk"), scalars.episode_file("o_orderkey").alias("file"))


@query(f"""WITH e AS ({EVENTS}), f AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY t, event_id) - 1 AS frame_index FROM e)
    SELECT user_id, event_id, frame_index, round(CAST(CAST(frame_index AS FLOAT) / 30::FLOAT AS DOUBLE), 6) AS timestamp, user_rank - 1 AS episode_index, start + frame_index AS index
    FROM f JOIN (SELECT user_id, row_number() OVER (ORDER BY user_id) AS user_rank, CAST(coalesce(sum(n) OVER (ORDER BY user_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
                 FROM (SELECT user_id, count(*) AS n FROM e GROUP BY user_id)) USING (user_id)""")
def frame_indices(spark, sf):
    rows = events(spark, sf)
    lengths = rows.groupBy("user_id").agg(F.count("*").alias("length"))
    out = etl.with_indices(rows, etl.episode_offsets(lengths, ["user_id"]), ["user_id"], ["t", "event_id"])
    return out.select("user_id", "event_id", "frame_index", r6(F.col("timestamp").cast("double")).alias("timestamp"), "episode_index", "index")


@query(f"""WITH e AS ({EVENTS}), k AS (SELECT user_id FROM e GROUP BY user_id HAVING max(value) <= 150 AND count(*) >= 3),
    f AS (SELECT e.*, row_number() OVER (PARTITION BY user_id ORDER BY t, event_id) - 1 AS frame_index FROM e SEMI JOIN k USING (user_id)),
    o AS (SELECT user_id, row_number() OVER (ORDER BY user_id) - 1 AS episode_index FROM k) SELECT user_id, event_id, frame_index, episode_index FROM f JOIN o USING (user_id)""")
def kept_episodes(spark, sf):
    rows = events(spark, sf)
    bad = (F.max("value") > 150) | (F.count("*") < 3)
    verdict = rows.groupBy("user_id").agg(F.when(bad, "REJECT").otherwise("PASS").alias("status"))
    return etl.kept_episodes(rows, verdict, ["user_id"], ["t", "event_id"]).select("user_id", "event_id", "frame_index", "episode_index")


@query("SELECT conv_id, CAST(floor((row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1) / 2) AS BIGINT) AS batch, turn, role FROM conversations")
def batch_unbatch(spark, sf):
    rows = shards.rank_step(table(spark, sf, "conversations").select("conv_id", "turn", "role"), "conv_id", 2, ["turn"])
    return rows.select("conv_id", "batch", F.explode("items").alias("x")).select("conv_id", "batch", "x.turn", "x.role")


@query("SELECT user_id, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ROLLUP (event_type, user_id)")
def rollup(spark, sf):
    return table(spark, sf, "events").rollup("event_type", "user_id").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total")).select("user_id", "event_type", "n", "total")


@query("SELECT l_returnflag, l_linestatus, count(*) AS n, sum(l_quantity) AS quantity FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)")
def cube(spark, sf):
    return table(spark, sf, "lineitem").cube("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("quantity"))


def ranks_hold(rows, read, keys, x, fractions, error=sketches.RANK_ERROR):
    """(keys..., holds): whether each quantile read from a state has a rank within `error` of the one asked
    for; ties make a range of ranks, of which one must be near. The read rows are one a key, the keys few."""
    asked = F.array(*[F.struct(F.lit(f).alias("f"), F.col(name).alias("q")) for name, f in fractions.items()])
    wanted = read.select(*keys, F.explode(asked).alias("a"))
    near = rows.join(F.broadcast(wanted), keys).groupBy(*keys, "a").agg(F.count(x).alias("n"), F.count_if(F.col(x) < F.col("a.q")).alias("less"), F.count_if(F.col(x) <= F.col("a.q")).alias("upto"))
    slack = F.greatest(F.lit(1.0), error * F.col("n"))
    return near.groupBy(*keys).agg(F.bool_and((F.col("less") - slack <= F.col("a.f") * F.col("n")) & (F.col("upto") + slack >= F.col("a.f") * F.col("n"))).alias("holds"))


@query("""WITH x AS (SELECT d.dim AS dim, CAST(embedding[d.dim + 1] AS DOUBLE) AS x FROM embeddings, (SELECT unnest(range(0, (SELECT max(len(embedding)) FROM embeddings))) AS dim) d WHERE d.dim < len(embedding))
    SELECT CAST(dim AS INTEGER) AS dim, count(x) AS n, round(avg(x), 6) AS mean, round(stddev_pop(x), 6) AS std, round(min(x), 6) AS min, round(max(x), 6) AS max, TRUE AS quantiles_hold, TRUE AS distinct_holds FROM x GROUP BY dim""")
def sketched_vector_stats(spark, sf):
    """One state per label and dimension, merged over labels; quantiles and distinct counts are checked
    against the rows themselves, where a number of distinct values may be off by five standard errors."""
    e = table(spark, sf, "embeddings").select("label", "embedding")
    read = sketches.read(sketches.merged(sketches.vector_states(e, "embedding", ["label"]), ["dim"]))
    rows = e.select(F.posexplode(F.col("embedding").cast("array<double>")).alias("dim", "x"))
    holds = ranks_hold(rows, read, ["dim"], "x", {"q01": 0.01, "q99": 0.99}).withColumnRenamed("holds", "quantiles_hold")
    exact = rows.groupBy("dim").agg(F.count_distinct("x").alias("d"))
    near = F.abs(F.col("n_distinct") - F.col("d")) <= F.greatest(F.lit(1.0), 5 * 1.04 / 2 ** (sketches.HLL_BITS / 2) * F.col("d"))
    out = read.join(holds, "dim").join(exact, "dim")
    return out.select("dim", "n", r6("mean").alias("mean"), r6("std").alias("std"), r6("min").alias("min"), r6("max").alias("max"), "quantiles_hold", near.alias("distinct_holds"))


@query(f"""SELECT event_type, CAST(floor(epoch_us(ts) / {DAY}) AS BIGINT) AS day, CAST(grouping(event_type, day) AS BIGINT) AS grouping_id, count(value) AS n, round(avg(value), 6) AS mean, round(stddev_pop(value), 4) AS std, min(value) AS min, max(value) AS max, TRUE AS median_holds FROM events GROUP BY CUBE (event_type, day)""")
def sketch_cube(spark, sf):
    """A cube whose totals come from the states of its finest cells; the medians by type are checked."""
    e = events(spark, sf).select("event_type", F.floor(F.col("t") / DAY).alias("day"), "value")
    cells = sketches.read(sketches.rolled_up(sketches.states(e, "value", ["event_type", "day"]), ["event_type", "day"]), {"median": 0.5})
    by_type = cells.where("grouping_id = 1").select("event_type", "median")
    holds = ranks_hold(e.select("event_type", "value"), by_type, ["event_type"], "value", {"median": 0.5})
    out = cells.join(F.broadcast(holds), "event_type", "left")
    return out.select("event_type", "day", "grouping_id", "n", r6("mean").alias("mean"), F.round("std", 4).alias("std"), "min", "max", F.coalesce("holds", F.lit(True)).alias("median_holds"))


@query("SELECT event_id, ntile(4) OVER w AS quartile, rank() OVER w AS rank, round(percent_rank() OVER w, 6) AS share, nth_value(value, 2) OVER (PARTITION BY event_type ORDER BY value, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS second FROM events WINDOW w AS (PARTITION BY event_type ORDER BY value, event_id)")
def ranking(spark, sf):
    w = W.partitionBy("event_type").orderBy("value", "event_id")
    whole = w.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    return table(spark, sf, "events").select("event_id", F.ntile(4).over(w).alias("quartile"), F.rank().over(w).alias("rank"), r6(F.percent_rank().over(w)).alias("share"), F.nth_value("value", 2).over(whole).alias("second"))


@query("SELECT c_nationkey AS k FROM customer INTERSECT SELECT s_nationkey FROM supplier")
def set_intersect(spark, sf):
    return table(spark, sf, "customer").select(F.col("c_nationkey").alias("k")).intersect(table(spark, sf, "supplier").select("s_nationkey"))


@query("SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders")
def set_except(spark, sf):
    return table(spark, sf, "customer").select(F.col("c_custkey").alias("k")).subtract(table(spark, sf, "orders").select("o_custkey"))


@query(f"SELECT CAST(floor(epoch_us(ts) / {DAY}) AS BIGINT) AS day, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def tumbling_window(spark, sf):
    e = events(spark, sf).groupBy(F.floor(F.col("t") / DAY).alias("day"), "event_type")
    return e.agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query(f"""WITH e AS ({EVENTS}), s AS (SELECT *, CASE WHEN t - lag(t) OVER w < {12 * HOUR} THEN 0 ELSE 1 END AS fresh FROM e WINDOW w AS (PARTITION BY user_id ORDER BY t)),
    k AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY t) AS session FROM s)
    SELECT user_id, min(t) AS start, max(t) AS last, count(*) AS n FROM k GROUP BY user_id, session""")
def sessions(spark, sf):
    e = table(spark, sf, "events").select("user_id", "ts", micros("ts").alias("t"))
    out = e.groupBy("user_id", F.session_window("ts", "12 hours")).agg(F.min("t").alias("start"), F.max("t").alias("last"), F.count("*").alias("n"))
    return out.select("user_id", "start", "last", "n")


@query("SELECT user_id, count(DISTINCT event_type) AS kinds, count(DISTINCT CAST(value AS BIGINT)) AS levels FROM events GROUP BY user_id")
def distinct_counts(spark, sf):
    # Both engines round a cast differently; whole parts are compared after rounding half to even.
    return table(spark, sf, "events").groupBy("user_id").agg(F.count_distinct("event_type").alias("kinds"), F.count_distinct(F.rint("value").cast("long")).alias("levels"))


@query("SELECT event_id, json_extract_string(props, '$.' || (json_keys(props)[1])) AS first_value, len(json_keys(props)) AS n_keys FROM events")
def json_fields(spark, sf):
    e = table(spark, sf, "events")
    m = F.from_json("props", "map<string,string>")
    return e.select("event_id", F.get(F.map_values(m), F.lit(0)).alias("first_value"), F.coalesce(F.size(m), F.lit(0)).cast("long").alias("n_keys"))


@query("SELECT doc_id, sha256(text) AS digest FROM documents")
def payload_digest(spark, sf):
    return table(spark, sf, "documents").select("doc_id", scalars.digest("text").alias("digest"))


@query("SELECT r_name, n_name, count(*) AS customers, round(avg(c_acctbal), 6) AS balance FROM region JOIN nation ON r_regionkey = n_regionkey JOIN customer ON c_nationkey = n_nationkey GROUP BY ALL")
def metadata_join(spark, sf):
    r, n, c = (table(spark, sf, t) for t in ("region", "nation", "customer"))
    j = c.join(n, c["c_nationkey"] == n["n_nationkey"]).join(r, n["n_regionkey"] == r["r_regionkey"])
    return j.groupBy("r_name", "n_name").agg(F.count("*").alias("customers"), r6(F.avg("c_acctbal")).alias("balance"))


SHARDS = f"""WITH e AS (SELECT user_id, count(*) - 7 AS n, {digest_sql("42", "user_id", digits=7)} AS key FROM events GROUP BY user_id HAVING count(*) > 7),
    t AS (SELECT CAST(ceil(sum(n) / 256.0) AS BIGINT) AS shards FROM e),
    parts AS (SELECT user_id, p, n // 10 + CASE WHEN p < n % 10 THEN 1 ELSE 0 END AS size, {digest_sql("42", "user_id", "p")} AS tie FROM e, range(10) r(p) WHERE p < n),
    ranked AS (SELECT *, row_number() OVER (ORDER BY size DESC, tie, user_id, p) - 1 AS k FROM parts),
    placed AS (SELECT user_id, p, CASE WHEN k // shards % 2 = 0 THEN k % shards ELSE shards - 1 - k % shards END AS shard_id FROM ranked, t),
    steps AS (SELECT user_id, n, key, unnest(range(0, n)) AS step FROM e),
    {permuted_sql("steps", "step", "n", "key", "mixed", shards.ROUNDS)}
    SELECT shard_id, user_id, step FROM mixed JOIN placed USING (user_id) WHERE p = x % 10"""


@query(SHARDS)
def balanced_shards(spark, sf):
    """Shards of the usable steps of each user's events."""
    n = events(spark, sf).groupBy("user_id").agg(F.count("*").alias("n"))
    return shards.balanced_shards(n, "user_id", "n", 8, shards.ShardOptions(shard_size=256))


def schedule_sql(epoch: int, first: str, last: str) -> str:
    draw, key = digest_sql(f"42:{epoch}", "position"), digest_sql(f"42:{epoch}", "dataset", "k // n", digits=7)
    return f"""WITH {SHARD_LISTS},
    units AS (SELECT dataset, count(*) AS n, CAST(floor(CAST(1e12 AS DOUBLE) * weight * count(*) / CAST(sum(size) AS DOUBLE)) AS BIGINT) AS u FROM own JOIN weights USING (dataset) GROUP BY dataset, weight),
    shares AS (SELECT dataset, n, CAST(sum(u) OVER (ORDER BY dataset) AS BIGINT) AS high, CAST(sum(u) OVER (ORDER BY dataset) AS BIGINT) - u AS low FROM units),
    total AS (SELECT max(high) AS t FROM shares),
    places AS (SELECT unnest(range(0, {last})) AS position),
    draws AS (SELECT position, {draw} % t AS u FROM places, total),
    taken AS (SELECT position, dataset, n, row_number() OVER (PARTITION BY dataset ORDER BY position) - 1 AS k FROM draws JOIN shares ON low <= u AND u < high),
    keyed AS (SELECT position, dataset, n, k % n AS i, {key} AS key FROM taken),
    {permuted_sql("keyed", "i", "n", "key", "mixed", shards.ROUNDS)},
    numbered AS (SELECT dataset, shard_id, row_number() OVER (PARTITION BY dataset ORDER BY shard_id) - 1 AS x FROM own)
    SELECT position, dataset, shard_id FROM mixed JOIN numbered USING (dataset, x) WHERE position >= {first}"""


@query(schedule_sql(0, "0", "(SELECT count(*) FROM customer)"))
def mixture_schedule(spark, sf):
    """An epoch as long as there are shards."""
    own, weights = shard_lists(spark, sf)
    return shards.mixture_schedule(own, weights, own.count(), seed=42)


@query(schedule_sql(3, "(SELECT count(*) FROM customer)", "2 * (SELECT count(*) FROM customer)"))
def mixture_schedule_stretch(spark, sf):
    """The fourth epoch's second stretch, without the first."""
    own, weights = shard_lists(spark, sf)
    n = own.count()
    return shards.mixture_schedule(own, weights, n, seed=42, epoch=3, first=n)


@query(f"WITH {SHARD_LISTS} SELECT row_number() OVER (ORDER BY dataset, shard_id) - 1 AS position, dataset, shard_id FROM own")
def every_shard(spark, sf):
    return shards.every_shard(shard_lists(spark, sf)[0])
