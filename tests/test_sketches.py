"""Mergeable states of statistics."""

import math

import pytest
from pyspark.sql import functions as F

from kinetrace.operators import sketches as K


def rows(spark, n=30_000):
    x = F.pmod(F.xxhash64("id"), F.lit(10_000)).cast("double")
    return spark.range(0, n, 1, 5).select((F.col("id") % 7).alias("part"), (F.col("id") % 2).alias("g"), x.alias("x"))


def test_merged_states_equal_one_state(spark):
    d = rows(spark)
    whole = {r.g: r for r in K.read(K.states(d, "x", ["g"])).collect()}
    merged = {r.g: r for r in K.read(K.merged(K.states(d, "x", ["part", "g"]), ["g"])).collect()}
    assert set(whole) == set(merged) == {0, 1}
    for g, a in whole.items():
        b = merged[g]
        assert (a.n, a.min, a.max) == (b.n, b.min, b.max) and math.isclose(a.mean, b.mean) and math.isclose(a.std, b.std)
        exact = sorted(r.x for r in d.where(f"g = {g}").collect())
        for got, f in ((b.q01, 0.01), (b.q99, 0.99)):
            less, upto = sum(x < got for x in exact), sum(x <= got for x in exact)
            assert less - K.RANK_ERROR * b.n <= f * b.n <= upto + K.RANK_ERROR * b.n
        assert abs(b.n_distinct - len(set(exact))) <= 0.04 * len(set(exact))


def test_cube_from_finest_states(spark):
    d = rows(spark, 5000)
    cube = K.read(K.rolled_up(K.states(d, "x", ["part", "g"]), ["part", "g"]))
    want = d.cube("part", "g").agg(F.grouping_id().alias("grouping_id"), F.count("x").alias("n"), F.avg("x").alias("mean"))
    got = {(r.part, r.g, r.grouping_id): (r.n, round(r["mean"], 6)) for r in cube.collect()}
    assert got == {(r.part, r.g, r.grouping_id): (r.n, round(r["mean"], 6)) for r in want.collect()} and len(got) == 7 * 2 + 7 + 2 + 1


def test_nulls_nan_and_nothing(spark):
    d = spark.createDataFrame([("a", 1.0), ("a", None), ("a", float("nan")), ("b", None)], "g string, x double")
    states = K.states(d, "x", ["g"])
    got = {r.g: r for r in K.read(states).collect()}
    assert (got["a"].n, got["a"]["mean"], got["a"].q01, got["a"].n_distinct) == (1, 1.0, 1.0, 1)
    assert (got["b"].n, got["b"]["mean"], got["b"]["std"], got["b"].q01, got["b"].n_distinct) == (0, None, None, None, 0)
    both = K.read(K.merged(states)).first()
    assert (both.n, both["mean"], both["std"]) == (1, 1.0, 0.0)
    assert K.read(K.merged(K.states(d.limit(0), "x", ["g"]), ["g"])).count() == 0
    assert states.where("g = 'a'").select(K.share_upto(2.0).alias("s"), K.share_upto(0.0).alias("z")).first() == (1.0, 0.0)


def test_vectors_of_unequal_length(spark):
    d = spark.createDataFrame([([1.0, 2.0],), ([3.0],), (None,), ([],)], "v array<double>")
    got = {r.dim: (r.n, r["mean"]) for r in K.read(K.vector_states(d, "v")).collect()}
    assert got == {0: (2, 2.0), 1: (1, 2.0)}


def test_states_of_datasets(spark, tmp_path):
    from kinetrace.plans import dataset_stats

    roots = []
    for k in range(2):
        frames = spark.range(4).select((F.col("id") + 10 * k).cast("double").alias("speed"), F.array(F.col("id").cast("float"), F.lit(float(k)).cast("float")).alias("arm"))
        root = tmp_path / str(k)
        dataset_stats.feature_states(frames, ["speed", "arm"]).write.parquet(str(root / "meta" / "stats_states.parquet"))
        roots.append(str(root))
    got = {(r.feature, r.dim): r for r in dataset_stats.union_stats(spark, roots).collect()}
    assert set(got) == {("speed", 0), ("arm", 0), ("arm", 1)}
    assert (got["speed", 0].n, got["speed", 0]["mean"], got["speed", 0]["min"], got["speed", 0]["max"]) == (8, 6.5, 0.0, 13.0)
    assert got["arm", 1]["std"] == pytest.approx(0.5) and got["arm", 0].n_distinct == 4
