"""Shards of training steps and weighted mixtures of datasets.

Shuffles are keyed permutations and draws are hashes of counters, so each row finds its place by itself:
any step, shard or stretch of a schedule comes out the same however rows are partitioned. What is sorted is
one row a part of an episode, never steps.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..session import staged
from .ordering import group_numbers, numbered

#: Turns of a keyed permutation.
ROUNDS = 24
#: Steps that one row unfolds to, and that one task gives out.
BLOCK_STEPS = 1 << 16
TASK_STEPS = 1 << 22
#: Cells of the line on which datasets hold their shares.
CELLS = 1024
#: A dataset's share of the draws is counted in these parts of one.
SHARE_UNITS = 1e12


@dataclass(frozen=True)
class ShardOptions:
    """The defaults of the data configuration."""

    shard_size: int = 1024
    sampling_rate: float = 0.1
    margin_start: int = 0
    margin_end: int = 0
    shards_per_epoch: int = 100_000
    seed: int = 42


def usable_steps(length: Column | str, horizon: int, start: int = 0, end: int = 0) -> Column:
    """Steps whose whole chunk lies inside the margins."""
    n = F.col(length) if isinstance(length, str) else length
    return F.greatest(F.lit(0).cast("long"), (n - start - end - horizon + 1).cast("long"))


def step_windows(episodes: DataFrame, by: Sequence[str], length: str, horizon: int, start: int = 0, end: int = 0) -> DataFrame:
    n = usable_steps(length, horizon, start, end)
    rows = episodes.select(*by, n.alias("__n")).where("__n > 0")
    return rows.select(*by, F.explode(F.sequence(F.lit(start).cast("long"), F.col("__n") + start - 1)).alias("step"))


def digest_number(seed: int | str, *keys: str | Column, digits: int = 15) -> Column:
    """The first hex digits of md5 of seed:key:key as a number; nulls read as nothing."""
    texts = [F.coalesce((F.col(k) if isinstance(k, str) else k).cast("string"), F.lit("")) for k in keys]
    return F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), *texts).cast("binary")), 1, digits), 16, 10).cast("long")


def scrambled(x: Column, turn: int) -> Column:
    """A number below 2^31 from one below 2^32."""
    low = F.lit((1 << 31) - 1)
    h = (x * 73244475 + turn * 40503).bitwiseAND(low)
    return (h.bitwiseXOR(F.shiftright(h, 15)) * 46557901).bitwiseAND(low)


def permuted(df: DataFrame, index: str, n: str, key: str, name: str, rounds: int = ROUNDS) -> DataFrame:
    """df with `name`, the place of `index` in a shuffle of 0 to n - 1 that the key fixes (n and key below
    2^31). Each turn of a swap-or-not shuffle pairs place x with k - x and swaps both or neither by a hash of
    the larger, so it is one to one for every n and needs no other row. Store the result before a join or a
    filter: what the optimiser infers from the turns doubles with each."""
    kept = [F.col(f"`{c}`") for c in df.columns]
    out = df.withColumn("__x", F.col(index).cast("long"))
    for turn in range(rounds):
        out = out.withColumn("__y", F.pmod(scrambled(F.col(key), turn) - F.col("__x"), F.col(n)))
        swaps = F.shiftright(scrambled(F.col(key) + F.greatest("__x", "__y"), turn + rounds), 16).bitwiseAND(F.lit(1)) == 1
        out = out.withColumn("__x", F.when(swaps, F.col("__y")).otherwise(F.col("__x")))
    return out.select(*kept, F.col("__x").alias(name))


def balanced_shards(episodes: DataFrame, episode: str, length: str, horizon: int, options: ShardOptions = ShardOptions()) -> DataFrame:
    """(shard_id, episode, step) from one row an episode. The usable steps of each are shuffled and dealt to
    int(1 / rate) parts, all of which are kept: the rate sets how finely episodes mix. Parts go to shards
    largest first, equal ones in an order that the seed fixes, forwards and backwards in turn, so the sizes
    of two shards differ by the largest part at most, as when each part goes to the smallest shard.
    An episode has fewer than 2^31 steps; null is an episode like others. Raises where a shard would stay empty."""
    parts, seed = max(1, int(1 / options.sampling_rate)), options.seed
    n = usable_steps(length, horizon, options.margin_start, options.margin_end)
    own = staged(episodes.select(F.col(episode).alias("__e"), n.alias("__len")).where("__len > 0"), "episodes")
    steps, dealt = own.agg(F.coalesce(F.sum("__len"), F.lit(0)), F.coalesce(F.sum(F.least("__len", F.lit(parts))), F.lit(0))).first()
    shards = -(-steps // options.shard_size)
    if dealt < shards:
        raise ValueError("a shard would be empty: lower the shard size or the sampling rate")
    rows = own.withColumn("__piece", F.explode(F.sequence(F.lit(0), F.least("__len", F.lit(parts)).cast("int") - 1)))
    size = F.floor(F.col("__len") / parts) + (F.col("__piece") < F.col("__len") % parts).cast("long")
    rows = rows.withColumn("__size", size).withColumn("__tie", digest_number(seed, "__e", "__piece"))
    rows = numbered(rows, [F.desc("__size"), "__tie", "__e", "__piece"], "__rank")
    turn, place = F.floor(F.col("__rank") / max(1, shards)), F.col("__rank") % max(1, shards)
    rows = rows.withColumn("__shard", F.when(turn % 2 == 0, place).otherwise(shards - 1 - place))
    # At most `parts` shards an episode: its steps look theirs up and are never shuffled.
    own = rows.groupBy("__e").agg(F.max("__len").alias("__len"), F.array_sort(F.collect_list(F.struct("__piece", "__shard"))).alias("__shards"))
    own = own.withColumn("__key", digest_number(seed, "__e", digits=7))
    blocks = own.withColumn("__low", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__len") - 1, F.lit(BLOCK_STEPS).cast("long"))))
    blocks = blocks.repartition(max(1, -(-steps // TASK_STEPS)), "__e", "__low")
    each = blocks.withColumn("__i", F.explode(F.sequence("__low", F.least(F.col("__low") + BLOCK_STEPS, F.col("__len")) - 1)))
    each = permuted(each, "__i", "__len", "__key", "__at")
    shard = F.get("__shards", (F.col("__at") % parts).cast("int"))["__shard"]
    return staged(each.select(shard.cast("long").alias("shard_id"), F.col("__e").alias(episode), (F.col("__i") + options.margin_start).alias("step")), "steps")


def materialised(assignment: DataFrame, frames: DataFrame, partitions: int, episode: str = "episode_index", step: str = "frame_index") -> DataFrame:
    """Frames joined to their shard and dealt by it: one shuffle for the join, one for the shards."""
    joined = assignment.withColumnRenamed("step", step).join(frames, [episode, step])
    return joined.repartition(partitions, "shard_id")


def mixture_weights(shards: DataFrame, by: str = "spec", n: str = "n_shards", ratio: str = "mix_ratio") -> DataFrame:
    """A dataset's share of its spec's shards times the spec's ratio."""
    share = F.col(n) / F.sum(n).over(W.partitionBy(by))
    return shards.withColumn("weight", share * F.col(ratio))


def dataset_shares(shards: DataFrame, weights: DataFrame, dataset: str = "dataset", size: str = "size", weight: str = "weight") -> DataFrame:
    """(dataset, n, low, high) of the datasets that can be drawn: n shards, and a stretch of a line as long
    as the weight over the mean shard size, counted in whole units so that sums are exact. Datasets without
    shards, size or a weight above zero are never drawn."""
    own = shards.groupBy(dataset).agg(F.count("*").alias("n"), F.sum(size).cast("double").alias("__size"))
    units = F.floor(F.lit(SHARE_UNITS) * F.col(weight).cast("double") * F.col("n") / F.col("__size"))
    own = own.where("__size > 0").join(weights.select(dataset, weight), dataset).select(dataset, "n", units.cast("long").alias("__units"))
    own = numbered(own.where("__units > 0"), [dataset], "__i", {"low": "__units"})
    return own.select(dataset, "n", "low", (F.col("low") + F.col("__units")).alias("high"))


def drawn_datasets(shares: DataFrame, first: int, last: int, seed: int, epoch: int, dataset: str = "dataset") -> DataFrame:
    """(position, dataset, n) for positions first to last - 1 of an epoch, drawn with replacement: a hash of
    the position falls into one dataset's stretch. The line is cut in cells, on which draws and stretches
    meet as equal keys; a cell lies in all stretches that touch it."""
    total = shares.agg(F.max("high")).first()[0]
    if not total:
        raise ValueError("no dataset can be drawn")
    width = total // CELLS + 1
    stretches = shares.withColumn("__cell", F.explode(F.expr(f"sequence(low div {width}, (high - 1) div {width})")))
    draws = shares.sparkSession.range(first, last).select(F.col("id").alias("position"))
    draws = draws.withColumn("__u", digest_number(f"{seed}:{epoch}", "position") % total).withColumn("__cell", F.expr(f"__u div {width}"))
    return draws.join(stretches, "__cell").where("low <= __u AND __u < high").select("position", dataset, "n")


def mixture_schedule(shards: DataFrame, weights: DataFrame, length: int, seed: int, epoch: int = 0, first: int = 0, dataset: str = "dataset", shard: str = "shard_id", size: str = "size", weight: str = "weight") -> DataFrame:
    """(position, dataset, shard) for `length` positions of an epoch from `first` on. Datasets are drawn with
    replacement by weight over mean shard size and give their shards in rounds, each shuffled by a key of
    its own: the k-th draw of a dataset within the epoch reads place k % n of round k // n. A stretch in
    the middle counts the draws before it, and every epoch starts afresh, so an endless schedule is this
    function over epochs. Takes one row a (dataset, shard), and one a dataset's weight; other columns don't
    matter. Raises where nothing can be drawn."""
    shares = staged(dataset_shares(shards, weights, dataset, size, weight), "shares")
    draws = group_numbers(drawn_datasets(shares, first, first + length, seed, epoch, dataset), [dataset], ["position"], "__k", "__among")
    if first:
        before = drawn_datasets(shares, 0, first, seed, epoch, dataset).groupBy(dataset).agg(F.count("*").alias("__before"))
        draws = draws.join(before, dataset, "left").withColumn("__k", F.col("__k") + F.coalesce("__before", F.lit(0)))
    draws = draws.withColumn("__turn", F.floor(F.col("__k") / F.col("n"))).withColumn("__i", F.col("__k") % F.col("n"))
    draws = draws.withColumn("__key", digest_number(f"{seed}:{epoch}", dataset, "__turn", digits=7))
    draws = staged(permuted(draws, "__i", "n", "__key", "__at").select("position", dataset, "__at"), "draws")
    places = group_numbers(shards.select(dataset, shard), [dataset], [shard], "__at", "__among").select(dataset, "__at", shard)
    return draws.join(places, [dataset, "__at"]).select("position", dataset, shard)


def every_shard(shards: DataFrame, dataset: str = "dataset", shard: str = "shard_id") -> DataFrame:
    """(position, dataset, shard) with each shard once, as evaluation reads them."""
    return numbered(shards.select(dataset, shard), [dataset, shard], "position").select("position", dataset, shard)


def round_robin(df: DataFrame, position: str, rank: int, world: int, worker: int = 0, workers: int = 1) -> DataFrame:
    """The rows of one worker of one rank."""
    return df.where(F.pmod(F.col(position), F.lit(world * workers)) == rank * workers + worker)


def worker_of(position: Column | str, world: int, workers: int = 1) -> Column:
    p = F.col(position) if isinstance(position, str) else position
    return F.pmod(p, F.lit(world * workers))


def seeded_order(seed: int, *keys: str) -> Column:
    """A reproducible shuffle's sort key."""
    return F.xxhash64(F.lit(seed), *keys)


def chance(seed: int, *keys: str) -> Column:
    """A number in [0, 1) fixed by the seed and the keys, however rows are partitioned."""
    digits = F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]).cast("binary")), 1, 8)
    return F.conv(digits, 16, 10).cast("double") / 2**32


def dropped_state(state: str, p: float, seed: int, *keys: str) -> Column:
    """The state, or zeros with probability p, the same for the same keys."""
    return F.when(chance(seed, *keys) < p, F.transform(state, lambda x: x * 0)).otherwise(F.col(state))


def chunk_of(episode: str = "episode_index", size: int = 1000) -> Column:
    return F.floor(F.col(episode) / size).cast("long")


def rank_step(df: DataFrame, group: str, batch: int, order: Sequence[str]) -> DataFrame:
    """Batches of rows per group, in order (the last may be short)."""
    i = F.row_number().over(W.partitionBy(group).orderBy(*order)) - 1
    rows = df.withColumn("batch", F.floor(i / batch))
    return rows.groupBy(group, "batch").agg(F.array_sort(F.collect_list(F.struct(*order, *[c for c in df.columns if c not in (*order, group)]))).alias("items"))
