"""Interfaces for what users add: per-sample processors, modality configurations, and episodes as
conversations of typed messages."""

from __future__ import annotations

from abc import ABC, abstractmethod
from collections.abc import Iterator, Mapping
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..sources.config import ConfigError, check_modality, load_yaml

#: The types of an episode's messages.
START, STEP, TEXT, IMAGE, END = "start_of_episode", "episode_step", "text", "image", "end_of_episode"


class Processor(ABC):
    """Turns samples into model inputs, batch by batch on the executors. A subclass names its output's
    schema and processes a pandas batch; `training` tells it which mode it is in, and `statistics`
    are what it normalises with."""

    schema: str
    training = True
    statistics: Mapping | None = None

    @abstractmethod
    def process(self, batch: pd.DataFrame) -> pd.DataFrame: ...

    def decode(self, batch: pd.DataFrame) -> pd.DataFrame:
        """Model outputs back to actions, for processors that have a way back."""
        raise NotImplementedError(f"{type(self).__name__} has no way back")

    def set_statistics(self, statistics: Mapping, override: bool = False) -> Processor:
        if self.statistics is not None and not override:
            raise ValueError("statistics are set: override them explicitly")
        self.statistics = statistics
        return self

    def train(self, on: bool = True) -> Processor:
        self.training = on
        return self

    def apply(self, samples: DataFrame) -> DataFrame:
        """process over all samples."""
        return samples.mapInPandas(self._over(self.process), self.schema)

    def apply_decode(self, outputs: DataFrame, schema: str) -> DataFrame:
        return outputs.mapInPandas(self._over(self.decode), schema)

    @staticmethod
    def _over(f):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                yield f(batch)

        return run


class Modalities:
    """Modality configurations by tag. Users add theirs as mappings or YAML files; code isn't imported."""

    def __init__(self):
        self.known: dict[str, dict] = {}

    def register(self, tag: str, config: Mapping[str, Mapping]) -> None:
        tag = tag.lower()
        if tag in self.known:
            raise ConfigError(f"{tag!r} is registered")
        self.known[tag] = dict(check_modality(config))

    def register_file(self, path: str | Path) -> None:
        """A YAML file of tags with their configurations."""
        for tag, config in load_yaml(Path(path).read_text()).items():
            self.register(tag, config)

    def of(self, tag: str) -> dict:
        try:
            return self.known[tag.lower()]
        except KeyError:
            raise ConfigError(f"unknown tag {tag!r}: {', '.join(sorted(self.known))}") from None

    def horizon(self, tag: str, modality: str = "action") -> int:
        return len(self.of(tag)[modality].get("delta_indices", ()))


def conversations(steps: DataFrame, texts: DataFrame, by: str = "episode", at: str = "step") -> DataFrame:
    """(by, position, type, role, at, content) of each episode: a start, its steps in order with the texts
    (by, at, role, content) that come before each step, and an end. Positions count from 0."""
    none = F.lit(None).cast("string")
    rows = steps.select(by, F.col(at).cast("long").alias(at), F.lit(2).alias("__k"), F.lit(STEP).alias("type"), none.alias("role"), none.alias("content"))
    rows = rows.unionByName(texts.select(by, F.col(at).cast("long").alias(at), F.lit(1).alias("__k"), F.lit(TEXT).alias("type"), "role", "content"))
    edges = rows.select(by).distinct().select(by, F.explode(F.array(F.struct(F.lit(0).alias("__k"), F.lit(START).alias("type")), F.struct(F.lit(3).alias("__k"), F.lit(END).alias("type")))).alias("x"))
    edges = edges.select(by, F.lit(None).cast("long").alias(at), "x.*", none.alias("role"), none.alias("content"))
    order = W.partitionBy(by).orderBy(F.col("__k") == 3, F.col("__k") != 0, at, "__k", "role", "content")
    return rows.unionByName(edges).withColumn("position", F.row_number().over(order) - 1).select(by, "position", "type", "role", at, "content")
