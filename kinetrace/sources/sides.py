"""Side tables of episodes: initial actions, and episodes kept in HDF5 files."""

from __future__ import annotations

import io
from collections.abc import Iterator, Mapping

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

INITIAL_ACTIONS = "dataset int, trajectory string, action_key string, step int, action array<double>"


def write_initial_actions(actions: DataFrame, path: str) -> None:
    """INITIAL_ACTIONS as JSON lines: a table that needs no unpickling."""
    actions.select(*[c.split()[0] for c in INITIAL_ACTIONS.split(", ")]).write.mode("overwrite").json(path)


def read_initial_actions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(INITIAL_ACTIONS).json(path)


def initial_chunks(actions: DataFrame) -> DataFrame:
    """One row per (dataset, trajectory, action_key) with its steps in order."""
    return actions.groupBy("dataset", "trajectory", "action_key").agg(F.transform(F.array_sort(F.collect_list(F.struct("step", "action"))), lambda s: s["action"]).alias("actions"))


#: The datasets of an episode file, and the columns that they become.
HDF5_FIELDS = {"observations/qpos": "qpos", "action": "action", "observations/ee_pose": "ee_pose"}


def open_hdf5(raw: bytes) -> Mapping[str, np.ndarray]:
    """The datasets of an HDF5 file as arrays, by path."""
    try:
        import h5py
    except ImportError as e:
        raise ImportError("HDF5 episodes need h5py on the executors, or an `opener` of your own") from e
    with h5py.File(io.BytesIO(raw), "r") as f:
        return {path: np.asarray(f[path]) for path in HDF5_FIELDS if path in f}


def read_hdf5_episodes(spark: SparkSession, path: str, glob: str = "*.hdf5", opener=open_hdf5, fields: Mapping[str, str] = HDF5_FIELDS) -> DataFrame:
    """(path, frame_index, one vector per field) of episode files, a file at a time. Fields that a file
    lacks are null; fields of different lengths raise."""
    columns = list(fields.values())
    schema = ", ".join(["path string", "frame_index long", *(f"`{c}` array<double>" for c in columns)])
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for name, raw in zip(pdf["path"], pdf["content"]):
                found = {fields[k]: np.asarray(v, float) for k, v in opener(raw).items() if k in fields}
                sizes = {len(v) for v in found.values()}
                if len(sizes) != 1:
                    raise ValueError(f"{name}: its datasets have {sorted(sizes)} rows")
                n = sizes.pop()
                vectors = {c: [x.ravel().tolist() for x in found[c]] if c in found else [None] * n for c in columns}
                yield pd.DataFrame({"path": name, "frame_index": range(n), **vectors})

    return files.select("path", "content").mapInPandas(run, schema)
