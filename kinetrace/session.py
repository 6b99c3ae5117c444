"""Session settings and table readers."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def session(master: str | None = None, **more: str) -> SparkSession:
    """A session with the settings that results and plans rely on."""
    builder = SparkSession.builder.appName("kinetrace").config(map=SETTINGS | more)
    return (builder.master(master) if master else builder).getOrCreate()


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def micros(ts: str | Column) -> Column:
    """Microseconds since 1970 of a timestamp without zone, whatever the session's zone."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), ts)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. A session on one machine that
    names none gets a local folder; on a cluster the setting is needed."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        import tempfile

        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="kinetrace-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def staged(df: DataFrame, name: str) -> DataFrame:
    """df, written to the shared folder and read again: what follows starts from a plan of one scan."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/staged/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, for those that can't import it."""
    import tempfile
    import zipfile
    from pathlib import Path

    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="kinetrace-")) / "kinetrace_package.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted((root / "kinetrace").rglob("*.py")):
            z.write(f, f.relative_to(root))
    sc.addPyFile(str(target))
    _shipped.add(sc.applicationId)
