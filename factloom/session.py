"""Sessions and tables."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PACKAGE = Path(__file__).resolve().parent
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the workers this package, unless their path already leads to it."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    _shipped.add(app)
    if str(PACKAGE.parent) in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    path = Path(tempfile.mkdtemp()) / "factloom.zip"
    with zipfile.ZipFile(path, "w") as z:
        for p in sorted(PACKAGE.rglob("*.py")):
            z.write(p, p.relative_to(PACKAGE.parent))
    spark.sparkContext.addPyFile(str(path))


def local_session(cpus: int | str = "*", partitions: int = 8, name: str = "factloom") -> SparkSession:
    """A session for tests and benchmarks; on a cluster the caller brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("FACTLOOM_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    ship(spark)
    return spark


def sized(df: DataFrame, most: int = 200_000, of: DataFrame | None = None) -> DataFrame:
    """df, to be broadcast if it has at most `most` rows: they are counted, up to one more. Else Spark joins it as it finds best. of: a table with as many rows
    or more that is counted in its place, where df would have to be worked out first."""
    return F.broadcast(df) if (df if of is None else of).limit(most + 1).count() <= most else df


def spread(df: DataFrame, most: int = 32 << 20) -> DataFrame:
    """A small table's rows dealt out to all cores: one of a single row group would be worked on by one task. Larger tables stay as they are read."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if size <= most and cores > 1 else df


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; a session on one machine gets a local one where that is unset."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="factloom-")
        spark.sparkContext.setCheckpointDir(found)
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, removed when the driver's Python ends."""
    path = f"{shared_dir(spark)}/factloom-{name}-{uuid.uuid4().hex}"
    atexit.register(_remove, spark, path)
    return path


def _remove(spark: SparkSession, path: str) -> None:
    try:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # noqa: BLE001 - the session may have ended first
        pass


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder: worked out once, and not lost with an executor."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents, for queries that work on their texts."""
    return spread(table(spark, sf_dir, "documents"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the Parquet tables in a directory."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
