"""What the operators share: intermediate tables that outlive executors, and joins on hot keys."""

from __future__ import annotations

import atexit
import pickle
import tempfile
import uuid

import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.session import ship

#: Arrow batches of texts: Spark's default of 64 MB is held several times at once, by the JVM and by each worker.
BATCH_BYTES = "8m"


def start(df: DataFrame) -> SparkSession:
    """What an operator with Python code needs of the session of df."""
    spark = df.sparkSession
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Where that is unset, a session on one machine (as in tests) gets a local one; on a cluster it is an
    error, as executors don't share such a folder."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="factloom-")
        spark.sparkContext.setCheckpointDir(found)
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, removed when the driver's Python ends."""
    path = f"{shared_dir(spark)}/factloom-{name}-{uuid.uuid4().hex}"
    atexit.register(_remove, spark, path)
    return path


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # noqa: BLE001 - the session may have ended first
        pass


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """What Python reads and writes a path of the shared folder with."""
    return pafs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


def stored(spark: SparkSession, value: object, name: str) -> str:
    """A driver's object as a file of the shared folder, which tasks load when they need it: no plan or closure holds it."""
    path = new_path(spark, name)
    fs, at = filesystem(path)
    fs.create_dir(at.rsplit("/", 1)[0], recursive=True)
    with fs.open_output_stream(at, compression=None) as f:
        f.write(pickle.dumps(value, protocol=5))
    return path


def loaded(path: str) -> object:
    fs, at = filesystem(path)
    with fs.open_input_stream(at, compression=None) as f:
        return pickle.loads(f.read())  # noqa: S301 - written by stored()


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder: computed once, lineage cut, and not lost with an executor."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scan_bytes(df: DataFrame, each: int = 16 << 20) -> int:
    """What Spark estimates df to hold, from the files that it reads; where it has no estimate, `each` for every shuffle partition of the session. A
    plan's size may depend on it, results may not."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size if size < 1 << 56 else each * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def salted_join(big: DataFrame, small: DataFrame, key: str, salt_of: Column, how: str = "inner", hot_rows: int = 200_000, counts: DataFrame | None = None) -> DataFrame:
    """Equi-join in which a key with over hot_rows rows of `big` is spread over several salts.

    `small` must have few rows for each key; its rows of hot keys are repeated once for each salt.
    counts: key and count of `big`, where they are known already.
    At most count(big) / hot_rows keys can be hot, so the table of hot keys is small and is broadcast.
    """
    hot = (big.groupBy(key).count() if counts is None else counts).where(F.col("count") > hot_rows).select(key, F.ceil(F.col("count") / hot_rows).cast("int").alias("_salts"))
    hot = written(hot, "hot-keys")
    if not hot.take(1):
        return big.join(small, key, how)
    salts = F.coalesce("_salts", F.lit(1))
    left = big.join(F.broadcast(hot), key, "left").withColumn("_salt", F.pmod(F.xxhash64(salt_of), salts).cast("int")).drop("_salts")
    right = small.join(F.broadcast(hot), key, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("_salts")
    return left.join(right, [key, "_salt"], how).drop("_salt")


def smallest_hashes(df: DataFrame, column: str, rows: int) -> DataFrame:
    """Rows with the smallest hashes of a column, about twice as many as `rows`, or all of a smaller table: a bound on the hash instead of an
    order, so that no task passes on more than its share."""
    total = df.count()
    if total <= 2 * rows:
        return df
    return df.where(F.xxhash64(column) <= int(-(2**63) + 2 * rows / total * 2**64))
