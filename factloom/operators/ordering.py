"""Order and position: numbers of rows over a whole table without sorting it in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

LEVEL = 4096


def global_index(df: DataFrame, bucket: Column, order: list, name: str = "id") -> DataFrame:
    """Rows numbered from 0 by (bucket, order). bucket: a number, a monotonic coarse form of the order's first column, so that a bucket fits a task;
    sums of buckets are added up first, rows are numbered within theirs."""
    rows = df.withColumn("_bucket", bucket)
    counts = rows.groupBy("_bucket").agg(F.count("*").alias("_n"))
    # Buckets are added up in groups of LEVEL first, so that no window holds more than LEVEL buckets, or all groups.
    counts = counts.withColumn("_group", F.floor(F.col("_bucket") / LEVEL))
    groups = counts.groupBy("_group").agg(F.sum("_n").alias("_g"))
    groups = groups.select("_group", F.coalesce(F.sum("_g").over(W.orderBy("_group").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_start"))
    before = W.partitionBy("_group").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.join(groups, "_group").select("_bucket", (F.col("_start") + F.coalesce(F.sum("_n").over(before), F.lit(0))).alias("_before"))
    own = F.row_number().over(W.partitionBy("_bucket").orderBy(*order))
    return rows.withColumn("_own", own).join(starts, "_bucket").withColumn(name, F.col("_before") + F.col("_own") - 1).drop("_bucket", "_own", "_before")


def segments(df: DataFrame, group: list[str], order: list, header: Column, name: str = "segment") -> DataFrame:
    """A running number of header rows: rows before the first header have 0."""
    return df.withColumn(name, F.sum(F.when(header, 1).otherwise(0)).over(W.partitionBy(*group).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)))


def adjacent_groups(df: DataFrame, group: list[str], order: list, value: str, name: str = "run") -> DataFrame:
    """A number for each stretch of neighbouring rows of equal value."""
    w = W.partitionBy(*group).orderBy(*order)
    new = ~F.col(value).eqNullSafe(F.lag(value).over(w)) | (F.row_number().over(w) == 1)
    return df.withColumn("_new", new.cast("int")).withColumn(name, F.sum("_new").over(w.rowsBetween(W.unboundedPreceding, 0))).drop("_new")


def context(df: DataFrame, group: list[str], order: list, column: str, width: int) -> DataFrame:
    """Columns column_m2 .. column_p2: the values up to width rows before and after; null beyond the ends."""
    w = W.partitionBy(*group).orderBy(*order)
    return df.withColumns({f"{column}_{'m' if k < 0 else 'p'}{abs(k)}": (F.lag(column, -k) if k < 0 else F.lead(column, k)).over(w) for k in range(-width, width + 1) if k})
