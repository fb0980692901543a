"""Results to files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dump_items(df: DataFrame, path: str, rows_per_file: int | None = None) -> None:
    """JSON lines; with rows_per_file no file has more."""
    w = df.write.mode("overwrite")
    (w.option("maxRecordsPerFile", rows_per_file) if rows_per_file else w).json(path)


def dump_statements(df: DataFrame, path: str, column: str = "statement") -> None:
    df.where(F.col(column).isNotNull()).select(column).write.mode("overwrite").text(path)


def dump_split(df: DataFrame, ok: Column, path: str, other_path: str) -> None:
    """Rows that are ok, and the others, from one persisted pass."""
    df = df.persist()
    try:
        df.where(ok).write.mode("overwrite").json(path)
        df.where(~F.coalesce(ok, F.lit(False))).write.mode("overwrite").json(other_path)
    finally:
        df.unpersist()


def dump_sheet(df: DataFrame, path: str) -> None:
    """A sheet with sorted columns."""
    df.select(*sorted(df.columns)).write.mode("overwrite").csv(path, header=True, quoteAll=True)


def dump_by(df: DataFrame, column: str, path: str) -> None:
    df.write.mode("overwrite").partitionBy(column).json(path)


def dump_ranking(df: DataFrame, score: str, key: str, path: str) -> None:
    """A ranking in one ordered file: rankings are cut to a few rows before."""
    df.orderBy(F.desc(score), key).coalesce(1).write.mode("overwrite").json(path)


def save_model(model: object, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> object:
    from pyspark.ml import PipelineModel

    return PipelineModel.load(path)
