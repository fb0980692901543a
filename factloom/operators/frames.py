"""Frame labelling and scores of frame elements."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from factloom.session import sized


def first_frame(tags: DataFrame, frames: DataFrame, key: list[str], position: str) -> DataFrame:
    """For each sentence the first tag that evokes a frame: lemma equal, and part of speech beginning with the frame's."""
    met = tags.join(sized(frames.withColumnRenamed("pos", "frame_pos")), "lemma").where(F.col("pos").startswith(F.col("frame_pos")))
    return met.withColumn("_n", F.row_number().over(W.partitionBy(*key).orderBy(position, "frame"))).where("_n = 1").drop("_n", "frame_pos")


def assign_elements(entities: DataFrame, elements: DataFrame, key: list[str], entity: str) -> DataFrame:
    """entities (with types array) joined with elements (fe, core, class): of an entity's types the first that the frame knows counts, core
    elements come before others, then the least name; entities with more types are ranked first."""
    each = entities.select("*", F.posexplode("types").alias("type_no", "class"))
    met = each.join(sized(elements), "class")
    w = W.partitionBy(*key, entity).orderBy("type_no", F.desc("core"), "fe")
    out = met.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n", "type_no")
    return out.withColumn("entity_rank", F.row_number().over(W.partitionBy(*key).orderBy(F.desc(F.size("types")), entity)))


def compatible(a: Column, b: Column) -> Column:
    """Types may go together: one side has none, or they share one."""
    return (F.size(a) <= 0) | (F.size(b) <= 0) | F.arrays_overlap(a, b)


def sentence_scores(elements: DataFrame, key: list[str], score: str, core: Column, weight: float = 2.0) -> DataFrame:
    """Mean, weighted mean and weighted harmonic mean of the scores of a sentence; core elements have `weight`. Null without scores."""
    w = F.when(core, F.lit(weight)).otherwise(F.lit(1.0))
    rows = elements.where(F.col(score).isNotNull()).withColumn("_w", w)
    return rows.groupBy(*key).agg(
        F.avg(score).alias("arithmetic"), (F.sum(F.col("_w") * F.col(score)) / F.sum("_w")).alias("weighted"),
        F.when(F.min(score) > 0, F.sum("_w") / F.sum(F.col("_w") / F.col(score))).otherwise(F.lit(0.0)).alias("harmonic"),
    )


def prioritized(elements: DataFrame, key: list[str], chunk: str, priority: Column, tie: str) -> DataFrame:
    """One element for each chunk: the one of highest priority, of several the last by tie."""
    w = W.partitionBy(*key, chunk).orderBy(priority.desc(), F.desc(tie))
    return elements.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")
