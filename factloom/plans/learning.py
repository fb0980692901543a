"""Queries of the learning family."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.operators import learning
from factloom.plans.base import query
from factloom.session import table


@query(
    """WITH q AS (SELECT vec_id, embedding::DOUBLE[] AS e, label FROM embeddings WHERE vec_id % 20 = 0), b AS (SELECT vec_id AS other, embedding::DOUBLE[] AS e, label AS found FROM embeddings),
r AS (SELECT q.vec_id, q.label, other, found, list_sum(list_transform(list_zip(q.e, b.e), lambda x: (x[1] - x[2]) * (x[1] - x[2]))) AS dist FROM q, b WHERE other <> vec_id
QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY round(dist, 6), other) <= 5),
v AS (SELECT vec_id, label, found, count(*) AS votes FROM r GROUP BY ALL)
SELECT vec_id, label, found AS predicted FROM v QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY votes DESC, found) = 1"""
)
def knn_label(spark: SparkSession, d: str) -> DataFrame:
    """The stated query set, rows with an id divisible by 20, against all rows, in blocks."""
    rows = table(spark, d, "embeddings")
    return learning.knn(rows.where("vec_id % 20 = 0"), rows, 5)


_CONF = "(SELECT CAST(toxic = 0 AS INT) AS predicted, quality AS actual FROM labels)"


@query(
    f"""WITH c AS (SELECT predicted, actual, count(*) AS n FROM {_CONF} GROUP BY ALL), k AS (SELECT DISTINCT actual AS k FROM c UNION SELECT predicted FROM c),
s AS (SELECT k, coalesce((SELECT sum(n) FROM c WHERE predicted = k AND actual = k), 0) AS tp, coalesce((SELECT sum(n) FROM c WHERE predicted = k), 0) AS p, coalesce((SELECT sum(n) FROM c WHERE actual = k), 0) AS a FROM k)
SELECT round(avg(CASE WHEN p + a > 0 THEN 2.0 * tp / (p + a) ELSE 0 END), 6) AS macro_f1, round(sum(a * CASE WHEN p + a > 0 THEN 2.0 * tp / (p + a) ELSE 0 END) / sum(a), 6) AS weighted_f1 FROM s"""
)
def f1_macro(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "labels").select((F.col("toxic") == 0).cast("int").alias("predicted"), F.col("quality").alias("actual"))
    return learning.f1(rows, "predicted", "actual").select(F.round("macro_f1", 6).alias("macro_f1"), F.round("weighted_f1", 6).alias("weighted_f1"))


@query("SELECT fold, count(*) AS n, round(avg(quality), 6) AS score FROM (SELECT *, CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) % 5 AS fold FROM labels) GROUP BY fold")
def fold_scores(spark: SparkSession, d: str) -> DataFrame:
    rows = learning.folds(table(spark, d, "labels"), F.col("doc_id").cast("string"), 5)
    return rows.groupBy("fold").agg(F.count("*").alias("n"), F.round(F.avg("quality"), 6).alias("score"))


@query("SELECT min(s) AS low, max(s) AS high, round(avg(s), 6) AS mean, median(s) AS middle FROM (SELECT lang, count(*)::DOUBLE AS s FROM documents GROUP BY lang)")
def score_summary(spark: SparkSession, d: str) -> DataFrame:
    by = table(spark, d, "documents").groupBy("lang").agg(F.count("*").cast("double").alias("s"))
    return by.agg(F.min("s").alias("low"), F.max("s").alias("high"), F.round(F.avg("s"), 6).alias("mean"), F.median("s").alias("middle"))


@query("SELECT p_type AS chunk, string_agg(p_brand, ' ' ORDER BY p_brand) AS features FROM (SELECT DISTINCT p_type, p_brand FROM part) GROUP BY p_type")
def gazetteer_reverse(spark: SparkSession, d: str) -> DataFrame:
    """Feature to chunks, turned into chunk to features."""
    index = table(spark, d, "part").groupBy(F.col("p_brand").alias("feature")).agg(F.collect_set("p_type").alias("chunks"))
    return learning.reverse(index, "feature", "chunks").select("chunk", F.array_join("features", " ").alias("features"))


@query(
    """WITH h AS (SELECT doc_id, quality, CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE AS h FROM labels),
c AS (SELECT quality AS c, sum(count(*)) OVER (ORDER BY quality) / sum(count(*)) OVER () AS u FROM labels GROUP BY quality)
SELECT doc_id, quality, (SELECT min(c) FROM c WHERE h.h < u) AS predicted FROM h"""
)
def dummy_baseline(spark: SparkSession, d: str) -> DataFrame:
    return learning.dummy(table(spark, d, "labels").select("doc_id", "quality"), "quality", "doc_id")


@query()
def svm_per_group(spark: SparkSession, d: str) -> DataFrame:
    """Linear classifiers of each group, fitted on four folds of its rows and asked for the fifth."""
    rows = learning.folds(table(spark, d, "embeddings").withColumn("unit", (F.col("vec_id") % 4).cast("int")), F.col("vec_id").cast("string"), 5)
    models = learning.fit_bank(rows.where("fold <> 0"), "unit", "embedding", "label", "vec_id")
    return learning.predict_bank(rows.where("fold = 0"), models, "unit", "embedding").select("vec_id", "unit", F.col("label").cast("int").alias("label"), F.col("predicted").cast("int").alias("predicted"))


@query()
def grid_search(spark: SparkSession, d: str) -> DataFrame:
    """Cross-validated estimators over embeddings, and the best of each family."""
    rows = table(spark, d, "embeddings").withColumn("target", (F.col("label") % 2).cast("double"))
    return learning.model_selection(rows, "embedding", "target", key="vec_id")
