"""Searches in a knowledge base that is held as tables: labels (id, label, lang), pages (title, id) and claims (id, property, value)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W


def search(terms: DataFrame, labels: DataFrame, pages: DataFrame, term: str = "term", limit: int = 15) -> DataFrame:
    """term, id and rank of hits: entities whose label equals the term whatever the case, then pages of that title; duplicates stay, the first
    `limit` of each search count."""
    key = F.lower(F.trim(term)).alias("_key")
    want = terms.select(term, key)
    found = want.join(labels.select(F.lower("label").alias("_key"), "id"), "_key").select(term, F.lit(0).alias("_search"), "id")
    other = want.join(pages.select(F.lower("title").alias("_key"), "id"), "_key").select(term, F.lit(1).alias("_search"), "id")
    by = W.partitionBy(term, "_search").orderBy("id")
    kept = found.unionByName(other).withColumn("_n", F.row_number().over(by)).where(F.col("_n") <= limit)
    return kept.withColumn("rank", F.row_number().over(W.partitionBy(term).orderBy("_search", "_n"))).select(term, "id", "rank")


def of_type(hits: DataFrame, claims: DataFrame, types: list[str], property_: str = "P31") -> DataFrame:
    """Hits that are an instance of one of the types."""
    return hits.join(claims.where((F.col("property") == property_) & F.col("value").isin(*types)).select("id"), "id", "left_semi")


def items_of_urls(df: DataFrame, pages: DataFrame, url: str = "url") -> DataFrame:
    """df with the id of the page that its URL's last segment names; null without one."""
    return df.withColumn("title", title_of(F.col(url))).join(pages, "title", "left")


def title_of(url: Column) -> Column:
    return F.replace(F.url_decode(F.element_at(F.split(F.regexp_replace(url, r"[?#].*$", ""), "/"), -1)), F.lit("_"), F.lit(" "))


def names(labels: DataFrame, lang: str) -> DataFrame:
    """id and its label in a language, else in English, else any: the least."""
    order = F.when(F.col("lang") == lang, 0).when(F.col("lang") == "en", 1).otherwise(2)
    return labels.groupBy("id").agg(F.min_by("label", F.struct(order, F.col("label"))).alias("label"))
