"""Queries over event time. Streams are an extension: the same plans run on readStream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.plans.base import query
from factloom.session import table
from factloom.streaming import events


@query("SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M') AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def events_windowed(spark: SparkSession, d: str) -> DataFrame:
    out = events.tumbling(table(spark, d, "events"))
    return out.select(F.date_format("start", "yyyy-MM-dd HH:mm").alias("start"), "event_type", "n", F.round("total", 4).alias("total"))


@query(
    """WITH f AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM f)
SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS start, count(*) AS n FROM s GROUP BY user_id, s"""
)
def event_sessions(spark: SparkSession, d: str) -> DataFrame:
    out = events.sessions(table(spark, d, "events"))
    return out.select("user_id", F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("start"), "n")
