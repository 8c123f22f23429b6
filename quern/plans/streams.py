"""Streaming queries: the tables are replayed as file streams."""

from pyspark.sql import functions as F

from quern.plans.registry import query
from quern.streaming import trailing


@query("k01_streaming_trailing_count", """
SELECT a.event_id, a.user_id, count(*) AS n FROM events a JOIN events b ON a.user_id = b.user_id
  AND b.ts >= a.ts - INTERVAL 3 SECOND AND (b.ts < a.ts OR (b.ts = a.ts AND b.event_id <= a.event_id)) GROUP BY 1, 2""")
def streaming_trailing_count(t):
    events = trailing.stream_parquet(t.spark, t.directory, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    late = trailing.disorder(t.spark, t.directory, "events", "ts")
    hot = trailing.busy_keys(t.spark, t.directory, "events", "user_id")
    told = trailing.replay(trailing.trailing_counts(events, "user_id", "ts", "event_id", late=late, hot=hot), "trailing")
    return told.groupBy("event_id", "user_id").agg(F.max("n").alias("n")).select("user_id", "event_id", "n")


@query("k02_streaming_top", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""")
def streaming_top(t):
    orders = trailing.stream_parquet(t.spark, t.directory, "orders")
    return trailing.running_top(orders, [F.desc("o_totalprice"), F.asc("o_orderkey")], ["o_orderkey", "o_totalprice"], 10, "top")
