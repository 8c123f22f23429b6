"""Window and sequence queries; the sequences are each user's events in time order."""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quern.operators import intervals, sequence
from quern.operators.ordered import Ordered, ntile, ranked, running
from quern.plans.joins import INTERVALS_SQL, order_intervals
from quern.plans.registry import query
from quern.tables import cents, day, micros, month

_ORDER = ["ts", "event_id"]
_TYPES = ["view", "click", "signup", "purchase", "error"]
_SEQ = """s AS (SELECT event_id, user_id, ts, event_type, CAST(round(value * 100) AS BIGINT) AS v,
  row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events)"""
_RUNS = _SEQ + """, c AS (SELECT *, CASE WHEN event_type = lag(event_type) OVER (PARTITION BY user_id ORDER BY i)
  THEN 0 ELSE 1 END AS fresh FROM s),
r AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY i) AS run FROM c),
g AS (SELECT user_id, run, min(event_type) AS event_type, count(*) AS length, sum(v) AS total, max(v) AS top
  FROM r GROUP BY 1, 2)"""


def events(t):
    return t.events.select("user_id", "ts", "event_id", "event_type", cents("value").alias("v"))


@query("f01_rank", """
WITH v AS (SELECT o_custkey, o_orderpriority, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS spend
  FROM orders GROUP BY 1, 2)
SELECT o_orderpriority, o_custkey, spend, rank() OVER (PARTITION BY o_orderpriority ORDER BY spend DESC) AS rank FROM v""")
def rank(t):
    spend = t.orders.groupBy("o_custkey", "o_orderpriority").agg(F.sum(cents("o_totalprice")).alias("spend"))
    return ranked(spend, ["o_orderpriority"], "spend", "o_custkey").rows().drop("row_number", "size")


@query("f02_lag_lead", """
WITH m AS (SELECT o_orderpriority, strftime(o_orderdate, '%Y-%m') AS m, count(*) AS n FROM orders GROUP BY 1, 2)
SELECT *, coalesce(lag(n) OVER w, 0) AS before, coalesce(lead(n) OVER w, 0) AS after FROM m
WINDOW w AS (PARTITION BY o_orderpriority ORDER BY m)""")
def lag_lead(t):
    """Monthly counts first: a window partition then holds one row per calendar month."""
    months = t.orders.groupBy("o_orderpriority", F.trunc("o_orderdate", "MM").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    w = W.partitionBy("o_orderpriority").orderBy("d")
    return months.select("o_orderpriority", month("d").alias("m"), "n", F.coalesce(F.lag("n").over(w), F.lit(0)).alias("before"),
                         F.coalesce(F.lead("n").over(w), F.lit(0)).alias("after"))


@query("f03_ntile", """
SELECT c_mktsegment, c_custkey, ntile(4) OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC, c_custkey) AS quartile
FROM customer""")
def quartiles(t):
    rows = ranked(t.customer.select("c_mktsegment", "c_custkey", "c_acctbal"), ["c_mktsegment"], "c_acctbal", "c_custkey")
    return rows.rows().select("c_mktsegment", "c_custkey", ntile(4).alias("quartile"))


def daily_counts(counts, keys, spine):
    """Counts on every day of the spine, 0 where there was none."""
    return spine.join(counts, [*keys, "dt"], "left").withColumn("n", F.coalesce("n", F.lit(0)))


@query("f04_rolling_average", """
WITH b AS (SELECT min(CAST(ts AS DATE)) AS a, max(CAST(ts AS DATE)) AS z FROM events),
 d AS (SELECT event_type, CAST(unnest(generate_series(a, z, INTERVAL 1 DAY)) AS DATE) AS dt
       FROM (SELECT DISTINCT event_type FROM events), b),
 n AS (SELECT event_type, CAST(ts AS DATE) AS dt, count(*) AS n FROM events GROUP BY 1, 2)
SELECT event_type, strftime(dt, '%Y-%m-%d') AS dt, round(avg(coalesce(n, 0)) OVER (
  PARTITION BY event_type ORDER BY dt ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 6) AS average
FROM d LEFT JOIN n USING (event_type, dt)""")
def rolling_average(t):
    counts = t.events.groupBy("event_type", F.to_date("ts").alias("dt")).agg(F.count(F.lit(1)).alias("n"))
    first, last = counts.agg(F.min("dt"), F.max("dt")).first()
    spine = counts.select("event_type").distinct().select(
        "event_type", F.explode(F.sequence(F.lit(first), F.lit(last))).alias("dt"))
    w = W.partitionBy("event_type").orderBy("dt").rowsBetween(-6, 0)
    return daily_counts(counts, ["event_type"], spine).select(
        "event_type", day("dt").alias("dt"), F.round(F.avg("n").over(w), 6).alias("average"))


@query("f05_cumulative_sum", """
SELECT event_id, user_id, CAST(sum(CAST(round(value * 100) AS BIGINT)) OVER (PARTITION BY user_id ORDER BY ts, event_id
  ROWS UNBOUNDED PRECEDING) AS BIGINT) AS upto FROM events""")
def cumulative_sum(t):
    return Ordered(events(t), ["user_id"], _ORDER).scan(upto=running("sum", "v")).rows().select(
        "event_id", "user_id", "upto")


@query("f06_filter_on_window", """
SELECT user_id, event_id, strftime(ts, '%Y-%m-%d') AS dt FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def filter_on_window(t):
    """Latest event per user: the row limit is applied before the shuffle."""
    w = W.partitionBy("user_id").orderBy(F.desc("ts"), F.desc("event_id"))
    e = t.events.select("user_id", "event_id", "ts").withColumn("rn", F.row_number().over(w))
    return e.filter("rn = 1").select("user_id", "event_id", day("ts").alias("dt"))


@query("f07_merge_intervals", f"""
WITH {INTERVALS_SQL}, m AS (SELECT *, max(e) OVER (PARTITION BY o_custkey ORDER BY s, e
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM iv),
 k AS (SELECT *, sum(CASE WHEN reach IS NULL OR s > reach THEN 1 ELSE 0 END) OVER (
   PARTITION BY o_custkey ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS island FROM m)
SELECT o_custkey, strftime(min(s), '%Y-%m-%d') AS start, strftime(max(e), '%Y-%m-%d') AS "end" FROM k GROUP BY o_custkey, island""")
def merge_intervals(t):
    merged = intervals.merge(order_intervals(t), ["o_custkey"])
    return merged.withColumns({"start": day("start"), "end": day("end")})


@query("f08_max_concurrent", f"""
WITH {INTERVALS_SQL}, d AS (SELECT o_orderpriority, s AS dt, 1 AS d FROM iv UNION ALL SELECT o_orderpriority, e, -1 FROM iv),
 n AS (SELECT o_orderpriority, sum(d) OVER (PARTITION BY o_orderpriority ORDER BY dt, d ROWS UNBOUNDED PRECEDING) AS rooms
   FROM d)
SELECT o_orderpriority, CAST(max(rooms) AS BIGINT) AS rooms FROM n GROUP BY 1""")
def max_concurrent(t):
    return intervals.max_concurrent(order_intervals(t), ["o_orderpriority"])


@query("f09_run_lengths", f"WITH {_RUNS} SELECT user_id, CAST(run AS BIGINT) AS run, event_type, length FROM g")
def run_lengths(t):
    return sequence.run_lengths(events(t), ["user_id"], _ORDER, "event_type")


@query("f09_encoded_size", f"""
WITH {_RUNS} SELECT user_id, CAST(sum(1 + CASE WHEN length > 1 THEN length(CAST(length AS VARCHAR)) ELSE 0 END) AS BIGINT)
  AS size FROM g GROUP BY 1""")
def encoded_size(t):
    return sequence.rle_size(events(t), ["user_id"], _ORDER, "event_type")


@query("f10_keep_one_per_run", f"WITH {_RUNS} SELECT user_id, CAST(sum(total - top) AS BIGINT) AS cost FROM g GROUP BY 1")
def keep_one_per_run(t):
    return sequence.keep_one_per_run(events(t), ["user_id"], _ORDER, "event_type", "v")


@query("f11_break_triples", f"WITH {_RUNS} SELECT user_id, CAST(sum(length // 3) AS BIGINT) AS changes FROM g GROUP BY 1")
def break_triples(t):
    return sequence.break_triples(events(t), ["user_id"], _ORDER, "event_type")


@query("f12_free_slots", f"""
WITH {_SEQ.replace("event_type,", "event_type = 'purchase' AS taken,")},
c AS (SELECT *, count(*) OVER (PARTITION BY user_id) AS n,
  CASE WHEN taken = lag(taken) OVER (PARTITION BY user_id ORDER BY i) THEN 0 ELSE 1 END AS fresh FROM s),
r AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY i) AS run FROM c),
g AS (SELECT user_id, run, bool_or(taken) AS taken, count(*) AS length, min(i) AS a, max(i) AS b, max(n) AS n FROM r GROUP BY 1, 2)
SELECT user_id, CAST(sum(CASE WHEN taken THEN 0 WHEN a = 1 AND b = n THEN (length + 1) // 2
  WHEN a = 1 OR b = n THEN length // 2 ELSE (length - 1) // 2 END) AS BIGINT) AS capacity,
  CAST(sum(CASE WHEN taken THEN 0 WHEN a = 1 AND b = n THEN (length + 1) // 2
  WHEN a = 1 OR b = n THEN length // 2 ELSE (length - 1) // 2 END) AS BIGINT) >= 25 AS fits FROM g GROUP BY 1""")
def free_slots(t):
    e = events(t).withColumn("taken", F.col("event_type") == "purchase")
    return sequence.free_slots(e, ["user_id"], _ORDER, "taken").withColumn("fits", F.col("capacity") >= 25)


@query("f13_beams", """
WITH n AS (SELECT p_type, p_size, count(*) AS n FROM part WHERE p_brand IN ('Brand#1', 'Brand#2') GROUP BY 1, 2),
 l AS (SELECT *, lag(n) OVER (PARTITION BY p_type ORDER BY p_size) AS prev FROM n)
SELECT p_type, CAST(coalesce(sum(n * prev), 0) AS BIGINT) AS beams FROM l GROUP BY 1""")
def beams(t):
    marked = t.part.withColumn("marked", F.col("p_brand").isin("Brand#1", "Brand#2"))
    return sequence.beams(marked, ["p_type"], "p_size", "marked")


def _circular_sql(k):
    low, high = (1, k) if k > 0 else (k, -1)
    return f"""
WITH {_SEQ}, n AS (SELECT user_id, count(*) AS n FROM s GROUP BY 1),
 x AS (SELECT s.user_id, event_id, i, n, unnest(range({low}, {high + 1})) AS o FROM s JOIN n USING (user_id)),
 y AS (SELECT user_id, event_id, ((i + o - 1) % n + n) % n + 1 AS j FROM x)
SELECT y.user_id, y.event_id, CAST(sum(s.v) AS BIGINT) AS circular FROM y JOIN s ON s.user_id = y.user_id AND s.i = y.j
GROUP BY 1, 2"""


@query("f14_circular_next", _circular_sql(3))
def circular_next(t):
    return sequence.circular_sum(events(t), ["user_id"], _ORDER, "v", 3).select("user_id", "event_id", "circular")


@query("f14_circular_previous", _circular_sql(-2))
def circular_previous(t):
    return sequence.circular_sum(events(t), ["user_id"], _ORDER, "v", -2).select("user_id", "event_id", "circular")


@query("f15_variable_frame", f"""
WITH {_SEQ}, w AS (SELECT user_id, i, v // 100 AS v FROM s)
SELECT a.user_id, CAST(sum(b.v) AS BIGINT) AS total FROM w a JOIN w b
ON a.user_id = b.user_id AND b.i BETWEEN a.i - a.v AND a.i GROUP BY 1""")
def variable_frame(t):
    whole = events(t).withColumn("v", F.floor(F.col("v") / 100))
    return sequence.variable_frame_sum(whole, ["user_id"], _ORDER, "v")


@query("f16_shortest_run", f"""
WITH {_SEQ}, p AS (SELECT user_id, i, sum(v) OVER (PARTITION BY user_id ORDER BY i) AS p FROM s
  UNION ALL SELECT DISTINCT user_id, 0, 0 FROM s)
SELECT u.user_id, CAST(coalesce(min(b.i - a.i), 0) AS BIGINT) AS shortest FROM (SELECT DISTINCT user_id FROM s) u
LEFT JOIN (p a JOIN p b ON a.user_id = b.user_id AND b.i > a.i AND b.p - a.p >= 100000) ON u.user_id = a.user_id
GROUP BY 1""")
def shortest_run(t):
    return sequence.shortest_run_reaching(events(t), ["user_id"], _ORDER, "v", 100000)


@query("f17_longest_without_repeat", f"""
WITH {_SEQ}, p AS (SELECT *, coalesce(lag(i) OVER (PARTITION BY user_id, event_type ORDER BY i), 0) AS prev FROM s),
 m AS (SELECT user_id, i, max(prev) OVER (PARTITION BY user_id ORDER BY i) AS start FROM p)
SELECT user_id, max(i - start) AS longest FROM m GROUP BY 1""")
def longest_without_repeat(t):
    return sequence.longest_without_repeat(events(t), ["user_id"], _ORDER, "event_type")


@query("f18_longest_with_two", f"""
WITH {_SEQ}, w AS (SELECT user_id, i, list_sort([{", ".join(
    f"coalesce(max(CASE WHEN event_type = '{e}' THEN i END) OVER p, 0)" for e in _TYPES)}], 'DESC') AS last
  FROM s WINDOW p AS (PARTITION BY user_id ORDER BY i ROWS UNBOUNDED PRECEDING))
SELECT user_id, max(i - last[3]) AS longest FROM w GROUP BY 1""")
def longest_with_two(t):
    return sequence.longest_with_distinct(events(t), ["user_id"], _ORDER, "event_type", 2)


@query("f19_top_values", """
SELECT user_id, event_type, n, CAST(r AS BIGINT) AS place FROM (SELECT user_id, event_type, count(*) AS n,
  row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, event_type) AS r FROM events GROUP BY 1, 2) WHERE r <= 3""")
def top_values(t):
    counts = t.events.groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    w = W.partitionBy("user_id").orderBy(F.desc("n"), "event_type")
    return counts.withColumn("place", F.row_number().over(w)).filter("place <= 3").withColumn(
        "place", F.col("place").cast("bigint"))


@query("f20_kth_value", """
SELECT o_orderpriority, max(CASE WHEN d = 4 THEN o_totalprice END) AS fourth_largest,
  max(CASE WHEN a = 4 THEN o_totalprice END) AS fourth_smallest
FROM (SELECT o_orderpriority, o_totalprice, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC) AS d,
  row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice) AS a FROM orders) GROUP BY 1""")
def kth_value(t):
    """Each side keeps only k rows per group before its shuffle."""
    def kth(order, name):
        w = W.partitionBy("o_orderpriority").orderBy(order)
        rows = t.orders.select("o_orderpriority", "o_totalprice").withColumn("rn", F.row_number().over(w))
        return rows.filter("rn = 4").select("o_orderpriority", F.col("o_totalprice").alias(name))
    groups = t.orders.select("o_orderpriority").distinct()  # a group with fewer rows keeps its line, with NULLs
    for found in (kth(F.desc("o_totalprice"), "fourth_largest"), kth(F.asc("o_totalprice"), "fourth_smallest")):
        groups = groups.join(found, "o_orderpriority", "left")
    return groups


@query("f21_every_third_free", """
SELECT o_custkey, CAST(sum(c) FILTER (WHERE rn % 3 <> 0) AS BIGINT) AS paid FROM (SELECT o_custkey,
  CAST(round(o_totalprice * 100) AS BIGINT) AS c, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC) AS rn
  FROM orders) GROUP BY 1""")
def every_third_free(t):
    priced = t.orders.select("o_custkey", "o_orderkey", cents("o_totalprice").alias("c"))
    rows = ranked(priced, ["o_custkey"], "c", "o_orderkey").rows()
    return rows.filter(F.col("row_number") % 3 != 0).groupBy("o_custkey").agg(F.sum("c").alias("paid"))


@query("f22_head_start", f"""
WITH {_SEQ}, p AS (SELECT user_id, event_id, v, coalesce(sum(v) OVER (PARTITION BY user_id ORDER BY i
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM s)
SELECT user_id, CAST(greatest(max(event_id - 100 - b + 1), 0) + greatest(sum(event_id % 7) - 20 + 1, 0) AS BIGINT) AS extra FROM p GROUP BY 1""")
def head_start(t):
    rows = events(t).withColumn("need", F.col("event_id")).withColumn("spent", F.col("event_id") % 7)
    return sequence.head_start(rows, ["user_id"], _ORDER, "v", "need", 100, "spent", 20)


@query("f23_repeated_pair", f"""
WITH {_SEQ}, l AS (SELECT user_id, i, event_type AS e, lag(event_type, 1) OVER w AS a, lag(event_type, 2) OVER w AS b,
  lag(event_type, 3) OVER w AS c, count(*) OVER (PARTITION BY user_id) AS n FROM s WINDOW w AS (PARTITION BY user_id ORDER BY i))
SELECT user_id, n >= 4 AND e = b AND a = c AS looping FROM l WHERE i = n""")
def repeated_pair(t):
    return sequence.repeated_pair(t.events, ["user_id"], _ORDER, F.col("event_type"))


@query("f24_trailing_count", """
SELECT a.event_id, a.user_id, count(*) FILTER (WHERE b.ts >= a.ts - INTERVAL 3 SECOND) AS in_3s, count(*) AS in_12h
FROM events a JOIN events b ON a.user_id = b.user_id AND b.ts >= a.ts - INTERVAL 12 HOUR
  AND (b.ts < a.ts OR (b.ts = a.ts AND b.event_id <= a.event_id)) GROUP BY 1, 2""")
def trailing_count(t):
    e = t.events.select("user_id", "event_id", micros("ts").alias("at"))
    short = sequence.trailing_count(e, ["user_id"], "at", "event_id", 3_000_000).withColumnRenamed("n", "in_3s")
    half_day = sequence.trailing_count(e, ["user_id"], "at", "event_id", 12 * 3_600_000_000)
    return short.join(half_day.select("event_id", F.col("n").alias("in_12h")), "event_id")


@query("f25_softmax", """
WITH m AS (SELECT event_id, event_type, value, max(value) OVER (PARTITION BY event_type) AS top FROM events)
SELECT event_id, event_type, round(exp(value - top) / sum(exp(value - top)) OVER (PARTITION BY event_type), 10) AS softmax
FROM m""")
def softmax(t):
    return sequence.softmax(t.events.select("event_id", "event_type", "value"), ["event_type"], ["event_id"], "value").select(
        "event_id", "event_type", F.round("softmax", 10).alias("softmax"))


@query("f27_reuse_distance", f"""
WITH {_SEQ}, k AS (SELECT user_id, i, v // 500 AS item FROM s),
p AS (SELECT *, lag(i) OVER (PARTITION BY user_id, item ORDER BY i) AS prev FROM k)
SELECT a.user_id, a.i, CAST(a.item AS BIGINT) AS item,
  CASE WHEN a.prev IS NULL THEN -1 ELSE count(DISTINCT b.item) END AS distance
FROM p a LEFT JOIN p b ON a.user_id = b.user_id AND b.i > a.prev AND b.i < a.i GROUP BY 1, 2, 3, a.prev""")
def reuse_distance(t):
    """Items are event values in steps of 5."""
    e = events(t).withColumn("item", F.floor(F.col("v") / 500))
    out = sequence.reuse_distance(e, ["user_id"], _ORDER, "item")
    return out.withColumn("distance", F.coalesce("distance", F.lit(-1).cast("bigint")))
