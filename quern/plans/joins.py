"""Join queries."""

from pyspark.sql import functions as F

from quern.functions import expressions as X
from quern.functions import text as T
from quern.operators import intervals, joins
from quern.plans.registry import query
from quern.tables import cents, day


def _at(text):
    return F.lit(text).cast("timestamp_ntz")


@query("d01_inner_join_distinct", """
SELECT DISTINCT p_partkey, p_name FROM part JOIN lineitem ON p_partkey = l_partkey
WHERE l_shipdate BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1997-03-31'""")
def inner_join_distinct(t):
    """Duplicates are dropped before the join, where a hot part is already one row."""
    sold = t.lineitem.filter(F.col("l_shipdate").between(_at("1997-01-01"), _at("1997-03-31")))
    return sold.select("l_partkey").distinct().join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        "p_partkey", "p_name")


@query("d02_join_filter_sum", """
SELECT round(sum(l_quantity * l_extendedprice), 2) AS sales FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
WHERE r_name = 'ASIA' AND l_shipdate >= TIMESTAMP '1998-04-01' AND l_shipdate < TIMESTAMP '1998-05-01'""")
def join_filter_sum(t):
    asia = t.supplier.join(t.geography().filter("r_name = 'ASIA'"), F.col("s_nationkey") == F.col("n_nationkey"))
    sold = t.lineitem.filter((F.col("l_shipdate") >= _at("1998-04-01")) & (F.col("l_shipdate") < _at("1998-05-01")))
    return joins.lookup(sold.select("l_suppkey", "l_quantity", "l_extendedprice"), asia.select("s_suppkey"),
                        [("l_suppkey", "s_suppkey")]).agg(
        F.round(F.sum(F.col("l_quantity") * F.col("l_extendedprice")), 2).alias("sales"))


_ONLY_SQL = """
SELECT DISTINCT o_custkey FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1995-01-01' AND TIMESTAMP '1999-12-31'
AND o_custkey NOT IN (SELECT o_custkey FROM orders
  WHERE o_orderdate NOT BETWEEN TIMESTAMP '1995-01-01' AND TIMESTAMP '1999-12-31')"""


@query("d03_only_in_period", _ONLY_SQL)
def only_in_period(t):
    """One pass: first and last order both inside the period."""
    return t.orders.groupBy("o_custkey").agg(
        F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b")
    ).filter((F.col("a") >= _at("1995-01-01")) & (F.col("b") <= _at("1999-12-31"))).select("o_custkey")


@query("d03_anti_join", _ONLY_SQL)
def anti_join(t):
    inside = F.col("o_orderdate").between(_at("1995-01-01"), _at("1999-12-31"))
    seen = t.orders.filter(inside).select("o_custkey").distinct()
    return seen.join(t.orders.filter(~inside).select("o_custkey").distinct(), "o_custkey", "left_anti")


@query("d04_set_difference", """
SELECT o_custkey FROM orders WHERE year(o_orderdate) = 1996 EXCEPT
SELECT o_custkey FROM orders WHERE year(o_orderdate) = 1997""")
def set_difference(t):
    buyers = lambda y: t.orders.filter(
        (F.col("o_orderdate") >= _at(f"{y}-01-01")) & (F.col("o_orderdate") < _at(f"{y + 1}-01-01"))).select("o_custkey")
    return buyers(1996).subtract(buyers(1997))


@query("d05_rising_days", """
WITH d AS (SELECT o_orderstatus, CAST(o_orderdate AS DATE) AS dt,
             CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS total FROM orders GROUP BY 1, 2)
SELECT a.o_orderstatus, strftime(a.dt, '%Y-%m-%d') AS dt, a.total FROM d a JOIN d b
ON a.o_orderstatus = b.o_orderstatus AND a.dt = b.dt + 1 WHERE a.total > b.total""")
def rising_days(t):
    """Equality on the next day, instead of a date difference that compares all pairs."""
    days = t.orders.groupBy("o_orderstatus", F.to_date("o_orderdate").alias("dt")).agg(
        F.sum(cents("o_totalprice")).alias("total"))
    before = days.select("o_orderstatus", F.date_add("dt", 1).alias("dt"), F.col("total").alias("past"))
    return days.join(before, ["o_orderstatus", "dt"]).filter("total > past").select(
        "o_orderstatus", day("dt").alias("dt"), "total")


def order_intervals(t):
    """Open time of each order: order date to its last shipment."""
    shipped = t.lineitem.groupBy("l_orderkey").agg(F.max("l_shipdate").alias("s"))
    return t.orders.join(shipped, F.col("o_orderkey") == F.col("l_orderkey")).select(
        "o_custkey", "o_orderpriority", F.to_date("o_orderdate").alias("start"),
        F.to_date(F.greatest("o_orderdate", "s")).alias("end"))


INTERVALS_SQL = """iv AS (SELECT o_custkey, o_orderpriority, CAST(o_orderdate AS DATE) AS s,
  CAST(greatest(o_orderdate, max(l_shipdate)) AS DATE) AS e
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey, o_custkey, o_orderpriority, o_orderdate)"""


@query("d06_points_in_intervals", f"""
WITH {INTERVALS_SQL}, p AS (SELECT DISTINCT o_orderpriority, CAST(o_orderdate AS DATE) AS dt FROM orders)
SELECT p.o_orderpriority, strftime(dt, '%Y-%m-%d') AS dt, count(s) AS n
FROM p LEFT JOIN iv ON iv.o_orderpriority = p.o_orderpriority AND dt BETWEEN s AND e GROUP BY 1, 2""")
def points_in_intervals(t):
    points = t.orders.select("o_orderpriority", F.to_date("o_orderdate").alias("at"))
    return intervals.cover_counts(order_intervals(t), points, ["o_orderpriority"]).select(
        "o_orderpriority", day("at").alias("dt"), "n")


_BRACKETS = [(100000, 10), (250000, 20), (1000000000, 35)]


@query("d07_bracket_lookup", """
SELECT o_orderkey, round(least(o_totalprice, 100000) * 0.10 + greatest(least(o_totalprice, 250000) - 100000, 0) * 0.20
  + greatest(o_totalprice - 250000, 0) * 0.35, 4) AS tax FROM orders""")
def bracket_lookup(t):
    return t.orders.select("o_orderkey", F.round(X.bracket_tax(F.col("o_totalprice"), _BRACKETS), 4).alias("tax"))


@query("d08_pairs_with_sum", """
WITH c AS (SELECT p_type, p_size AS v, count(*) AS n FROM part GROUP BY 1, 2)
SELECT a.p_type, CAST(sum(CASE WHEN a.v * 2 = 50 THEN a.n // 2 ELSE least(a.n, b.n) END) AS BIGINT) AS operations
FROM c a JOIN c b ON a.p_type = b.p_type AND b.v = 50 - a.v WHERE a.v * 2 <= 50 GROUP BY 1""")
def pairs_with_sum(t):
    return joins.pair_operations(t.part, ["p_type"], "p_size", 50)


@query("d09_pairs_at_distance", """
WITH v AS (SELECT DISTINCT c_mktsegment, CAST(floor(c_acctbal) AS BIGINT) AS low FROM customer)
SELECT a.c_mktsegment, a.low, b.low AS high FROM v a JOIN v b ON a.c_mktsegment = b.c_mktsegment AND b.low = a.low + 5""")
def pairs_at_distance(t):
    whole = t.customer.select("c_mktsegment", F.floor("c_acctbal").alias("v"))
    return joins.pairs_at_distance(whole, ["c_mktsegment"], "v", 5).orderBy("c_mktsegment", "low")


@query("d10_closest_pairs", """
WITH v AS (SELECT DISTINCT c_mktsegment, CAST(round(c_acctbal * 100) AS BIGINT) AS high FROM customer),
 g AS (SELECT *, lag(high) OVER (PARTITION BY c_mktsegment ORDER BY high) AS low FROM v),
 d AS (SELECT *, high - low AS gap FROM g WHERE low IS NOT NULL)
SELECT c_mktsegment, low, high, gap FROM d
WHERE gap = (SELECT min(gap) FROM d x WHERE x.c_mktsegment = d.c_mktsegment)""")
def closest_pairs(t):
    return intervals.closest_pairs(t.customer.select("c_mktsegment", cents("c_acctbal").alias("v")), ["c_mktsegment"], "v")


@query("d11_nearest_item", """
WITH s AS (SELECT event_id, user_id, event_type,
  row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events),
p AS (SELECT *, CASE WHEN event_type = 'purchase' THEN i END AS h FROM s)
SELECT event_id, user_id, coalesce(least(
  i - max(h) OVER (PARTITION BY user_id ORDER BY i ROWS UNBOUNDED PRECEDING),
  min(h) OVER (PARTITION BY user_id ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) - i), -1) AS distance
FROM p""")
def nearest_item(t):
    e = t.events.select("event_id", "user_id", "event_type", "ts")
    return intervals.nearest_item(e, ["user_id"], ["ts", "event_id"], "event_type", "purchase").select(
        "event_id", "user_id", "distance")


VOCABULARY_SQL = r"""vocab AS (SELECT DISTINCT w FROM (
  SELECT unnest(regexp_split_to_array(lower(text), '[^\p{L}\p{N}_]+')) AS w FROM documents)
  WHERE regexp_full_match(w, '[a-z]{3,}'))"""


def vocabulary(t):
    return t.documents.select(F.explode(F.array_distinct(T.tokens(F.col("text")))).alias("word")).distinct()


@query("d12_one_letter_neighbours", f"""
WITH {VOCABULARY_SQL.replace("vocab AS (", "vocab AS MATERIALIZED (")}, m AS MATERIALIZED (SELECT w, unnest(list_transform(range(1, length(w) + 1),
  lambda i: substring(w, 1, CAST(i AS INTEGER) - 1) || '_' || substring(w, CAST(i AS INTEGER) + 1))) AS mask FROM vocab)
SELECT l[i] AS a, unnest(l[i + 1:]) AS b FROM (SELECT l, unnest(range(1, len(l))) AS i FROM (SELECT list(w ORDER BY w) AS l FROM m GROUP BY mask))""")
def one_letter_neighbours(t):
    return joins.one_letter_neighbours(vocabulary(t), "word")


def order_tasks(t):
    """Orders as tasks: each waits for up to three earlier order keys; 'F' ones have a result."""
    k = F.col("o_orderkey")
    waits = F.filter(F.array(F.floor(k / 2), k - 1, k - 7), lambda d: (d >= 0) & (d < k))
    return t.orders.select(
        k.alias("task_id"), waits.alias("depends_on"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority")).alias("result"))


@query("d13_dependency_context", """
WITH d AS (SELECT o_orderkey AS task_id, unnest([o_orderkey // 2, o_orderkey - 1, o_orderkey - 7]) AS dep,
             unnest([1, 2, 3]) AS pos FROM orders),
 r AS (SELECT o_orderkey AS id, o_orderpriority AS result FROM orders WHERE o_orderstatus = 'F')
SELECT o_orderkey AS task_id, coalesce(string_agg('[Result from ' || dep || ']' || chr(10) || result,
    chr(10) || chr(10) ORDER BY pos), '') AS context
FROM orders LEFT JOIN (SELECT * FROM d JOIN r ON r.id = d.dep WHERE dep >= 0 AND dep < task_id) x ON task_id = o_orderkey
GROUP BY 1""")
def dependency_context(t):
    return joins.dependency_context(order_tasks(t))
