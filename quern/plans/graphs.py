"""Graph and tree queries."""

from pyspark.sql import functions as F

from quern.operators import graph
from quern.operators.ordered import Ordered, position, total
from quern.plans.joins import VOCABULARY_SQL, vocabulary
from quern.plans.registry import query
from quern.tables import cents

_NET = """e AS MATERIALIZED (WITH x AS (SELECT 's' || l_suppkey AS s, 'p' || l_partkey AS p,
   min(CAST(round(l_extendedprice * 100) AS BIGINT)) AS w FROM lineitem GROUP BY 1, 2)
  SELECT s AS src, p AS dst, w FROM x UNION ALL SELECT p, s, w FROM x)"""
_PATHS = f"""WITH RECURSIVE {_NET}, t(v, dist) USING KEY (v) AS (SELECT 's0', CAST(0 AS BIGINT)
 UNION SELECT e.dst, min(t.dist + e.w) FROM t JOIN e ON e.src = t.v LEFT JOIN recurring.t AS r ON r.v = e.dst
 WHERE r.dist IS NULL OR t.dist + e.w < r.dist GROUP BY e.dst)"""


def supplier_network(t):
    """Suppliers and parts, joined by the price of every line, in both directions: a view, of which paths take the lowest price."""
    both = t.lineitem.select(F.concat(F.lit("s"), "l_suppkey").alias("s"), F.concat(F.lit("p"), "l_partkey").alias("p"),
                             cents("l_extendedprice").alias("w"))
    return both.select(F.col("s").alias("src"), F.col("p").alias("dst"), "w").unionByName(
        both.select(F.col("p").alias("src"), F.col("s").alias("dst"), "w"))


@query("j01_shortest_paths", f"{_PATHS} SELECT v, dist FROM t")
def shortest_paths(t):
    return graph.shortest_paths(supplier_network(t), "s0", stored=True)


@query("j01_network_delay", f"""{_PATHS} SELECT CASE WHEN count(dist) = count(*) THEN max(dist) ELSE -1 END AS delay
FROM (SELECT DISTINCT src AS v FROM e) LEFT JOIN t USING (v)""")
def network_delay(t):
    edges = supplier_network(t)
    return graph.network_delay(edges, "s0", edges.select(F.col("src").alias("v")), stored=True)


_DAG = """e AS MATERIALIZED (SELECT DISTINCT a AS src, b AS dst FROM (SELECT min(l_partkey) AS a, max(l_partkey) AS b FROM lineitem
  GROUP BY l_orderkey) WHERE a < b), v AS MATERIALIZED (SELECT src AS v FROM e UNION SELECT dst FROM e)"""
_LEVELS = """l(v, level) AS (SELECT v, CAST(0 AS BIGINT) FROM v WHERE v NOT IN (SELECT dst FROM e)
  UNION SELECT e.dst, level + 1 FROM l JOIN e ON e.src = l.v)"""


def part_order(t):
    """Lowest part of an order before its highest: keys only grow, so there is no cycle."""
    ends = t.lineitem.groupBy("l_orderkey").agg(F.min("l_partkey").alias("src"), F.max("l_partkey").alias("dst"))
    return ends.filter("src < dst").select("src", "dst").distinct()


@query("j02_topological_levels", f"WITH RECURSIVE {_DAG}, {_LEVELS} SELECT v, max(level) AS level FROM l GROUP BY 1")
def topological_levels(t):
    edges = part_order(t)
    return graph.levels(edges, graph.vertices_of(edges))


def part_circle(t):
    """The same, but orders with an odd key point from the highest part to the lowest."""
    ends = t.lineitem.groupBy("l_orderkey").agg(F.min("l_partkey").alias("a"), F.max("l_partkey").alias("b"))
    odd = F.col("l_orderkey") % 2 == 1
    return ends.filter("a < b").select(
        F.when(odd, F.col("b")).otherwise(F.col("a")).alias("src"), F.when(odd, F.col("a")).otherwise(F.col("b")).alias("dst")).distinct()


_MIXED = """f AS MATERIALIZED (SELECT DISTINCT CASE WHEN l_orderkey % 2 = 1 THEN b ELSE a END AS src, CASE WHEN l_orderkey % 2 = 1 THEN a ELSE b END AS dst
  FROM (SELECT l_orderkey, min(l_partkey) AS a, max(l_partkey) AS b FROM lineitem GROUP BY 1) WHERE a < b)"""


@query("j03_acyclic", f"""
WITH RECURSIVE {_DAG}, {_MIXED}, r(a, b) AS (SELECT src, dst FROM e UNION SELECT r.a, e.dst FROM r JOIN e ON e.src = r.b),
 x(a, b) AS (SELECT src, dst FROM f UNION SELECT x.a, f.dst FROM x JOIN f ON f.src = x.b)
SELECT 'ascending' AS graph, (SELECT count(*) FROM v) AS vertices, NOT EXISTS (SELECT 1 FROM r WHERE a = b) AS acyclic
UNION ALL SELECT 'mixed', (SELECT count(*) FROM v), NOT EXISTS (SELECT 1 FROM x WHERE a = b)""")
def acyclic(t):
    """The first graph only has growing keys; the second holds two-way pairs or longer cycles."""
    one = graph.is_acyclic(part_order(t)).withColumn("graph", F.lit("ascending"))
    two = graph.is_acyclic(part_circle(t)).withColumn("graph", F.lit("mixed"))
    return one.unionByName(two).select("graph", "vertices", "acyclic")


@query("j04_letter_order", f"""
WITH RECURSIVE {VOCABULARY_SQL}, p AS (SELECT w AS b, lag(w) OVER (ORDER BY w) AS a FROM vocab),
 d AS (SELECT a, b, list_filter(range(1, least(length(a), length(b)) + 1), lambda i: substring(a, CAST(i AS INTEGER), 1) <>
   substring(b, CAST(i AS INTEGER), 1))[1] AS i FROM p WHERE a IS NOT NULL),
 e AS MATERIALIZED (SELECT DISTINCT substring(a, CAST(i AS INTEGER), 1) AS src, substring(b, CAST(i AS INTEGER), 1) AS dst FROM d WHERE i IS NOT NULL),
 v AS MATERIALIZED (SELECT DISTINCT unnest(string_split(w, '')) AS v FROM vocab), {_LEVELS}
SELECT v, max(level) AS level FROM l GROUP BY 1""")
def letter_order(t):
    words = Ordered(vocabulary(t), [], ["word"], settle=True).scan(i=position()).rows()
    return graph.letter_levels(words, "word")


_TREE = """e AS MATERIALIZED (SELECT o_orderkey // 2 AS src, o_orderkey AS dst FROM orders WHERE o_orderkey > 0), v AS (SELECT o_orderkey AS v FROM orders)"""


def order_heap(t):
    return t.orders.filter("o_orderkey > 0").select(F.floor(F.col("o_orderkey") / 2).alias("src"), F.col("o_orderkey").alias("dst"))


def supplier_edges(t):
    return t.lineitem.select(F.concat(F.lit("s"), "l_suppkey").alias("src"), F.concat(F.lit("p"), "l_partkey").alias("dst")).distinct()


def _reach(name, edges, first):
    return f"""{name} AS (SELECT {first} AS v UNION SELECT x.b FROM {name} JOIN (SELECT src AS a, dst AS b FROM {edges}
  UNION SELECT dst, src FROM {edges}) x ON x.a = {name}.v)"""


@query("j05_is_tree", f"""
WITH RECURSIVE {_TREE}, s AS MATERIALIZED (SELECT DISTINCT 's' || l_suppkey AS src, 'p' || l_partkey AS dst FROM lineitem),
 {_reach('r1', 'e', 'CAST(0 AS BIGINT)')}, {_reach('r2', 's', "'s0'")},
 n AS (SELECT 'orders' AS graph, (SELECT count(*) FROM v) AS vertices, (SELECT count(*) FROM e) AS edges, (SELECT count(*) FROM r1) AS r
  UNION ALL SELECT 'suppliers', (SELECT count(*) FROM (SELECT src FROM s UNION SELECT dst FROM s)), (SELECT count(*) FROM s), (SELECT count(*) FROM r2))
SELECT graph, vertices, edges, r = vertices AS connected, r = vertices AND edges = vertices - 1 AS is_tree FROM n""")
def is_tree(t):
    heap = graph.is_tree(order_heap(t), t.orders.select(F.col("o_orderkey").alias("v"))).withColumn("graph", F.lit("orders"))
    sold = supplier_edges(t)
    net = graph.is_tree(sold).withColumn("graph", F.lit("suppliers"))
    return heap.unionByName(net).select("graph", "vertices", "edges", (F.col("components") == 1).alias("connected"), "is_tree")


def user_trees(t):
    """Two binary trees per user in heap shape, one node per event.

    The second has other inner nodes; for every third user its last leaf differs too.
    """
    o = Ordered(t.events.select("user_id", "ts", "event_id", "event_type"), ["user_id"], ["ts", "event_id"]).scan(
        i=position(), n=total("sum", F.lit(1).cast("bigint")))
    i = F.col("i")
    base = o.rows().select(
        "user_id", i.alias("node"), F.when(i > 1, F.floor(i / 2)).alias("parent"), (i % 2).alias("side"),
        F.col("event_type").alias("value"), "n")
    inner = F.col("node") * 2 <= F.col("n")
    other = F.when(inner | ((F.col("user_id") % 3 == 0) & (F.col("node") == F.col("n"))), "x").otherwise(F.col("value"))
    return base.withColumn("tree", F.lit(0)).unionByName(base.withColumn("value", other).withColumn("tree", F.lit(1))).drop("n")


@query("j06_same_leaves", "SELECT DISTINCT user_id, user_id % 3 <> 0 AS same FROM events")
def same_leaves(t):
    return graph.same_leaves(user_trees(t), "user_id", "tree")


_HEAP = """
h AS MATERIALIZED (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS node, event_type AS value,
  count(*) OVER (PARTITION BY user_id) AS n FROM events),
w(user_id, node, path) AS (SELECT user_id, node, '' FROM h WHERE node = 1
  UNION ALL SELECT h.user_id, h.node, w.path || (h.node % 2) FROM w JOIN h ON h.user_id = w.user_id AND h.node // 2 = w.node AND h.node > 1)"""


@query("j06_leaf_sequence", f"""
WITH RECURSIVE {_HEAP} SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY path) AS i, value
FROM w JOIN h USING (user_id, node) WHERE node * 2 > n""")
def leaf_sequence(t):
    return graph.leaf_sequence(user_trees(t).filter("tree = 0"), ["user_id"])


def plan_tasks(t):
    """Orders as tasks that wait for two smaller order keys; status P has failed."""
    k = F.col("o_orderkey")
    waits = F.filter(F.array_distinct(F.array(F.floor(k / 2), F.floor(k / 3))), lambda d: d < k)
    status = F.when(F.col("o_orderstatus") == "P", "failed").otherwise("done")
    late = F.when(k < 100, "done").otherwise(status)
    return t.orders.select(k.alias("task_id"), waits.alias("depends_on"), late.alias("status"))


@query("j07_task_levels", """
WITH RECURSIVE t AS MATERIALIZED (SELECT o_orderkey AS k, CASE WHEN o_orderkey < 100 OR o_orderstatus <> 'P' THEN 'done' ELSE 'failed' END AS status FROM orders),
 e AS MATERIALIZED (SELECT DISTINCT d AS src, k AS dst FROM (SELECT k, unnest([k // 2, k // 3]) AS d FROM t) WHERE d < k),
 bad AS (SELECT e.dst AS k FROM e JOIN t ON t.k = e.src WHERE t.status = 'failed' UNION SELECT e.dst FROM bad JOIN e ON e.src = bad.k),
 l(v, level) AS (SELECT k, CAST(0 AS BIGINT) FROM t WHERE k NOT IN (SELECT dst FROM e) UNION SELECT e.dst, level + 1 FROM l JOIN e ON e.src = l.v),
 m AS (SELECT v, max(level) AS level FROM l GROUP BY 1)
SELECT k AS task_id, CASE WHEN k IN (SELECT k FROM bad) THEN -1 ELSE level END AS level,
  CASE WHEN k IN (SELECT k FROM bad) THEN 'stuck' ELSE status END AS state FROM t JOIN m ON m.v = k""")
def task_levels(t):
    return graph.task_levels(plan_tasks(t))
