"""Inspection and profiling queries."""

from pyspark.sql import functions as F

from quern.operators import profile
from quern.plans.registry import query


@query("b01_head", "SELECT * REPLACE (strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate) FROM orders ORDER BY o_orderkey LIMIT 5")
def head(t):
    return t.orders.orderBy("o_orderkey").limit(5).withColumn(
        "o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))


@query("b01_tail", "SELECT * REPLACE (strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate) FROM orders ORDER BY o_orderkey DESC LIMIT 5")
def tail(t):
    return t.orders.orderBy(F.desc("o_orderkey")).limit(5).withColumn(
        "o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))


@query("b02_info", """
SELECT * FROM (
  SELECT 'o_orderkey' AS column_name, 'bigint' AS data_type, count(o_orderkey) AS non_null FROM orders UNION ALL
  SELECT 'o_custkey', 'bigint', count(o_custkey) FROM orders UNION ALL
  SELECT 'o_orderstatus', 'string', count(o_orderstatus) FROM orders UNION ALL
  SELECT 'o_totalprice', 'double', count(o_totalprice) FROM orders UNION ALL
  SELECT 'o_orderdate', 'timestamp_ntz', count(o_orderdate) FROM orders UNION ALL
  SELECT 'o_orderpriority', 'string', count(o_orderpriority) FROM orders)
""")
def info(t):
    return profile.info(t.orders)


_NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _describe_sql(table, columns):
    return " UNION ALL ".join(f"""
SELECT '{c}' AS column_name, count({c}) AS count, round(avg({c}), 6) AS mean,
  round(stddev_samp({c}), 6) AS std, min({c}) AS min, round(quantile_cont({c}, 0.25), 6) AS p25,
  round(quantile_cont({c}, 0.5), 6) AS p50, round(quantile_cont({c}, 0.75), 6) AS p75, max({c}) AS max
FROM {table}""" for c in columns)


@query("b03_describe_numeric", _describe_sql("lineitem", _NUMERIC))
def describe_numeric(t):
    out = profile.describe_numeric(t.lineitem, _NUMERIC)
    return out.select(*[F.round(c, 6).alias(c) if c in ("mean", "std", "p25", "p50", "p75") else c
                        for c in out.columns])


_CATEGORIES = ["l_returnflag", "l_linestatus"]


@query("b04_describe_categorical", " UNION ALL ".join(f"""
SELECT '{c}' AS column_name, CAST(sum(n) AS BIGINT) AS count, count(*) AS "unique",
  arg_min(v, (-n, v)) AS top, max(n) AS freq
FROM (SELECT {c} AS v, count(*) AS n FROM lineitem WHERE {c} IS NOT NULL GROUP BY 1)""" for c in _CATEGORIES))
def describe_categorical(t):
    return profile.describe_categorical(t.lineitem, _CATEGORIES)


@query("b05_value_counts", "SELECT p_type, count(*) AS n FROM part GROUP BY 1 ORDER BY n DESC, p_type")
def value_counts(t):
    return profile.value_counts(t.part, "p_type")


_FEATURES = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]


@query("b06_correlation", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, round(corr({c}, l_extendedprice), 6) AS correlation FROM lineitem"
    for c in _FEATURES))
def correlation(t):
    return profile.correlations(t.lineitem, _FEATURES, "l_extendedprice").withColumn(
        "correlation", F.round("correlation", 6)).orderBy("correlation")


def _box_sql(keys):
    k = ", ".join(keys)
    return f"""
WITH q AS (SELECT {k}, quantile_cont(o_totalprice, 0.25) AS q1, quantile_cont(o_totalprice, 0.5) AS median,
           quantile_cont(o_totalprice, 0.75) AS q3 FROM orders GROUP BY {k})
SELECT {k}, round(q1, 4) AS q1, round(median, 4) AS median, round(q3, 4) AS q3,
  min(o_totalprice) FILTER (WHERE o_totalprice BETWEEN q1 - 1.5*(q3-q1) AND q3 + 1.5*(q3-q1)) AS low_whisker,
  max(o_totalprice) FILTER (WHERE o_totalprice BETWEEN q1 - 1.5*(q3-q1) AND q3 + 1.5*(q3-q1)) AS high_whisker,
  count(*) FILTER (WHERE o_totalprice NOT BETWEEN q1 - 1.5*(q3-q1) AND q3 + 1.5*(q3-q1)) AS outliers
FROM orders JOIN q USING ({k}) GROUP BY {k}, q1, median, q3"""


def _box(t, keys):
    out = profile.box_plot(t.orders, keys, "o_totalprice")
    return out.withColumns({c: F.round(c, 4) for c in ("q1", "median", "q3")})


@query("b07_box_one_key", _box_sql(["o_orderstatus"]))
def box_one_key(t):
    return _box(t, ["o_orderstatus"])


@query("b07_box_two_keys", _box_sql(["o_orderstatus", "o_orderpriority"]))
def box_two_keys(t):
    return _box(t, ["o_orderstatus", "o_orderpriority"])


@query("b08_histogram", "SELECT p_type, p_size, count(*) AS n FROM part GROUP BY ALL")
def histogram(t):
    return t.part.groupBy("p_type", "p_size").agg(F.count(F.lit(1)).alias("n"))


@query("b09_density", """
WITH s AS (SELECT o_orderstatus, o_orderpriority, count(*) AS n,
             stddev_samp(o_totalprice) * pow(count(*), -0.2) AS bw FROM orders GROUP BY 1, 2),
     r AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders),
     g AS (SELECT CAST(i AS INTEGER) AS point, lo + (hi - lo) * i / 20 AS x FROM r, range(21) AS t(i))
SELECT o_orderstatus, o_orderpriority, point, round(x, 4) AS x,
  round(sum(exp(-0.5 * pow((x - o_totalprice) / bw, 2))) / (n * bw * sqrt(2 * pi())), 12) AS density
FROM orders JOIN s USING (o_orderstatus, o_orderpriority), g
GROUP BY o_orderstatus, o_orderpriority, point, x, n, bw""")
def density(t):
    return profile.density(t.orders, ["o_orderstatus", "o_orderpriority"], "o_totalprice", 21).withColumns(
        {"x": F.round("x", 4), "density": F.round("density", 12)})


@query("b10_regression_line", """
SELECT l_returnflag, round(regr_slope(l_extendedprice, l_quantity), 6) AS slope,
  round(regr_intercept(l_extendedprice, l_quantity), 6) AS intercept
FROM lineitem GROUP BY 1""")
def regression_line(t):
    return t.lineitem.groupBy("l_returnflag").agg(
        F.round(F.regr_slope("l_extendedprice", "l_quantity"), 6).alias("slope"),
        F.round(F.regr_intercept("l_extendedprice", "l_quantity"), 6).alias("intercept"))
