"""Regression queries on order lines."""

from pyspark.sql import functions as F

from quern.operators import regress
from quern.operators.joins import lookup
from quern.plans.registry import query

#: eleven features of an order line; none is a function of the others
_FEATURES = ["l_quantity", "l_discount", "l_tax", "l_linenumber", "p_size", "p_retailprice", "s_acctbal", "s_nationkey",
             "ship_day", "ship_month", "ship_weekday"]


def lines(t):
    part = t.part.select("p_partkey", "p_size", "p_retailprice")
    supplier = t.supplier.select("s_suppkey", "s_acctbal", "s_nationkey")
    rows = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax", "l_extendedprice",
        F.day("l_shipdate").alias("ship_day"), F.month("l_shipdate").alias("ship_month"), F.dayofweek("l_shipdate").alias("ship_weekday"))
    return lookup(lookup(rows, part, [("l_partkey", "p_partkey")]), supplier, [("l_suppkey", "s_suppkey")])


# The same normal equations in SQL: sums of products of standardised terms, then Gauss-Jordan elimination.
_LINES = """lines AS MATERIALIZED (SELECT l_quantity, l_discount, l_tax, l_linenumber, p_size, p_retailprice, s_acctbal, s_nationkey,
  day(l_shipdate) AS ship_day, month(l_shipdate) AS ship_month, dayofweek(l_shipdate) + 1 AS ship_weekday, l_extendedprice AS y,
  substr(md5(l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey), 1, 4) < '2666' AS test
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey)"""


def _listed(parts):
    return "[" + ", ".join(parts) + "]"


def _fit_sql(degree: int, scaled: bool, train: str, test: str, alpha: float, coefficients: bool) -> str:
    n = len(_FEATURES)
    terms = regress.terms(n, degree)
    k = len(terms)
    feature = [f"((CAST({f} AS DOUBLE) - m{i}) / d{i})" if scaled else f"CAST({f} AS DOUBLE)" for i, f in enumerate(_FEATURES)]
    x = ", ".join(" * ".join(feature[i] for i in t) + f" AS x{j}" for j, t in enumerate(terms))
    moments = ", ".join(f"avg(CAST({f} AS DOUBLE)) AS m{i}, stddev_pop(CAST({f} AS DOUBLE)) AS d{i}" for i, f in enumerate(_FEATURES))
    stats = ", ".join(f"avg(x{j}) AS a{j}, stddev_pop(x{j}) AS s{j}" for j in range(k))
    z = ", ".join(f"(x{j} - a{j}) / s{j} AS z{j}" for j in range(k))
    held = {(i, j): f"sum(z{i} * z{j})" + (f" + {alpha} / (any_value(s{i}) * any_value(s{i}))" if i == j and alpha else "") for i in range(k) for j in range(i, k)}
    gram = _listed(_listed([*(held[min(i, j), max(i, j)] for j in range(k)), f"sum(z{i} * (y - ay))"]) for i in range(k))
    spread = ", ".join(f"any_value(s{j}) AS s{j}, any_value(a{j}) AS a{j}" for j in range(k))
    guess = " + ".join(f"b[{j + 1}] * (x{j} - a{j}) / s{j}" for j in range(k))
    names = _listed(f"'{f}'" for f in [*_FEATURES, "intercept", "r2"])
    slopes = _listed([*(f"b[{j + 1}] / s{j}" for j in range(k)), "ay - (" + " + ".join(f"b[{j + 1}] / s{j} * a{j}" for j in range(k)) + ")", "r2"])
    out = (f"SELECT unnest({names}) AS term, unnest(list_transform({slopes}, lambda v: round(v, 4))) AS value FROM r" if coefficients
           else "SELECT 'r2' AS term, round(r2, 4) AS value FROM r")
    return f"""
WITH RECURSIVE {_LINES}, f AS (SELECT {moments} FROM lines), x AS MATERIALIZED (SELECT y, test, {x} FROM lines, f),
 s AS (SELECT {stats}, avg(y) AS ay FROM x WHERE {train}), z AS MATERIALIZED (SELECT y, {z}, s.* FROM x, s WHERE {train}),
 g AS MATERIALIZED (SELECT {gram} AS m, {spread}, any_value(ay) AS ay FROM z),
 e AS (SELECT 1 AS i, m FROM g UNION ALL SELECT i + 1, list_transform(m, lambda r, p: CASE WHEN p = i THEN list_transform(r, lambda v: v / m[i][i])
   ELSE list_transform(r, lambda v, q: v - r[i] * m[i][q] / m[i][i]) END) FROM e WHERE i <= {k}),
 b AS MATERIALIZED (SELECT list_transform(e.m, lambda r: r[{k + 1}]) AS b, g.* EXCLUDE (m) FROM e, g WHERE i = {k + 1}),
 r AS (SELECT any_value(b) AS b, {spread}, any_value(ay) AS ay, 1 - sum(pow(y - ay - ({guess}), 2)) / (count(*) * var_pop(y)) AS r2 FROM x, b WHERE {test})
{out}"""


def _rounded(report):
    return report.withColumn("value", F.round("value", 4))


@query("o01_one_feature", """
SELECT round(regr_slope(l_extendedprice, l_quantity), 6) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 6) AS intercept,
  round(regr_r2(l_extendedprice, l_quantity), 8) AS r2 FROM lineitem""")
def one_feature(t):
    y, x = "l_extendedprice", "l_quantity"
    return t.lineitem.agg(F.round(F.regr_slope(y, x), 6).alias("slope"), F.round(F.regr_intercept(y, x), 6).alias("intercept"),
                          F.round(F.regr_r2(y, x), 8).alias("r2"))


@query("o02_many_features", _fit_sql(1, False, "true", "true", 0, True))
def many_features(t):
    return _rounded(regress.fit(lines(t), _FEATURES, "l_extendedprice"))


@query("o03_polynomial", _fit_sql(2, True, "true", "true", 0, False))
def polynomial(t):
    return _rounded(regress.fit_polynomial(lines(t), _FEATURES, "l_extendedprice"))


@query("o04_split", """
SELECT count_if(s) AS test, count_if(NOT s) AS train FROM (SELECT substr(md5(l_orderkey || '-' || l_linenumber || '-' || l_partkey
  || '-' || l_suppkey), 1, 4) < '2666' AS s FROM lineitem)""")
def split(t):
    test = regress.is_test("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return t.lineitem.agg(F.count_if(test).alias("test"), F.count_if(~test).alias("train"))


def _parts(t):
    rows, test = lines(t), regress.is_test("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return rows.filter(~test), rows.filter(test)


@query("o05_ridge", _fit_sql(1, False, "NOT test", "test", 0.1, True))
def ridge(t):
    return _rounded(regress.ridge(*_parts(t), _FEATURES, "l_extendedprice", 0.1))


@query("o06_ridge_polynomial", _fit_sql(2, False, "NOT test", "test", 0.1, False))
def ridge_polynomial(t):
    return _rounded(regress.ridge(*_parts(t), _FEATURES, "l_extendedprice", 0.1, degree=2))
