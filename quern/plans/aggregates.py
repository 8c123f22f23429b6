"""Aggregation, sorting and set queries."""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quern.functions import expressions as X
from quern.functions import text as T
from quern.operators import sketches
from quern.operators.ordered import Ordered, position, total
from quern.plans.joins import VOCABULARY_SQL, vocabulary
from quern.plans.registry import query
from quern.tables import day, month, revenue

def _n():
    return F.count(F.lit(1))


@query("e01_sum_two_keys", """
SELECT m, flag, round(sum(l_quantity), 2) AS quantity FROM (
  SELECT month(l_shipdate) AS m, nullif(l_returnflag, 'N') AS flag, l_quantity FROM lineitem)
WHERE flag IS NOT NULL GROUP BY 1, 2""")
def sum_two_keys(t):
    """Rows without a key are left out, as a pandas group-by does."""
    keyed = t.lineitem.select(F.month("l_shipdate").cast("bigint").alias("m"),
                              F.nullif("l_returnflag", F.lit("N")).alias("flag"), "l_quantity")
    return keyed.filter(F.col("flag").isNotNull()).groupBy("m", "flag").agg(
        F.round(F.sum("l_quantity"), 2).alias("quantity"))


_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]


@query("e02_means_two_keys", "SELECT month(l_shipdate) AS m, l_returnflag, "
       + ", ".join(f"round(avg({c}), 6) AS avg_{c}" for c in _MEASURES) + " FROM lineitem GROUP BY 1, 2")
def means_two_keys(t):
    return t.lineitem.groupBy(F.month("l_shipdate").cast("bigint").alias("m"), "l_returnflag").agg(
        *[F.round(F.avg(c), 6).alias(f"avg_{c}") for c in _MEASURES])


@query("e03_sum_and_overall_max", """
SELECT p_brand, total, max(total) OVER () AS largest
FROM (SELECT p_brand, round(sum(p_retailprice), 2) AS total FROM part GROUP BY 1)""")
def sum_and_overall_max(t):
    sums = t.part.groupBy("p_brand").agg(F.round(F.sum("p_retailprice"), 2).alias("total"))
    return sums.withColumn("largest", F.max("total").over(W.partitionBy(F.lit(1))))  # a row per brand


@query("e04_share_of_total", """
SELECT event_type, round(sum(value) / sum(sum(value)) OVER (), 8) AS share FROM events GROUP BY 1""")
def share_of_total(t):
    sums = t.events.groupBy("event_type").agg(F.sum("value").alias("v"))
    everything = F.sum("v").over(W.partitionBy(F.lit(1)))  # over a row per type
    return sums.select("event_type", F.round(F.col("v") / everything, 8).alias("share"))


@query("e05_two_level_totals", """
SELECT coalesce(p_type, 'ALL') AS p_type, coalesce(p_brand, 'ALL') AS p_brand,
  CAST(grouping(p_type) * 2 + grouping(p_brand) AS BIGINT) AS level,
  round(sum(p_retailprice), 2) AS total, count(*) AS n
FROM part GROUP BY ROLLUP (p_type, p_brand)""")
def two_level_totals(t):
    return t.part.rollup("p_type", "p_brand").agg(
        F.grouping_id().cast("bigint").alias("level"), F.round(F.sum("p_retailprice"), 2).alias("total"), _n().alias("n")
    ).select(F.coalesce("p_type", F.lit("ALL")).alias("p_type"), F.coalesce("p_brand", F.lit("ALL")).alias("p_brand"),
             "level", "total", "n")


@query("e06_mean_sorted", """
SELECT p_brand, round(avg(p_retailprice), 6) AS mean FROM part GROUP BY 1 ORDER BY avg(p_retailprice) DESC, 1""")
def mean_sorted(t):
    return t.part.groupBy("p_brand").agg(F.avg("p_retailprice").alias("m")).orderBy(F.desc("m"), "p_brand").select(
        "p_brand", F.round("m", 6).alias("mean"))


@query("e07_group_sizes", "SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY 1, 2")
def group_sizes(t):
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(_n().alias("n"))


@query("e08_conditional_ratio", """
SELECT o_orderpriority, round(count_if(o_orderstatus = 'F') / count_if(o_orderstatus = 'O'), 2) AS ratio
FROM orders GROUP BY 1""")
def conditional_ratio(t):
    count = lambda s: F.count_if(F.col("o_orderstatus") == s)
    return t.orders.groupBy("o_orderpriority").agg(F.round(F.try_divide(count("F"), count("O")), 2).alias("ratio"))


@query("e09_filtered_scalars", """
SELECT min(o_totalprice) FILTER (WHERE o_orderstatus = 'F') AS min_f, max(o_totalprice) FILTER (WHERE o_orderstatus = 'F')
  AS max_f, round(avg(o_totalprice) FILTER (WHERE o_orderstatus = 'F'), 6) AS avg_f,
  round(avg(o_totalprice) FILTER (WHERE o_orderstatus = 'O'), 6) AS avg_o FROM orders""")
def filtered_scalars(t):
    price = lambda s: F.when(F.col("o_orderstatus") == s, F.col("o_totalprice"))
    return t.orders.agg(F.min(price("F")).alias("min_f"), F.max(price("F")).alias("max_f"),
                        F.round(F.avg(price("F")), 6).alias("avg_f"), F.round(F.avg(price("O")), 6).alias("avg_o"))


def _active_month(t):
    return t.events.filter(F.col("ts").between(
        F.lit("2024-01-01").cast("timestamp_ntz"), F.lit("2024-01-30").cast("timestamp_ntz")))


@query("e10_distinct_per_day", """
SELECT strftime(ts, '%Y-%m-%d') AS dt, count(DISTINCT user_id) AS users FROM events
WHERE ts BETWEEN TIMESTAMP '2024-01-01' AND TIMESTAMP '2024-01-30' GROUP BY 1""")
def distinct_per_day(t):
    return _active_month(t).groupBy(F.to_date("ts").alias("d")).agg(F.count_distinct("user_id").alias("users")).select(
        day("d").alias("dt"), "users")


_DAYS = 7


@query("e10_approx_distinct_per_day", """
WITH d AS (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-01' AND TIMESTAMP '2024-01-30')
SELECT strftime(d, '%Y-%m-%d') AS dt, true AS day_holds, true AS week_holds FROM d""")
def approx_distinct_per_day(t):
    """Stored sketches: one per day, united over the seven days up to each; whether both lie near enough to the exact counts."""
    users = _active_month(t).select(F.to_date("ts").alias("d"), "user_id")
    held = sketches.distinct_sketches(users, ["d"], "user_id")
    after = F.explode(F.sequence(F.col("d"), F.date_add("d", _DAYS - 1))).alias("to")
    weeks = sketches.united(held.select("sketch", after), ["to"])
    exact = users.groupBy("d").agg(F.count_distinct("user_id").alias("day_exact"))
    exact_weeks = users.distinct().select("user_id", after).groupBy("to").agg(F.count_distinct("user_id").alias("week_exact"))
    both = held.select("d", F.hll_sketch_estimate("sketch").alias("day")).join(exact, "d").join(
        weeks.select(F.col("to").alias("d"), F.hll_sketch_estimate("sketch").alias("week")), "d").join(
        exact_weeks.withColumnRenamed("to", "d"), "d")
    near = lambda a, b: F.abs(F.col(a) - F.col(b)) <= F.ceil(F.col(b) * sketches.BOUND)
    return both.select(day("d").alias("dt"), near("day", "day_exact").alias("day_holds"), near("week", "week_exact").alias("week_holds"))


@query("e11_sum_of_product", "SELECT round(sum(l_quantity * l_extendedprice), 2) AS total FROM lineitem")
def sum_of_product(t):
    return t.lineitem.agg(F.round(F.sum(F.col("l_quantity") * F.col("l_extendedprice")), 2).alias("total"))


def _brand():
    return F.regexp_replace("p_brand", "Brand#", "").cast("int")


@query("e12_count_at_maximum", """
WITH s AS (SELECT p_type, least(p_size, CAST(replace(p_brand, 'Brand#', '') AS INTEGER)) AS side, count(*) AS n
  FROM part GROUP BY 1, 2)
SELECT p_type, max(side) AS side, arg_max(n, side) AS n FROM s GROUP BY 1""")
def count_at_maximum(t):
    sides = t.part.groupBy("p_type", F.least(F.col("p_size"), _brand()).alias("side")).agg(_n().alias("n"))
    return sides.groupBy("p_type").agg(F.max("side").alias("side"), F.max_by("n", "side").alias("n"))


@query("e13_xor", "SELECT l_returnflag, bit_xor(l_orderkey) AS x FROM lineitem GROUP BY 1")
def xor(t):
    return t.lineitem.groupBy("l_returnflag").agg(F.bit_xor("l_orderkey").alias("x"))


@query("e14_conditional_count_sum", """
SELECT l_linestatus, count_if(l_discount > 0.05) AS n, round(sum(CASE WHEN l_tax = 0 THEN l_extendedprice ELSE 0 END), 2)
  AS untaxed FROM lineitem GROUP BY 1""")
def conditional_count_sum(t):
    return t.lineitem.groupBy("l_linestatus").agg(
        F.count_if(F.col("l_discount") > 0.05).alias("n"),
        F.round(F.sum(F.when(F.col("l_tax") == 0, F.col("l_extendedprice")).otherwise(0)), 2).alias("untaxed"))


def anagram_groups(words):
    """Long form: each word with its letter signature, and the first word and size of its group."""
    keyed = words.select("word", T.letters_sorted(F.col("word")).alias("letters"))
    return Ordered(keyed, ["letters"], ["word"], settle=True).scan(
        first=total("min", "word"), size=total("sum", F.lit(1).cast("bigint"))).rows()


@query("e15_anagrams", f"""
WITH {VOCABULARY_SQL}, s AS (SELECT w AS word, array_to_string(list_sort(string_split(w, '')), '') AS letters FROM vocab)
SELECT word, letters, min(word) OVER p AS first, count(*) OVER p AS size FROM s WINDOW p AS (PARTITION BY letters)""")
def anagrams(t):
    return anagram_groups(vocabulary(t))


@query("e16_distinct_emails", r"""
WITH m AS (SELECT lang, unnest(regexp_extract_all(text, '[A-Za-z0-9._+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+')) AS mail
  FROM documents)
SELECT lang, count(DISTINCT replace(split_part(split_part(mail, '@', 1), '+', 1), '.', '') || '@' || split_part(mail, '@', 2))
  AS n FROM m GROUP BY 1""")
def distinct_emails(t):
    found = t.documents.select("lang", F.explode(X.emails(F.col("text"))).alias("mail"))
    return found.groupBy("lang").agg(F.count_distinct(X.canonical_email(F.col("mail"))).alias("n"))


def is_one_to_one(df, a, b):
    """Every value of ``a`` has one ``b`` and the other way round: the three distinct counts agree."""
    pairs = df.select(F.col(a).alias("a"), F.col(b).alias("b")).distinct()
    return pairs.agg((
        (F.count_distinct("a") == F.count(F.lit(1))) & (F.count_distinct("b") == F.count(F.lit(1)))
    ).alias("one_to_one"))


def _one_sql(table, a, b):
    return f"""SELECT '{a}={b}' AS mapping, count(DISTINCT a) = count(*) AND count(DISTINCT b) = count(*) AS one_to_one
FROM (SELECT DISTINCT {a} AS a, {b} AS b FROM {table})"""


_MAPPINGS = [("customer", "c_custkey", "c_name"), ("part", "p_partkey", "p_retailprice"), ("part", "p_brand", "p_type"),
             ("nation", "n_name", "n_regionkey")]


@query("e17_one_to_one", " UNION ALL ".join(_one_sql(*m) for m in _MAPPINGS))
def one_to_one(t):
    out = None
    for table, a, b in _MAPPINGS:
        row = is_one_to_one(getattr(t, table), a, b).select(F.lit(f"{a}={b}").alias("mapping"), "one_to_one")
        out = row if out is None else out.unionByName(row)
    return out


@query("e19_first_last_position", """
WITH s AS (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events)
SELECT user_id, min(i) AS first, max(i) AS last FROM s WHERE event_type = 'purchase' GROUP BY 1""")
def first_last_position(t):
    e = t.events.select("user_id", "event_type", "ts", "event_id")
    rows = Ordered(e, ["user_id"], ["ts", "event_id"]).scan(i=position()).rows()
    return rows.filter("event_type = 'purchase'").groupBy("user_id").agg(
        F.min("i").alias("first"), F.max("i").alias("last"))


@query("e20_having", """
SELECT p_brand, count(*) AS n, min(p_size) AS lo, max(p_size) AS hi, round(avg(p_size), 6) AS mean,
  round(stddev_samp(p_size), 6) AS sd FROM part GROUP BY 1 HAVING count(*) > 75""")
def having(t):
    return t.part.groupBy("p_brand").agg(
        _n().alias("n"), F.min("p_size").alias("lo"), F.max("p_size").alias("hi"),
        F.round(F.avg("p_size"), 6).alias("mean"), F.round(F.stddev_samp("p_size"), 6).alias("sd")).filter("n > 75")


@query("e21_status_summary", """
SELECT o_orderpriority, count(*) AS total, count_if(o_orderstatus = 'F') AS done, count_if(o_orderstatus = 'P') AS failed,
  CAST(sum(length(o_orderpriority)) AS BIGINT) AS tokens, round(sum(o_totalprice), 2) AS duration FROM orders GROUP BY 1""")
def status_summary(t):
    return t.orders.groupBy("o_orderpriority").agg(
        _n().alias("total"), F.count_if(F.col("o_orderstatus") == "F").alias("done"),
        F.count_if(F.col("o_orderstatus") == "P").alias("failed"),
        F.sum(F.length("o_orderpriority")).alias("tokens"), F.round(F.sum("o_totalprice"), 2).alias("duration"))


@query("g01_sort_by_aggregate", """
SELECT o_orderpriority, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1 ORDER BY total DESC, 1""")
def sort_by_aggregate(t):
    return t.orders.groupBy("o_orderpriority").agg(F.round(F.sum("o_totalprice"), 2).alias("total")).orderBy(
        F.desc("total"), "o_orderpriority")


def top_products(t, lines, n):
    """Revenue and order count per product, the n largest with their names."""
    best = lines.groupBy("l_partkey").agg(
        F.sum(revenue()).alias("r"), F.count_distinct("l_orderkey").alias("order_count")
    ).orderBy(F.desc("r"), "l_partkey").limit(n)
    return best.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        "p_partkey", "p_name", F.round("r", 4).alias("total_revenue"), "order_count"
    ).orderBy(F.desc("total_revenue"), "p_partkey")


@query("g02_top_products", """
SELECT p_partkey, p_name, round(sum(l_extendedprice * (1 - l_discount)), 4) AS total_revenue,
  count(DISTINCT l_orderkey) AS order_count FROM lineitem JOIN part ON l_partkey = p_partkey
GROUP BY 1, 2 ORDER BY 3 DESC, 1 LIMIT 5""")
def top_products_all_time(t):
    return top_products(t, t.lineitem, 5)


@query("g03_segments", """
WITH v AS (SELECT o_custkey, sum(o_totalprice) AS ltv FROM orders GROUP BY 1)
SELECT c_mktsegment, count(*) AS customer_count, round(avg(coalesce(ltv, 0)), 4) AS avg_ltv
FROM customer LEFT JOIN v ON o_custkey = c_custkey GROUP BY 1""")
def segments(t):
    ltv = t.orders.groupBy("o_custkey").agg(F.sum("o_totalprice").alias("ltv"))
    return t.customer.join(ltv, F.col("c_custkey") == F.col("o_custkey"), "left").groupBy("c_mktsegment").agg(
        _n().alias("customer_count"), F.round(F.avg(F.coalesce("ltv", F.lit(0.0))), 4).alias("avg_ltv"))


@query("g04_event_counts", "SELECT event_type, count(*) AS event_count FROM events GROUP BY 1")
def event_counts(t):
    return t.events.groupBy("event_type").agg(_n().alias("event_count"))


@query("g05_distinct_rows", "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem")
def distinct_rows(t):
    return t.lineitem.select("l_returnflag", "l_linestatus", "l_linenumber").distinct()


@query("g06_set_difference", """
SELECT strftime(o_orderdate, '%Y-%m') AS m, o_custkey FROM orders WHERE o_orderstatus = 'F' EXCEPT
SELECT strftime(o_orderdate, '%Y-%m'), o_custkey FROM orders WHERE o_orderstatus = 'O'""")
def set_difference(t):
    pairs = lambda s: t.orders.filter(F.col("o_orderstatus") == s).select(
        month("o_orderdate").alias("m"), "o_custkey")
    return pairs("F").subtract(pairs("O"))
