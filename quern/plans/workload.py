"""The thirty business questions and the demo questions.

"Today" is 2001-08-01 for orders and 2024-01-31 for events.  Facts are summed per
key before they meet a dimension, so a customer or product with a huge share of
the rows is one row by the time of the join.
"""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quern.functions import expressions as X
from quern.operators.joins import lookup
from quern.operators.ordered import ntile, ranked
from quern.plans.aggregates import top_products
from quern.plans.registry import query
from quern.plans.sequences import daily_counts
from quern.tables import cents, day, month, revenue

GEO_SQL = """geo AS (SELECT c_custkey, c_name, c_mktsegment, n_name, r_name FROM customer
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""
LTV_SQL = """ltv AS (SELECT o_custkey, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS ltv
  FROM orders GROUP BY 1)"""
_REV = "l_extendedprice * (1 - l_discount)"


def _at(text):
    return F.lit(text).cast("timestamp_ntz")


def _count():
    return F.count(F.lit(1))


def lifetime_value(t):
    """Order value per customer, in whole cents."""
    return t.orders.groupBy("o_custkey").agg(F.sum(cents("o_totalprice")).alias("ltv"))


def with_customer(t, per_customer, how="inner"):
    return per_customer.join(t.customer_geo(), F.col("o_custkey") == F.col("c_custkey"), how)


@query("l01_total_for_status", "SELECT round(sum(o_totalprice), 2) AS total, count(*) AS n FROM orders WHERE o_orderstatus = 'F'")
def total_for_status(t):
    return t.orders.filter("o_orderstatus = 'F'").agg(F.round(F.sum("o_totalprice"), 2).alias("total"), _count().alias("n"))


@query("l02_region_after_date", f"""
WITH {GEO_SQL} SELECT o_orderkey, c_name, r_name, strftime(o_orderdate, '%Y-%m-%d') AS dt FROM orders
JOIN geo ON o_custkey = c_custkey WHERE r_name IN ('EUROPE', 'ASIA') AND o_orderdate > TIMESTAMP '2001-01-01'""")
def region_after_date(t):
    late = t.orders.filter(F.col("o_orderdate") > _at("2001-01-01")).select("o_orderkey", "o_custkey", "o_orderdate")
    where = t.customer_geo().filter(F.col("r_name").isin("EUROPE", "ASIA"))
    return lookup(late, where, [("o_custkey", "c_custkey")]).select("o_orderkey", "c_name", "r_name", day("o_orderdate").alias("dt"))


@query("l03_count_above", "SELECT count(*) AS n FROM orders WHERE o_totalprice > 250000")
def count_above(t):
    return t.orders.filter("o_totalprice > 250000").agg(_count().alias("n"))


@query("l04_average", "SELECT round(avg(o_totalprice), 6) AS average FROM orders")
def average(t):
    return t.orders.agg(F.round(F.avg("o_totalprice"), 6).alias("average"))


@query("l05_flagged_rows", """
SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders GROUP BY 1
  HAVING max(o_orderdate) >= TIMESTAMP '2001-05-03')""")
def flagged_rows(t):
    active = t.orders.groupBy("o_custkey").agg((F.max("o_orderdate") >= _at("2001-05-03")).alias("is_active"))
    return t.customer.join(active.filter("is_active"), F.col("c_custkey") == F.col("o_custkey"), "left_semi").select(
        "c_custkey", "c_mktsegment")


@query("l06_most_orders_last_quarter", """
SELECT c_custkey, c_mktsegment, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey
WHERE date_trunc('quarter', o_orderdate) = DATE '2001-04-01' GROUP BY 1, 2 ORDER BY n DESC, 1 LIMIT 10""")
def most_orders_last_quarter(t):
    spring = t.orders.filter((F.col("o_orderdate") >= _at("2001-04-01")) & (F.col("o_orderdate") < _at("2001-07-01")))
    best = spring.groupBy("o_custkey").agg(_count().alias("n")).orderBy(F.desc("n"), "o_custkey").limit(10)
    return best.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("c_custkey", "c_mktsegment", "n").orderBy(
        F.desc("n"), "c_custkey")


@query("l07_order_value_by_category", f"""
SELECT p_type, round(avg(v), 4) AS average_value, count(*) AS orders FROM (
  SELECT l_orderkey, p_type, sum({_REV}) AS v FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)
GROUP BY 1""")
def order_value_by_category(t):
    typed = lookup(t.lineitem, t.part.select("p_partkey", "p_type"), [("l_partkey", "p_partkey")])
    per_order = typed.groupBy("l_orderkey", "p_type").agg(F.sum(revenue()).alias("v"))
    return per_order.groupBy("p_type").agg(F.round(F.avg("v"), 4).alias("average_value"), _count().alias("orders"))


@query("l08_bought_category_in_month", """
SELECT DISTINCT c_custkey, c_name FROM customer JOIN orders ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey
JOIN part ON p_partkey = l_partkey WHERE p_type = 'PROMO' AND o_orderdate >= TIMESTAMP '1998-06-01'
  AND o_orderdate < TIMESTAMP '1998-07-01'""")
def bought_category_in_month(t):
    promo = t.part.filter("p_type = 'PROMO'").select("p_partkey")
    june = t.orders.filter((F.col("o_orderdate") >= _at("1998-06-01")) & (F.col("o_orderdate") < _at("1998-07-01")))
    sold = lookup(t.lineitem.select("l_orderkey", "l_partkey"), promo, [("l_partkey", "p_partkey")]).select("l_orderkey").distinct()
    buyers = june.join(sold, F.col("o_orderkey") == F.col("l_orderkey")).select("o_custkey").distinct()
    return t.customer.join(buyers, F.col("c_custkey") == F.col("o_custkey")).select("c_custkey", "c_name")


@query("l09_segment_revenue_active", """
WITH a AS (SELECT o_custkey, sum(o_totalprice) AS v FROM orders GROUP BY 1 HAVING max(o_orderdate) >= TIMESTAMP '2001-05-03')
SELECT c_mktsegment, round(sum(v), 2) AS revenue FROM a JOIN customer ON o_custkey = c_custkey GROUP BY 1""")
def segment_revenue_active(t):
    per = t.orders.groupBy("o_custkey").agg(F.sum("o_totalprice").alias("v"), F.max("o_orderdate").alias("last"))
    active = per.filter(F.col("last") >= _at("2001-05-03"))
    return active.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).groupBy("c_mktsegment").agg(
        F.round(F.sum("v"), 2).alias("revenue"))


def enterprise_purchases(t):
    """Distinct (product, customer) pairs of the BUILDING segment."""
    firms = t.customer.filter("c_mktsegment = 'BUILDING'").select("c_custkey")
    theirs = lookup(t.orders.select("o_orderkey", "o_custkey"), firms, [("o_custkey", "c_custkey")])
    # an order has a few lines only: no key is hot, and the selective join comes before anything is made distinct
    lines = t.lineitem.select("l_orderkey", "l_partkey").join(theirs, F.col("l_orderkey") == F.col("o_orderkey"))
    return lines.select("l_partkey", "o_custkey").distinct()


@query("l10_most_enterprise_customers", """
SELECT l_partkey, count(DISTINCT o_custkey) AS customers FROM lineitem JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment = 'BUILDING' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""")
def most_enterprise_customers(t):
    return enterprise_purchases(t).groupBy("l_partkey").agg(_count().alias("customers")).orderBy(
        F.desc("customers"), "l_partkey").limit(10)


@query("l11_top_groups", f"""
WITH {GEO_SQL} SELECT n_name, round(sum(o_totalprice), 2) AS total FROM orders JOIN geo ON o_custkey = c_custkey
GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5""")
def top_groups(t):
    per = t.orders.groupBy("o_custkey").agg(F.sum("o_totalprice").alias("v"))
    return with_customer(t, per).groupBy("n_name").agg(F.round(F.sum("v"), 2).alias("total")).orderBy(
        F.desc("total"), "n_name").limit(5)


@query("l12_monthly_growth", f"""
WITH m AS (SELECT strftime(l_shipdate, '%Y-%m') AS m, sum({_REV}) AS r FROM lineitem GROUP BY 1),
 p AS (SELECT *, lag(r) OVER (ORDER BY m) AS b FROM m)
SELECT m, round(r, 4) AS revenue, coalesce(round(CASE WHEN b = 0 THEN 0 ELSE (r - b) / b * 100 END, 6), 0) AS growth FROM p""")
def monthly_growth(t):
    """The window runs over one row per calendar month."""
    months = t.lineitem.groupBy(F.trunc("l_shipdate", "MM").alias("d")).agg(F.sum(revenue()).alias("r"))
    b = F.lag("r").over(W.orderBy("d"))
    return months.withColumn("b", b).select(
        month("d").alias("m"), F.round("r", 4).alias("revenue"),
        F.coalesce(F.round(X.div0(F.col("r") - F.col("b"), F.col("b")) * 100, 6), F.lit(0.0)).alias("growth"))


@query("l13_best_large_group", f"""
WITH {GEO_SQL} SELECT n_name, round(avg(o_totalprice), 6) AS average, count(*) AS n FROM orders JOIN geo ON o_custkey = c_custkey
GROUP BY 1 HAVING count(*) > 500 ORDER BY avg(o_totalprice) DESC LIMIT 1""")
def best_large_group(t):
    per = t.orders.groupBy("o_custkey").agg(F.sum("o_totalprice").alias("v"), _count().alias("k"))
    groups = with_customer(t, per).groupBy("n_name").agg((F.sum("v") / F.sum("k")).alias("a"), F.sum("k").alias("n"))
    return groups.filter("n > 500").orderBy(F.desc("a"), "n_name").limit(1).select("n_name", F.round("a", 6).alias("average"), "n")


@query("l14_distribution", """
SELECT p_type, min(p_retailprice) AS lo, max(p_retailprice) AS hi, round(avg(p_retailprice), 6) AS mean,
  round(stddev_samp(p_retailprice), 6) AS sd FROM part GROUP BY 1""")
def distribution(t):
    return t.part.groupBy("p_type").agg(
        F.min("p_retailprice").alias("lo"), F.max("p_retailprice").alias("hi"),
        F.round(F.avg("p_retailprice"), 6).alias("mean"), F.round(F.stddev_samp("p_retailprice"), 6).alias("sd"))


@query("l15_above_average_total", f"""
WITH {GEO_SQL}, g AS (SELECT n_name, sum(o_totalprice) AS total FROM orders JOIN geo ON o_custkey = c_custkey GROUP BY 1)
SELECT n_name, round(total, 2) AS total FROM g WHERE total > (SELECT avg(total) FROM g)""")
def above_average_total(t):
    per = t.orders.groupBy("o_custkey").agg(F.sum("o_totalprice").alias("v"))
    groups = with_customer(t, per).groupBy("n_name").agg(F.sum("v").alias("total"))
    return groups.withColumn("mean", F.avg("total").over(W.partitionBy())).filter("total > mean").select(
        "n_name", F.round("total", 2).alias("total"))


@query("l16_rank_in_country", f"""
WITH {GEO_SQL}, {LTV_SQL} SELECT n_name, c_custkey, ltv, rank() OVER (PARTITION BY n_name ORDER BY ltv DESC) AS rank
FROM ltv JOIN geo ON o_custkey = c_custkey""")
def rank_in_country(t):
    spend = with_customer(t, lifetime_value(t)).select("n_name", "c_custkey", "ltv")
    return ranked(spend, ["n_name"], "ltv", "c_custkey").rows().select("n_name", "c_custkey", "ltv", "rank")


def orders_per_day(t):
    """Order count and value per region and day; customers are summed before their region is known."""
    per = t.orders.groupBy("o_custkey", F.to_date("o_orderdate").alias("dt")).agg(
        _count().alias("n"), F.sum(cents("o_totalprice")).alias("v"))
    return lookup(per, t.customer_geo().select("c_custkey", "r_name"), [("o_custkey", "c_custkey")]).groupBy(
        "r_name", "dt").agg(F.sum("n").alias("n"), F.sum("v").alias("v"))


_DAILY = f"""{GEO_SQL}, d AS (SELECT r_name, CAST(o_orderdate AS DATE) AS dt, count(*) AS n,
  CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS v FROM orders JOIN geo ON o_custkey = c_custkey GROUP BY 1, 2)"""


@query("l17_rolling_orders_by_region", f"""
WITH {_DAILY}, b AS (SELECT min(CAST(o_orderdate AS DATE)) AS a, max(CAST(o_orderdate AS DATE)) AS z FROM orders),
 s AS (SELECT r_name, CAST(unnest(generate_series(a, z, INTERVAL 1 DAY)) AS DATE) AS dt FROM region, b)
SELECT r_name, strftime(dt, '%Y-%m-%d') AS dt, round(avg(coalesce(n, 0)) OVER (PARTITION BY r_name ORDER BY dt
  ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 6) AS average FROM s LEFT JOIN d USING (r_name, dt)""")
def rolling_orders_by_region(t):
    first, last = t.orders.agg(F.min(F.to_date("o_orderdate")), F.max(F.to_date("o_orderdate"))).first()
    days = F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))
    spine = t.region.select("r_name", F.explode(days).alias("dt"))
    w = W.partitionBy("r_name").orderBy("dt").rowsBetween(-6, 0)
    return daily_counts(orders_per_day(t), ["r_name"], spine).select(
        "r_name", day("dt").alias("dt"), F.round(F.avg("n").over(w), 6).alias("average"))


@query("l18_product_month_over_month", f"""
WITH m AS (SELECT l_partkey, date_trunc('month', l_shipdate) AS m, sum({_REV}) AS r FROM lineitem GROUP BY 1, 2)
SELECT a.l_partkey, strftime(a.m, '%Y-%m') AS m, round(a.r, 4) AS revenue, round(coalesce(b.r, 0), 4) AS previous
FROM m a LEFT JOIN m b ON a.l_partkey = b.l_partkey AND b.m = a.m - INTERVAL 1 MONTH""")
def product_month_over_month(t):
    """LAG gives the previous row; it counts only if that is the previous calendar month."""
    months = t.lineitem.groupBy("l_partkey", F.trunc("l_shipdate", "MM").alias("d")).agg(F.sum(revenue()).alias("r"))
    w = W.partitionBy("l_partkey").orderBy("d")
    near = F.lag("d").over(w) == F.add_months("d", -1)
    return months.withColumn("p", F.when(near, F.lag("r").over(w)).otherwise(0.0)).select(
        "l_partkey", month("d").alias("m"), F.round("r", 4).alias("revenue"), F.round("p", 4).alias("previous"))


@query("l19_cumulative_by_region", f"""
WITH {_DAILY} SELECT r_name, strftime(dt, '%Y-%m-%d') AS dt, CAST(sum(v) OVER (PARTITION BY r_name ORDER BY dt) AS BIGINT)
  AS upto FROM d""")
def cumulative_by_region(t):
    w = W.partitionBy("r_name").orderBy("dt").rowsBetween(W.unboundedPreceding, 0)
    return orders_per_day(t).select("r_name", day("dt").alias("dt"), F.sum("v").over(w).alias("upto"))


@query("l20_top_quarter_in_segment", f"""
WITH {LTV_SQL}, q AS (SELECT c_mktsegment, c_custkey, ltv, ntile(4) OVER (PARTITION BY c_mktsegment ORDER BY ltv DESC, c_custkey)
  AS tile FROM ltv JOIN customer ON o_custkey = c_custkey)
SELECT c_mktsegment, c_custkey, ltv FROM q WHERE tile = 1""")
def top_quarter_in_segment(t):
    spend = lifetime_value(t).join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("c_mktsegment", "c_custkey", "ltv")
    return ranked(spend, ["c_mktsegment"], "ltv", "c_custkey").rows().filter(ntile(4) == 1).select(
        "c_mktsegment", "c_custkey", "ltv")


@query("l21_above_average_spend", f"WITH {LTV_SQL} SELECT o_custkey, ltv FROM ltv WHERE ltv > (SELECT avg(ltv) FROM ltv)")
def above_average_spend(t):
    spend = lifetime_value(t)
    mean = spend.agg(F.avg("ltv").alias("_mean"))
    return spend.join(F.broadcast(mean), F.col("ltv") > F.col("_mean")).drop("_mean")  # one row


@query("l22_never_ordered_by_enterprise", """
SELECT p_partkey, p_name FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment = 'BUILDING')""")
def never_ordered_by_enterprise(t):
    bought = enterprise_purchases(t).select("l_partkey").distinct()
    return t.part.join(bought, F.col("p_partkey") == F.col("l_partkey"), "left_anti").select("p_partkey", "p_name")


@query("l23_top_three_per_category", f"""
WITH r AS (SELECT l_partkey, sum({_REV}) AS r FROM lineitem GROUP BY 1),
 k AS (SELECT p_type, p_partkey, p_name, r, row_number() OVER (PARTITION BY p_type ORDER BY r DESC, p_partkey) AS rn
   FROM r JOIN part ON l_partkey = p_partkey)
SELECT p_type, p_partkey, p_name, round(r, 4) AS revenue, rn AS place FROM k WHERE rn <= 3""")
def top_three_per_category(t):
    sums = t.lineitem.groupBy("l_partkey").agg(F.sum(revenue()).alias("r"))
    w = W.partitionBy("p_type").orderBy(F.desc("r"), "p_partkey")
    best = sums.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select("p_type", "p_partkey", "p_name", "r").withColumn(
        "place", F.row_number().over(w)).filter("place <= 3")
    return best.select("p_type", "p_partkey", "p_name", F.round("r", 4).alias("revenue"), F.col("place").cast("bigint").alias("place"))


@query("l24_ordered_in_every_region", """
SELECT o_custkey FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN supplier ON s_suppkey = l_suppkey
JOIN nation ON s_nationkey = n_nationkey GROUP BY 1 HAVING count(DISTINCT n_regionkey) = (SELECT count(*) FROM region)""")
def ordered_in_every_region(t):
    """Relational division: as many distinct supplier regions as there are regions."""
    home = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "n_regionkey")
    per_order = lookup(t.lineitem.select("l_orderkey", "l_suppkey"), home, [("l_suppkey", "s_suppkey")]).select(
        "l_orderkey", "n_regionkey").distinct()
    pairs = per_order.join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")).select(
        "o_custkey", "n_regionkey").distinct()
    regions = t.region.count()
    return pairs.groupBy("o_custkey").agg(_count().alias("k")).filter(F.col("k") == regions).select("o_custkey")


@query("l25_days_above_p90", """
WITH d AS (SELECT CAST(o_orderdate AS DATE) AS dt, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS v
  FROM orders GROUP BY 1)
SELECT strftime(dt, '%Y-%m-%d') AS dt, v FROM d WHERE v > (SELECT quantile_cont(v, 0.9) FROM d)""")
def days_above_p90(t):
    days = t.orders.groupBy(F.to_date("o_orderdate").alias("dt")).agg(F.sum(cents("o_totalprice")).alias("v"))
    limit = days.agg(F.percentile("v", F.lit(0.9))).first()[0]
    return days.filter(F.col("v") > F.lit(limit)).select(day("dt").alias("dt"), "v")


@query("l26_cohort_retention", """
WITH c AS (SELECT o_custkey, min(o_orderdate) AS a, max(o_orderdate) AS z FROM orders GROUP BY 1)
SELECT strftime(a, '%Y-%m') AS cohort, count(*) AS customers, count_if(z >= a + INTERVAL 90 DAY) AS retained,
  round(count_if(z >= a + INTERVAL 90 DAY) * 100.0 / count(*), 6) AS retention FROM c GROUP BY 1""")
def cohort_retention(t):
    spans = t.orders.groupBy("o_custkey").agg(F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("z"))
    kept = F.count_if(F.col("z") >= F.col("a") + F.expr("INTERVAL 90 DAYS"))
    return spans.groupBy(month("a").alias("cohort")).agg(
        _count().alias("customers"), kept.alias("retained"), F.round(kept * 100.0 / _count(), 6).alias("retention"))


@query("l27_category_share_by_region", f"""
WITH {GEO_SQL}, g AS (SELECT r_name, p_type, sum({_REV}) AS r FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN geo ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)
SELECT r_name, p_type, round(r / sum(r) OVER (PARTITION BY r_name), 8) AS share,
  rank() OVER (PARTITION BY r_name ORDER BY r DESC) AS place FROM g""")
def category_share_by_region(t):
    typed = lookup(t.lineitem, t.part.select("p_partkey", "p_type"), [("l_partkey", "p_partkey")])
    per_order = typed.groupBy("l_orderkey", "p_type").agg(F.sum(revenue()).alias("r"))
    per_customer = per_order.join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")).groupBy(
        "o_custkey", "p_type").agg(F.sum("r").alias("r"))
    per_region = with_customer(t, per_customer).groupBy("r_name", "p_type").agg(F.sum("r").alias("r"))
    w = W.partitionBy("r_name")
    return per_region.select("r_name", "p_type", F.round(F.col("r") / F.sum("r").over(w), 8).alias("share"),
                             F.rank().over(w.orderBy(F.desc("r"))).cast("bigint").alias("place"))


@query("l28_more_orders_in_q4", f"""
WITH {LTV_SQL}, q AS (SELECT o_custkey, ntile(4) OVER (ORDER BY ltv DESC, o_custkey) AS band FROM ltv),
 c AS (SELECT o_custkey, count_if(quarter(o_orderdate) = 3) AS q3, count_if(quarter(o_orderdate) = 4) AS q4 FROM orders
   WHERE year(o_orderdate) = 2000 GROUP BY 1)
SELECT o_custkey, q3, q4, band FROM c JOIN q USING (o_custkey) WHERE q4 > q3""")
def more_orders_in_q4(t):
    year = t.orders.filter((F.col("o_orderdate") >= _at("2000-07-01")) & (F.col("o_orderdate") < _at("2001-01-01")))
    counts = year.groupBy("o_custkey").agg(F.count_if(F.col("o_orderdate") < _at("2000-10-01")).alias("q3"),
                                           F.count_if(F.col("o_orderdate") >= _at("2000-10-01")).alias("q4"))
    bands = ranked(lifetime_value(t), [], "ltv", "o_custkey").rows().select("o_custkey", ntile(4).alias("band"))
    return counts.filter("q4 > q3").join(bands, "o_custkey")


def conversions(t):
    """Per user and device: first click, and whether a purchase followed it."""
    device = F.get_json_object("props", "$.k").cast("int") % 3
    steps = t.events.filter(F.col("event_type").isin("click", "purchase")).groupBy("user_id", device.alias("device")).agg(
        F.min(F.when(F.col("event_type") == "click", F.col("ts"))).alias("a"),
        F.max(F.when(F.col("event_type") == "purchase", F.col("ts"))).alias("z")).filter(F.col("a").isNotNull())
    flags = steps.select("user_id", "device", F.coalesce(F.col("z") > F.col("a"), F.lit(False)).cast("bigint").alias("bought"))
    return flags.join(t.customer_geo(), F.col("user_id") == F.col("c_custkey"))


_STEPS = f"""{GEO_SQL}, f AS (SELECT user_id, CAST(json_extract_string(props, '$.k') AS INTEGER) % 3 AS device,
  min(ts) FILTER (WHERE event_type = 'click') AS a, max(ts) FILTER (WHERE event_type = 'purchase') AS z FROM events GROUP BY 1, 2),
 b AS (SELECT user_id, device, coalesce(z > a, false) AS bought FROM f WHERE a IS NOT NULL)"""


@query("l29_funnel", f"""
WITH {_STEPS} SELECT r_name, device, count(*) AS added, count_if(bought) AS purchased,
  round(count_if(bought) / count(*), 8) AS rate FROM b JOIN geo ON user_id = c_custkey GROUP BY 1, 2""")
def funnel(t):
    return conversions(t).groupBy("r_name", "device").agg(
        _count().alias("added"), F.sum("bought").alias("purchased"), F.round(F.sum("bought") / _count(), 8).alias("rate"))


@query("l30_falling_order_value", f"""
WITH m AS (SELECT c_mktsegment, CAST(year(o_orderdate) * 12 + month(o_orderdate) AS DOUBLE) AS m, avg(o_totalprice) AS v FROM orders
  JOIN customer ON o_custkey = c_custkey WHERE o_orderdate >= TIMESTAMP '2001-02-01' AND o_orderdate < TIMESTAMP '2001-08-01'
  GROUP BY 1, 2)
SELECT c_mktsegment, round(regr_slope(v, m), 4) AS slope FROM m GROUP BY 1 HAVING regr_slope(v, m) < 0""")
def falling_order_value(t):
    half = t.orders.filter((F.col("o_orderdate") >= _at("2001-02-01")) & (F.col("o_orderdate") < _at("2001-08-01")))
    m = (F.year("o_orderdate") * 12 + F.month("o_orderdate")).cast("double")
    per = half.groupBy("o_custkey", m.alias("m")).agg(F.sum("o_totalprice").alias("s"), _count().alias("k"))
    months = per.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).groupBy("c_mktsegment", "m").agg(
        (F.sum("s") / F.sum("k")).alias("v"))
    return months.groupBy("c_mktsegment").agg(F.regr_slope("v", "m").alias("s")).filter("s < 0").select(
        "c_mktsegment", F.round("s", 4).alias("slope"))


@query("l31_top_products_last_month", f"""
SELECT p_partkey, p_name, round(sum({_REV}), 4) AS total_revenue, count(DISTINCT l_orderkey) AS order_count
FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_shipdate >= TIMESTAMP '2001-07-01' AND l_shipdate < TIMESTAMP '2001-08-01'
GROUP BY 1, 2 ORDER BY 3 DESC, 1 LIMIT 5""")
def top_products_last_month(t):
    july = t.lineitem.filter((F.col("l_shipdate") >= _at("2001-07-01")) & (F.col("l_shipdate") < _at("2001-08-01")))
    return top_products(t, july, 5)


@query("l32_customers_per_segment", f"""
WITH {LTV_SQL} SELECT c_mktsegment, count(*) AS customers, round(avg(ltv) / 100, 6) AS average_value
FROM ltv JOIN customer ON o_custkey = c_custkey GROUP BY 1""")
def customers_per_segment(t):
    return lifetime_value(t).join(t.customer, F.col("o_custkey") == F.col("c_custkey")).groupBy("c_mktsegment").agg(
        _count().alias("customers"), F.round(F.avg("ltv") / 100, 6).alias("average_value"))


@query("l33_daily_revenue_trend", f"""
WITH {_DAILY}, s AS (SELECT CAST(unnest(generate_series(DATE '2001-07-02', DATE '2001-07-31', INTERVAL 1 DAY)) AS DATE) AS dt)
SELECT strftime(s.dt, '%Y-%m-%d') AS dt, coalesce(v, 0) AS revenue FROM s LEFT JOIN d ON d.dt = s.dt AND r_name = 'AMERICA'""")
def daily_revenue_trend(t):
    recent = t.orders.filter((F.col("o_orderdate") >= _at("2001-07-02")) & (F.col("o_orderdate") < _at("2001-08-01")))
    per = recent.groupBy("o_custkey", F.to_date("o_orderdate").alias("dt")).agg(F.sum(cents("o_totalprice")).alias("v"))
    america = t.customer_geo().filter("r_name = 'AMERICA'").select("c_custkey")
    sums = lookup(per, america, [("o_custkey", "c_custkey")]).groupBy("dt").agg(F.sum("v").alias("v"))
    days = F.sequence(F.lit("2001-07-02").cast("date"), F.lit("2001-07-31").cast("date"))
    spine = t.region.filter("r_name = 'AMERICA'").select(F.explode(days).alias("dt"))
    return spine.join(sums, "dt", "left").select(day("dt").alias("dt"), F.coalesce("v", F.lit(0)).alias("revenue"))


@query("l34_best_conversion_region", f"""
WITH {_STEPS} SELECT r_name, round(count_if(bought) / count(*), 8) AS rate FROM b JOIN geo ON user_id = c_custkey
GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1""")
def best_conversion_region(t):
    return conversions(t).groupBy("r_name").agg(F.round(F.sum("bought") / _count(), 8).alias("rate")).orderBy(
        F.desc("rate"), "r_name").limit(1)
