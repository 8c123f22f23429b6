"""Projection, filtering and cleaning queries."""

from pyspark.sql import functions as F

from quern.functions import expressions as X
from quern.plans.registry import query
from quern.tables import day


@query("c01_drop_columns", "SELECT * EXCLUDE (p_name, p_brand) FROM part")
def drop_columns(t):
    return t.part.drop("p_name", "p_brand")


@query("c02_derived_column", """
SELECT p_partkey, p_size + CAST(replace(p_brand, 'Brand#', '') AS INTEGER) + 1 AS family FROM part""")
def derived_column(t):
    brand = F.regexp_replace("p_brand", "Brand#", "").cast("int")
    return t.part.select("p_partkey", (F.col("p_size") + brand + 1).alias("family"))


@query("c03_equality_filter", """
SELECT o_orderkey, o_totalprice FROM orders WHERE year(o_orderdate) = 1998 AND o_orderstatus = 'F'""")
def equality_filter(t):
    """One year, written as a range so that the scan can skip row groups."""
    return t.orders.filter(
        (F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz"))
        & (F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz"))
        & (F.col("o_orderstatus") == "F")
    ).select("o_orderkey", "o_totalprice")


@query("c04_not_equal_keeps_missing", """
SELECT l_returnflag, count(*) AS n, count(d) AS known
FROM (SELECT l_returnflag, nullif(l_discount, 0.1) AS d FROM lineitem)
WHERE d IS DISTINCT FROM 0.0 GROUP BY 1""")
def not_equal_keeps_missing(t):
    missing = t.lineitem.select("l_returnflag", F.nullif("l_discount", F.lit(0.1)).alias("d"))
    return missing.filter(~F.col("d").eqNullSafe(0.0)).groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.count("d").alias("known"))


@query("c05_closed_range", """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate FROM orders
WHERE o_orderdate BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1997-03-31'""")
def closed_range(t):
    return t.orders.filter(F.col("o_orderdate").between(
        F.lit("1997-01-01").cast("timestamp_ntz"), F.lit("1997-03-31").cast("timestamp_ntz"))
    ).select("o_orderkey", day("o_orderdate").alias("o_orderdate"))


@query("c05_range_complement", """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate FROM orders
WHERE o_orderdate < TIMESTAMP '1997-01-01' OR o_orderdate > TIMESTAMP '1997-03-31'""")
def range_complement(t):
    return t.orders.filter(
        (F.col("o_orderdate") < F.lit("1997-01-01").cast("timestamp_ntz"))
        | (F.col("o_orderdate") > F.lit("1997-03-31").cast("timestamp_ntz"))
    ).select("o_orderkey", day("o_orderdate").alias("o_orderdate"))


@query("c06_one_month", """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate FROM orders
WHERE o_orderdate >= TIMESTAMP '1998-04-01' AND o_orderdate < TIMESTAMP '1998-05-01'""")
def one_month(t):
    """A half-open calendar month: exactly April, whatever the time of day."""
    start = F.lit("1998-04-01").cast("timestamp_ntz")
    end = F.add_months(F.lit("1998-04-01").cast("date"), 1).cast("timestamp_ntz")
    return t.orders.filter((F.col("o_orderdate") >= start) & (F.col("o_orderdate") < end)).select(
        "o_orderkey", day("o_orderdate").alias("o_orderdate"))


@query("c07_category_list", """
SELECT doc_id, source, lang, CASE WHEN n_chars < 500 THEN 'short' WHEN n_chars < 2000 THEN 'medium' ELSE 'long' END
  AS length_class
FROM documents WHERE lang IN ('de', 'fr') AND source = 'src3'""")
def category_list(t):
    length = F.when(F.col("n_chars") < 500, "short").when(F.col("n_chars") < 2000, "medium").otherwise("long")
    return t.documents.filter(F.col("lang").isin("de", "fr") & (F.col("source") == "src3")).select(
        "doc_id", "source", "lang", length.alias("length_class"))


@query("c08_membership", """
SELECT p_partkey, p_name FROM part WHERE p_partkey IN (
  SELECT l_partkey FROM lineitem WHERE l_quantity = 50 AND l_discount = 0)""")
def membership(t):
    keys = t.lineitem.filter((F.col("l_quantity") == 50) & (F.col("l_discount") == 0))
    return t.part.select("p_partkey", "p_name").join(
        keys, F.col("p_partkey") == F.col("l_partkey"), "left_semi")


_MAIL_SQL = """CASE c_nationkey % 4 WHEN 0 THEN replace(c_name, '#', '_') || '@' || lower(c_mktsegment) || '.com'
  WHEN 1 THEN replace(c_name, '#', '_') || '@' || lower(c_mktsegment) || '.com.au'
  WHEN 2 THEN c_name || '@' || lower(c_mktsegment) || '.com'
  ELSE replace(c_name, '#', '_') || '@' || lower(c_mktsegment) || c_nationkey || '.com' END"""


@query("c09_valid_email", f"""
SELECT c_custkey, mail FROM (SELECT c_custkey, {_MAIL_SQL} AS mail FROM customer)
WHERE regexp_full_match(mail, '[a-zA-Z0-9_]+@[a-zA-Z]+\\.com') ORDER BY c_custkey""")
def valid_email(t):
    kind, name = F.col("c_nationkey") % 4, F.regexp_replace("c_name", "#", "_")
    host = F.lower("c_mktsegment")
    mail = (
        F.when(kind == 0, F.concat(name, F.lit("@"), host, F.lit(".com")))
        .when(kind == 1, F.concat(name, F.lit("@"), host, F.lit(".com.au")))
        .when(kind == 2, F.concat("c_name", F.lit("@"), host, F.lit(".com")))
        .otherwise(F.concat(name, F.lit("@"), host, F.col("c_nationkey").cast("string"), F.lit(".com")))
    )
    return t.customer.select("c_custkey", mail.alias("mail")).filter(
        X.is_valid_email(F.col("mail"))).orderBy("c_custkey")


_MAILS_SQL = r"""SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z0-9._+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+')) AS mail
FROM documents"""


@query("c09_email_in_text", rf"""
SELECT doc_id, mail, count(*) AS n, regexp_full_match(mail, '[a-zA-Z0-9_]+@[a-zA-Z]+\.com') AS valid
FROM ({_MAILS_SQL}) GROUP BY doc_id, mail""")
def email_in_text(t):
    return t.documents.select("doc_id", F.explode(X.emails(F.col("text"))).alias("mail")).groupBy(
        "doc_id", "mail").agg(F.count(F.lit(1)).alias("n")).withColumn("valid", X.is_valid_email(F.col("mail")))


@query("c10_valid_serial", """
SELECT p_partkey, p_name, d AS description FROM (
  SELECT p_partkey, p_name, p_type || ' SN' || p_partkey || '-' || (990 + p_size * 200) ||
    CASE WHEN p_size % 2 = 0 THEN ' ok' ELSE '' END AS d FROM part)
WHERE regexp_matches(d, 'SN[0-9]{4}-[0-9]{4}([^0-9]|$)') ORDER BY p_partkey""")
def valid_serial(t):
    text = F.concat(
        F.col("p_type"), F.lit(" SN"), F.col("p_partkey"), F.lit("-"), 990 + F.col("p_size") * 200,
        F.when(F.col("p_size") % 2 == 0, " ok").otherwise(""))
    return t.part.select("p_partkey", "p_name", text.alias("description")).filter(
        X.has_valid_serial(F.col("description"))).orderBy("p_partkey")


@query("c11_order_by_key", "SELECT c_custkey, c_name FROM customer ORDER BY c_custkey")
def order_by_key(t):
    return t.customer.select("c_custkey", "c_name").orderBy("c_custkey")


@query("c12_drop_missing", """
SELECT o_orderkey, p, d FROM (SELECT o_orderkey, nullif(o_orderpriority, '4-NOT SPECIFIED') AS p,
  nullif(o_orderstatus, 'P') AS d FROM orders) WHERE p IS NOT NULL AND d IS NOT NULL""")
def drop_missing(t):
    return t.orders.select(
        "o_orderkey", F.nullif("o_orderpriority", F.lit("4-NOT SPECIFIED")).alias("p"),
        F.nullif("o_orderstatus", F.lit("P")).alias("d")).na.drop("any")


@query("c13_fill_mean", """
WITH m AS (SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS b FROM customer)
SELECT c_custkey, round(coalesce(b, (SELECT avg(b) FROM m)), 6) AS balance FROM m""")
def fill_mean(t):
    known = t.customer.select("c_custkey", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("balance"))
    mean = known.agg(F.avg("balance").alias("_mean"))  # one row; its mean is NULL where nothing is known
    one = F.lit(1).alias("_one")
    return known.select("*", one).join(F.broadcast(mean.select("*", one)), "_one").select("c_custkey", F.round(F.coalesce("balance", "_mean"), 6).alias("balance"))


@query("c14_text_to_timestamp", """
SELECT o_orderkey, coalesce(strftime(try_strptime(s, '%d/%m/%Y'), '%Y-%m-%d'), 'missing') AS at FROM (
  SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'pending' ELSE strftime(o_orderdate, '%d/%m/%Y') END AS s
  FROM orders)""")
def text_to_timestamp(t):
    text = F.when(F.col("o_orderstatus") == "P", "pending").otherwise(F.date_format("o_orderdate", "dd/MM/yyyy"))
    parsed = F.try_to_timestamp(text, F.lit("dd/MM/yyyy"))
    return t.orders.select("o_orderkey", F.coalesce(F.date_format(parsed, "yyyy-MM-dd"), F.lit("missing")).alias("at"))


@query("c15_binning", """
SELECT p_partkey, age, CASE WHEN age > 0 AND age <= 11 THEN 'Child' WHEN age <= 17 THEN 'Youth'
  WHEN age <= 25 THEN 'Young Adult' WHEN age <= 65 THEN 'Adult' WHEN age <= 80 THEN 'Senior' END AS age_group
FROM (SELECT p_partkey, p_size + CAST(replace(p_brand, 'Brand#', '') AS INTEGER) AS age FROM part)""")
def binning(t):
    age = F.col("p_size") + F.regexp_replace("p_brand", "Brand#", "").cast("int")
    return t.part.select("p_partkey", age.alias("age")).withColumn(
        "age_group", X.cut(F.col("age"), X.AGE_BINS, X.AGE_LABELS))


@query("c16_ilike", "SELECT p_partkey, p_name FROM part WHERE p_name ILIKE '%RING%'")
def ilike(t):
    return t.part.select("p_partkey", "p_name").filter(F.col("p_name").ilike("%RING%"))


@query("c17_flag_filter", """
SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders
  WHERE o_orderdate >= TIMESTAMP '2001-05-03')""")
def flag_filter(t):
    """IS_ACTIVE: an order within 90 days of 2001-08-01."""
    flags = t.orders.groupBy("o_custkey").agg(
        (F.max("o_orderdate") >= F.lit("2001-05-03").cast("timestamp_ntz")).alias("is_active"))
    return t.customer.join(flags.filter("is_active"), F.col("c_custkey") == F.col("o_custkey")).select(
        "c_custkey", "c_name")
