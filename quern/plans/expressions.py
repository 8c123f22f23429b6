"""Column expression queries."""

from pyspark.sql import functions as F

from quern.functions import expressions as X
from quern.functions import text as T
from quern.plans.registry import query


@query("h01_reverse_words", """
SELECT doc_id, array_to_string(list_reverse(list_filter(string_split(text, ' '), lambda w: w <> '')), ' ') AS reversed
FROM documents""")
def reverse_words(t):
    return t.documents.select("doc_id", X.reverse_words(F.col("text")).alias("reversed"))


@query("h03_last_word_length", """
SELECT doc_id, CAST(length(string_split(rtrim(text), ' ')[-1]) AS BIGINT) AS n FROM documents""")
def last_word_length(t):
    return t.documents.select("doc_id", X.last_word_length(F.col("text")).cast("bigint").alias("n"))


@query("h05_lenient_integer", """
WITH s AS (SELECT page_id, CASE page_id % 3 WHEN 0 THEN '  ' WHEN 1 THEN ' -' ELSE '+' END ||
    regexp_extract(url, '[0-9].*$') AS raw FROM pages)
SELECT page_id, raw, CAST(least(greatest(coalesce(try_cast(regexp_extract(trim(raw), '^([+-]?[0-9]+)', 1) AS BIGINT), 0),
  -2147483648), 2147483647) AS BIGINT) AS n FROM s""")
def lenient_integer(t):
    sign = F.when(F.col("page_id") % 3 == 0, "  ").when(F.col("page_id") % 3 == 1, " -").otherwise("+")
    raw = F.concat(sign, F.regexp_extract("url", "[0-9].*$", 0))
    return t.pages.select("page_id", raw.alias("raw")).withColumn("n", X.lenient_int(F.col("raw")).cast("bigint"))


_WEIGHTS = [(7 * i + 5) % 26 + 1 for i in range(26)]


@query("h08_word_weights", rf"""
SELECT doc_id, array_to_string(list_transform(list_filter(regexp_split_to_array(lower(text), '[^\p{{L}}\p{{N}}_]+'),
  lambda w: regexp_full_match(w, '[a-z]{{3,}}')), lambda w: chr(CAST(122 - list_sum(list_transform(string_split(w, ''),
  lambda c: {_WEIGHTS}[ascii(c) - 96])) % 26 AS INTEGER))), '') AS letters FROM documents""")
def word_weights(t):
    return t.documents.select("doc_id", X.word_weights(T.tokens(F.col("text")), _WEIGHTS).alias("letters"))


@query("h09_fit_context", """
WITH m AS (SELECT doc_id, string_split(text, ' ') AS w, CASE lang WHEN 'en' THEN 'non-think' WHEN 'es' THEN 'max' ELSE 'high' END
    AS mode, CASE lang WHEN 'en' THEN 192 WHEN 'es' THEN 0 ELSE 72 END AS room FROM documents)
SELECT doc_id, mode, CASE WHEN room <= 0 THEN '' ELSE array_to_string(w[greatest(len(w) - room, 0) + 1 : len(w)], ' ') END AS kept
FROM m""")
def fit_context(t):
    """English keeps 192 tokens, Spanish none, the others 72, after the reserved part."""
    mode = F.when(F.col("lang") == "en", "non-think").when(F.col("lang") == "es", "max").otherwise("high")
    reserved = F.when(F.col("lang") == "en", 8000).when(F.col("lang") == "es", 393216).otherwise(131000)
    kept = X.fit_context(F.split("text", " "), F.col("mode"), reserved)
    return t.documents.withColumn("mode", mode).select("doc_id", "mode", F.array_join(kept, " ").alias("kept"))


@query("h10_date_arithmetic", """
SELECT o_orderkey, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS month_start,
  strftime(o_orderdate + INTERVAL 1 MONTH, '%Y-%m-%d') AS next_month,
  date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-08-01') AS age,
  o_orderdate >= TIMESTAMP '2001-07-01' AS recent FROM orders""")
def date_arithmetic(t):
    today = F.lit("2001-08-01").cast("date")
    return t.orders.select(
        "o_orderkey", day_of(F.date_trunc("month", "o_orderdate")).alias("month_start"),
        day_of(F.add_months("o_orderdate", 1)).alias("next_month"),
        F.datediff(today, F.to_date("o_orderdate")).cast("bigint").alias("age"),
        (F.to_date("o_orderdate") >= F.add_months(today, -1)).alias("recent"))


def day_of(column):
    return F.date_format(column, "yyyy-MM-dd")


@query("h11_conditional_safe_division", """
SELECT p_partkey, CASE WHEN p_size > 25 THEN 'big' ELSE 'small' END AS class,
  round(CASE WHEN p_size - 25 = 0 THEN 0 ELSE p_retailprice / (p_size - 25) END, 6) AS ratio FROM part""")
def conditional_safe_division(t):
    return t.part.select("p_partkey", F.expr("if(p_size > 25, 'big', 'small')").alias("class"),
                         F.round(X.div0(F.col("p_retailprice"), F.col("p_size") - 25), 6).alias("ratio"))


@query("h12_concat", "SELECT p_partkey, p_brand || ' / ' || p_name || ' / ' || p_type AS label FROM part")
def concat(t):
    return t.part.select("p_partkey", F.concat_ws(" / ", "p_brand", "p_name", "p_type").alias("label"))


@query("h13_json_path", """
SELECT event_id, json_extract_string(props, '$.k') AS k, CAST(json_extract_string(props, '$.k') AS BIGINT) + 1 AS next FROM events""")
def json_path(t):
    k = F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint")
    return t.events.select("event_id", F.get_json_object("props", "$.k").alias("k"), (k + 1).alias("next"))


_RAW = """CASE event_type WHEN 'view' THEN '```json' || chr(10) || props || chr(10) || '```'
  WHEN 'purchase' THEN '```' || chr(10) || props || '```' WHEN 'click' THEN 'Answer: ' || props || ' as asked'
  WHEN 'error' THEN 'no value {here' ELSE props END"""


@query("h14_tolerant_json", """
SELECT event_id, CASE event_type WHEN 'error' THEN -1 ELSE CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k FROM events""")
def tolerant_json(t):
    value = F.try_variant_get(X.tolerant_json(F.expr(_RAW)), "$.k", "bigint")
    return t.events.select("event_id", F.coalesce(value, F.lit(-1)).alias("k"))


@query("h15_strip_fences", "SELECT event_id, 'SELECT ' || user_id || ' AS u' AS sql FROM events")
def strip_fences(t):
    raw = F.expr("""CASE event_type WHEN 'view' THEN '```sql' || chr(10) || 'SELECT ' || user_id || ' AS u' || chr(10) || '```'
      WHEN 'click' THEN '```' || chr(10) || 'SELECT ' || user_id || ' AS u```  ' ELSE 'SELECT ' || user_id || ' AS u' END""")
    return t.events.select("event_id", X.strip_fences(raw, "sql").alias("sql"))


@query("h16_content_id", """
SELECT conv_id, turn, substr(md5(role || text), 1, 12) AS id FROM conversations""")
def content_id(t):
    return t.conversations.select("conv_id", "turn", X.content_id(F.col("role"), F.col("text")).alias("id"))


@query("h17_sigmoid", "SELECT c_custkey, round(1 / (1 + exp(-c_acctbal / 1000)), 10) AS s FROM customer")
def sigmoid(t):
    return t.customer.select("c_custkey", F.round(X.sigmoid(F.col("c_acctbal") / 1000), 10).alias("s"))


@query("h18_elu", """
SELECT c_custkey, round(CASE WHEN c_acctbal > 0 THEN c_acctbal / 1000 ELSE 0.5 * (exp(c_acctbal / 1000) - 1) END, 10) AS e
FROM customer""")
def elu(t):
    return t.customer.select("c_custkey", F.round(X.elu(F.col("c_acctbal") / 1000, 0.5), 10).alias("e"))


@query("h19_fahrenheit", "SELECT event_id, round(value * 9 / 5 + 32, 1) AS f FROM events")
def fahrenheit(t):
    return t.events.select("event_id", X.fahrenheit(F.col("value")).alias("f"))
