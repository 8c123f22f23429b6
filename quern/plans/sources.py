"""Source and sink queries: tables are written in a format and read back."""

from pyspark.sql import functions as F

from quern import settings
from quern.operators import curation
from quern.plans.curation import _AUDIT, REASON_SQL, candidate_pairs
from quern.plans.registry import query
from quern.sources import files


@query("a01_csv_typed", """
SELECT c_custkey, c_name || ' é' AS c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey, c_acctbal FROM customer""")
def csv_typed(t):
    """ISO-8859-1 file, one code column read as text."""
    path = settings.scratch(t.spark, "csv")
    t.customer.select("c_custkey", F.concat("c_name", F.lit(" é")).alias("c_name"), "c_nationkey", "c_acctbal").write.option(
        "header", True).option("encoding", "ISO-8859-1").csv(path)
    return files.read_csv(t.spark, path, "c_custkey bigint, c_name string, c_nationkey string, c_acctbal double")


@query("a02_csv_inferred", "SELECT p_partkey AS index, p_name, CAST(p_size AS BIGINT) AS p_size, p_retailprice FROM part")
def csv_inferred(t):
    path = settings.scratch(t.spark, "csv")
    t.part.select(F.col("p_partkey").alias("Unnamed: 0"), "p_name", "p_size", "p_retailprice").write.option("header", True).csv(path)
    return files.read_csv_inferred(t.spark, path, {"index": "bigint", "p_size": "bigint", "p_retailprice": "double"})


_SALES = """
SELECT DISTINCT p.p_partkey, p.p_name FROM part p JOIN lineitem s ON p.p_partkey = s.l_partkey
WHERE s.l_quantity = 50 AND NOT EXISTS (SELECT 1 FROM lineitem x WHERE x.l_partkey = p.p_partkey AND x.l_discount = 0.1
  AND x.l_quantity > 40)"""


@query("a03_sql_over_tables", _SALES)
def sql_over_tables(t):
    return files.run_sql(t.spark, _SALES, {"part": t.part, "lineitem": t.lineitem})


@query("a04_largest_files")
def largest_files(t):
    return files.largest_files(t.spark, t.directory).select(F.regexp_extract("path", "[^/]*$", 0).alias("file"), "length")


def audited(t):
    return curation.audit(candidate_pairs(t), "id")


@query("a05_json_accepted", f"""
WITH RECURSIVE {_AUDIT} SELECT id, question, sql, 'simple' AS tier, 'orders,customers' AS tables, CAST(length(sql) AS BIGINT) AS exec_rows,
  round(audited.cosine, 3) AS consistency, audited.score AS quality FROM audited JOIN gated USING (id) WHERE stage = 'ACCEPTED'""")
def json_accepted(t):
    path = settings.scratch(t.spark, "accepted")
    files.save_accepted(audited(t).filter("stage = 'ACCEPTED'").select(
        "id", "question", "sql", F.lit("simple").alias("tier"), F.array(F.lit("orders"), F.lit("customers")).alias("tables_used"),
        F.length("sql").alias("execution_rows"), F.col("cosine").alias("consistency_score"), F.col("score").alias("quality_score")), path)
    back = t.spark.read.schema("id bigint, question string, sql string, tier string, tables array<string>, exec_rows bigint, "
                               "consistency double, quality double").json(path)
    return back.withColumn("tables", F.array_join("tables", ","))


@query("a06_json_rejected", f"""
WITH RECURSIVE {_AUDIT} SELECT id, question, sql, stage, {REASON_SQL}
FROM audited JOIN gated USING (id) WHERE stage <> 'ACCEPTED'""")
def json_rejected(t):
    path = settings.scratch(t.spark, "rejected")
    rejected = audited(t).filter("stage <> 'ACCEPTED'")
    files.save_rejected(rejected.withColumn("rejection_reason", curation.rejection_reason()), path)
    return t.spark.read.schema("id bigint, question string, sql string, rejection_reason string, stage string").json(path)


@query("a07_result_cap", "SELECT event_id, user_id, event_type FROM events ORDER BY event_id LIMIT 1000")
def result_cap(t):
    return files.capped(t.events.select("event_id", "user_id", "event_type"), ["event_id"], 1000)


@query("a07_preview", "SELECT event_id, user_id, event_type FROM events ORDER BY event_id LIMIT 20")
def preview(t):
    return files.capped(t.events.select("event_id", "user_id", "event_type"), ["event_id"], 20)
