"""Curation of text pairs: gates, quotas, audit trail, funnel and template fill."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quern.operators.ordered import Ordered, position, running
from quern.operators.similarity import CONSISTENT, NEAR, greedy_dedup, pair_cosine, unit_vectors

# Share of each complexity tier.
TIER_SHARES = {"simple": 0.20, "join": 0.25, "aggregate": 0.25, "window": 0.12, "nested": 0.10, "analytical": 0.08}

# Rubric weights and pass mark.
RUBRIC = {"logical_correctness": 0.30, "nl_naturalness": 0.20, "sql_style": 0.20, "schema_grounding": 0.20, "specificity": 0.10}
PASS_MARK = 0.72

# Why a pair was rejected, by stage; {score} has two places, texts are cut to 80 characters.
REASONS = {
    "EXEC": "EXEC_FAIL: not a read-only query",
    "CONSISTENCY": "CONSISTENCY_FAIL: score={score} (need ≥0.45)\n  Original: {question}\n  BackT:    {back_question}",
    "DEDUP": "DEDUP: near-duplicate of accepted question",
    "QUALITY": "QUALITY_FAIL: score={score} < 0.72",
}

# Question templates of each tier.
TEMPLATES = {
    "simple": [
        "What is the total {agg} of {col} for orders with status = '{status}'?",
        "List all {entity} where {col} is in {region} and {date_col} > '{date}'",
        "How many {entity} have {col} greater than {threshold}?",
        "What is the average {col} across all {entity}?",
        "Find {entity} where {flag_col} is {flag_val}",
    ],
    "join": [
        "Which customers placed the most orders last quarter, and what segment are they in?",
        "What is the average order value by product category?",
        "List customers who bought from the '{category}' category in '{month}'",
        "What is the total revenue per customer segment for active customers only?",
        "Which products have been ordered by the most enterprise customers?",
    ],
    "aggregate": [
        "What are the top {n} {entity} by {agg}({col}), grouped by {group_col}?",
        "Show monthly revenue trend with month-over-month growth percentage",
        "Which {group_col} has the highest average {col} among groups with more than {threshold} records?",
        "What is the {col} distribution (min, max, avg, stddev) by {group_col}?",
        "Find {group_col} where the total {col} exceeds the overall average",
    ],
    "window": [
        "Rank customers by lifetime value within each country",
        "What is the 7-day rolling average of daily order count by region?",
        "For each product, what is the revenue this month vs previous month (LAG)?",
        "Show the cumulative revenue per region ordered by date",
        "Which customers are in the top 25% by LTV within their segment (NTILE)?",
    ],
    "nested": [
        "Find customers whose total spend exceeds the average total spend across all customers",
        "Which products have never been ordered by enterprise customers?",
        "List the top 3 products per category by revenue (using a subquery or CTE)",
        "Find customers who placed orders in every region",
        "Which days had revenue above the 90th percentile across all days?",
    ],
    "analytical": [
        "Show customer cohort retention: for each signup month, what % are still active 90 days later?",
        "What is the product category revenue share by region, ranked within each region?",
        "Find customers who increased their order frequency in Q4 vs Q3, along with their LTV segment",
        "Show the funnel conversion rate from add_to_cart to purchase by region and device type",
        "Which customer segments show declining AOV trend over the last 6 months?",
    ],
}

# What fills the slots of a template.
SLOTS = {
    "agg": ["SUM", "COUNT", "AVG", "MAX", "MIN"],
    "status": ["completed", "pending", "cancelled"],
    "entity": ["orders", "customers", "products", "user_events", "daily_revenue"],
    "region": ["North America", "EMEA", "APAC"],
    "date_col": ["ORDER_DATE"],
    "date": [f"2024-{m:02d}-01" for m in range(1, 13)],
    "threshold": ["100", "500", "1000", "5000"],
    "flag_col": ["IS_ACTIVE"],
    "flag_val": ["TRUE"],
    "n": ["3", "5", "10"],
    "group_col": ["REGION", "SEGMENT", "CATEGORY", "COUNTRY", "STATUS"],
    "category": ["Electronics", "Apparel", "Software", "Home"],
    "month": [f"2024-{m:02d}" for m in range(1, 13)],
    "segment": ["enterprise", "mid-market", "smb"],
}


def tier_targets(target: int) -> dict[str, int]:
    """Rows wanted per tier: halves go to the even number, never below 1."""
    return {tier: max(1, round(target * share)) for tier, share in TIER_SHARES.items()}


def hash_number(*parts) -> Column:
    """A whole number below 2^32 from the md5 of the parts: the same on every run."""
    text = F.concat_ws("-", *[p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def pick(options: list[str], *seed) -> Column:
    if len(options) == 1:
        return F.lit(options[0])
    values = F.array(*[F.lit(o) for o in options])
    return F.get(values, (hash_number(*seed) % len(options)).cast("int"))


def fill_templates(df: DataFrame, key: str, tier: str, columns: list[str]) -> DataFrame:
    """A question per row: a template of its tier with every slot filled."""
    k = F.col(key)
    template = reduce(
        lambda rest, name: F.when(F.col(tier) == name, pick(TEMPLATES[name], k, "template")).otherwise(rest),
        TEMPLATES, F.lit(None).cast("string"))
    text = F.col("_template")
    for slot, options in {**SLOTS, "col": columns}.items():
        text = F.replace(text, F.lit("{" + slot + "}"), pick(options, k, slot))
    return df.withColumn("_template", template).withColumn("question", text).drop("_template")


def rubric_score(df: DataFrame, judged: str) -> Column:
    """Weighted sum; a missing dimension counts 0.5, a row without judgement 0."""
    total = reduce(lambda a, b: a + b, [F.coalesce(F.col(d), F.lit(0.5)) * w for d, w in RUBRIC.items()])
    return F.when(F.col(judged), F.round(total, 3)).otherwise(F.lit(0.0))


def take_quota(df: DataFrame, tier: str, key: str, targets: dict[str, int]) -> DataFrame:
    """Up to the tier's quota of rows, in order of the md5 of their key.

    The constant upper limit lets Spark cut every tier before the shuffle.
    """
    quota = F.create_map(*[F.lit(x) for pair in targets.items() for x in pair])[F.col(tier)]
    w = W.partitionBy(tier).orderBy(F.md5(F.col(key).cast("string")), key)
    return df.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= max(targets.values())).filter(
        F.col("place") <= quota)


def sample_remaining(df: DataFrame, tier: str, key: str, accepted: DataFrame, targets: dict[str, int], seed: str) -> DataFrame:
    """Sample each tier at the rate its quota is still open: remaining / available."""
    have = {r[0]: r[1] for r in accepted.groupBy(tier).count().collect() if r[0] in targets}
    available = {r[0]: r[1] for r in df.groupBy(tier).count().collect() if r[0] in targets}
    rate = F.lit(0.0)
    for name, quota in targets.items():
        share = max(quota - have.get(name, 0), 0) / max(available.get(name, 0), 1)
        rate = F.when(F.col(tier) == name, min(share, 1.0)).otherwise(rate)
    return df.filter(hash_number(F.col(key), seed) < rate * float(2**32))


def passes_sql_gate(sql: Column) -> Column:
    """A query (SELECT or WITH) without data-changing words."""
    return sql.rlike(r"(?i)^\s*(select|with)\b") & ~sql.rlike(r"(?i)\b(drop|delete|insert)\b")


def audit(pairs: DataFrame, key: str) -> DataFrame:
    """First failing stage of every pair, in the order EXEC, CONSISTENCY, DEDUP, QUALITY.

    ``pairs``: key, question, back_question, sql, score.  Only pairs that pass the
    first two stages enter the duplicate check, and those that fail QUALITY can be
    rejected there but never reject others.
    """
    cosine = pair_cosine(pairs, key, "question", "back_question")
    gated = pairs.join(cosine, key).withColumn(
        "stage",
        F.when(~passes_sql_gate(F.col("sql")), "EXEC").when(F.col("cosine") < CONSISTENT, "CONSISTENCY"))
    open_ = gated.filter(F.col("stage").isNull()).select(key, "question", (F.col("score") >= PASS_MARK).alias("good"))
    vectors = unit_vectors(open_, key, "question").join(open_.select(key, "good"), key)
    copies = greedy_dedup(vectors, key, NEAR, "good")
    return gated.join(copies, key, "left").withColumn(
        "stage",
        F.coalesce(
            "stage",
            F.when(F.col("duplicate_of").isNotNull(), "DEDUP").when(F.col("score") < PASS_MARK, "QUALITY"),
            F.lit("ACCEPTED")))


def rejection_reason() -> Column:
    """The stage in words, with the number that failed to two places and the texts it is about."""
    stage = F.col("stage")
    score = F.when(stage == "CONSISTENCY", F.col("cosine")).otherwise(F.col("score"))
    text = reduce(lambda rest, s: F.when(stage == s, REASONS[s]).otherwise(rest), REASONS, F.lit(None).cast("string"))
    text = F.replace(text, F.lit("{score}"), F.format_number(score, 2))  # rounds the binary value, unlike format_string
    for name in ("question", "back_question"):
        text = F.replace(text, F.lit("{" + name + "}"), F.substring(name, 1, 80))
    return text


def funnel(audited: DataFrame) -> DataFrame:
    """Rows left after each stage and what share of the stage before that is, in one row."""
    stage = F.col("stage")
    left = lambda *out: F.count_if(~stage.isin(*out)) if out else F.count(F.lit(1))
    one = audited.agg(
        left().alias("generated"), left("EXEC").alias("exec_pass"),
        left("EXEC", "CONSISTENCY").alias("backt_pass"), left("EXEC", "CONSISTENCY", "DEDUP").alias("dedup_pass"),
        F.count_if(stage == "ACCEPTED").alias("accepted"))
    share = lambda a, b: F.round(F.col(a) / F.greatest(F.col(b), F.lit(1)) * 100, 4)
    return one.select(
        "*", share("exec_pass", "generated").alias("exec_pct"), share("backt_pass", "exec_pass").alias("backt_pct"),
        share("dedup_pass", "backt_pass").alias("dedup_pct"), share("accepted", "generated").alias("yield_pct"))


def transcripts(turns: DataFrame, keys: list[str], order: str, line: Column) -> DataFrame:
    """The lines of every transcript in order: (keys, place, start, line).

    ``place`` counts from 0; ``start`` is where the line begins in the text that the lines
    make, joined by newlines.  A conversation of any length has this one shape.
    """
    o = Ordered(turns.select(*keys, order, line.alias("line")), keys, [order]).scan(
        place=position(), start=running("sum", F.length("line").cast("bigint") + 1, before=True))
    return o.rows().select(*keys, (F.col("place") - 1).alias("place"), F.coalesce("start", F.lit(0)).alias("start"), "line")
