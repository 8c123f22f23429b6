"""Rules over a table of query texts, and table relevance for a table of questions.

Every rule is a column expression, so one scan of the texts evaluates all of them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions import catalogue

# Forbidden patterns and their messages.
FORBIDDEN = [
    (r"\bDROP\s+TABLE\b", "DROP TABLE is not allowed"),
    (r"\bDROP\s+DATABASE\b", "DROP DATABASE is not allowed"),
    (r"\bTRUNCATE\b", "TRUNCATE is not allowed"),
    (r"\bDELETE\s+FROM\b", "DELETE is not allowed (read-only agent)"),
    (r"\bUPDATE\s+\w+\s+SET\b", "UPDATE is not allowed (read-only agent)"),
    (r"\bINSERT\s+INTO\b", "INSERT is not allowed (read-only agent)"),
    (r"\bCREATE\s+TABLE\b", "CREATE TABLE is not allowed"),
    (r"\bALTER\s+TABLE\b", "ALTER TABLE is not allowed"),
    (r"\bEXEC(UTE)?\b", "EXECUTE is not allowed"),
    (r";\s*\w", "Multiple statements (semicolon-separated) not allowed"),
]
LARGE_TABLES = [r"FROM\s+PROD_DW\.ANALYTICS\.USER_EVENTS"]

# Messages of the other rules.
NOT_A_QUERY = "Query must start with SELECT (read-only agent)."
LARGE_SCAN = (
    "Query on USER_EVENTS (900M rows) must include a WHERE clause, GROUP BY, or LIMIT to avoid a full table scan."
)
SELECT_STAR = "SELECT * fetches all columns. Consider selecting only the columns you need."
NO_GROUPING = "Aggregate function without GROUP BY — ORDER BY may behave unexpectedly."


def has(text: Column, pattern: str) -> Column:
    return text.rlike("(?i)" + pattern)


def is_read_only(text: Column) -> Column:
    """Starts with SELECT or with the WITH of a common table expression."""
    return has(text, r"^\s*(select|with)\b")


def is_large_scan(text: Column) -> Column:
    big = reduce(lambda a, b: a | b, [has(text, p) for p in LARGE_TABLES])
    narrowed = has(text, r"\bLIMIT\s+\d+") | has(text, r"\bWHERE\b") | has(text, r"\bGROUP\s+BY\b")
    return big & ~narrowed


def selects_star(text: Column) -> Column:
    return has(text, r"SELECT\s+\*")


def aggregates_ungrouped(text: Column) -> Column:
    return (
        has(text, r"\b(SUM|AVG|COUNT|MIN|MAX)\s*\(")
        & has(text, r"\bORDER\s+BY\b")
        & ~has(text, r"\bGROUP\s+BY\b")
    )


def unknown_tables(text: Column, known: list[str]) -> Column:
    """Dotted names after FROM or JOIN that the catalogue does not list, as an array."""
    names = F.regexp_extract_all(text, F.lit(r"(?i)(?:FROM|JOIN)\s+([\w.]+)"), F.lit(1))
    listed = [k.lower() for k in known]
    return F.filter(names, lambda n: n.contains(".") & ~F.lower(n).isin(listed))


def errors(text: Column) -> Column:
    """Messages of all broken rules, in rule order."""
    rules = [(~is_read_only(text), NOT_A_QUERY)]
    rules += [(has(text, pattern), message) for pattern, message in FORBIDDEN]
    rules.append((is_large_scan(text), LARGE_SCAN))
    return F.array_compact(F.array(*[F.when(c, F.lit(m)) for c, m in rules]))


def warnings(text: Column, known: list[str]) -> Column:
    missing = F.transform(
        unknown_tables(text, known),
        lambda n: F.concat(F.lit("Table '"), n, F.lit("' not found in schema registry. Verify the table name is correct.")))
    star = F.array_compact(F.array(F.when(selects_star(text), F.lit(SELECT_STAR))))
    group = F.array_compact(F.array(F.when(aggregates_ungrouped(text), F.lit(NO_GROUPING))))
    return F.concat(star, missing, group)


def verdicts(queries: DataFrame, text: str, known: list[str]) -> DataFrame:
    """Adds ``is_valid``, ``errors`` and ``warnings``."""
    return queries.withColumns(
        {"errors": errors(F.col(text)), "warnings": warnings(F.col(text), known)}
    ).withColumn("is_valid", F.size("errors") == 0)


def relevant_tables(questions: DataFrame, key: str, text: str, most: int = 8, least: int = 2) -> DataFrame:
    """Best matching catalogue tables of each question: key, place, table_name, score.

    Tables without any match only fill up to ``least``, in catalogue order.
    """
    # a projection of its own: the text is lower-cased once, not once per term
    questions = questions.select(key, F.lower(F.col(text)).alias("_low"))
    low = F.col("_low")
    scored = []
    for place, table in enumerate(catalogue.TABLES):
        score = reduce(
            lambda a, b: a + b,
            [F.when(F.contains(low, F.lit(term)), F.lit(weight)).otherwise(F.lit(0.0))
             for term, weight in catalogue.weighted_terms(table)])
        scored.append(F.struct(
            (-score).alias("loss"), F.lit(place).alias("ord"), F.lit(catalogue.full_name(table)).alias("table_name")))
    ranked = F.posexplode(F.array_sort(F.array(*scored))).alias("pos", "t")
    rows = questions.select(key, ranked)
    matched = (F.col("t.loss") < 0) & (F.col("pos") < most)
    return rows.filter(matched | (F.col("pos") < least)).select(
        key, (F.col("pos") + 1).cast("bigint").alias("place"), "t.table_name", (F.lit(0.0) - F.col("t.loss")).alias("score"))
