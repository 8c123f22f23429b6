"""Query-text linting: one query text is derived from every event."""

from pyspark.sql import functions as F

from quern.functions import catalogue
from quern.operators import lint
from quern.plans.registry import query

_TEXTS = [
    "SELECT region, sum(gross_revenue) FROM PROD_DW.ANALYTICS.DAILY_REVENUE WHERE region = ''{u}'' GROUP BY region",
    "SELECT * FROM PROD_DW.ANALYTICS.USER_EVENTS",
    "select user_id from prod_dw.analytics.user_events where user_id = {u}",
    "WITH x AS (SELECT {u} AS u) SELECT u FROM x",
    "DROP TABLE PROD_DW.SALES.ORDERS",
    "SELECT 1; DELETE FROM PROD_DW.SALES.ORDERS WHERE customer_id = {u}",
    "UPDATE orders SET status = ''{u}''",
    "SELECT count(*) FROM PROD_DW.SALES.CUSTOMERS ORDER BY 1",
    "SELECT c.email FROM PROD_DW.SALES.CLIENTS c JOIN PROD_DW.SALES.ORDERS o ON c.id = o.id LIMIT {u}",
    "insert into t select {u}; truncate t",
    "  SELECT dropoff, updated_at FROM PROD_DW.SALES.ORDERS o JOIN MART.X.Y{u} m ON o.a = m.a",
    "EXECUTE refresh({u})",
    "CREATE TABLE t{u} AS SELECT * FROM PROD_DW.CATALOG.PRODUCTS",
]
_CASE = (
    f"replace(CASE CAST(event_id % {len(_TEXTS)} AS INTEGER) "
    + " ".join(f"WHEN {i} THEN '{s}'" for i, s in enumerate(_TEXTS))
    + " END, '{u}', CAST(user_id AS STRING))"
)
_Q = f"q AS (SELECT event_id, {_CASE} AS sql FROM events)"
_KNOWN = [catalogue.full_name(t) for t in catalogue.TABLES]
_LISTED = ", ".join(f"'{k.lower()}'" for k in _KNOWN)


def query_texts(t):
    text = _CASE.replace("''", "\\'")
    return t.events.select("event_id", F.expr(text).alias("sql"))


def _rx(pattern):
    return f"regexp_matches(sql, '{pattern}', 'i')"


_LARGE = (f"({_rx(lint.LARGE_TABLES[0])} AND NOT ({_rx(chr(92) + 'bLIMIT' + chr(92) + 's+' + chr(92) + 'd+')} OR "
          f"{_rx(chr(92) + 'bWHERE' + chr(92) + 'b')} OR {_rx(chr(92) + 'bGROUP' + chr(92) + 's+BY' + chr(92) + 'b')}))")
_READ = _rx(r"^\s*(select|with)\b")
_STAR = _rx(r"SELECT\s+\*")
_UNGROUPED = (f"({_rx(r'\b(SUM|AVG|COUNT|MIN|MAX)\s*\(')} AND {_rx(r'\bORDER\s+BY\b')} AND NOT {_rx(r'\bGROUP\s+BY\b')})")


@query("n01_read_only", f"WITH {_Q} SELECT event_id, {_READ} AS ok FROM q")
def read_only(t):
    return query_texts(t).select("event_id", lint.is_read_only(F.col("sql")).alias("ok"))


@query("n02_forbidden", f"WITH {_Q} " + " UNION ALL ".join(
    f"SELECT event_id, '{m}' AS message FROM q WHERE {_rx(p)}" for p, m in lint.FORBIDDEN))
def forbidden(t):
    """Long form: one row per broken rule."""
    found = F.array_compact(F.array(*[F.when(lint.has(F.col("sql"), p), F.lit(m)) for p, m in lint.FORBIDDEN]))
    return query_texts(t).select("event_id", F.explode(found).alias("message"))


@query("n03_large_scan", f"WITH {_Q} SELECT event_id, sql FROM q WHERE {_LARGE}")
def large_scan(t):
    return query_texts(t).filter(lint.is_large_scan(F.col("sql")))


@query("n04_select_star", f"WITH {_Q} SELECT event_id FROM q WHERE {_STAR}")
def select_star(t):
    return query_texts(t).filter(lint.selects_star(F.col("sql"))).select("event_id")


_REFS = rf"""SELECT event_id, unnest(regexp_extract_all(sql, '(?i)(?:FROM|JOIN)\s+([\w.]+)', 1)) AS ref FROM q"""


@query("n05_unknown_tables", f"""
WITH {_Q}, r AS ({_REFS}) SELECT event_id, ref FROM r WHERE contains(ref, '.') AND lower(ref) NOT IN ({_LISTED})""")
def unknown_tables(t):
    return query_texts(t).select("event_id", F.explode(lint.unknown_tables(F.col("sql"), _KNOWN)).alias("ref"))


@query("n06_ungrouped_aggregate", f"WITH {_Q} SELECT event_id FROM q WHERE {_UNGROUPED}")
def ungrouped_aggregate(t):
    return query_texts(t).filter(lint.aggregates_ungrouped(F.col("sql"))).select("event_id")


_ERRORS = ", ".join(
    [f"CASE WHEN NOT {_READ} THEN '{lint.NOT_A_QUERY}' END"]
    + [f"CASE WHEN {_rx(p)} THEN '{m}' END" for p, m in lint.FORBIDDEN]
    + [f"CASE WHEN {_LARGE} THEN '{lint.LARGE_SCAN}' END"])


@query("n07_verdict", f"""
WITH {_Q}, r AS ({_REFS}), u AS (SELECT event_id, count(*) AS n FROM r WHERE contains(ref, '.')
  AND lower(ref) NOT IN ({_LISTED}) GROUP BY 1), v AS (SELECT event_id, sql, concat_ws(' | ', {_ERRORS}) AS errors FROM q)
SELECT event_id, errors = '' AS is_valid, errors, CAST(coalesce(n, 0) + CASE WHEN {_STAR} THEN 1 ELSE 0 END
  + CASE WHEN {_UNGROUPED} THEN 1 ELSE 0 END AS BIGINT) AS warnings FROM v LEFT JOIN u USING (event_id)""")
def verdict(t):
    return lint.verdicts(query_texts(t), "sql", _KNOWN).select(
        "event_id", "is_valid", F.array_join("errors", " | ").alias("errors"), F.size("warnings").cast("bigint").alias("warnings"))


def _scores(text):
    parts = []
    for i, table in enumerate(catalogue.TABLES):
        score = " + ".join(f"CASE WHEN contains({text}, '{w}') THEN {v} ELSE 0.0 END" for w, v in catalogue.weighted_terms(table))
        parts.append(f"SELECT doc_id, {i} AS ord, '{catalogue.full_name(table)}' AS table_name, CAST({score} AS DOUBLE) AS score FROM documents")
    return " UNION ALL ".join(parts)


@query("n08_relevant_tables", f"""
WITH s AS ({_scores("lower(text)")}), p AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, ord) AS place FROM s)
SELECT doc_id, place, table_name, score FROM p WHERE (score > 0 AND place <= 8) OR place <= 2""")
def relevant_tables(t):
    return lint.relevant_tables(t.documents, "doc_id", "text")
