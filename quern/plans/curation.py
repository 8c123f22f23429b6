"""Text-pair curation queries.

Pairs are a user turn with the assistant turn after it; rubric scores come from
the labels of the document with the conversation's number.
"""

from pyspark.sql import functions as F

from quern.operators import curation, similarity
from quern.plans.registry import query

_TOKENS = r"regexp_split_to_array(lower({0}), '[^\p{{L}}\p{{N}}_]+')"


def _words(table, key, text):
    return (f"(SELECT {key}, w, count(*) AS tf FROM (SELECT {key}, unnest({_TOKENS.format(text)}) AS w FROM {table}) "
            f"WHERE regexp_full_match(w, '[a-z]{{3,}}') GROUP BY ALL)")


@query("m01_term_vectors", f"SELECT doc_id, w AS token, tf FROM {_words('documents', 'doc_id', 'text')}")
def term_vectors(t):
    return similarity.term_counts(t.documents, "doc_id", "text")


_SQLS = [
    "SELECT customer_id, count(*) FROM orders GROUP BY customer_id",
    "WITH recent AS (SELECT * FROM orders) SELECT count(*) FROM recent",
    "select dropoff, inserted_at from trips",
    "DROP TABLE orders",
    "SELECT 1; DELETE FROM orders",
    "SELECT region FROM daily_revenue",
    "UPDATE orders SET status = 1",
]
_TIERS = list(curation.TIER_SHARES)
_PAIRS = f"""pairs AS (SELECT u.conv_id * 4294967296 + u.turn AS id, u.conv_id, u.turn, u.text AS question, a.text AS back_question
  FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
  WHERE u.role = 'user' AND a.role = 'assistant')"""
_LISTED = "[" + ", ".join("'" + s.replace("'", "''") + "'" for s in _SQLS) + "]"
_SQL_TEXT = f"{_LISTED}[(turn * 7 + conv_id) % 11 % {len(_SQLS)} + 1]"
_COSINE = f"""cosine AS (WITH x AS {_words('pairs', 'id', 'question')}, y AS {_words('pairs', 'id', 'back_question')},
  nx AS (SELECT id, sqrt(sum(tf * tf)) AS n FROM x GROUP BY 1), ny AS (SELECT id, sqrt(sum(tf * tf)) AS n FROM y GROUP BY 1),
  d AS (SELECT id, sum(x.tf * y.tf) AS d FROM x JOIN y USING (id, w) GROUP BY 1)
  SELECT id, coalesce(d / (nx.n * ny.n), 0) AS cosine FROM pairs LEFT JOIN d USING (id) LEFT JOIN nx USING (id) LEFT JOIN ny USING (id))"""


def conversation_pairs(t):
    """Both sides of the join are unique in (conversation, turn)."""
    user = t.conversations.filter("role = 'user'").select(
        "conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("question"),
        (F.col("conv_id").cast("bigint") * (1 << 32) + F.col("turn")).alias("id"))  # unique for any number of turns below 2^32
    answer = t.conversations.filter("role = 'assistant'").select("conv_id", "turn", F.col("text").alias("back_question"))
    return user.join(answer, ["conv_id", "turn"]).select(
        "id", "conv_id", (F.col("turn") - 1).alias("turn"), "question", "back_question")


@query("m02_pair_cosine", f"WITH {_PAIRS}, {_COSINE} SELECT id, round(cosine, 8) AS cosine FROM cosine")
def pair_cosine(t):
    return similarity.pair_cosine(conversation_pairs(t), "id", "question", "back_question").withColumn(
        "cosine", F.round("cosine", 8))


@query("m03_consistency_gate", f"WITH {_PAIRS}, {_COSINE} SELECT id, round(cosine, 8) AS cosine FROM cosine WHERE cosine >= 0.45")
def consistency_gate(t):
    scored = similarity.pair_cosine(conversation_pairs(t), "id", "question", "back_question")
    return scored.filter(F.col("cosine") >= similarity.CONSISTENT).withColumn("cosine", F.round("cosine", 8))


def _near(table, key, text, name="near"):
    return f"""{name} AS MATERIALIZED (WITH v AS {_words(table, key, text)}, n AS (SELECT {key}, sqrt(sum(tf * tf)) AS n FROM v GROUP BY 1),
  d AS (SELECT a.{key} AS late, b.{key} AS early, sum(a.tf * b.tf) AS d FROM v a JOIN v b ON a.w = b.w AND b.{key} < a.{key} GROUP BY 1, 2)
  SELECT late, early FROM d JOIN n x ON x.{key} = late JOIN n y ON y.{key} = early WHERE d / (x.n * y.n) >= 0.85)"""


@query("m04_near_duplicates", f"WITH {_near('documents', 'doc_id', 'text')} SELECT late AS doc_id, min(early) AS match FROM near GROUP BY 1")
def near_duplicates(t):
    """Texts with a near-duplicate before them, and the first of these."""
    return similarity.earlier_match(similarity.unit_vectors(t.documents, "doc_id", "text"), "doc_id")


def _greedy(rows, key, good):
    """Walk the rows in order, carrying the list of accepted keys."""
    return f"""o AS (SELECT r.*, row_number() OVER (ORDER BY r.{key}) AS i FROM {rows} r),
 h AS MATERIALIZED (SELECT o.i, o.{key} AS k, {good} AS good, coalesce((SELECT list(early ORDER BY early) FROM near WHERE late = o.{key}), []) AS past FROM o),
 walk AS (SELECT CAST(0 AS BIGINT) AS i, CAST([] AS BIGINT[]) AS kept, CAST(NULL AS BIGINT) AS k, CAST(NULL AS BIGINT) AS by_
  UNION ALL SELECT h.i, CASE WHEN h.good AND NOT list_has_any(h.past, walk.kept) THEN list_append(walk.kept, h.k) ELSE walk.kept END, h.k,
   list_min(list_intersect(h.past, walk.kept)) FROM walk JOIN h ON h.i = walk.i + 1)"""


@query("m05_greedy_dedup", f"""
WITH RECURSIVE {_near('documents', 'doc_id', 'text')}, {_greedy('documents', 'doc_id', 'true')}
SELECT k AS doc_id, coalesce(by_, -1) AS duplicate_of FROM walk WHERE k IS NOT NULL""")
def greedy_dedup(t):
    out = similarity.greedy_dedup(similarity.unit_vectors(t.documents, "doc_id", "text"), "doc_id")
    return out.withColumn("duplicate_of", F.coalesce("duplicate_of", F.lit(-1).cast("bigint")))


_RUBRIC = """coalesce(quality, 0.5) * 0.3 + coalesce(1.0 - toxic, 0.5) * 0.2 + 0.5 * 0.2
  + coalesce(least(n_chars / 4096, 1.0), 0.5) * 0.2 + coalesce(CASE WHEN quality = 1 THEN 0.9 END, 0.5) * 0.1"""
_SCORED = f"""scored AS (SELECT d.doc_id, d.n_chars, CASE WHEN l.doc_id IS NULL THEN 0.0 ELSE round(CAST({_RUBRIC} AS DOUBLE), 3) END AS score
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)"""


def scored_documents(t):
    judged = t.labels.select(
        F.col("doc_id").alias("_doc"), F.col("quality").cast("double").alias("logical_correctness"),
        (1.0 - F.col("toxic")).alias("nl_naturalness"), F.lit(None).cast("double").alias("sql_style"),
        F.when(F.col("quality") == 1, 0.9).alias("specificity"), F.lit(True).alias("judged"))
    rows = t.documents.join(judged, F.col("doc_id") == F.col("_doc"), "left").withColumns({
        "schema_grounding": F.least(F.col("n_chars") / 4096, F.lit(1.0)),
        "judged": F.coalesce("judged", F.lit(False))})
    return rows.select("doc_id", "n_chars", curation.rubric_score(rows, "judged").alias("score"))


@query("m06_rubric_score", f"WITH {_SCORED} SELECT doc_id, score, score >= 0.72 AS passed FROM scored")
def rubric_score(t):
    return scored_documents(t).select("doc_id", "score", (F.col("score") >= curation.PASS_MARK).alias("passed"))


_HASH = "CAST('0x' || substr(md5({0}), 1, 8) AS BIGINT)"
_TIER_SQL = f"""{_TIERS}[{_HASH.format("doc_id || '-tier'")} % 6 + 1]"""


def tiered_documents(t):
    return t.documents.select("doc_id", "lang", curation.pick(_TIERS, F.col("doc_id"), "tier").alias("tier"))


_QUOTA = "CASE tier " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in curation.tier_targets(500).items()) + " END"
_TIERED = f"tiered AS (SELECT doc_id, lang, {_TIER_SQL} AS tier FROM documents)"


@query("m07_quotas", f"""
WITH {_TIERED}, p AS (SELECT *, row_number() OVER (PARTITION BY tier ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id) AS place FROM tiered)
SELECT doc_id, tier, place FROM p WHERE place <= {_QUOTA}""")
def quotas(t):
    return curation.take_quota(tiered_documents(t), "tier", "doc_id", curation.tier_targets(500)).select(
        "doc_id", "tier", F.col("place").cast("bigint").alias("place"))


_OPEN = "CASE tier " + " ".join(
    f"WHEN '{k}' THEN greatest(1, round_even((SELECT count(*) // 2 FROM documents) * CAST({v} AS DOUBLE), 0))"
    for k, v in curation.TIER_SHARES.items()) + " END"


@query("m08_sample_remaining", f"""
WITH {_TIERED}, r AS (SELECT tier, greatest({_OPEN} - count_if(lang = 'fr'), 0) / greatest(count_if(lang <> 'fr'), 1) AS rate
  FROM tiered GROUP BY 1)
SELECT doc_id, tier FROM tiered JOIN r USING (tier) WHERE lang <> 'fr' AND {_HASH.format("doc_id || '-draw'")} < least(rate, 1.0) * 4294967296""")
def sample_remaining(t):
    """Half of all documents are wanted; the French ones count as accepted already."""
    rows = tiered_documents(t)
    return curation.sample_remaining(
        rows.filter("lang <> 'fr'"), "tier", "doc_id", rows.filter("lang = 'fr'"),
        curation.tier_targets(t.documents.count() // 2), "draw").select("doc_id", "tier")


def sql_text():
    place = (F.col("turn") * 7 + F.col("conv_id")) % 11 % len(_SQLS)
    return F.get(F.array(*[F.lit(s) for s in _SQLS]), place.cast("int"))


def candidate_pairs(t):
    scores = scored_documents(t).select("doc_id", "score")
    return conversation_pairs(t).join(scores, F.col("conv_id") == F.col("doc_id"), "left").select(
        "id", "question", "back_question", sql_text().alias("sql"), F.coalesce("score", F.lit(0.0)).alias("score"))


_AUDIT = f"""{_PAIRS}, {_COSINE}, {_SCORED}, gated AS (SELECT id, question, back_question, {_SQL_TEXT} AS sql, cosine, coalesce(score, 0.0) AS score
  FROM pairs JOIN cosine USING (id) LEFT JOIN scored ON doc_id = conv_id),
 staged AS (SELECT *, CASE WHEN NOT regexp_matches(sql, '^\\s*(select|with)\\b', 'i') OR regexp_matches(sql, '\\b(drop|delete|insert)\\b', 'i')
   THEN 'EXEC' WHEN cosine < 0.45 THEN 'CONSISTENCY' END AS stage FROM gated),
 alive AS (SELECT * FROM staged WHERE stage IS NULL), {_near('alive', 'id', 'question')}, {_greedy('alive', 'id', 'o.score >= 0.72')},
 audited AS (SELECT id, round(cosine, 6) AS cosine, score, coalesce(stage, CASE WHEN by_ IS NOT NULL THEN 'DEDUP'
   WHEN score < 0.72 THEN 'QUALITY' END, 'ACCEPTED') AS stage FROM staged LEFT JOIN walk ON walk.k = id)"""


REASON_SQL = """CASE stage WHEN 'EXEC' THEN 'EXEC_FAIL: not a read-only query'
  WHEN 'CONSISTENCY' THEN 'CONSISTENCY_FAIL: score=' || printf('%.2f', audited.cosine) || ' (need ≥0.45)' || chr(10) || '  Original: '
    || substr(question, 1, 80) || chr(10) || '  BackT:    ' || substr(back_question, 1, 80)
  WHEN 'DEDUP' THEN 'DEDUP: near-duplicate of accepted question'
  WHEN 'QUALITY' THEN 'QUALITY_FAIL: score=' || printf('%.2f', audited.score) || ' < 0.72' END AS rejection_reason"""


@query("m09_audit_trail", f"""WITH RECURSIVE {_AUDIT} SELECT id, stage, audited.cosine, audited.score, {REASON_SQL}
FROM audited JOIN gated USING (id)""")
def audit_trail(t):
    return curation.audit(candidate_pairs(t), "id").withColumn("rejection_reason", curation.rejection_reason()).select(
        "id", "stage", F.round("cosine", 6).alias("cosine"), "score", "rejection_reason")


@query("m10_stage_funnel", f"""
WITH RECURSIVE {_AUDIT}, c AS (SELECT count(*) AS generated, count_if(stage <> 'EXEC') AS exec_pass,
  count_if(stage NOT IN ('EXEC', 'CONSISTENCY')) AS backt_pass, count_if(stage NOT IN ('EXEC', 'CONSISTENCY', 'DEDUP')) AS dedup_pass,
  count_if(stage = 'ACCEPTED') AS accepted FROM audited)
SELECT *, round(exec_pass / greatest(generated, 1) * 100, 4) AS exec_pct, round(backt_pass / greatest(exec_pass, 1) * 100, 4) AS backt_pct,
  round(dedup_pass / greatest(backt_pass, 1) * 100, 4) AS dedup_pct, round(accepted / greatest(generated, 1) * 100, 4) AS yield_pct FROM c""")
def stage_funnel(t):
    return curation.funnel(curation.audit(candidate_pairs(t), "id"))


@query("m11_sql_gate", f"""
WITH {_PAIRS} SELECT id, sql, regexp_matches(sql, '^\\s*(select|with)\\b', 'i') AND NOT regexp_matches(sql, '\\b(drop|delete|insert)\\b', 'i') AS ok
FROM (SELECT id, {_SQL_TEXT} AS sql FROM pairs)""")
def sql_gate(t):
    return conversation_pairs(t).select("id", sql_text().alias("sql")).withColumn("ok", curation.passes_sql_gate(F.col("sql")))


_COLUMNS = ["ORDER_ID", "ORDER_DATE", "QUANTITY", "LTV", "PRICE", "NET_REVENUE", "EVENT_TYPE"]


def _quoted(values):
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def _fill_sql():
    def choose(options, slot):
        if len(options) == 1:
            return "'" + options[0] + "'"
        pos = _HASH.format("doc_id || '-" + slot + "'")
        return f"{_quoted(options)}[{pos} % {len(options)} + 1]"
    text = "CASE tier " + " ".join(f"WHEN '{k}' THEN {choose(v, 'template')}" for k, v in curation.TEMPLATES.items()) + " END"
    for slot, options in {**curation.SLOTS, "col": _COLUMNS}.items():
        text = f"replace({text}, '{{{slot}}}', {choose(options, slot)})"
    return text


@query("m12_template_fill", f"WITH {_TIERED} SELECT doc_id, tier, {_fill_sql()} AS question FROM tiered")
def template_fill(t):
    return curation.fill_templates(tiered_documents(t), "doc_id", "tier", _COLUMNS).select("doc_id", "tier", "question")


@query("m13_transcripts", """
SELECT conv_id, row_number() OVER w - 1 AS place, CAST(coalesce(sum(length(line) + 1) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
  AS BIGINT) AS start, line FROM (SELECT conv_id, turn, role || ': ' || text AS line FROM conversations) WINDOW w AS (PARTITION BY conv_id ORDER BY turn)""")
def transcripts(t):
    line = F.concat("role", F.lit(": "), "text")
    return curation.transcripts(t.conversations, ["conv_id"], "turn", line)
