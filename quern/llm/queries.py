"""Registered queries of this package and their checks in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quern.llm import (
    decontaminate,
    licenses,
    mixing,
    ngrams,
    pages,
    phrases,
    pieces,
    quality,
    ranking,
    secret_scan,
    sharding,
    simhash,
    toxicity,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


@query("op1_simhash")
def op1(spark: SparkSession, directory: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, directory, "documents"))


@query("op3_toxicity")
def op3(spark: SparkSession, directory: str) -> DataFrame:
    return toxicity.score_documents(table(spark, directory, "documents"), table(spark, directory, "labels"))


@query("op5_decontamination")
def op5(spark: SparkSession, directory: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, directory, "documents"), table(spark, directory, "benchmark")).drop("h")


@query("op7_secrets")
def op7(spark: SparkSession, directory: str) -> DataFrame:
    return secret_scan.find_secrets(table(spark, directory, "documents"))


@query("op4_pieces")
def op4(spark: SparkSession, directory: str) -> DataFrame:
    return pieces.tokenize(table(spark, directory, "documents"))


@query("op2_shards")
def op2(spark: SparkSession, directory: str) -> DataFrame:
    return sharding.shard(table(spark, directory, "documents"))


def _license_pairs() -> str:
    """Voting pairs of words of all templates as SQL rows: template, label, base, votes, m, at, first and second word."""
    rows = []
    every = [(*p, True) for p in licenses.PHRASES] + [(*n, False) for n in licenses.NOTICES]
    for number, (label, text, base) in enumerate(every):
        words = text.split()
        voting = [(i, a, b) for i, (a, b) in enumerate(zip(words, words[1:])) if base or not {a, b} <= licenses.COMMON]
        rows += [f"({number}, '{label}', {base}, {len(voting)}, {len(words)}, {i}, '{a}', '{b}')" for i, a, b in voting]
    return ", ".join(rows)


_LICENSES = rf"""
WITH t(template, label, base, votes, m, place, a, b) AS (VALUES {_license_pairs()}),
 d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{licenses.UPPER}', '{licenses.LOWER}'),
   '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
 g AS (SELECT r, i - 1 AS p, w[i] AS a, w[i + 1] AS b FROM (SELECT r, w, unnest(range(1, len(w))) AS i FROM d)),
 v AS (SELECT r, template, label, base, votes, m, p - place AS diagonal, list(place) AS places, min(p) AS low, max(p) + {licenses.K} AS high
   FROM g JOIN t USING (a, b) GROUP BY ALL),
 f AS (SELECT *, base OR coalesce(diagonal - lag(diagonal) OVER (PARTITION BY r, template ORDER BY diagonal) > {licenses.NEIGHBOURS}, true) AS first FROM v),
 n AS (SELECT *, count_if(first) OVER (PARTITION BY r, template ORDER BY diagonal) AS grp FROM f),
 o AS (SELECT r, template, label, base, votes, m, grp, min(low) AS low, max(high) AS high, len(list_distinct(flatten(list(places)))) AS got,
   max(len(list_distinct(places)) / votes) FILTER (WHERE NOT base AND high - low <= {licenses.STRETCH} * m
     AND len(list_distinct(places)) / votes >= CASE WHEN votes < {licenses.SHORT} THEN 1.0 ELSE {licenses.COVERAGE} END) AS alone FROM n GROUP BY ALL),
 k AS (SELECT *, CAST(got AS DOUBLE) / votes AS share, base AND got = votes AS whole FROM o),
 f2 AS (SELECT *, whole OR (NOT base AND share >= CASE WHEN votes < {licenses.SHORT} THEN 1.0 ELSE {licenses.COVERAGE} END AND high - low <= {licenses.STRETCH} * m) AS most FROM k),
 h AS (SELECT *, CASE WHEN most THEN least(share, 1.0) ELSE alone END AS part FROM f2)
SELECT doc_id, len(w) AS n_words, count(*) FILTER (WHERE whole) AS n_base, min(low) FILTER (WHERE whole) AS first_word, max(low) FILTER (WHERE whole) AS last_word,
 coalesce(array_to_string(list_sort(list_distinct(list(label) FILTER (WHERE whole))), ','), '') AS base_labels,
 coalesce(array_to_string(list_sort(list_distinct(list(label) FILTER (WHERE part IS NOT NULL))), ','), '') AS labels,
 coalesce(max(part), 0.0) AS score FROM d LEFT JOIN h USING (r) GROUP BY r, doc_id, w"""


@query("op6_licenses", _LICENSES)
def op6(spark: SparkSession, directory: str) -> DataFrame:
    return licenses.scan(table(spark, directory, "documents"))


@query("op9_quality")
def op9(spark: SparkSession, directory: str) -> DataFrame:
    return quality.judge(table(spark, directory, "documents"), table(spark, directory, "labels"))


@query("op10_language_model")
def op10(spark: SparkSession, directory: str) -> DataFrame:
    return ngrams.score_documents(table(spark, directory, "documents"))


@query("op8_pages")
def op8(spark: SparkSession, directory: str) -> DataFrame:
    return pages.main_text(table(spark, directory, "pages"))


_MIX = r"""
WITH d AS MATERIALIZED (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
   md5(concat('11:', coalesce(CAST(doc_id AS VARCHAR), ''), ':', coalesce(text, ''))) AS draw FROM documents),
 s AS (SELECT source, sum(size) AS z, row_number() OVER (ORDER BY source IS NULL, source) AS place FROM d GROUP BY source),
 w AS (SELECT *, [3, 1, 2][(place - 1) % 3 + 1] AS w FROM s),
 o AS (SELECT *, row_number() OVER r AS nth, coalesce(sum(z) OVER (r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below,
   coalesce(sum(w) OVER (r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS light, sum(z) OVER () AS words, sum(w) OVER () AS weights
   FROM w WINDOW r AS (ORDER BY z / w, place)),
 q AS (SELECT *, 3 * words - 4 * below AS open, 2 * (weights - light) AS rest FROM o),
 l AS (SELECT nth, open, rest FROM q WHERE 2 * z * rest >= open * w ORDER BY nth LIMIT 1),
 t AS (SELECT q.source, CAST(q.z AS BIGINT) AS z, CASE WHEN q.nth < l.nth THEN CAST(2 * q.z AS DOUBLE) ELSE l.open * q.w / l.rest END AS target,
   CAST(CASE WHEN q.nth < l.nth THEN 2 * q.z ELSE l.open * q.w // l.rest END AS BIGINT) AS budget FROM q, l),
 p AS (SELECT doc_id, size, z, target, CASE WHEN z > 0 THEN budget // z ELSE 0 END AS epochs, budget,
   coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY draw, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
   FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, z AS source_size, target,
  CAST(epochs * size + least(greatest(budget - epochs * z - ahead, 0), size) AS BIGINT) AS taken FROM p"""


@query("op11_mixing", _MIX)
def op11(spark: SparkSession, directory: str) -> DataFrame:
    return mixing.mix(table(spark, directory, "documents"))


_RANK = r"""
WITH t AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
   'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
 s AS (SELECT count(*) AS texts, sum(len(w)) AS words FROM t WHERE len(w) > 0),
 i AS (SELECT DISTINCT item_id, coalesce(text, '') AS text FROM benchmark),
 q AS (SELECT DISTINCT item_id, text, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
   'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM i),
 f AS MATERIALIZED (SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, len(w) AS n, unnest(w) AS term FROM t) GROUP BY ALL),
 d AS (SELECT term, count(*) AS df FROM f WHERE term IN (SELECT term FROM q) GROUP BY term),
 w AS (SELECT term, CAST(floor(1000 * ln((2 * texts + 2) / (2 * df + 1))) AS BIGINT) AS w FROM d, s),
 e AS (SELECT r, doc_id, f.term, w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * texts) // words))) AS part
   FROM f JOIN w ON f.term = w.term CROSS JOIN s),
 c AS (SELECT item_id, text, r, doc_id, CAST(sum(part) AS BIGINT) AS score FROM q JOIN e ON q.term = e.term GROUP BY ALL HAVING sum(part) > 0)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM c
QUALIFY row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id) <= 50"""


@query("op12_ranking", _RANK)
def op12(spark: SparkSession, directory: str) -> DataFrame:
    return ranking.rank(table(spark, directory, "documents"), table(spark, directory, "benchmark"))


_PHRASES = r"""
WITH t AS (SELECT row_number() OVER () AS r, coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
 w AS MATERIALIZED (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM t),
 s AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
 g AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS f FROM (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
   FROM (SELECT lang, k, w, unnest(range(1, len(w) - k + 2)) AS i FROM w, range(1, 5) AS r(k))) GROUP BY ALL HAVING count(*) >= 30),
 p AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM g WHERE k > 1),
 c AS (SELECT p.lang, p.phrase, p.a, x.f AS l, y.f AS r, j, CAST(2000000::HUGEINT * p.a // (x.f + y.f) AS BIGINT) AS score
   FROM (SELECT *, unnest(range(1, k)) AS j FROM p) p JOIN g x ON x.lang = p.lang AND x.phrase = array_to_string(w[1:j], ' ')
   JOIN g y ON y.lang = p.lang AND y.phrase = array_to_string(w[j + 1:], ' ')),
 b AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
 m AS (SELECT lang, inner_, max(a) AS longer FROM (SELECT lang, a, array_to_string(w[i:i + z - 1], ' ') AS inner_
   FROM (SELECT *, unnest(range(1, k - z + 2)) AS i FROM p, range(2, 4) AS q(z) WHERE z < k)) GROUP BY ALL)
SELECT b.lang, CAST(row_number() OVER o AS INTEGER) AS rank, b.phrase, a, l, r, n, score FROM b JOIN s USING (lang)
 LEFT JOIN m ON m.lang = b.lang AND m.inner_ = b.phrase WHERE longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * a
 WINDOW o AS (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) QUALIFY row_number() OVER o <= 2000"""


@query("op13_phrases", _PHRASES)
def op13(spark: SparkSession, directory: str) -> DataFrame:
    return phrases.collocations(table(spark, directory, "documents"))


@query("pipeline")
def pipeline(spark: SparkSession, directory: str) -> DataFrame:
    import corpus_pipeline  # at the top of the repository

    return corpus_pipeline.run(spark, directory)
