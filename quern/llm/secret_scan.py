"""Secrets in texts, in DataFrame operations only: fixed patterns and a model of random strings.

Three patterns find secrets by their surroundings or form.  Others betray themselves by their
letters alone: two Markov models of characters, one of random strings and one of ordinary
identifiers and words, are compared by their log-likelihood ratio on every longer token.
Both are counted over all documents: strings that the patterns take for a secret are labelled
random, those of letters (and - and _) outside of them ordinary; tokens with digits outside of them have no label.  The model of random strings is mixed with an even
distribution, since a few samples cannot show all kinds of them.

Positions are code points.  They are the running sums of the lengths of the matches and of what is
left between them, made in chunks so that the work stays near the number of matches.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.text import once
from quern.llm.common import text_column

#: shortest token that is judged by its letters; bits per step of the ratio from which it is a secret
TOKEN, BITS = 16, 1.0
#: share of the even distribution in the model of random strings, what every character is counted more, and how many
#: characters of a context weigh as much as the characters' own shares
EVEN, MORE, LEAN = 0.5, 0.02, 5.0

#: fixed values: the patterns, and the kinds in their order
ASSIGN = (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "random")
VALUE = 6

ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/=_-"
#: a token with a letter in it
TOKENS = r"(?<![A-Za-z0-9+/=_-])(?=[0-9+/=_-]*[A-Za-z])[A-Za-z0-9+/=_-]{%d,}"
CHUNK = 256


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def starts(before: str) -> Column:
    """Running sums, without the own value, of an array of integers."""
    n = f"size({before})"
    chunks = f"transform(sequence(0, ({n} - 1) div {CHUNK}), c -> slice({before}, c * {CHUNK} + 1, {CHUNK}))"
    inner = (f"transform(ch, (x, i) -> aggregate(slice(sums, 1, c), 0, (a, s) -> a + s) + aggregate(slice(ch, 1, i), 0, (a, y) -> a + y))")
    return F.expr(
        f"if({n} = 0, cast(array() AS array<int>), flatten(get(transform(array({chunks}), chs -> "
        f"get(transform(array(transform(chs, ch -> aggregate(ch, 0, (a, y) -> a + y))), sums -> "
        f"transform(chs, (ch, c) -> {inner})), 0)), 0)))")


def located(df: DataFrame, found: str, pattern: str, out: str) -> DataFrame:
    """Add an array of (start, end, match) for the matches in column ``found`` of the column ``text``."""
    gaps = F.expr(f"if(size({found}) = 0, array(''), split(text, {_quoted(pattern)}, -1))")
    df = df.withColumn("_gaps", once(gaps)).withColumn("_steps", once(F.expr(
        f"transform({found}, (m, i) -> length(get(_gaps, i)) + length(m))")))
    df = df.withColumn("_at", once(starts("_steps")))
    return df.withColumn(out, once(F.expr(
        f"transform({found}, (m, i) -> struct(get(_at, i) + length(get(_gaps, i)) AS start, "
        f"get(_at, i) + length(get(_gaps, i)) + length(m) AS end, m AS match))"))).drop("_gaps", "_steps", "_at")


def all_matches(text: str, pattern: str, group: int = 0) -> Column:
    return F.expr(f"regexp_extract_all({text}, {_quoted(pattern)}, {group})")


def bigrams(strings: DataFrame, column: str) -> dict[tuple[str, str], int]:
    """Counts of neighbouring characters in all strings: at most the square of the alphabet's size."""
    s = F.col(column)
    pairs = strings.select(F.explode_outer(F.expr(
        f"transform(sequence(1, length({column}) - 1), i -> substring({column}, i, 2))")).alias("pair"), F.length(s).alias("n"))
    rows = pairs.filter("n > 1").groupBy("pair").agg(F.count(F.lit(1)).alias("c")).collect()
    return {(r["pair"][0], r["pair"][1]): r["c"] for r in rows if r["pair"][0] in ALPHABET and r["pair"][1] in ALPHABET}


def chances(counts: dict[tuple[str, str], int], even: float) -> list[float]:
    """log2 P(next | character) for all pairs of the alphabet, a rare context leaning on the characters' own shares."""
    size, out = len(ALPHABET), []
    single = {b: MORE + sum(counts.get((a, b), 0) for a in ALPHABET) for b in ALPHABET}
    whole = sum(single.values())
    for a in ALPHABET:
        total = sum(counts.get((a, b), 0) for b in ALPHABET) + LEAN
        for b in ALPHABET:
            chance = (counts.get((a, b), 0) + LEAN * single[b] / whole) / total
            out.append(math.log2((1 - even) * chance + even / size))
    return out


def train(docs: DataFrame) -> list[float]:
    """Log-likelihood ratio, in bits, of every pair of characters: random string against ordinary one.

    Without any ordinary strings all ratios are 0, and no token is taken for a secret.
    """
    text = text_column(docs)
    texts = docs.select(text.alias("text"))
    values = texts.select(F.concat(
        F.filter(all_matches("text", ASSIGN, 2), lambda v: F.length(v) >= VALUE),
        all_matches("text", ACCESS), all_matches("text", HEX)).alias("v")).select(F.explode_outer("v").alias("v")).filter("v IS NOT NULL")
    ordinary = texts.select(F.explode_outer(F.expr(
        rf"regexp_extract_all(regexp_replace(regexp_replace(text, {_quoted(ASSIGN)}, ' '), {_quoted(ACCESS + '|' + HEX)}, ' '), "
        r"'(?<![A-Za-z0-9+/=_-])[A-Za-z][A-Za-z_-]{3,}(?![A-Za-z0-9+/=_-])', 0)")).alias("v")).filter("v IS NOT NULL")
    plain = bigrams(ordinary, "v")
    if not plain:
        return [0.0] * len(ALPHABET) ** 2
    return [r - o for r, o in zip(chances(bigrams(values, "v"), EVEN), chances(plain, 0.0))]


def scanned(docs: DataFrame, ratios: list[float], keep: list[str]) -> DataFrame:
    """Columns ``keep`` of ``docs`` (renamed k0, k1, ...), text, and spans: (start, kind, end) in order."""
    df = docs.select(*[docs[c].alias(f"k{i}") for i, c in enumerate(keep)], text_column(docs).alias("text"))
    tokens = TOKENS % TOKEN
    df = df.select("*", all_matches("text", ASSIGN).alias("m_assign"), all_matches("text", ASSIGN, 2).alias("v_assign"),
                   all_matches("text", ACCESS).alias("m_access"), all_matches("text", HEX).alias("m_hex"),
                   all_matches("text", tokens).alias("m_token"))
    df = located(df, "m_assign", ASSIGN, "s_assign")
    df = df.withColumn("s_assign", F.expr(f"filter(s_assign, (s, i) -> length(get(v_assign, i)) >= {VALUE})"))
    df = located(df, "m_access", ACCESS, "s_access")
    df = located(df, "m_hex", HEX, "s_hex")
    size = len(ALPHABET)
    table = F.array(*[F.lit(round(x, 6)) for x in ratios])
    step = f"(instr('{ALPHABET}', substring(t, i, 1)) - 1) * {size} + instr('{ALPHABET}', substring(t, i + 1, 1)) - 1"
    df = df.withColumn("table", table).withColumn("odd", F.expr(
        f"transform(m_token, t -> aggregate(sequence(1, length(t) - 1), 0D, (a, i) -> a + get(table, {step})) "
        f">= {BITS} * (length(t) - 1))")).drop("table")
    # tokens are located only in texts with a suspicious one
    df = df.withColumn("m_token", F.expr("if(exists(odd, o -> o), m_token, cast(array() AS array<string>))"))
    df = located(df, "m_token", tokens, "s_token")
    base = [F.expr(f"transform(s_{kind}, s -> struct(s.start AS start, {k} AS kind, s.end AS end))")
            for k, kind in enumerate(KINDS[:3])]
    df = df.withColumn("base", once(F.array_sort(F.concat(*base)))).withColumn("apart", once(merged("base")))
    # the last stretch that begins before a token's end, by halving; the token is free if that has ended before it
    steps = f"array({', '.join(str(1 << i) for i in range(30, -1, -1))})"
    last = f"aggregate({steps}, 0, (n, x) -> if(coalesce(get(apart, n + x - 1).start < s.end, false), n + x, n))"
    df = df.withColumn("random", once(F.expr(
        f"transform(filter(filter(s_token, (s, i) -> get(odd, i)), s -> coalesce(get(apart, {last} - 1).end <= s.start, true)), "
        "s -> struct(s.start AS start, 3 AS kind, s.end AS end))")))
    return df.withColumn("spans", once(F.array_sort(F.concat("base", "random"))))


def merged(spans: str) -> Column:
    """Spans in order of their starts as (start, end), those that overlap or touch as one.

    A span begins a stretch if all before it end before it; the ends before it are running maxima, made in one pass.
    """
    ends = (f"aggregate({spans}, named_struct('top', -1, 'all', cast(array() AS array<int>)), "
            "(a, s) -> named_struct('top', greatest(a.top, s.end), 'all', array_append(a.all, a.top)), a -> array_append(a.all, a.top))")
    heads = f"filter(sequence(0, size({spans}) - 1), i -> get({spans}, i).start > get(tops, i))"
    joined = (f"transform(heads, (h, j) -> struct(get({spans}, h).start AS start, get(tops, coalesce(get(heads, j + 1), size({spans}))) AS end))")
    empty = "cast(array() AS array<struct<start: int, end: int>>)"
    return F.expr(f"if(size({spans}) = 0, {empty}, get(transform(array({ends}), tops -> get(transform(array({heads}), heads -> {joined}), 0)), 0))")


def written(spans: str) -> Column:
    """kind:start:end of all spans, joined by commas."""
    names = ", ".join(f"'{k}'" for k in KINDS)
    return F.expr(f"array_join(transform({spans}, s -> concat_ws(':', get(array({names}), s.kind), s.start, s.end)), ',')")


def find_secrets(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans), one row per row of ``docs``.

    spans has those of the patterns and, as kind ``random``, tokens that the models take for random strings
    and that no pattern's span touches.  Null texts count as empty; without spans base_sha256
    is that of an empty text.  Null ids and repeated rows stay; texts are read whole; other columns
    play no part; an empty table gives no rows.
    """
    df = scanned(docs, train(docs), ["doc_id"])
    count = [F.size(f"s_{k}").cast("long").alias(f"n_{k}") for k in KINDS[:3]]
    return df.select(F.col("k0").alias("doc_id"), *count, F.sha2(written("base"), 256).alias("base_sha256"),
                     written("spans").alias("spans"))


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every secret in the text replaced by ``mark``; all rows and columns stay.

    Null and empty texts stay as they are, equal rows stay equal, texts are read whole.  n_chars, if there is such a column, becomes the length of the new text where the text changed.
    """
    columns = docs.columns
    df = scanned(docs, train(docs), columns)
    df = df.withColumn("heads", once(merged("spans")))
    # the text between them, and the mark after each part but the last
    new = F.expr(
        "if(size(heads) = 0, text, array_join(transform(sequence(0, size(heads)), i -> substring(text, "
        "coalesce(get(heads, i - 1).end, 0) + 1, coalesce(get(heads, i).start, 2147483647) - coalesce(get(heads, i - 1).end, 0))), "
        f"{_quoted(mark)}))")
    changed = F.expr("size(heads) > 0")
    df = df.withColumn("new", once(new))
    out = []
    for i, c in enumerate(columns):
        own = F.col(f"k{i}")
        if c.lower() == "text":
            own = F.when(changed, F.col("new")).otherwise(own)
        elif c.lower() == "n_chars":
            own = F.when(changed, F.length("new").cast(docs.schema[i].dataType)).otherwise(own)
        out.append(own.alias(c))
    return df.select(*out)
