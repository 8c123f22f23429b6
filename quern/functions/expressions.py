"""Column expressions: Column in, Column out, all inside Spark's own functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Right-closed age bins and their labels.
AGE_BINS = [0, 11, 17, 25, 65, 80]
AGE_LABELS = ["Child", "Youth", "Young Adult", "Adult", "Senior"]

# Text patterns.
EMAIL = r"^[a-zA-Z0-9_]+@[a-zA-Z]+\.com$"
LOOSE_EMAIL = r"[A-Za-z0-9._+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
SERIAL = r"SN[0-9]{4}-[0-9]{4}([^0-9]|$)"


def is_valid_email(mail: Column) -> Column:
    return mail.rlike(EMAIL)


def emails(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(LOOSE_EMAIL), F.lit(0))


def canonical_email(mail: Column) -> Column:
    """Drop the +tag and the dots of the local part."""
    local = F.regexp_replace(F.split_part(F.split_part(mail, F.lit("@"), F.lit(1)), F.lit("+"), F.lit(1)), r"\.", "")
    return F.concat(local, F.lit("@"), F.split_part(mail, F.lit("@"), F.lit(2)))


def has_valid_serial(text: Column) -> Column:
    return text.rlike(SERIAL)


def cut(x: Column, bins: list, labels: list[str]) -> Column:
    """Right-closed bins (a, b]; outside all bins: NULL."""
    out = F.lit(None).cast("string")
    for low, high, label in reversed(list(zip(bins, bins[1:], labels))):
        out = F.when((x > low) & (x <= high), label).otherwise(out)
    return out


def div0(n: Column, d: Column) -> Column:
    """Division that gives 0 for a zero divisor."""
    return F.when(d == 0, F.lit(0.0)).otherwise(n / d)


def reverse_words(text: Column) -> Column:
    """Words in reverse order, one space between them."""
    return F.array_join(F.reverse(F.filter(F.split(text, " "), lambda w: w != "")), " ")


def last_word_length(text: Column) -> Column:
    return F.length(F.element_at(F.split(F.rtrim(text), " "), -1))


def lenient_int(text: Column) -> Column:
    """Optional sign and leading digits after trimming; 0 if none; clamped to 32 bits."""
    body = F.trim(text)
    digits = F.regexp_extract(body, r"^[+-]?0*([0-9]*)", 1)
    negative = body.startswith("-")
    size = F.when(F.length(digits) > 18, F.lit("9" * 18)).otherwise(digits).try_cast("bigint")
    value = F.coalesce(F.when(negative, -size).otherwise(size), F.lit(0))
    return F.greatest(F.least(value, F.lit(2147483647)), F.lit(-2147483648)).cast("int")


def word_weights(words: Column, weights: list[int]) -> Column:
    """Each word's letter weights summed, modulo 26, counted back from z; joined."""
    table = F.array(*[F.lit(w) for w in weights])

    def letter(word: Column) -> Column:
        weight = F.aggregate(
            F.split(word, ""), F.lit(0),
            lambda s, c: s + F.when(c == "", 0).otherwise(F.coalesce(F.get(table, F.ascii(c) - 97), F.lit(0))))
        return F.char(F.lit(122) - weight % 26)

    return F.array_join(F.transform(words, letter), "")


# Context length of each reasoning mode.
CONTEXT = {"non-think": 8192, "high": 131072, "max": 393216}


def fit_context(tokens: Column, mode: Column, reserved: Column) -> Column:
    """The last ``context - reserved`` tokens; none if that is not positive."""
    context = F.create_map(*[F.lit(x) for pair in CONTEXT.items() for x in pair])[mode]
    room = F.when(context.isNotNull(), context - reserved).otherwise(
        F.raise_error(F.concat(F.lit("invalid mode: "), mode)).cast("int"))
    start = F.greatest(F.size(tokens) - room, F.lit(0)) + 1
    return F.when(room <= 0, F.array().cast("array<string>")).otherwise(
        F.slice(tokens, start, F.greatest(room, F.lit(0))))


def strip_fences(raw: Column, language: str) -> Column:
    """Text without a leading ```language and a trailing ``` fence."""
    return F.regexp_replace(
        F.regexp_replace(F.trim(raw), rf"(?i)^```(?:{language})?\s*", ""), r"\s*```\s*$", "")


def tolerant_json(raw: Column) -> Column:
    """The JSON value in a messy answer: the whole text, else its {…} block, else NULL."""
    body = strip_fences(raw, "json")
    block = F.regexp_extract(body, r"(?s)(\{.*\})", 1)
    return F.coalesce(F.try_parse_json(body), F.try_parse_json(F.nullif(block, F.lit(""))))


def content_id(question: Column, sql: Column) -> Column:
    return F.substring(F.md5(F.concat(question, sql)), 1, 12)


def sigmoid(z: Column) -> Column:
    return 1 / (1 + F.exp(-z))


def elu(z: Column, alpha: float) -> Column:
    return F.when(z > 0, z).otherwise(alpha * (F.exp(z) - 1))


def fahrenheit(celsius: Column) -> Column:
    return F.round(celsius * 9 / 5 + 32, 1)


def bracket_tax(income: Column, brackets: list[tuple[float, float]]) -> Column:
    """Progressive tax: each (upper bound, percent) applies to the part above the last bound."""
    tax, low = F.lit(0.0), 0
    for high, percent in brackets:
        part = F.greatest(F.least(income, F.lit(float(high))) - float(low), F.lit(0.0))
        tax, low = tax + part * percent / 100, high
    return tax
