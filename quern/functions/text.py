"""Tokens and letter signatures as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: three or more letters a-z with no letter, digit or underscore next to them.
TOKEN = r"(?<![\p{L}\p{N}_])[a-z]{3,}+(?![\p{L}\p{N}_])"


def tokens(text: Column) -> Column:
    """Lower-case words made of three or more letters a-z."""
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))


def once(c: Column) -> Column:
    """The same value, made in this projection and nowhere else.

    Spark moves filters below projections and puts the expressions in place of their names; arrays
    that are read inside lambdas would then be made again for every element.  It leaves alone what
    depends on the task.
    """
    return F.when(F.spark_partition_id() >= 0, c)


def letters_sorted(word: Column) -> Column:
    return F.array_join(F.array_sort(F.split(word, "")), "")
