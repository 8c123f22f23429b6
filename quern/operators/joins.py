"""Joins that hold up under hot keys, and range-like joins written as equi-joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern import settings
from quern.operators.ordered import hot_keys, null_safe


def _bytes(field: T.StructField) -> Column:
    """Size of a value: texts, lists and nested values are measured, the rest is small and fixed."""
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(column), F.lit(0)) + 24
    if isinstance(field.dataType, T.ArrayType) and isinstance(field.dataType.elementType, (T.NumericType, T.BooleanType, T.DatetimeType)):
        return F.coalesce(F.array_size(column) * 8, F.lit(0)) + 24
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        return F.coalesce(F.octet_length(F.to_json(F.struct(column))), F.lit(0)) + 24
    return F.lit(16)


def fits_broadcast(df: DataFrame) -> bool:
    """One pass over a table to learn whether its rows and bytes may be broadcast."""
    width = reduce(lambda a, b: a + b, [_bytes(f) for f in df.schema.fields])
    rows, size = df.agg(F.count(F.lit(1)), F.sum(width.cast("bigint"))).first()
    return rows <= settings.limit(df.sparkSession, settings.BROADCAST_ROWS) and (size or 0) <= settings.limit(
        df.sparkSession, settings.BROADCAST_BYTES)


def lookup(
    fact: DataFrame, dim: DataFrame, on: list[tuple[str, str]], how: str = "inner", dim_rows: int | None = None
) -> DataFrame:
    """Join a large table to one whose key is unique (``how``: inner or left).

    ``on`` pairs fact columns with dimension columns; their names must differ.
    A small dimension is broadcast after its rows and bytes were checked.  A large one is
    shuffled, except for the keys that are hot in the fact table: their rows meet a
    broadcast of just those dimension rows, at most rows / ``quern.block.rows`` of them.
    ``dim_rows`` is the row count of a dimension of a few numbers per row, where the
    caller has it already.
    """
    spark = fact.sparkSession
    fact_keys, dim_keys = [F.col(a) for a, _ in on], [F.col(b) for _, b in on]
    same = reduce(lambda x, y: x & y, [a == b for a, b in zip(fact_keys, dim_keys)])
    if dim_rows is None:
        small = fits_broadcast(dim)
    else:
        small = dim_rows <= settings.limit(spark, settings.BROADCAST_ROWS)
    if small:
        return fact.join(F.broadcast(dim), same, how)
    present = reduce(lambda x, y: x & y, [a.isNotNull() for a in fact_keys])
    hot, _ = hot_keys(fact.filter(present), [a for a, _ in on])
    if hot is None:
        return fact.join(dim, same, how)
    names = [f"_h{i}" for i in range(len(on))]
    hot = F.broadcast(hot.toDF(*names))
    hot_keys_ = [F.col(n) for n in names]
    few = dim.join(hot, null_safe(dim_keys, hot_keys_), "left_semi")
    many = dim.join(hot, null_safe(dim_keys, hot_keys_), "left_anti")
    is_hot = null_safe(fact_keys, hot_keys_)
    return fact.join(hot, is_hot, "left_semi").join(F.broadcast(few), same, how).unionByName(
        fact.join(hot, is_hot, "left_anti").join(many, same, how)
    )


def pair_operations(df: DataFrame, keys: list[str], value: str, target: int) -> DataFrame:
    """Most disjoint pairs of rows per key whose values add up to ``target``.

    Rows are counted per value first, so each value meets one partner row.
    """
    counts = df.groupBy(*keys, F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    other = counts.select(*[F.col(k).alias(f"_{k}") for k in keys], (F.lit(target) - F.col("_v")).alias("_w"),
                          F.col("_c").alias("_d"))
    same = null_safe([F.col(k) for k in keys], [F.col(f"_{k}") for k in keys])
    pairs = counts.join(other, same & (F.col("_v") == F.col("_w"))).filter(F.col("_v") * 2 <= target)
    used = F.when(F.col("_v") * 2 == target, F.floor(F.col("_c") / 2)).otherwise(F.least("_c", "_d"))
    return pairs.groupBy(*keys).agg(F.sum(used).cast("bigint").alias("operations"))


def pairs_at_distance(df: DataFrame, keys: list[str], value: str, distance: int) -> DataFrame:
    """Distinct value pairs (low, low + distance) of the same key."""
    low = df.select(*keys, F.col(value).alias("low")).distinct()
    high = low.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("low").alias("high"))
    same = null_safe([F.col(k) for k in keys], [F.col(f"_{k}") for k in keys])
    return low.join(high, same & (F.col("low") + distance == F.col("high"))).select(*keys, "low", "high")


def one_letter_neighbours(words: DataFrame, word: str) -> DataFrame:
    """Pairs of words that differ in exactly one letter.

    Every word is stored under each of its places with the rest of its letters.  Such a form holds at
    most one word per letter of the alphabet, which bounds the join's groups.
    """
    w = words.select(F.col(word).alias("a")).distinct()
    masks = F.transform(
        F.sequence(F.lit(1), F.length("a")),
        lambda i: F.struct(i.alias("place"), F.concat(
            F.substring(F.col("a"), F.lit(1), i - 1), F.substring(F.col("a"), i + 1, F.length("a"))).alias("rest")),
    )
    left = w.filter(F.length("a") > 0).select("a", F.explode(masks).alias("m")).select("a", "m.place", "m.rest")
    right = left.select(F.col("a").alias("b"), F.col("place").alias("_place"), F.col("rest").alias("_rest"))
    same = (F.col("place") == F.col("_place")) & (F.col("rest") == F.col("_rest"))
    return left.join(right, same & (F.col("a") < F.col("b"))).select("a", "b")


def dependency_context(tasks: DataFrame) -> DataFrame:
    """Results of each task's ``depends_on`` in listed order, joined as one text.

    ``tasks``: task_id, depends_on (array), result.  Missing results are left out.
    """
    wanted = tasks.select("task_id", F.posexplode("depends_on").alias("pos", "dep"))
    done = tasks.filter(F.col("result").isNotNull() & (F.col("result") != "")).select(
        F.col("task_id").alias("_id"), F.col("result").alias("_text"))
    part = F.concat(F.lit("[Result from "), F.col("dep"), F.lit("]\n"), F.col("_text"))
    found = lookup(wanted, done, [("dep", "_id")])
    texts = found.groupBy("task_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", part.alias("part")))),
                                 lambda x: x["part"]), "\n\n").alias("context"))
    return tasks.select("task_id").join(texts, "task_id", "left").withColumn(
        "context", F.coalesce("context", F.lit("")))
