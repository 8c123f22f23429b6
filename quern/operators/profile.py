"""Inspection of tables: what a data frame's head/info/describe family reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern import settings
from quern.operators.joins import lookup
from quern.operators.quantiles import exact_quantiles, present


def melt(df: DataFrame, columns: list[str], kind: str) -> DataFrame:
    """Long form (column_name, value) of some columns, cast to one type."""
    return df.select(*[F.col(c).cast(kind).alias(c) for c in columns]).unpivot(
        [], columns, "column_name", "value"
    )


def info(df: DataFrame) -> DataFrame:
    """Per column: type and number of values present, in one pass over the table."""
    one = df.agg(*[F.count(c).alias(c) for c in df.columns])
    types = F.create_map(*[F.lit(x) for pair in df.dtypes for x in pair])
    return one.unpivot([], df.columns, "column_name", "non_null").select(
        "column_name", types[F.col("column_name")].alias("data_type"), "non_null"
    )


def describe_numeric(df: DataFrame, columns: list[str]) -> DataFrame:
    """count, mean, sample deviation, min, quartiles and max of each column; NaN counts as missing."""
    one = df.agg(*[f(present(c)).alias(f"{name}{i}") for i, c in enumerate(columns) for name, f in (
        ("count", F.count), ("mean", F.avg), ("std", F.stddev_samp), ("min", F.min), ("max", F.max))])
    moments = one.select(F.inline(F.array(*[F.struct(
        F.lit(i).alias("place"), F.lit(c).alias("column_name"), *[F.col(f"{m}{i}").alias(m) for m in ("count", "mean", "std", "min", "max")])
        for i, c in enumerate(columns)])))
    quartiles = exact_quantiles(df, [], columns, [0.25, 0.5, 0.75])  # a row per column
    return moments.join(F.broadcast(quartiles), F.col("place") == F.col("column"), "left").select(
        "column_name", "count", "mean", "std", "min",
        F.col("q0").alias("p25"), F.col("q1").alias("p50"), F.col("q2").alias("p75"), "max",
    )


def describe_categorical(df: DataFrame, columns: list[str]) -> DataFrame:
    """count, number of distinct values, the most frequent one (ties: smallest)."""
    counts = melt(df, columns, "string").groupBy("column_name", "value").agg(
        F.count("value").alias("n")
    ).filter(F.col("value").isNotNull())
    return counts.groupBy("column_name").agg(
        F.sum("n").alias("count"),
        F.count(F.lit(1)).alias("unique"),
        F.min_by("value", F.struct(-F.col("n"), "value")).alias("top"),
        F.max("n").alias("freq"),
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNotNull()).groupBy(column).agg(
        F.count(F.lit(1)).alias("n")
    ).orderBy(F.desc("n"), column)


def correlations(df: DataFrame, columns: list[str], target: str) -> DataFrame:
    """Correlation of each column with the target: one pass, one row per column."""
    one = df.agg(*[F.corr(F.col(c).cast("double"), F.col(target)).alias(c) for c in columns])
    return one.unpivot([], columns, "column_name", "correlation")


def box_plot(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Quartiles, whiskers (last value within 1.5 IQR) and outlier count per group; NaN counts as missing."""
    box = exact_quantiles(df, keys, [value], [0.25, 0.5, 0.75]).select(
        *[F.col(k).alias(f"_{k}") for k in keys],
        F.col("q0").alias("q1"), F.col("q1").alias("median"), F.col("q2").alias("q3"),
    ).checkpoint()
    iqr = F.col("q3") - F.col("q1")
    low, high = F.col("q1") - 1.5 * iqr, F.col("q3") + 1.5 * iqr
    v = present(value)
    inside = v.between(low, high)
    return lookup(df.select(*keys, value), box, [(k, f"_{k}") for k in keys]).groupBy(
        *keys, "q1", "median", "q3"
    ).agg(
        F.min(F.when(inside, F.col(value))).alias("low_whisker"),
        F.max(F.when(inside, F.col(value))).alias("high_whisker"),
        F.count_if(~inside).alias("outliers"),
    )


def density(df: DataFrame, facets: list[str], value: str, points: int) -> DataFrame:
    """Gaussian kernel density on an even grid, per facet, Scott's bandwidth.

    Each grid point is one partial aggregate, so the rows are never multiplied by
    the grid.
    """
    settings.ensure_checkpoint_dir(df.sparkSession)
    spread = df.groupBy(*[F.col(f).alias(f"_{f}") for f in facets]).agg(
        F.count(value).alias("_n"), F.min(value).alias("_low"), F.max(value).alias("_high"),
        (F.stddev_samp(value) * F.pow(F.count(value), F.lit(-0.2))).alias("_bw"),
    ).checkpoint()
    low, high = spread.agg(F.min("_low"), F.max("_high")).first()
    if low is None:
        low = high = 0.0
    grid = [low + (high - low) * i / (points - 1) for i in range(points)]
    spread = spread.drop("_low", "_high")
    z = lambda g: (F.lit(g) - F.col(value)) / F.col("_bw")
    sums = lookup(df.select(*facets, value), spread, [(f, f"_{f}") for f in facets]).groupBy(*facets, "_n", "_bw").agg(
        *[F.sum(F.exp(-0.5 * z(g) * z(g))).alias(f"g{i}") for i, g in enumerate(grid)]
    )
    scale = F.col("_n") * F.col("_bw") * (2 * 3.141592653589793) ** 0.5
    return sums.select(*facets, *[(F.col(f"g{i}") / scale).alias(str(i)) for i in range(points)]).unpivot(
        facets, [str(i) for i in range(points)], "point", "density"
    ).select(
        *facets, F.col("point").cast("int").alias("point"),
        F.element_at(F.array(*[F.lit(g) for g in grid]), F.col("point").cast("int") + 1).alias("x"),
        "density",
    )
