"""Vectors as arrays, matrices and grids as coordinate tables (i, j, v)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.operators.joins import lookup

BLOCK = 512  # rows and columns of one block of a product


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two arrays; NULL if one has no length."""
    dot = lambda x, y: F.aggregate(
        F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    norms = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norms > 0, dot(a, b) / norms)


def coordinates(df: DataFrame, row: str, vector: str) -> DataFrame:
    """Array rows to (i, j, v)."""
    return df.select(F.col(row).alias("i"), F.posexplode(vector).alias("j", "v")).select(
        "i", F.col("j").cast("bigint").alias("j"), F.col("v").cast("double").alias("v"))


def transpose(m: DataFrame) -> DataFrame:
    return m.select(F.col("j").alias("i"), F.col("i").alias("j"), "v")


def product(a: DataFrame, b: DataFrame, block: int = BLOCK) -> DataFrame:
    """Matrix product in square blocks.

    Blocks of A meet blocks of B with the same inner range; each task holds one
    pair of blocks, of bounded size however the entries are spread, and adds up
    the inner range before anything is shuffled.
    """
    cut = lambda c: F.floor(F.col(c) / block).cast("bigint")
    a_rows, b_cols = (m.agg(F.min(cut(c)), F.max(cut(c))).first() for m, c in ((a, "i"), (b, "j")))
    if a_rows[0] is None or b_cols[0] is None:
        return a.limit(0)
    # bigint like cut(): both sides of the cogroup must hash their keys alike
    spread = lambda r: F.explode(F.sequence(*[F.lit(x).cast("bigint") for x in r]))
    # every column gets a name of its own: a and b may be made from the same table
    left = a.select(F.col("i").alias("row"), F.col("j").alias("a_k"), F.col("v").alias("a_v"),
                    cut("i").alias("bi"), cut("j").alias("bk"), spread(b_cols).alias("bj"))
    right = b.select(F.col("i").alias("b_k"), F.col("j").alias("col"), F.col("v").alias("b_v"),
                     spread(a_rows).alias("bi"), cut("i").alias("bk"), cut("j").alias("bj"))

    def multiply(key: tuple, x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        bi, bk, bj = key
        if x.empty or y.empty:
            return pd.DataFrame({"i": [], "j": [], "v": [], "odd": []})
        # entries with equal coordinates add up; a cell exists wherever two entries meet, whatever their values
        sides = []
        for i, j, v in ((x.row - bi * block, x.a_k - bk * block, x.a_v), (y.b_k - bk * block, y.col - bj * block, y.b_v)):
            dense, there, odd = (np.zeros((block, block)) for _ in range(3))
            v = v.to_numpy(dtype=float)
            np.add.at(dense, (i, j), np.where(np.isfinite(v), v, 0.0))
            there[i, j] = 1.0
            odd[i, j] = np.maximum(odd[i, j], ~np.isfinite(v))
            sides.append((dense, there, odd))
        (dense_x, there_x, odd_x), (dense_y, there_y, odd_y) = sides
        out = dense_x @ dense_y
        odd = odd_x @ there_y + there_x @ odd_y > 0  # NaN only where such an entry takes part
        i, j = np.nonzero(there_x @ there_y > 0)
        return pd.DataFrame({"i": i + bi * block, "j": j + bj * block, "v": out[i, j], "odd": odd[i, j]})

    keys = ["bi", "bk", "bj"]
    parts = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(multiply, "i bigint, j bigint, v double, odd boolean")
    return parts.groupBy("i", "j").agg(F.when(F.bool_or("odd"), F.lit(float("nan"))).otherwise(F.sum("v")).alias("v"))


def row_means(m: DataFrame) -> DataFrame:
    return m.groupBy("i").agg(F.avg("v").alias("mean"))


def column_means(m: DataFrame) -> DataFrame:
    return m.groupBy("j").agg(F.avg("v").alias("mean"))


def diagonal(vector: DataFrame) -> DataFrame:
    """Diagonal matrix of (i, v) in coordinates: all other cells are zero and have no row."""
    return vector.select("i", F.col("i").alias("j"), "v")


def covariance(df: DataFrame, vector: str) -> DataFrame:
    """Sample covariance of the vector's components.

    Every partition is reduced to its component sums and products, so the
    shuffle carries one small matrix per partition and not the vectors.  All values are shifted by
    one of the vectors, so that large means do not eat the digits of small deviations.
    """
    origin = df.select(vector).filter(F.col(vector).isNotNull()).first()
    shift = np.asarray(origin[0], dtype=float) if origin else np.zeros(0)

    def reduce_batch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, products, sums = 0.0, 0.0, 0.0
        for batch in batches:
            if batch.empty:
                continue
            x = np.stack(batch[vector].to_numpy()).astype(float) - shift
            n, products, sums = n + len(x), products + x.T @ x, sums + x.sum(axis=0)
        if n:
            d = len(sums)
            i, j = np.divmod(np.arange(d * d), d)
            yield pd.DataFrame({"i": i, "j": j, "n": n, "p": products.ravel(), "a": sums[i], "b": sums[j]})

    parts = df.select(vector).mapInPandas(reduce_batch, "i bigint, j bigint, n double, p double, a double, b double")
    n = F.sum("n")
    return parts.groupBy("i", "j").agg(((F.sum("p") - F.sum("a") * F.sum("b") / n) / (n - 1)).alias("v"))


def skyline_gain(grid: DataFrame) -> DataFrame:
    """How much all cells can grow without changing any row or column maximum."""
    rows = grid.groupBy(F.col("i").alias("_i")).agg(F.max("v").alias("_r"))
    cols = grid.groupBy(F.col("j").alias("_j")).agg(F.max("v").alias("_c"))
    both = lookup(lookup(grid, rows, [("i", "_i")]), cols, [("j", "_j")])
    room = both.filter((F.col("v") != F.col("_r")) & (F.col("v") != F.col("_c")))
    return room.agg(F.coalesce(F.sum(F.least("_r", "_c") - F.col("v")), F.lit(0)).cast("bigint").alias("gain"))


def neighbour_counts(marks: DataFrame, rows: int, columns: int) -> DataFrame:
    """Marked cells among the 8 neighbours of every cell of a grid; -1 on marked cells.

    Cells are numbered from 1; a cell marked twice counts once.
    """
    cells = marks.select("i", "j").distinct()
    near = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"))
                     for a in (-1, 0, 1) for b in (-1, 0, 1) if (a, b) != (0, 0)])
    sums = cells.select("i", "j", F.explode(near).alias("o")).select(
        (F.col("i") + F.col("o.a")).alias("i"), (F.col("j") + F.col("o.b")).alias("j")
    ).filter(F.col("i").between(1, rows) & F.col("j").between(1, columns)).groupBy("i", "j").agg(
        F.count(F.lit(1)).alias("n"))
    grid = marks.sparkSession.range(1, rows + 1).select(
        F.col("id").alias("i"), F.explode(F.expr(f"sequence(1L, {int(columns)}L)")).alias("j"))
    marked = cells.withColumn("_m", F.lit(True))
    return grid.join(sums, ["i", "j"], "left").join(marked, ["i", "j"], "left").select(
        "i", "j", F.when(F.col("_m"), F.lit(-1)).otherwise(F.coalesce("n", F.lit(0))).cast("bigint").alias("n"))
