"""Exact quantiles of groups of any size, by radix selection."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quern import settings
from quern.operators.joins import lookup

#: places at which the 64 bits of a value are cut: three digits of 16, 24 and 24 bits
SHIFTS = (48, 24, 0)


def present(value: str) -> Column:
    """The value as a double, NULL in place of NaN."""
    v = F.col(value).cast("double")
    return F.when(~F.isnan(v), v)


def ordinal(value: Column) -> Column:
    """A whole number per double that sorts as the doubles do: its bits, with all but the sign turned over if it is negative."""
    bits = F.call_function("java_method", F.lit("java.lang.Double"), F.lit("doubleToLongBits"), value).cast("bigint")
    return bits.bitwiseXOR(F.shiftright(bits, 63).bitwiseAND(F.lit((1 << 63) - 1)))


def exact_quantiles(df: DataFrame, keys: list[str], values: list[str], probs: list[float]) -> DataFrame:
    """Interpolated quantiles per key and value column: ``column`` (place in ``values``), ``n``, ``q0, q1, …``.

    Rows without a key, missing values and NaN are left out; a column without any value in a group has no row.  All columns go
    through one histogram of the first digit of their bits; the cell that holds a wanted rank is told by its running sum.
    Only rows of such cells are looked at again, by the next digit, until a cell holds one value: two passes as a rule and
    never more than three, and no rows are shuffled, only counts (at most 2^24 per cell).
    """
    settings.ensure_checkpoint_dir(df.sparkSession)
    filled = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys], F.lit(True))
    cells_of = F.inline(F.array(*[F.struct(F.lit(i).alias("_c"), present(v).alias("_v")) for i, v in enumerate(values)]))
    rows = df.filter(filled).select(*keys, cells_of).filter(F.col("_v").isNotNull()).withColumn("_o", ordinal(F.col("_v")))
    group = [*keys, "_c"]
    counts = [F.count(F.lit(1)).alias("_m"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")]

    def chosen(cells: DataFrame, part: list[str], asks) -> DataFrame:
        """The cells that hold a wanted rank, one row per rank, which then counts from the cell's first value."""
        upto = F.sum("_m").over(W.partitionBy(*part).orderBy("_p"))
        held = F.filter(asks, lambda a: (a["rank"] >= F.col("_to") - F.col("_m")) & (a["rank"] < F.col("_to")))
        ask = F.explode(held).alias("_a")
        return cells.withColumn("_to", upto).select(
            *group, "n", "_p", "_lo", "_hi", "_to", "_m", ask).select(
            *group, "n", "_p", "_lo", "_hi", F.struct("_a.q", "_a.side", (F.col("_a.rank") - F.col("_to") + F.col("_m")).alias("rank")).alias("_a"))

    cells = rows.groupBy(*group, F.shiftright("_o", SHIFTS[0]).alias("_p")).agg(*counts).withColumn(
        "n", F.sum("_m").over(W.partitionBy(*group)))
    asks = []
    for q, p in enumerate(probs):
        at = (F.col("n") - 1) * F.lit(float(p))
        asks += [F.struct(F.lit(q).alias("q"), F.lit(side).alias("side"), place(at).cast("bigint").alias("rank"))
                 for side, place in enumerate((F.floor, F.ceil))]
    found = chosen(cells, group, F.array(*asks)).checkpoint()
    for before, shift in zip(SHIFTS, SHIFTS[1:]):
        open_ = found.filter("_lo < _hi")
        if open_.isEmpty():
            break
        names = [f"_k{i}" for i in range(len(group) + 1)]
        wanted = open_.groupBy(*group, "_p", "n").agg(F.collect_list("_a").alias("_asks")).toDF(*names, "n", "_asks").checkpoint()
        parents = rows.withColumn("_up", F.shiftright("_o", before))
        inside = lookup(parents, wanted, list(zip([*group, "_up"], names))).groupBy(
            *group, "_up", F.shiftright("_o", shift).alias("_p")).agg(*counts, F.first("n").alias("n"), F.first("_asks").alias("_asks"))
        found = found.filter("_lo = _hi").unionByName(chosen(inside, [*group, "_up"], F.col("_asks"))).checkpoint()
    side = lambda q, s: F.max(F.when((F.col("_a.q") == q) & (F.col("_a.side") == s), F.col("_lo")))
    ends = found.groupBy(*group, "n").agg(*[side(q, s).alias(f"_{s}{q}") for q in range(len(probs)) for s in (0, 1)])
    at = [(F.col("n") - 1) * F.lit(float(p)) for p in probs]
    return ends.select(*keys, F.col("_c").alias("column"), "n", *[
        (F.col(f"_0{q}") + (F.col(f"_1{q}") - F.col(f"_0{q}")) * (at[q] - F.floor(at[q]))).alias(f"q{q}") for q in range(len(probs))])
