"""Distinct counts that can be stored and united: one small sketch per group, whatever the number of rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: 2^LOG_BUCKETS counters per sketch, a few kilobytes
LOG_BUCKETS = 12
#: three standard errors of such a sketch, also after a union
BOUND = 3 * 1.04 / 2 ** (LOG_BUCKETS / 2)


def distinct_sketches(df: DataFrame, keys: list[str], column: str) -> DataFrame:
    """(keys, sketch) of the distinct values per group; summed in the tasks, so no value is shuffled.  Missing values do not count."""
    return df.groupBy(*keys).agg(F.hll_sketch_agg(F.col(column), F.lit(LOG_BUCKETS)).alias("sketch"))


def united(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, sketch) of the values that are in any sketch of the group: ranges of days from stored days, for instance."""
    return sketches.groupBy(*keys).agg(F.hll_union_agg("sketch", F.lit(False)).alias("sketch"))
