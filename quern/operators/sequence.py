"""Jobs over the ordered rows of each key, built on ``Ordered`` scans.

Each function takes ``keys`` and a unique ``order`` within a key.  Values that are
added up should be integers, so that the result does not depend on the order in
which partial sums meet.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern import settings
from quern.operators.ordered import Ordered, null_safe, position, running, runs, shift, total

LONG = "bigint"


def run_lengths(df: DataFrame, keys: list[str], order: list[str], item: str) -> DataFrame:
    """Run-length encoding: one row per stretch of equal neighbours."""
    o = runs(Ordered(df.select(*keys, *order, item), keys, order), item)
    return o.rows().groupBy(*keys, "run").agg(
        F.first(item).alias(item), F.count(F.lit(1)).alias("length"))


def rle_size(df: DataFrame, keys: list[str], order: list[str], item: str) -> DataFrame:
    """Characters the encoding takes: one per run, plus the digits of lengths above 1."""
    lengths = run_lengths(df, keys, order, item)
    digits = F.when(F.col("length") > 1, F.length(F.col("length").cast("string"))).otherwise(0)
    return lengths.groupBy(*keys).agg(F.sum(1 + digits).cast(LONG).alias("size"))


def keep_one_per_run(df: DataFrame, keys: list[str], order: list[str], item: str, cost: str) -> DataFrame:
    """Cost of removing all but the dearest row of each run."""
    o = runs(Ordered(df.select(*keys, *order, item, cost), keys, order), item)
    per = o.rows().groupBy(*keys, "run").agg((F.sum(cost) - F.max(cost)).alias("c"))
    return per.groupBy(*keys).agg(F.sum("c").cast(LONG).alias("cost"))


def break_triples(df: DataFrame, keys: list[str], order: list[str], item: str) -> DataFrame:
    """Fewest changes so that no three equal neighbours remain."""
    return run_lengths(df, keys, order, item).groupBy(*keys).agg(
        F.sum(F.floor(F.col("length") / 3)).cast(LONG).alias("changes"))


def free_slots(df: DataFrame, keys: list[str], order: list[str], taken: str) -> DataFrame:
    """How many items fit into the empty places if no two items may be neighbours.

    ``taken`` is a boolean column; a run of empty places at an edge has one side
    without a neighbour, a run that covers everything has two.
    """
    o = runs(Ordered(df.select(*keys, *order, taken), keys, order), taken).scan(
        _i=position(), _n=total("sum", F.lit(1).cast(LONG)))
    per = o.rows().groupBy(*keys, "run").agg(
        F.first(taken).alias("taken"), F.count(F.lit(1)).alias("length"),
        F.min("_i").alias("a"), F.max("_i").alias("b"), F.max("_n").alias("n"))
    edges = F.when(F.col("a") == 1, 1).otherwise(0) + F.when(F.col("b") == F.col("n"), 1).otherwise(0)
    fits = F.when(F.col("taken"), 0).otherwise(F.floor((F.col("length") - 1 + edges) / 2))
    return per.groupBy(*keys).agg(F.sum(fits).cast(LONG).alias("capacity"))


def beams(df: DataFrame, keys: list[str], row: str, marked: str) -> DataFrame:
    """Products of the mark counts of consecutive non-empty rows, summed."""
    counts = df.filter(marked).groupBy(*keys, row).agg(F.count(F.lit(1)).alias("n"))
    o = Ordered(counts, keys, [row]).scan(prev=shift("n"))
    return o.rows().groupBy(*keys).agg(F.coalesce(F.sum(F.col("n") * F.col("prev")), F.lit(0)).cast(LONG).alias("beams"))


def prefix_sums(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """Adds 1-based ``i`` and ``upto`` (sum including the row)."""
    return Ordered(df, keys, order).scan(i=position(), upto=running("sum", value)).rows()


def circular_sum(df: DataFrame, keys: list[str], order: list[str], value: str, k: int) -> DataFrame:
    """Adds ``circular``: the sum of the next k (or previous -k) values around the circle.

    Two prefix sums are subtracted; the far one is found by its place, a join key
    that never repeats.
    """
    if k == 0:
        return df.withColumn("circular", F.lit(0).cast(LONG))
    settings.ensure_checkpoint_dir(df.sparkSession)
    rows = Ordered(df, keys, order).scan(
        _i=position(), _upto=running("sum", value), _n=total("sum", F.lit(1).cast(LONG)), _whole=total("sum", value)).rows().checkpoint()
    far = rows.select(*[F.col(c).alias(f"_far_{c}") for c in keys], F.col("_i").alias("_far_i"), F.col("_upto").alias("_far_upto"))
    same_key = null_safe([F.col(c) for c in keys], [F.col(f"_far_{c}") for c in keys])
    # forward: (i, i + k]; backward: [i - |k|, i - 1], that is (i - |k| - 1, i - 1]
    end = F.col("_i") + (k if k > 0 else -1)
    sums = []
    for name, place in (("_end", end), ("_start", end - abs(k))):
        turns = F.floor((place - 1) / F.col("_n"))
        rows = rows.join(far, same_key & (place - turns * F.col("_n") == F.col("_far_i"))).withColumn(
            name, F.col("_far_upto") + turns * F.col("_whole")).drop(*far.columns)
        sums.append(F.col(name))
    return rows.withColumn("circular", (sums[0] - sums[1]).cast(LONG)).drop("_i", "_upto", "_n", "_whole", "_end", "_start")


def variable_frame_sum(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """Per key: the sum over rows i of all values in places [max(0, i - v_i), i]."""
    rows = prefix_sums(df.select(*keys, *order, value), keys, order, value)
    before = rows.select(*[F.col(c).alias(f"_{c}") for c in keys], F.col("i").alias("_i"), F.col("upto").alias("_upto"))
    start = F.greatest(F.lit(1), F.col("i") - F.col(value))
    on = null_safe([F.col(c) for c in keys], [F.col(f"_{c}") for c in keys]) & (start - 1 == F.col("_i"))
    # frames that reach the first row have nothing before them, and need not look for it
    first = rows.filter(start <= 1).select(*keys, F.col("upto").alias("part"))
    later = rows.filter(start > 1).join(before, on).select(*keys, (F.col("upto") - F.col("_upto")).alias("part"))
    return first.unionByName(later).groupBy(*keys).agg(F.sum("part").cast(LONG).alias("total"))


def shortest_run_reaching(df: DataFrame, keys: list[str], order: list[str], value: str, target: int) -> DataFrame:
    """Length of the shortest stretch whose (non-negative) values reach ``target``; 0 if none.

    For each prefix sum P[r] the largest l with P[l] <= P[r] - target is an as-of
    lookup, done as one scan over prefix sums and questions in value order.
    """
    settings.ensure_checkpoint_dir(df.sparkSession)
    rows = prefix_sums(df.select(*keys, *order, value), keys, order, value).checkpoint()
    points = rows.select(*keys, F.col("upto").alias("at"), F.lit(0).alias("kind"), "i")
    zero = rows.select(*keys).distinct().select(
        *keys, F.lit(0).cast(LONG).alias("at"), F.lit(0).alias("kind"), F.lit(0).cast(LONG).alias("i"))
    asks = rows.select(*keys, (F.col("upto") - target).alias("at"), F.lit(1).alias("kind"), "i").filter("at >= 0")
    o = Ordered(points.unionByName(zero).unionByName(asks), keys, ["at", "kind", "i"]).scan(
        left=running("max", F.when(F.col("kind") == 0, F.col("i"))))
    length = F.when(F.col("kind") == 1, F.col("i") - F.col("left"))
    return o.rows().groupBy(*keys).agg(F.coalesce(F.min(length), F.lit(0)).cast(LONG).alias("shortest"))


def _last_same(df: DataFrame, keys: list[str], order: list[str], item: str) -> Ordered:
    """Place ``i`` of each row and ``prev``, the place of the same item before it (else 0)."""
    first = Ordered(df.select(*keys, *order, item), keys, order)
    placed = first.scan(i=position()).rows()
    again = Ordered(placed.drop(*order), [*keys, item], ["i"], within=first).scan(prev=shift("i")).rows()
    return Ordered(again.withColumn("prev", F.coalesce("prev", F.lit(0).cast(LONG))), keys, ["i"], settle=first.split, within=first)


def longest_without_repeat(df: DataFrame, keys: list[str], order: list[str], item: str) -> DataFrame:
    o = _last_same(df, keys, order, item).scan(start=running("max", "prev"))
    return o.rows().groupBy(*keys).agg(F.max(F.col("i") - F.col("start")).alias("longest"))


def longest_with_distinct(df: DataFrame, keys: list[str], order: list[str], item: str, k: int) -> DataFrame:
    """Longest stretch with at most ``k`` distinct items.

    place_m(r) is the last place before r's m-1 latest distinct items.  Going from
    row r-1 to r, place_{m+1} becomes place_m(r-1) unless r repeats one of those
    first m items, else it stays; places only grow, so "stays" is a running max.
    """
    o = _last_same(df, keys, order, item)
    place = "i"
    for m in range(k):
        o = o.scan(_old=shift(place))
        moved = F.when(F.col("prev") < F.col("_old"), F.col("_old"))
        o = o.scan(**{f"_p{m}": running("max", moved)})
        o.df = o.df.drop("_old").withColumn(f"_p{m}", F.coalesce(f"_p{m}", F.lit(0).cast(LONG)))
        place = f"_p{m}"
    return o.rows().groupBy(*keys).agg(F.max(F.col("i") - F.col(place)).alias("longest"))


def reuse_distance(df: DataFrame, keys: list[str], order: list[str], item: str) -> DataFrame:
    """Distinct items between each row and the same item's row before it; NULL at first use.

    With prev(j) the earlier place of j's item, the answer for row i is the number
    of earlier rows with prev <= prev(i), less prev(i).  That rank is counted one
    binary digit at a time: two prevs compare by the first digit in which they
    differ, so each digit is one running count inside the rows that agree above it.
    If no key is too large for a task, each key is counted in one go, by merging.
    """
    first = Ordered(df.select(*keys, *order, item), keys, order)
    if not first.split:
        return _reuse_in_groups(first.rows(), keys, order, item)
    rows = _last_same(df, keys, order, item).rows()
    longest = rows.agg(F.max("i")).first()[0] or 1
    digits = int(longest).bit_length()
    firsts = Ordered(rows, keys, ["i"]).scan(
        _new=running("sum", F.when(F.col("prev") == 0, 1).otherwise(0).cast(LONG))).rows()
    again = firsts.filter("prev > 0")
    levels = again.select(*keys, "i", "prev", F.explode(F.sequence(F.lit(0), F.lit(digits - 1))).alias("level")).select(
        *keys, "i", "level",
        F.expr("shiftright(prev, level + 1)").alias("above"),
        F.expr("shiftright(prev, level) & 1").alias("digit"))
    o = Ordered(levels, [*keys, "level", "above"], ["i"]).scan(
        smaller=running("sum", (1 - F.col("digit")).cast(LONG), before=True))
    part = F.when(F.col("digit") == 1, F.coalesce("smaller", F.lit(0))).otherwise(0)
    rank = o.rows().groupBy(*[F.col(k).alias(f"_{k}") for k in keys], F.col("i").alias("_i")).agg(F.sum(part).alias("_r"))
    on = null_safe([F.col(k) for k in keys], [F.col(f"_{k}") for k in keys]) & (F.col("i") == F.col("_i"))
    # rows with prev = 0 also count as "prev <= prev(i)"
    return firsts.join(rank, on, "left").select(
        *keys, "i", item,
        F.when(F.col("prev") > 0, F.col("_r") + F.col("_new") - F.col("prev")).alias("distance"))


def earlier_not_above(values: np.ndarray) -> np.ndarray:
    """For every place the number of earlier places with a value no larger, counted while halves are merged."""
    at = np.arange(len(values))
    out, width = np.zeros(len(values), np.int64), 1
    while width < len(values):
        right = at // width % 2 == 1
        order = np.lexsort((right, values, at // (2 * width)))  # of equal values the left half's come first
        left = np.concatenate(([0], np.cumsum(~right[order])))
        start = np.searchsorted(at[order] // (2 * width), at[order] // (2 * width), "left")
        later = right[order]
        out[order[later]] += (left[1:] - left[start])[later]
        width *= 2
    return out


def _reuse_in_groups(rows: DataFrame, keys: list[str], order: list[str], item: str) -> DataFrame:
    """Reuse distances of keys that fit into a task: one shuffle."""

    def count(table: pa.Table) -> pa.Table:
        table = table.take(pc.sort_indices(table, [(c, "ascending") for c in order], null_placement="at_start"))
        codes = table[item].combine_chunks().dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
        by_item = np.argsort(codes, kind="stable")
        same = codes[by_item[1:]] == codes[by_item[:-1]]
        prev = np.zeros(len(codes), np.int64)
        prev[by_item[1:][same]] = by_item[:-1][same] + 1
        distance = pa.array(earlier_not_above(prev) - prev, mask=prev == 0)
        return pa.table([*(table[k] for k in keys), pa.array(np.arange(1, len(codes) + 1)), table[item], distance],
                        [*keys, "i", item, "distance"])

    long = T.LongType()
    kind = T.StructType([*(rows.schema[k] for k in keys), T.StructField("i", long), rows.schema[item], T.StructField("distance", long)])
    return rows.groupBy(*keys).applyInArrow(count, kind)


def repeated_pair(df: DataFrame, keys: list[str], order: list[str], record: Column) -> DataFrame:
    """Whether the last two records of a key equal the two before them."""
    o = Ordered(df.select(*keys, *order, record.alias("e")), keys, order).scan(l1=shift("e"), i=position())
    o = o.scan(l2=shift("l1")).scan(l3=shift("l2"), n=total("sum", F.lit(1).cast(LONG)))
    last = o.rows().filter("i = n")
    loop = (F.col("n") >= 4) & F.col("e").eqNullSafe(F.col("l2")) & F.col("l1").eqNullSafe(F.col("l3"))
    return last.select(*keys, loop.alias("looping"))


def trailing_count(df: DataFrame, keys: list[str], time: str, tie: str, micros: int) -> DataFrame:
    """Rows of the key in the closed trailing window, up to and including each row.

    A sweep: a row counts from its own time and is dropped just after the window.
    """
    come = df.select(*keys, F.col(time).alias("at"), F.lit(1).alias("kind"), F.col(tie).alias("tie"))
    leave = come.withColumn("at", F.col("at") + micros + 1).withColumn("kind", F.lit(0))
    delta = F.when(F.col("kind") == 1, 1).otherwise(-1).cast(LONG)
    o = Ordered(come.unionByName(leave), keys, ["at", "kind", "tie"]).scan(n=running("sum", delta))
    return o.rows().filter("kind = 1").select(*keys, F.col("tie").alias(tie), "n")


def head_start(df: DataFrame, keys: list[str], order: list[str], value: str, threshold: str, first: int,
               spent: str | None = None, stock: int = 0) -> DataFrame:
    """Least extra start so that the running total always exceeds the next threshold.

    With ``spent``, what the rows use up in all must stay below the ``stock``, too: what lacks there is
    added to the extra start.
    """
    columns = [*keys, *order, value, threshold] + ([F.col(spent).alias("_spent")] if spent else [])
    o = Ordered(df.select(*columns), keys, order).scan(_before=running("sum", value, before=True))
    lack = F.greatest(F.max(F.col(threshold) - first - F.coalesce("_before", F.lit(0)) + 1), F.lit(0))
    if spent:
        lack = lack + F.greatest(F.sum("_spent") - stock + 1, F.lit(0))
    return o.rows().groupBy(*keys).agg(lack.cast(LONG).alias("extra"))


def softmax(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """exp(x - max) over its sum, within the key."""
    names = [f"_k{i}" for i in range(len(keys))]
    on = null_safe([F.col(k) for k in keys], [F.col(n) for n in names])
    groups = [F.col(k).alias(n) for k, n in zip(keys, names)]
    with_top = df.join(df.groupBy(*groups).agg(F.max(value).alias("_top")), on).drop(*names).withColumn(
        "_e", F.exp(F.col(value) - F.col("_top")))
    sums = with_top.groupBy(*groups).agg(F.sum("_e").alias("_sum"))
    return with_top.join(sums, on).withColumn("softmax", F.col("_e") / F.col("_sum")).drop("_top", "_e", "_sum", *names)
