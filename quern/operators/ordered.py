"""Ordered scans over keyed rows that stay parallel when one key is huge.

A plain window puts all rows of a key into one task.  Here a key with more rows
than a task should hold is cut, along the order, into blocks.  Every scan runs
inside the blocks, and the block summaries (a row per block, broadcast if they are few) give
each block what came before it.  Without such a key the plan is the plain window
and nothing else.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quern import settings

BLOCK = "_block"
SAMPLES_PER_BLOCK = 32
_AGG = {"sum": F.sum, "max": F.max, "min": F.min}


def hot_keys(df: DataFrame, keys: list[str]) -> tuple[DataFrame | None, int]:
    """Keys holding more rows than one task should, and that row limit.

    The limit does not depend on the data, so at most total / limit keys can
    qualify: half a million of 10^12 rows.
    """
    spark = df.sparkSession
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    largest = counts.agg(F.max("_n")).first()[0]
    cap = settings.limit(spark, settings.BLOCK_ROWS)
    if (largest or 0) <= cap:
        return None, cap
    rows = counts.filter(F.col("_n") > cap).select(*keys).collect()
    if not keys:
        return spark.range(1).select(F.lit(True).alias("_all")), cap
    return spark.createDataFrame(rows, df.select(*keys).schema), cap


def null_safe(left: list[Column], right: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, [a.eqNullSafe(b) for a, b in zip(left, right)], F.lit(True))


@dataclass(frozen=True)
class Scan:
    kind: str  # running | shift | total
    how: str
    value: Column
    before: bool = False
    reverse: bool = False


def running(how: str, value, before: bool = False, reverse: bool = False) -> Scan:
    """sum/max/min of everything up to this row (``before``: without this row)."""
    return Scan("running", how, F.col(value) if isinstance(value, str) else value, before, reverse)


def position() -> Scan:
    """1-based place in the order."""
    return running("sum", F.lit(1).cast("bigint"))


def shift(value, reverse: bool = False) -> Scan:
    """Value of the previous row (``reverse``: of the next row)."""
    return Scan("shift", "", F.col(value) if isinstance(value, str) else value, reverse=reverse)


def total(how: str, value) -> Scan:
    """sum/max/min over all rows of the key."""
    return Scan("total", how, F.col(value) if isinstance(value, str) else value)


class Ordered:
    """Rows of ``df`` per key in the order of the columns ``order`` (all ascending).

    ``order`` must be unique within a key, so that results do not depend on how
    equal rows happen to be placed.  The rows are read once to find large keys and
    again to scan them; ``settle`` writes them to the checkpoint folder first, for
    rows that took joins or aggregations to make.  ``within`` is a scan over the same rows by the same
    or fewer keys: if it has no large key, this one has none either and need not count.
    """

    def __init__(self, df: DataFrame, keys: list[str], order: list[str], settle: bool = False, within: Ordered | None = None):
        self.keys, self.order = list(keys), list(order)
        if settle:
            settings.ensure_checkpoint_dir(df.sparkSession)
            df = df.checkpoint()
        hot, cap = (None, 0) if within is not None and not within.split else hot_keys(df, self.keys)
        self.split = hot is not None
        self.df = self._cut(df, hot, cap) if self.split else df.withColumn(BLOCK, F.lit(0))

    def _cut(self, df: DataFrame, hot: DataFrame, cap: int) -> DataFrame:
        spark, place = df.sparkSession, F.struct(*self.order)
        names = [f"_k{i}" for i in range(len(self.keys))]
        hot = hot.toDF(*names) if names else hot
        same = null_safe([F.col(k) for k in self.keys], [F.col(n) for n in names])
        every = max(1, cap // SAMPLES_PER_BLOCK)
        sample = df.join(F.broadcast(hot), same).filter(
            F.pmod(F.xxhash64(*self.order), F.lit(every)) == 0
        ).select(*names, place.alias("_at"))
        ranked = sample.withColumn("_r", F.row_number().over(W.partitionBy(*names).orderBy("_at")))
        cuts = ranked.filter(F.col("_r") % SAMPLES_PER_BLOCK == 0).groupBy(*names).agg(
            F.sort_array(F.collect_list("_at")).alias("_cuts")
        )
        rows = cuts.collect()  # about total / cap places
        table = spark.createDataFrame(rows, cuts.schema)
        longest = max((len(r["_cuts"]) for r in rows), default=0)
        steps, step = [], 1
        while step <= longest:
            steps.insert(0, step)
            step *= 2
        block = F.lit(1)
        if steps:  # binary search: number of cuts at or before this row, plus one
            block = F.aggregate(
                F.array(*[F.lit(s) for s in steps]),
                F.lit(1),
                lambda low, s: F.when(F.get(F.col("_cuts"), low + s - 2) <= place, low + s).otherwise(low),
            )
        marked = F.broadcast(hot.withColumn("_hot", F.lit(True)))
        return (
            df.join(marked, same, "left").drop(*names, "_all")
            .join(F.broadcast(table), same, "left").drop(*names)
            .withColumn(BLOCK, F.when(F.col("_hot").isNull(), 0).otherwise(
                F.when(F.col("_cuts").isNull(), 1).otherwise(block)))
            .drop("_hot", "_cuts")
        )

    def _window(self, reverse: bool):
        order = [F.col(c).desc() if reverse else F.col(c).asc() for c in self.order]
        return W.partitionBy(*self.keys, BLOCK).orderBy(*order)

    def _local(self, s: Scan) -> Column:
        if s.kind == "total":
            return _AGG[s.how](s.value).over(W.partitionBy(*self.keys, BLOCK))
        if s.kind == "shift":
            return F.lag(s.value).over(self._window(s.reverse))
        frame = self._window(s.reverse).rowsBetween(W.unboundedPreceding, -1 if s.before else 0)
        return _AGG[s.how](s.value).over(frame)

    def scan(self, **scans: Scan) -> Ordered:
        """Add one column per scan; all share one sort per direction."""
        df = self.df
        for name, s in scans.items():
            df = df.withColumn(name, self._local(s))
        if self.split:
            df = self._carry(df, scans)
        out = object.__new__(Ordered)
        out.keys, out.order, out.split, out.df = self.keys, self.order, self.split, df
        return out

    def _carry(self, df: DataFrame, scans: dict[str, Scan]) -> DataFrame:
        place = F.struct(*self.order)
        pieces = []
        for name, s in scans.items():
            if s.kind == "shift":
                pick = F.min_by if s.reverse else F.max_by
                pieces.append(pick(F.struct(s.value.alias("v")), place).alias(f"_s_{name}"))
            else:
                pieces.append(_AGG[s.how](s.value).alias(f"_s_{name}"))
            if s.kind == "shift":
                df = df.withColumn(f"_f_{name}", F.row_number().over(self._window(s.reverse)) == 1)
        names = [f"_k{i}" for i in range(len(self.keys))]
        blocks = self.df.filter(F.col(BLOCK) > 0).groupBy(
            *[F.col(k).alias(n) for k, n in zip(self.keys, names)], F.col(BLOCK).alias("_b")
        ).agg(*pieces)
        carried = []
        for name, s in scans.items():
            along = W.partitionBy(*names).orderBy(F.col("_b").desc() if s.reverse else F.col("_b").asc())
            if s.kind == "total":
                column = _AGG[s.how](f"_s_{name}").over(W.partitionBy(*names))
            elif s.kind == "shift":
                column = F.lag(f"_s_{name}").over(along)["v"]
            else:
                column = _AGG[s.how](f"_s_{name}").over(along.rowsBetween(W.unboundedPreceding, -1))
            carried.append(column.alias(f"_c_{name}"))
        found = blocks.select(*names, "_b", *carried)
        # a few rows per block, written once, so that a chain of scans reads its input once per scan
        settings.ensure_checkpoint_dir(df.sparkSession)
        carry = found.checkpoint()
        keys = [F.col(k) for k in self.keys] + [F.col(BLOCK)]
        small = carry.count() <= settings.limit(df.sparkSession, settings.BROADCAST_ROWS)
        df = df.join(F.broadcast(carry) if small else carry, null_safe(keys, [F.col(n) for n in names + ["_b"]]), "left")
        for name, s in scans.items():
            mine, past = F.col(name), F.col(f"_c_{name}")
            if s.kind == "total":
                both = F.coalesce(past, mine)
            elif s.kind == "shift":
                both = F.when(F.col(f"_f_{name}") & (F.col(BLOCK) > 0), past).otherwise(mine)
            elif s.how == "sum":
                both = F.when(past.isNull(), mine).otherwise(past + F.coalesce(mine, F.lit(0)))
            else:
                both = (F.greatest if s.how == "max" else F.least)(mine, past)
            df = df.withColumn(name, both)
        return df.drop(*names, "_b", *[f"_c_{n}" for n in scans], *[f"_f_{n}" for n in scans])

    def rows(self) -> DataFrame:
        return self.df.drop(BLOCK)


def runs(ordered: Ordered, item: str) -> Ordered:
    """Number the stretches of equal neighbouring items: column ``run``."""
    o = ordered.scan(_prev=shift(item), _place=position())
    fresh = (F.col("_place") == 1) | ~F.col(item).eqNullSafe(F.col("_prev"))
    out = o.scan(run=running("sum", F.when(fresh, 1).otherwise(0).cast("bigint")))
    out.df = out.df.drop("_prev", "_place")
    return out


def ranked(df: DataFrame, keys: list[str], value: str, tie: str) -> Ordered:
    """Largest ``value`` first, missing ones last: columns ``row_number``, ``rank`` and ``size``."""
    df = df.withColumn("_neg", -F.col(value)).withColumn("_none", F.col(value).isNull())
    o = Ordered(df, keys, ["_none", "_neg", tie]).scan(
        row_number=position(), _last=shift("_neg"), size=total("sum", F.lit(1).cast("bigint"))
    )
    first = F.when(~F.col("_neg").eqNullSafe(F.col("_last")) | (F.col("row_number") == 1), F.col("row_number"))
    o = o.scan(rank=running("max", first))
    o.df = o.df.drop("_neg", "_last", "_none")
    return o


def ntile(tiles: int) -> Column:
    """Tile of a row from its ``row_number`` and the ``size`` of its group."""
    small = F.floor(F.col("size") / tiles)
    wide = F.col("size") - small * tiles  # tiles that hold one row more
    rn = F.col("row_number")
    return F.when(
        rn <= wide * (small + 1), F.ceil(rn / (small + 1))
    ).otherwise(wide + F.ceil((rn - wide * (small + 1)) / F.greatest(small, F.lit(1)))).cast("bigint")
