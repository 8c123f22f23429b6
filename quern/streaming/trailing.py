"""Streaming jobs: trailing counts per key, and a running top-N table."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from quern import settings
from quern.operators.ordered import hot_keys

HOUR = 3_600_000_000
#: files of a backlog that one micro-batch takes
FILES = 256
#: state store that keeps lists and timers per key
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_parquet(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """A file stream over the Parquet files of one table, a single file or a folder of them."""
    path = f"{directory}/{name}.parquet"
    schema = spark.read.parquet(path).schema
    # a pattern that only this path matches: a plain path would have to be a folder
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", FILES).parquet(f"{path[:-1]}[{path[-1]}]")


def disorder(spark: SparkSession, directory: str, name: str, time: str, least: int = 600_000) -> int:
    """How many milliseconds late an event of a stored table can come when its files are read one after the other, ``least`` ms at least.

    A stream takes files by their time of writing, and those of one time in any order.  An event comes after events of
    files that are not younger than its own, so it is late by at most the newest of these less its own time.
    """
    table = spark.read.parquet(f"{directory}/{name}.parquet")
    rows = table.select(F.unix_micros(table[time].cast("timestamp")).alias("at"), F.col("_metadata.file_modification_time").alias("written"))
    files = rows.groupBy("written").agg(F.min("at").alias("lo"), F.max("at").alias("hi"))  # at most one row per file
    newest = F.max("hi").over(W.orderBy("written"))
    late = files.select((newest - F.col("lo")).alias("late")).agg(F.max("late")).first()[0]
    return max(least, (late or 0) // 1000 + 1)


def busy_keys(spark: SparkSession, directory: str, name: str, key: str) -> list[int]:
    """Keys of a stored table with more rows than one task should hold."""
    hot, _ = hot_keys(spark.read.parquet(f"{directory}/{name}.parquet"), [key])
    return [] if hot is None else [r[0] for r in hot.collect() if r[0] is not None]  # a row per cap rows at most


class TrailingCount(StatefulProcessor):
    """Counts per key; the state is a list of the events that later ones may still have to count."""

    def __init__(self, window: int, late: int, bucket: int):
        self.window, self.late, self.bucket = window, late, bucket

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.events = handle.getListState("events", "at bigint, id bigint")

    def counts(self, at: np.ndarray) -> np.ndarray:
        return np.arange(1, len(at) + 1) - np.searchsorted(at, at - self.window, side="left")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows))
        old = np.array(list(self.events.get()), np.int64).reshape(-1, 2)
        fresh = np.stack([new["at"].to_numpy(np.int64), new["id"].to_numpy(np.int64)], axis=1)
        if len(old):
            fresh = fresh[fresh[:, 0] >= old[:, 0].max() - self.late * 1000]
        if not len(fresh):
            return
        both = np.concatenate((old, fresh))
        order = np.lexsort((both[:, 1], both[:, 0]))
        known = order < len(old)
        at, ids = both[order].T
        n, told = self.counts(at), np.zeros(len(at), np.int64)
        told[known] = self.counts(at[known])
        emit = n > told
        if key[1] is not None and key[1] >= 0:
            emit &= at // self.bucket == key[1]
        # what is older than this can neither be counted by an event that is not too late, nor have to count one
        newest = int(at[-1])
        live = fresh[fresh[:, 0] >= newest - self.late * 1000 - self.window]
        self.events.appendList([(int(a), int(i)) for a, i in live])
        step = self.late + self.window // 1000 + 1
        self.handle.registerTimer((newest // 1000 // step + 2) * step)
        yield pd.DataFrame({"k": key[0], "id": ids[emit], "n": n[emit]})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """The watermark has passed the newest event of some batch by more than the window: what lies before goes."""
        mark = timerValues.getCurrentWatermarkInMs() * 1000 - self.window
        held = list(self.events.get())
        live = [e for e in held if e[0] >= mark]
        if not live:
            self.events.clear()
        elif len(live) < len(held):
            self.events.put(live)
        return iter([])

    def close(self) -> None:
        pass


def trailing_counts(events: DataFrame, key: str, time: str, tie: str, window: int = 3_000_000, late: int = 600_000,
                    hot: Sequence[int] = (), bucket: int = HOUR) -> DataFrame:
    """(key, tie, n): for each event as it arrives, the key's events in the closed window before it.

    If an event comes after events that have to count it, these get another row; the largest n of an event is the last.

    ``time`` is a timestamp; ``window`` and ``bucket`` are microseconds, ``late`` are milliseconds.  There is one
    state per key, a list: new events are appended, and a timer takes away those that the watermark has passed by more than the
    window.  ``hot`` names keys that are too busy for one task: they have a state for each
    stretch (``bucket``) of time, and their events near the end of a stretch are also shown to the next one.
    Events later than ``late`` behind the newest one of their key, or behind the watermark, are dropped; for a stored table
    ``disorder`` gives a ``late`` that drops none.  Events without a time are left out.  The query needs the RocksDB state store,
    which ``replay`` sets.
    """
    at = F.unix_micros(time)
    k = F.col(key).cast("bigint")
    own = F.floor(at / bucket)
    near_end = at >= (own + 1) * bucket - window
    stretches = F.array_compact(F.array(own, F.when(near_end, own + 1)))
    whole = F.array(F.lit(-1).cast("bigint"))
    part = F.when(k.isin([int(x) for x in hot]), stretches).otherwise(whole) if len(hot) else whole
    rows = events.filter(F.col(time).isNotNull()).withWatermark(time, f"{late} milliseconds").select(
        k.alias("k"), F.col(time).alias("ts"), at.alias("at"), F.col(tie).cast("bigint").alias("id"), F.explode(part).alias("part"))
    out = rows.groupBy("k", "part").transformWithStateInPandas(
        TrailingCount(window, late, bucket), "k bigint, id bigint, n bigint", "Append", "EventTime")
    return out.select(F.col("k").alias(key), F.col("id").alias(tie), "n")


def replay(stream: DataFrame, name: str) -> DataFrame:
    """Run a stream over everything available now and return what it wrote."""
    spark = stream.sparkSession
    path = settings.scratch(spark, name)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)  # a query keeps what it was started with
    stream.writeStream.format("parquet").option("path", path).option(
        "checkpointLocation", path + "-state").outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(path)


def running_top(stream: DataFrame, order: list, columns: list[str], n: int, name: str) -> DataFrame:
    """The n first rows of a stream in the given order, kept in a small table.

    Each batch merges its own top n with the last version and writes a new one;
    a batch that is run again reads the same version and writes the same rows.
    """
    spark = stream.sparkSession
    path = settings.scratch(spark, name)

    def merge(batch: DataFrame, epoch: int) -> None:
        best = batch.select(*columns).orderBy(*order).limit(n)
        if epoch > 0:
            best = best.unionByName(spark.read.schema(best.schema).parquet(f"{path}/v{epoch - 1}")).orderBy(*order).limit(n)
        best.write.mode("overwrite").parquet(f"{path}/v{epoch}")

    stream.writeStream.foreachBatch(merge).option("checkpointLocation", path + "-state").trigger(
        availableNow=True).start().awaitTermination()
    # the last version is the one of the last batch that the stream's own log has as done
    done = spark.read.format("text").load(path + "-state/commits").select(
        F.regexp_extract(F.input_file_name(), r"(\d+)$", 1).cast("long").alias("batch")).agg(F.max("batch")).first()[0]
    if done is None:
        return spark.createDataFrame([], stream.select(*columns).schema)
    return spark.read.parquet(f"{path}/v{done}").orderBy(*order)
