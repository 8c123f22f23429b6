"""Small helpers that several operators of this package share."""

from __future__ import annotations

import ctypes
import gc
from contextlib import suppress
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.operators.joins import fits_broadcast

#: ASCII letters, for lower-casing A-Z and nothing else
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def release(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of finished steps: it does so for what the driver's garbage collection no longer finds."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def give_back() -> None:
    """Return what a worker's allocators keep to the system: workers stay, idle or with other work, beside an executor that needs the memory."""
    pa.default_memory_pool().release_unused()
    with suppress(AttributeError, OSError):  # glibc only
        ctypes.CDLL(None).malloc_trim(0)


def text_column(docs: DataFrame, column: str = "text") -> Column:
    """The text as a string, an empty one in place of a null."""
    return F.coalesce(docs[column].cast("string"), F.lit(""))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, made longer until no column of the table has it in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def semi_or_anti(docs: DataFrame, keys: DataFrame, how: str, column: str = "text") -> DataFrame:
    """Rows of ``docs`` whose (doc_id, text) is, or is not, among ``keys`` (id, h).

    ``keys`` is broadcast only after its size was checked; all columns of ``docs`` stay.
    """
    small = fits_broadcast(keys)
    same = docs["doc_id"].eqNullSafe(keys["id"]) & (F.xxhash64(text_column(docs, column)) == keys["h"])
    return docs.join(F.broadcast(keys) if small else keys, same, how)


#: equal rows that one task writes
COPIES = 100_000


def repeated(df: DataFrame, n: str, k: str, all_single: bool = False) -> DataFrame:
    """Every row ``n`` times, with ``k`` from 0 to n - 1; rows with many copies are dealt out in parts."""
    zero = F.lit(0).cast("bigint")
    single = df.filter(F.col(n) == 1).withColumn(k, zero)
    if all_single:
        return single.drop(n)
    step = lambda total, by: F.explode(F.sequence(zero, total - 1, F.lit(by).cast("bigint")))
    parts = df.filter(F.col(n) > 1).withColumn("_at", step(F.col(n), COPIES)).repartition(F.xxhash64(*df.columns, "_at"))
    many = parts.withColumn(k, step(F.least(F.col(n) - F.col("_at"), F.lit(COPIES)), 1))
    return single.unionByName(many.withColumn(k, F.col(k) + F.col("_at")).drop("_at")).drop(n)


def binaries(texts: pa.Array) -> list[bytes]:
    """UTF-8 bytes of every text, empty for a null."""
    return pc.fill_null(texts, "").cast(pa.large_binary()).to_pylist()


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts in a row, offsets): text i is bytes[offsets[i]:offsets[i + 1]]."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    held = texts.buffers()[2]
    data = np.frombuffer(held, np.uint8)[ends[0]:ends[-1]] if held is not None else np.zeros(0, np.uint8)
    return data, ends - ends[0]


def lowered(data: np.ndarray) -> np.ndarray:
    """The same bytes with A-Z in lower case."""
    return data + (((data >= 65) & (data <= 90)).astype(np.uint8) << np.uint8(5))


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, text) of all words ``[^\\x20\\x09-\\x0D]+``; no word spans two texts."""
    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    first = offsets[:-1][offsets[:-1] < offsets[1:]]
    before[first] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    last = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    after[last] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread all bits of 64-bit numbers over all bits."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every span of bytes: the span as digits of a number to an odd base."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(BASE, len(data)), out=sums[1:])
    shift = powers(INVERSE, len(data) + 1)
    return mixed((sums[ends] - sums[starts]) * shift[starts] + (ends - starts).astype(np.uint64))


def pieces_of(texts: pa.Array, most: int) -> list[pa.Array]:
    """The array in slices of about ``most`` bytes, at least one text each."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    group = np.cumsum(sizes) // max(most, 1)
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(texts)]
    return [texts.slice(a, b - a) for a, b in zip(cuts, cuts[1:]) if b > a]


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))
