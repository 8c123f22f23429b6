"""Phrase collocation mining by SON partitioning.

The texts are dealt at random into shards of equal size.  A phrase that occurs ``least`` times in all of them occurs in one of
k shards at least ``least`` / k times, rounded up.  So every shard is mined completely at this lowered support, level by
level (a phrase is frequent only if all its parts are), the phrases that are frequent in any shard are united, and these
alone are counted over all texts, exactly.

With a support that does not grow with the corpus there can be only a few shards (a shard with less than 1 / least of the
words would have to keep everything), so a shard is no task: it is a share of the documents that many tasks
read, and its counts are summed by a shuffle.  Tasks sum their own n-grams first and send one number each: hash, shard and count.
Two n-grams with one hash only make a candidate too many.
Which phrases go on to the next level is told by a filter of bits of bounded size, built in Spark.  It lets
through every frequent phrase and by chance some others; these cost time but change nothing, since the last count
is by the words themselves.  Once there are more than about ``bits / 8`` frequent phrases the filter prunes less and less;
raise ``bits`` with the memory of the workers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quern import settings
from quern.llm.common import lowered, mixed, pieces_of, raw, release, span_hashes, text_column
from quern.operators.joins import lookup

#: occurrences of a phrase, words in the longest one, phrases returned per language
LEAST, LONGEST, FIRST = 30, 4, 2000
#: a phrase is dropped if a longer one has so many of a hundred of its occurrences
INSIDE = 80
#: scores are millionths, twice
UNIT = 2_000_000
#: shares of the documents that are mined on their own, 31 at most
SHARDS = 3
#: bits of the shard and of the count in the number that stands for an n-gram; 48 bits of hash lie above them
SHARD_BITS, COUNT_BITS = 5, 10
#: most bits of the filter, and bits per phrase while there are few; every phrase sets up to PROBES of them, all in one word
BITS, PER_PHRASE, PROBES = 1 << 28, 16, 4
#: bytes of text that are worked on at once, and n-grams that a task gathers before it sends their sums
SLICE, GATHERED = 4 << 20, 4_000_000

#: a word; bytes that end a piece, and bytes that end a word
WORD = r"[^\x20\x09.,;:!?\x0A-\x0D]+"
ENDS = np.isin(np.arange(256), [*b".,;:!?", *range(10, 14)])
GAPS = ENDS | np.isin(np.arange(256), [32, 9])


class Words:
    """The words of some texts: ``ids`` numbers into ``names``, ``hashes`` and ``group`` per word, ``joined``: same piece as the next word."""

    def __init__(self, texts: pa.Array, group: np.ndarray):
        data, offsets = raw(texts)
        data = lowered(data)
        inside = ~GAPS[data]
        starts, ends, owner = spans(inside, offsets)
        kept = data[inside]
        sizes = np.concatenate(([0], np.cumsum(ends - starts)))
        found = pa.Array.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(sizes.astype(np.int64)), pa.py_buffer(kept)]).dictionary_encode()
        self.ids = found.indices.to_numpy().astype(np.int64)
        self.names = found.dictionary
        held, at = raw(pa.LargeStringArray.from_buffers(len(self.names), *self.names.buffers()[1:3]))
        self.hashes = span_hashes(held, at[:-1], at[1:])[self.ids] if len(self.ids) else np.zeros(0, np.uint64)
        self.group = group[owner]
        piece = np.cumsum(ENDS[data], dtype=np.int64)[starts] if len(starts) else starts
        self.joined = (piece[1:] == piece[:-1]) & (owner[1:] == owner[:-1])

    def places(self, n: int) -> np.ndarray:
        """Words at which an n-gram begins."""
        places = np.arange(max(len(self.ids) - n + 1, 0))
        for k in range(1, n):
            places = places[self.joined[places + k - 1]]
        return places

    def keys(self, places: np.ndarray, n: int, langs: np.ndarray) -> np.ndarray:
        """Hashes (48 bits) of the n-grams at the given places; ``langs``: a number per word for its language."""
        key = mixed(self.hashes[places] ^ langs[places])
        for k in range(1, n):
            key = mixed(key * np.uint64(31) + self.hashes[places + k])
        return key >> np.uint64(16)


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, text) of the runs of true; no run spans two texts."""
    filled = offsets[:-1] < offsets[1:]
    before, after = np.zeros(len(inside), bool), np.zeros(len(inside), bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    before[offsets[:-1][filled]] = False
    after[offsets[1:][filled] - 1] = False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def name_hash(names: list[str]) -> np.ndarray:
    """A number per language."""
    held = [n.encode() for n in names]
    at = np.concatenate(([0], np.cumsum([len(h) for h in held]))).astype(np.int64)
    return span_hashes(np.frombuffer(b"".join(held), np.uint8), at[:-1], at[1:]) if names else np.zeros(0, np.uint64)


# --- the filter ----------------------------------------------------------------------------------------


def probes(keys: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(place of a key's word in a filter of 2^x words, its bits in the word)."""
    first, second = mixed(keys), mixed(keys ^ np.uint64(0xC2B2AE3D27D4EB4F))
    bits = np.zeros(len(keys), np.uint64)
    for i in range(PROBES):
        bits |= np.uint64(1) << ((second >> np.uint64(6 * i)) & np.uint64(63))
    return (first & np.uint64(words - 1)).astype(np.int64), bits


def passes(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    place, bits = probes(keys, len(table))
    return table[place] & bits == bits


def filter_of(keys: DataFrame, most: int) -> np.ndarray:
    """Words of bits; every key has its own set.  At most ``most`` bits, whatever the number of keys."""
    words = 1 << 10
    count = keys.count()
    while 64 * words < min(most, PER_PHRASE * count):
        words *= 2

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place, bits = probes(batch.column(0).to_numpy().view(np.uint64), words)
            yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(bits.view(np.int64))], ["at", "bits"])

    held = keys.mapInArrow(placed, "at long, bits long").groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
    table = np.zeros(words, np.int64)
    table[held["at"].to_numpy()] = held["bits"].to_numpy()
    return table.view(np.uint64)


# --- mining ------------------------------------------------------------------------------------------


def read_words(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Words, list[tuple]]]:
    """The words of (lang, shard, text) rows slice by slice, and the (lang, shard) that their groups stand for."""
    for batch in batches:
        at = 0
        for texts in pieces_of(batch.column(2), SLICE):
            own = batch.slice(at, len(texts))
            at += len(texts)
            pairs = list(zip(own.column(0).to_pylist(), own.column(1).to_pylist()))
            names = sorted(set(pairs))
            number = {p: i for i, p in enumerate(names)}
            yield Words(texts, np.array([number[p] for p in pairs], np.int64)), names


def mined(rows: DataFrame, lengths: list[int], frequent: np.ndarray | None, asked: int) -> DataFrame:
    """(key): n-grams of the given lengths, with their shard, that occur in it as often as asked.

    n-grams that have a part of fewer words, two at most, which is not ``frequent`` in the shard are left out.
    """
    given = rows.sparkSession.sparkContext.broadcast(frequent)
    most = (1 << COUNT_BITS) - 1

    def sums(parts: list[np.ndarray]) -> pa.RecordBatch:
        keys, counts = np.unique(np.concatenate(parts), return_counts=True)
        times = -(-counts // most)  # a larger count takes several rows
        last = counts - (times - 1) * most
        out = np.repeat(keys << np.uint64(COUNT_BITS), times) | np.uint64(most)
        ends = np.cumsum(times) - 1
        out[ends] = (keys << np.uint64(COUNT_BITS)) | last.astype(np.uint64)
        return pa.RecordBatch.from_arrays([pa.array(out.view(np.int64))], ["k"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered, size = [], 0
        for words, names in read_words(batches):
            langs = name_hash([lang for lang, _ in names])[words.group]
            shards = np.array([shard for _, shard in names], np.uint64)[words.group]
            keyed = lambda places, n: (words.keys(places, n, langs) << np.uint64(SHARD_BITS)) | shards[places]  # noqa: B023, E731
            ok = []
            for n in range(1, min(max(lengths), 3)) if given.value is not None else ():
                places = words.places(n)
                ok.append(np.zeros(len(words.ids), bool))
                ok[-1][places[passes(given.value, keyed(places, n))]] = True
            for n in lengths:
                places = words.places(n)
                gathered.append(keyed(places[frequent_parts(places, n, ok)], n))
                size += len(gathered[-1])
            if size >= GATHERED:
                yield sums(gathered)
                gathered, size = [], 0
        if size:
            yield sums(gathered)

    # the tasks have summed already: one exchange of these numbers, and no second sum before it
    key = F.shiftright("k", COUNT_BITS)
    found = rows.mapInArrow(work, "k long").repartition(key).groupBy(key.alias("key")).agg(
        F.sum(F.col("k").bitwiseAND(F.lit(most))).alias("c"))
    return found.filter(F.col("c") >= asked).select("key")


def frequent_parts(places: np.ndarray, n: int, ok: list[np.ndarray]) -> np.ndarray:
    """Whether all parts of an n-gram are frequent; ``ok``: for 1, 2 ... words, whether the phrase that begins at a word is."""
    good = np.ones(len(places), bool)
    for size, found in enumerate(ok, 1):
        if size < n:
            for k in range(n - size + 1):
                good &= found[places + k]
    return good


def candidates(rows: DataFrame, asked: int, longest: int, bits: int) -> np.ndarray:
    """Filter of all phrases, of one word too, that are frequent in some shard."""
    every = None
    for lengths in ([1], [2], list(range(3, longest + 1))):
        if lengths and lengths[0] <= longest:
            found = mined(rows, lengths, None if every is None else filter_of(every, bits), asked).checkpoint()
            every = found if every is None else every.unionByName(found)
            release(rows.sparkSession)  # else the shuffles of all levels lie on the disks at once
    return filter_of(every.select(F.shiftright("key", SHARD_BITS).alias("key")), bits)


def counted(rows: DataFrame, frequent: np.ndarray, longest: int) -> DataFrame:
    """(lang, phrase, words, f): all phrases that pass the filter, counted by their words over all texts."""
    given = rows.sparkSession.sparkContext.broadcast(frequent)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words, names in read_words(batches):
            langs = sorted({lang for lang, _ in names})
            of = np.array([langs.index(lang) for lang, _ in names], np.int64)[words.group]
            hashes = name_hash(langs)[of]
            ok: list[np.ndarray] = []
            for n in range(1, longest + 1):
                places = words.places(n)
                places = places[frequent_parts(places, n, ok)]
                places = places[passes(given.value, words.keys(places, n, hashes))]
                ok.append(np.zeros(len(words.ids), bool))
                ok[-1][places] = True
                yield from exact(words, places, n, of, langs)

    summed = rows.mapInArrow(work, "lang string, phrase string, f long").groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
    return summed.withColumn("words", F.length("phrase") - F.length(F.replace("phrase", F.lit(" "))) + 1)


def exact(words: Words, places: np.ndarray, n: int, of: np.ndarray, langs: list[str]) -> Iterator[pa.RecordBatch]:
    """Sums of the n-grams at the given places by the numbers of their words: no hash decides which are equal."""
    if not len(places):
        return
    number = of[places]
    for k in range(n):  # after each step equal numbers mean equal beginnings
        number = np.unique(number * len(words.names) + words.ids[places + k], return_inverse=True)[1]
    _, first, counts = np.unique(number, return_index=True, return_counts=True)
    at = places[first]
    names = words.names.cast(pa.large_string())
    parts = [names.take(pa.array(words.ids[at + k])) for k in range(n)]
    phrase = pc.binary_join_element_wise(*parts, pa.scalar(" ", pa.large_string())) if n > 1 else parts[0]
    yield pa.RecordBatch.from_arrays([
        pa.array(langs, pa.string()).take(pa.array(of[at])), phrase.cast(pa.string()), pa.array(counts)], ["lang", "phrase", "f"])


def ngram_counts(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, shards: int = SHARDS, bits: int = BITS) -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, words, f) of all phrases with f >= least, of one word too; (lang, n) with the words of each language)."""
    settings.ensure_checkpoint_dir(docs.sparkSession)
    text = text_column(docs)
    rows = docs.select(F.coalesce(docs["lang"].cast("string"), F.lit("und")).alias("lang"),
                       F.pmod(F.xxhash64(docs["doc_id"], text), F.lit(shards)).cast("int").alias("shard"), text.alias("text"))
    frequent = candidates(rows, -(-least // shards), longest, bits)
    found = counted(rows, frequent, longest).filter(F.col("f") >= least).checkpoint()
    release(docs.sparkSession)
    words = F.length(F.translate(F.regexp_replace("text", WORD, "x"), " \t.,;:!?\n\x0b\x0c\r", ""))  # one letter per word is left
    return found, rows.groupBy("lang").agg(F.sum(words.cast("bigint")).alias("n"))


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, first: int = FIRST, **how) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``first`` best phrases of 2 to ``longest`` words of every language.

    A-Z are lower-cased, texts are cut into pieces at ``.,;:!?`` and line ends and these into words at spaces and tabs.  ``a`` counts
    a phrase, ``l`` and ``r`` its two parts at the cut with the lowest score, floor(2,000,000 a / (l + r)), of several such cuts
    the first; ``n`` are all words of the language.  Phrases with a < least do not count, nor those that lie inside a longer one with 80 % of
    their occurrences or more.  Ranks go by score, a and the phrase in order of UTF-8 bytes.

    A null text is an empty one and a null lang is ``und``; the id only deals documents into shards and may be null;
    repeated rows count as often as they come; texts are read whole; other columns play no part; an empty
    table gives no rows.
    """
    found, totals = ngram_counts(docs, least, longest, **how)
    phrases = found.filter(F.col("words") > 1)
    cut = F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")
    cuts = phrases.select("lang", "phrase", F.col("f").alias("a"), cut).select(
        "*", F.expr("substring_index(phrase, ' ', k)").alias("left"))
    cuts = cuts.withColumn("right", F.expr("substring(phrase, length(left) + 2)"))
    part = lambda name: found.select(F.col("lang").alias("_lang"), F.col("phrase").alias("_part"), F.col("f").alias(name))
    both = lookup(cuts, part("l"), [("lang", "_lang"), ("left", "_part")]).drop("_lang", "_part")
    both = lookup(both, part("r"), [("lang", "_lang"), ("right", "_part")])
    exact_ratio = F.expr(f"cast(a as decimal(20,0)) * {UNIT}BD div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    lowest = both.groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.min(F.struct(exact_ratio.alias("score"), "k", "l", "r")).alias("cut"))
    # what lies inside a longer phrase: parts of 2 words and more, and the most that any longer one of them has
    inner = phrases.filter(F.col("words") > 2).select("lang", "words", "f", F.split("phrase", " ").alias("w")).select(
        "lang", "f", F.explode(F.expr("""
            flatten(transform(sequence(2, words - 1), size -> transform(sequence(1, words - size + 1), at -> array_join(slice(w, at, size), ' '))))""")).alias("inner"))
    covered = inner.groupBy(F.col("lang").alias("_lang"), F.col("inner").alias("_part")).agg(F.max("f").alias("longer"))
    left = lookup(lowest, covered, [("lang", "_lang"), ("phrase", "_part")], "left").filter(
        F.col("longer").isNull() | (F.col("longer").cast("decimal(20,0)") * 100 < F.col("a").cast("decimal(20,0)") * INSIDE))
    rank = F.row_number().over(W.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase"))
    best = left.select("lang", "phrase", "a", "cut", rank.alias("rank")).filter(F.col("rank") <= first)
    named = lookup(best, totals.withColumnRenamed("lang", "_lang"), [("lang", "_lang")])
    return named.select("lang", "rank", "phrase", "a", "cut.l", "cut.r", "n", F.col("cut.score").cast("bigint").alias("score"))
