"""Passages of a benchmark inside documents, in DataFrame operations only.

Every benchmark item is compared with windows of documents that are as long as itself:

1. Anchors.  At a similarity of ``t`` a window lacks at most ``(1 - t) * W`` of the item's W
   shingles, so it holds one of any ``floor((1 - t) * W) + 1`` of them.  The rarest that many
   per item are joined to the rolling shingle hashes of all documents; every match marks
   the stretch of the document in which windows with it can lie.  Nothing is lost, and a
   phrase that many items share marks nothing.
2. Item-sized windows.  Within a stretch only windows that begin at a shingle of the item (or at
   the end of the document) can be the best ones; those with enough shingles of the item
   get a SimHash fingerprint, each shingle voting as often as it occurs.
3. Multi-index Hamming blocks.  A fingerprint is cut into ``BLOCKS`` blocks.  Two fingerprints
   within ``2 * BLOCKS - 1`` bits differ by at most one bit in some block, so items are indexed under
   each block's value and under all values one bit away, by number of words; windows look their blocks
   up and get all items within that radius.
4. Exact check.  The weighted Jaccard similarity of the two bags of shingles (weight: the number of
   occurrences) must reach ``t``.

A large benchmark is taken in blocks of items, each small enough to be broadcast.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quern import settings
from quern.llm.common import semi_or_anti, text_column

#: words in a shingle, similarity, blocks of a fingerprint (hence a radius of 2 * BLOCKS - 1 bits)
SHINGLE, SIMILARITY, BLOCKS = 5, 0.8, 10
#: shingles of the items that are broadcast at once
BLOCK_SHINGLES = 500_000


def words_of(text: Column) -> Column:
    """Letters and digits in lower case; everything else separates."""
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def shingles(words: str, k: int) -> Column:
    """Hash of every ``k`` consecutive words of an array column."""
    parts = ", ".join(f"get({words}, i + {j})" for j in range(k))
    return F.expr(f"CASE WHEN size({words}) >= {k} THEN transform(sequence(0, size({words}) - {k}), i -> xxhash64({parts}))"
                  " ELSE cast(array() AS array<bigint>) END")


def fingerprint(grams: str) -> Column:
    """SimHash of an array of hashes: bits j and j + 32 are counted together, in the halves of one number."""
    return F.expr(
        f"aggregate(transform(transform(sequence(0, 31), j -> aggregate({grams}, 0L, "
        "(a, g) -> a + (shiftrightunsigned(g, j) & 4294967297L))), (a, j) -> "
        f"shiftleft(if(2 * (a & 4294967295L) > size({grams}), 1L, 0L), j) | "
        f"shiftleft(if(2 * shiftrightunsigned(a, 32) > size({grams}), 1L, 0L), j + 32)), 0L, (x, y) -> x | y)")


def occurrences(grams: str) -> Column:
    """The bag of an array as a set: every hash together with the number of equal ones before it."""
    return F.expr(f"transform({grams}, (g, i) -> xxhash64(g, size(filter(slice({grams}, 1, i), x -> x = g))))")


def cuts() -> list[tuple[int, int]]:
    """(shift, width) of the blocks of a fingerprint."""
    at = [64 * i // BLOCKS for i in range(BLOCKS + 1)]
    return [(a, b - a) for a, b in zip(at, at[1:])]


def block(fp: str, shift: int, width: int) -> str:
    return f"(shiftrightunsigned({fp}, {shift}) & {(1 << width) - 1}L)"


def prepared(benchmark: DataFrame, shingle: int) -> DataFrame:
    """Items with words: item (a number), item_id, m words, k, grams, bag, item_fp; equal rows once."""
    items = benchmark.select(benchmark["item_id"], words_of(text_column(benchmark)).alias("words")).distinct().filter(
        F.size("words") > 0).withColumn("item", F.monotonically_increasing_id()).checkpoint()
    m = F.size("words")
    items = items.select("item", "item_id", "words", m.alias("m"), F.least(m, F.lit(shingle)).alias("k"))
    of = reduce(lambda rest, k: F.when(F.col("k") == k, shingles("words", k)).otherwise(rest),
                range(1, shingle), shingles("words", shingle))
    items = items.withColumn("grams", of)
    return items.select("item", "item_id", "m", "k", "grams", occurrences("grams").alias("bag"),
                        fingerprint("grams").alias("item_fp")).checkpoint()


def anchors(items: DataFrame, similarity: float) -> DataFrame:
    """(g, item, at, m, k): the rarest shingles of every item, as many as a similar window may lack and one more."""
    placed = items.select("item", "m", "k", F.size("grams").alias("w"), F.posexplode_outer("grams").alias("at", "g"))
    held = placed.select("g", "item").distinct()
    rarity = held.groupBy("g").agg(F.count(F.lit(1)).alias("df"))
    lacking = F.floor((1 - similarity) * F.col("w") + 1e-9)
    ranked = placed.select("item", "g", "w").distinct().join(rarity, "g").withColumn(
        "r", F.row_number().over(W.partitionBy("item").orderBy("df", "g")))
    return placed.join(ranked.filter(F.col("r") <= lacking + 1).select("item", "g"), ["item", "g"]).select(
        "g", "item", "at", "m", "k")


def stretches(docs: DataFrame, found: DataFrame, k: int) -> DataFrame:
    """(id, h, item, base, grams): part of a document where windows with an anchor of the item can lie."""
    text = text_column(docs)
    rows = docs.select(docs["doc_id"].alias("id"), F.xxhash64(text).alias("h"), words_of(text).alias("words"))
    hashes = rows.select("id", "h", shingles("words", k).alias("all"))
    # outer: for an inner explode Spark would first filter by the size of `all`, and make all hashes twice
    hits = hashes.select("id", "h", "all", F.posexplode_outer("all").alias("p", "g")).join(F.broadcast(found), "g")
    diagonal = F.col("p") - F.col("at")
    w = F.col("m") - k + 1
    base = F.greatest(diagonal - w + 1, F.lit(0))
    marked = hits.select("id", "h", "item", "m", "k", diagonal.alias("diagonal"), base.alias("base"),
                         F.slice("all", base + 1, diagonal + 2 * w - base).alias("part"),
                         F.size("all").alias("n"))
    return marked.dropDuplicates(["id", "h", "item", "diagonal"])


def contaminated(docs: DataFrame, benchmark: DataFrame, shingle: int = SHINGLE,
                 similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, item_id, start, n_words, similarity, bits): the best window of a document for an item, if similar enough.

    start counts words from 0; n_words is the item's length (the document's, if that is shorter);
    bits is the distance of the fingerprints.  Words are runs of letters and digits in any case.
    Of equally similar windows that begin at a shingle of the item the first one counts.  Null and empty texts hold nothing; an item without words is
    never found, one with fewer than ``shingle`` words is one shingle.  Documents with the same id
    and text, and items with the same id and words, count once; a null id is an id like any other.
    Texts are read whole, other columns are not looked at, and empty tables give no rows.
    """
    settings.ensure_checkpoint_dir(docs.sparkSession)
    items = prepared(benchmark, shingle)
    sizes = {r["k"]: r["n"] for r in items.groupBy("k").agg(F.sum(F.size("grams")).alias("n")).collect()}
    parts = []
    for k in sorted(sizes):  # at most `shingle` values, most often one
        blocks = -(-sizes[k] // BLOCK_SHINGLES)
        for b in range(blocks):
            own = items.filter((F.col("k") == k) & (F.pmod(F.xxhash64("item"), F.lit(blocks)) == b))
            parts.append(verified(docs, own, k, similarity))
    if not parts:
        return empty(docs, benchmark)
    best = F.max(F.struct("similarity", (-F.col("start")).alias("s"), "n_words", "bits")).alias("best")
    named = reduce(DataFrame.unionByName, parts).groupBy("id", "h", "item", "item_id").agg(best)
    return named.select(F.col("id").alias("doc_id"), "h", "item_id", (-F.col("best.s")).alias("start"),
                        "best.n_words", "best.similarity", "best.bits")


def empty(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return docs.select("doc_id").limit(0).join(benchmark.select("item_id").limit(0), F.lit(False)).select(
        "doc_id", F.lit(0).cast("bigint").alias("h"), "item_id", F.lit(0).alias("start"), F.lit(0).alias("n_words"),
        F.lit(0.0).alias("similarity"), F.lit(0).alias("bits"))


def verified(docs: DataFrame, items: DataFrame, k: int, similarity: float) -> DataFrame:
    """Windows and the items that they resemble, for one broadcast block of items with shingles of ``k`` words."""
    found = anchors(items, similarity).checkpoint()
    marked = stretches(docs, found, k).join(F.broadcast(items.select("item", "grams")), "item")
    w = "(m - k + 1)"
    hit = marked.withColumn("own", F.expr("transform(part, g -> if(array_contains(grams, g), 1, 0))"))
    # places in `part` where a window may begin: a shingle of the item, not beyond the last window of the document
    begins = F.expr(f"array_distinct(transform(filter(sequence(0, size(part) - 1), i -> own[i] = 1), "
                    f"i -> greatest(least(i, n - {w} - base), 0)))")
    enough = F.expr(f"filter(begins, i -> aggregate(slice(own, i + 1, {w}), 0, (a, x) -> a + x) >= {similarity} * {w} - 1e-9)")
    windows = hit.withColumn("begins", begins).withColumn("begins", enough).select(
        "id", "h", "m", "k", "base", "part", F.explode_outer("begins").alias("i")).filter("i IS NOT NULL").select(
        "id", "h", "m", "k", (F.col("base") + F.col("i")).alias("start"),
        F.expr(f"slice(part, i + 1, {w})").alias("window"))
    windows = windows.withColumn("fp", fingerprint("window"))

    places = cuts()
    probe = F.array(*[F.struct(F.lit(j).alias("j"), F.expr(block("fp", s, n)).alias("value")) for j, (s, n) in enumerate(places)])
    near = F.array(*[
        F.struct(F.lit(j).alias("j"), (F.expr(block("item_fp", s, n)).bitwiseXOR(F.lit(flip))).alias("value"))
        for j, (s, n) in enumerate(places) for flip in (0, *(1 << bit for bit in range(n)))])
    index = items.select("item", "m", "item_fp", F.explode(near).alias("x")).select("item", "m", "item_fp", "x.*")
    pairs = windows.select("id", "h", "m", "k", "start", "window", "fp", F.explode(probe).alias("x")).select(
        "id", "h", "m", "k", "start", "window", "fp", "x.*").join(F.broadcast(index), ["m", "j", "value"])
    # a pair meets in every block that differs by at most one bit: keep the first of them
    first = reduce(lambda rest, jc: F.when(
        F.expr(f"bit_count({block('fp', *jc[1])} ^ {block('item_fp', *jc[1])})") <= 1, F.lit(jc[0])).otherwise(rest),
        reversed(list(enumerate(places))), F.lit(-1))
    bits = F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp")))
    pairs = pairs.filter((F.col("j") == first) & (bits <= 2 * BLOCKS - 1)).withColumn("bits", bits)
    checked = pairs.join(F.broadcast(items.select("item", "item_id", "bag")), "item").withColumn(
        "both", F.size(F.array_intersect("bag", occurrences("window"))))
    alike = F.col("both") / (F.size("bag") + F.size("window") - F.col("both"))
    return checked.withColumn("similarity", alike).filter(F.col("similarity") >= similarity).select(
        "id", "h", "item", "item_id", "start", (F.size("window") + F.col("k") - 1).alias("n_words"), "similarity", "bits")


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """``docs`` without the documents that hold a passage of the benchmark; all columns stay."""
    keys = contaminated(docs, benchmark, **how).select(F.col("doc_id").alias("id"), "h").distinct().checkpoint()
    return semi_or_anti(docs, keys, "left_anti")
