"""Mixing sources to target weights: how many words of every document go into the mix.

Every document draws a hash-random key.  Within a source the documents are sorted by that key in ranges of
it, prefix sums of the word counts run through the ranges, and the source is cut at its exact budget: all
documents are taken as often as the budget holds the whole source (epochs), then those before the cut once
more, and the document at the cut gives just the words that are still missing.

The draw depends on the id and the text only, so reruns and lost executors take the same words.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quern import settings
from quern.llm.common import repeated, text_column
from quern.operators.joins import lookup
from quern.operators.ordered import Ordered, position, running, total

#: shares of the sources in the order of their names, over and over
WEIGHTS = (3, 1, 2)
#: size of the mix in parts of all words (numerator, denominator), and how often a source may be used up
SHARE, LIMIT = (3, 2), 2
#: documents of a source that are sorted as one range
RANGE_ROWS = 1 << 12
#: first characters of the draw (hexadecimal) from which its range is told: 32 bits
DIGITS = 8
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of words ``[^\\x20\\x09-\\x0D]+``: every word becomes one letter, the rest goes."""
    return F.length(F.translate(F.regexp_replace(text, WORD, "x"), " \t\n\x0b\x0c\r", "")).cast("bigint")


def draw(seed: int, doc_id: Column, text: Column) -> Column:
    """Random key of a document, the same in every run."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(doc_id.cast("string"), F.lit("")), text).cast("binary"))


def targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, share: tuple[int, int] = SHARE, limit: int = LIMIT) -> DataFrame:
    """Add ``target`` (double) and ``budget`` (whole words) to (key, source, source_size): each source's part of the mix.

    Sources are weighted in the order of their names, a null name last.  A source that would have to give more than
    ``limit`` times its size stops there and the rest is shared out by weight among the others.  Sources that stop are
    those with the least size for their weight, so they are found by running sums in that order.
    """
    whole = lambda c: c.cast("decimal(19,0)")
    named = Ordered(sources.withColumn("none", F.col("source").isNull()), [], ["none", "source"]).scan(place=position()).rows()
    cycle = F.array(*[F.lit(w).cast("bigint") for w in weights])
    weighed = named.withColumn("weight", F.get(cycle, F.pmod(F.col("place") - 1, F.lit(len(weights))).cast("int")))
    weighed = weighed.withColumn("ratio", F.col("source_size") / F.col("weight"))
    o = Ordered(weighed, [], ["ratio", "place"], settle=True).scan(
        at=position(), below=running("sum", "source_size", before=True), light=running("sum", "weight", before=True),
        words=total("sum", "source_size"), weights=total("sum", "weight"))
    left = o.rows().withColumn("open", F.lit(share[0]) * F.col("words") - F.lit(share[1] * limit) * F.coalesce("below", F.lit(0)))
    left = left.withColumn("rest", F.lit(share[1]) * (F.col("weights") - F.coalesce("light", F.lit(0)))).checkpoint()
    fits = whole(F.lit(limit) * F.col("source_size")) * whole(F.col("rest")) >= whole(F.col("open")) * whole(F.col("weight"))
    level = left.filter(fits).agg(F.min(F.struct("at", "open", "rest")).alias("level"))  # one row
    shared = left.crossJoin(F.broadcast(level))
    stops = F.col("level").isNull() | (F.col("at") < F.col("level.at"))
    given = F.col("level.open") * F.col("weight")
    most = F.lit(limit) * F.col("source_size")
    return shared.select(
        "key", "source_size", "lines",
        F.when(stops, most.cast("double")).otherwise(given / F.col("level.rest")).alias("target"),
        F.when(stops, most).otherwise(F.expr("level.open * weight div level.rest")).alias("budget"))


def plan(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: tuple[int, int] = SHARE, limit: int = LIMIT,
         seed: int = 11, range_rows: int = RANGE_ROWS) -> DataFrame:
    """One line per distinct (source, id, text): size, source_size, target, ``n`` equal rows and what the mix takes of them.

    ``epochs``: how often each of the rows is taken whole; ``whole``: how many of the rows are taken once more; ``part``:
    words that the next one of them gives.
    """
    settings.ensure_checkpoint_dir(docs.sparkSession)
    text, source = text_column(docs), docs["source"].cast("string")
    rows = docs.select(
        F.coalesce(F.concat(F.lit("s"), source), F.lit("n")).alias("key"), source.alias("source"), docs["doc_id"],
        word_count(text).alias("size"), draw(seed, docs["doc_id"], text).alias("draw"))
    lines = rows.groupBy("key", "source", "doc_id", "size", "draw").agg(F.count(F.lit(1)).alias("n")).checkpoint()
    sources = lines.groupBy("key", "source").agg(
        F.sum(F.col("size") * F.col("n")).alias("source_size"), F.count(F.lit(1)).alias("lines")).checkpoint()
    aims = targets(sources, weights, share, limit)
    # ranges of the draw: its leading bits, as many as the source needs
    bits = F.least(F.ceil(F.log2(F.greatest(F.col("lines") / range_rows, F.lit(1.0)))), F.lit(4 * DIGITS)).cast("int")
    step = F.pow(F.lit(2.0), F.lit(4 * DIGITS) - bits).cast("bigint")
    aims = aims.withColumn("step", step).drop("lines").withColumnRenamed("key", "_key").checkpoint()
    held = lookup(lines, aims, [("key", "_key")]).drop("_key")
    leading = F.conv(F.substring("draw", 1, DIGITS), 16, 10).cast("bigint")
    held = held.withColumn("range", F.floor(leading / F.col("step")))
    words = F.col("size") * F.col("n")
    ranges = held.groupBy("key", "range").agg(F.sum(words).alias("words"))
    before = F.sum("words").over(W.partitionBy("key").orderBy("range").rowsBetween(W.unboundedPreceding, -1))
    ranges = ranges.select(F.col("key").alias("_key"), F.col("range").alias("_range"), F.coalesce(before, F.lit(0)).alias("ahead")).checkpoint()
    inside = F.sum(words).over(W.partitionBy("key", "range").orderBy("draw", "doc_id", "size").rowsBetween(W.unboundedPreceding, -1))
    held = lookup(held.withColumn("inside", F.coalesce(inside, F.lit(0))), ranges, [("key", "_key"), ("range", "_range")])
    epochs = F.when(F.col("source_size") > 0, F.expr("budget div source_size")).otherwise(F.lit(0).cast("bigint"))
    held = held.withColumn("epochs", epochs)
    held = held.withColumn("room", F.greatest(
        F.col("budget") - F.col("epochs") * F.col("source_size") - F.col("ahead") - F.col("inside"), F.lit(0).cast("bigint")))
    whole = F.when(F.col("size") > 0, F.least(F.expr("room div size"), F.col("n"))).otherwise(F.lit(0).cast("bigint"))
    held = held.withColumn("whole", whole)
    part = F.when(F.col("whole") < F.col("n"), F.least(F.col("room") - F.col("whole") * F.col("size"), F.col("size")))
    return held.withColumn("part", F.coalesce(part, F.lit(0).cast("bigint"))).select(
        "source", "doc_id", "draw", "size", "source_size", "target", "n", "epochs", "whole", "part")


def mix(docs: DataFrame, **how) -> DataFrame:
    """(doc_id, size, source_size, target, taken), one row per row of ``docs``.

    size is the number of words of the text (a null text has none), source_size and target are those of the row's
    source, taken is the number of words that the mix takes from the row, repeats counted.  Sources are told apart by
    name; a null name is a source of its own, the last one.  The taken words of a source add up to its target rounded down.
    Null ids and repeated rows stay; of repeated rows some may be taken once more than others.  Texts without words are
    never taken.  Other columns play no part; an empty table gives no rows.
    """
    lines = repeated(plan(docs, **how), "n", "k")
    more = F.when(F.col("k") < F.col("whole"), F.col("size")).when(F.col("k") == F.col("whole"), F.col("part")).otherwise(0)
    return lines.select("doc_id", "size", "source_size", "target", (F.col("epochs") * F.col("size") + more).alias("taken"))


def mixed_texts(docs: DataFrame, seed: int = 11, **how) -> DataFrame:
    """(doc_id, source, epoch, text): the mix itself, a row each time a text is taken; the one at a cut gives its first
    words, joined by one space.

    Handles nulls, empty texts and repeated rows as ``mix`` does; texts without words have no row.
    """
    text, source = text_column(docs), docs["source"].cast("string")
    texts = docs.select(docs["doc_id"].alias("id"), source.alias("of"), draw(seed, docs["doc_id"], text).alias("drawn"), text.alias("text"))
    texts = texts.dropDuplicates(["id", "of", "drawn"])
    takes = F.col("n") * F.col("epochs") + F.col("whole")
    cut = F.when(F.col("part") > 0, 1).otherwise(0)
    lines = plan(docs, seed=seed, **how).filter(F.col("size") > 0).withColumn("takes", takes + cut).filter("takes > 0")
    same = (F.col("draw") == F.col("drawn")) & F.col("doc_id").eqNullSafe(F.col("id")) & F.col("source").eqNullSafe(F.col("of"))
    rows = repeated(lines.join(texts, same).select("doc_id", "source", "n", "part", "text", (takes + cut).alias("times"), takes.alias("full")),
                    "times", "k")
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    first = F.concat_ws(" ", F.slice(words, F.lit(1), F.col("part").cast("int")))
    return rows.select("doc_id", "source", F.floor(F.col("k") / F.col("n")).alias("epoch"),
                       F.when(F.col("k") < F.col("full"), F.col("text")).otherwise(first).alias("text"))
