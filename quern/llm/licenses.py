"""License notices in texts by diagonal voting, in DataFrame operations only.

Phrases and notices are templates: short texts with a label.  All rolling k-word hashes of all
documents are joined to the places of the same hashes in the templates.  A template that occurs
in a document puts all its hits on one diagonal (place in the document minus place in the
template), so every hit votes for its diagonal; words that were put in or left out move the rest of an
occurrence to a neighbouring diagonal, and such neighbours are merged.  A diagonal by itself or a merged group is an
occurrence if enough of the template's hashes are there within about its length.

Each document also sends one line of its own through the join, so that its word count, its
hits and the fact that it has none meet in one aggregation, and the text is read once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quern.llm.common import LOWER, UPPER, repeated, text_column
from quern.operators.joins import fits_broadcast

#: words per hash; diagonals this close are one occurrence; share of a notice's hashes that must be there
K, NEIGHBOURS, COVERAGE = 2, 4, 0.6
#: notices with fewer hashes must be there as a whole: they differ from each other by a word
SHORT = 10
#: an occurrence may be this many times as long as its template
STRETCH = 1.5

#: fixed values: phrases that are counted wherever their words stand consecutively
PHRASES = [("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license")]
#: fixed values: notices as their licenses word them
NOTICES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "the software is provided as is without warranty of any kind express or implied"),
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "you may not use this file except in compliance with the license"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", "gnu lesser general public license"),
    ("agpl", "gnu affero general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license"),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc", "licensed under a creative commons attribution"),
]
#: words whose pairs with each other say nothing and do not vote
COMMON = set("a and any as by can files for in is it may not of on or that the this to under use with you".split())


def words_of(text: Column) -> Column:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z in lower case."""
    return F.array_remove(F.split(F.translate(text, UPPER, LOWER), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def template_hashes(spark, phrases: list[tuple[str, str]], notices: list[tuple[str, str]]) -> DataFrame:
    """(g, template, at, label, base, votes, m): the hashes of every template, ``votes`` of them that count."""
    rows = []
    for number, (label, text, base) in enumerate([(*p, True) for p in phrases] + [(*n, False) for n in notices]):
        words = text.split()
        pairs = [(i, words[i:i + K]) for i in range(len(words) - K + 1)]
        voting = [(i, p) for i, p in pairs if base or not set(p) <= COMMON]
        rows += [(number, i, label, base, len(voting), len(words), p) for i, p in voting]
    table = spark.createDataFrame(rows, "template int, at int, label string, base boolean, votes int, m int, pair array<string>")
    return table.withColumn("g", F.xxhash64(*[F.get("pair", F.lit(j)) for j in range(K)])).drop("pair")


def scan(docs: DataFrame, phrases: list[tuple[str, str]] = PHRASES, notices: list[tuple[str, str]] = NOTICES) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score), one row per row of ``docs``.

    Phrases (of at least two words) are counted at every place where they stand, overlapping or not; notices
    may have gaps and changes.  score is the largest share of a template's hashes found in one
    occurrence, 1 for a phrase, 0 without any.  Null texts are empty; without phrases first_word and
    last_word are null and the labels empty.  Null ids stay; rows with equal id and text give equal rows, as many as
    there were; texts are read whole; other columns play no part; an empty table gives no rows.
    """
    text = text_column(docs)
    found = template_hashes(docs.sparkSession, phrases, notices)
    rows = docs.select(docs["doc_id"], F.xxhash64(text).alias("h"), words_of(text).alias("words"))
    pair = ", ".join(f"get(words, i + {j})" for j in range(K))
    # the leading null is the document's own line; outer, or Spark would make the array twice to filter by its size
    grams = F.expr(f"concat(array(cast(null AS bigint)), if(size(words) >= {K}, transform(sequence(0, size(words) - {K}), "
                   f"i -> xxhash64({pair})), cast(array() AS array<bigint>)))")
    places = rows.select("doc_id", "h", F.size("words").cast("long").alias("n_words"), grams.alias("grams")).select(
        "doc_id", "h", "n_words", F.posexplode_outer("grams").alias("p", "g"))
    hits = places.join(F.broadcast(found) if fits_broadcast(found) else found, "g", "left").filter(
        F.col("template").isNotNull() | (F.col("p") == 0))
    key = ["doc_id", "h", "n_words"]
    diagonal = (F.col("p") - 1 - F.col("at")).alias("diagonal")
    votes = hits.groupBy(*key, "template", "label", "base", "votes", "m", diagonal).agg(
        F.count(F.lit(1)).alias("n"), F.collect_set("at").alias("ats"), F.max(F.col("p") - 1 + K).alias("end"),
        F.min(F.col("p") - 1).alias("begin"))

    order = W.partitionBy(*key, "template").orderBy("diagonal")
    far = F.col("diagonal") - F.lag("diagonal").over(order) > NEIGHBOURS
    group = F.sum(F.when(F.col("base") | F.coalesce(far, F.lit(True)), 1).otherwise(0)).over(order)
    enough = F.when(F.col("votes") < SHORT, 1.0).otherwise(COVERAGE)
    occurs = lambda share: ~F.col("base") & (share >= enough) & (F.col("end") - F.col("begin") <= STRETCH * F.col("m"))
    own = F.size("ats") / F.col("votes")
    # a notice on one diagonal counts whatever lies on the next ones, such as a part of another notice
    alone = F.max(F.when(occurs(own), own)).alias("alone")
    merged = votes.withColumn("group", group).groupBy(*key, "template", "label", "base", "votes", "m", "group").agg(
        F.max("n").alias("n"), F.min("begin").alias("begin"), F.max("end").alias("end"), alone,
        F.size(F.array_distinct(F.flatten(F.collect_list("ats")))).alias("got"))
    share = F.col("got") / F.col("votes")
    whole = F.col("base") & (F.col("got") == F.col("votes"))
    share = F.when(whole | occurs(share), F.least(share, F.lit(1.0))).otherwise(F.col("alone"))
    notice = share.isNotNull()
    counted = merged.groupBy(*key).agg(
        F.max(F.when(F.col("template").isNull(), F.col("n"))).alias("copies"),
        F.count_if(whole).alias("n_base"),
        F.min(F.when(whole, F.col("begin"))).cast("long").alias("first_word"),
        F.max(F.when(whole, F.col("begin"))).cast("long").alias("last_word"),
        F.collect_set(F.when(whole, F.col("label"))).alias("base_labels"),
        F.collect_set(F.when(notice, F.col("label"))).alias("labels"), F.max(share).alias("score"))
    joined = lambda c: F.array_join(F.array_sort(c), ",").alias(c)
    return repeated(counted, "copies", "k").select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", joined("base_labels"), joined("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"))
