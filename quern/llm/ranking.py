"""Ranked lexical search: the best documents for every item of a query set, exactly, by dual-tree search.

A document is a sparse vector: for each of its terms what one unit of the term's weight earns there.  An item
gives its terms their weights, and a score is the product of both.  Two kinds of trees are searched against each
other.  The items are halved again and again by the terms they share; a node holds the largest weight of each term
below it.  So are the documents, batch by batch inside the tasks; a node holds the largest earning of each term.  The product
of two such maxima bounds every score between the two nodes.  A pair of nodes goes no further if its bound lies under
the weakest k-th score that any item below the item node has reached so far, so whole batches are left out and
nothing is lost.

All scores are whole numbers.  Products are taken in doubles while no sum can reach 2^53, and in 64-bit integers beyond.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quern import settings
from quern.llm.common import text_column

#: maximal matches of [^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+, in UTF-8
TERM = re.compile(rb"[0-9A-Za-z\x80-\xFF]+")
#: results per item
TOP = 50
#: UTF-8 bytes of items that are searched in one round (a longer query set takes several), and those that share a tree
ROUND_BYTES, TREE_BYTES = 1 << 18, 1 << 16
#: documents and postings of a batch that gets a tree, and documents and items of a leaf
BATCH_DOCS, BATCH_POSTINGS, LEAF_DOCS, LEAF_ITEMS = 4096, 1 << 21, 16, 4
#: one document of so many is searched first, for the scores to start from
FIRST = 32
#: sums of products below this are exact in doubles
EXACT = 1 << 53
#: parts in which the tasks' lists of an item are first merged
PARTS = 16


def terms_of(text: bytes) -> list[bytes]:
    return TERM.findall(text.lower())  # lower() of bytes changes A-Z only


# --- documents ---------------------------------------------------------------------------------------------


def postings(docs: DataFrame, numbers: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, tfs): all terms of a text, and the numbers of the asked ones with how often they occur."""
    asked = docs.sparkSession.sparkContext.broadcast(numbers)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = asked.value
        for batch in batches:
            sizes, ends, terms, tfs = [], [0], [], []
            for text in batch.column(1).cast(pa.large_binary()):
                words = terms_of(text.as_py())
                held = sorted((numbers[w], c) for w, c in Counter(words).items() if w in numbers)
                sizes.append(len(words))
                terms += [t for t, _ in held]
                tfs += [c for _, c in held]
                ends.append(len(terms))
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, kind))
                     for x, kind in ((terms, pa.int32()), (tfs, pa.int64()))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), *lists], ["doc_id", "n", "terms", "tfs"])

    rows = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), text_column(docs).alias("text"))
    return rows.mapInArrow(found, "doc_id long, n long, terms array<int>, tfs array<long>")


def frequencies(rows: DataFrame, vocabulary: int) -> np.ndarray:
    """In how many documents each asked term occurs; every task sends one row per term that it has met."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(vocabulary, np.int64)
        for batch in batches:
            counts += np.bincount(batch.column(0).flatten().to_numpy(), minlength=vocabulary)
        met = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(counts[met])], ["term", "df"])

    found = rows.select("terms").mapInArrow(counted, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    out = np.zeros(vocabulary, np.int64)
    out[found["term"].to_numpy()] = found["df"].to_numpy()
    return out


# --- trees -------------------------------------------------------------------------------------------------


class Tree:
    """Rows of a sparse table, halved down to leaves.

    ``order`` lists the rows leaf by leaf; node i holds order[low[i]:high[i]], its children are left[i] and left[i] + 1
    (none if left[i] is 0), and most[i] are its coordinate maxima.
    """

    def __init__(self, table: np.ndarray, leaf: int):
        self.order = np.arange(len(table))
        self.low, self.high, self.left, most = [0], [len(table)], [0], [table.max(0, initial=0)]
        at = 0
        while at < len(self.low):
            low, high = self.low[at], self.high[at]
            if high - low > leaf:
                rows = self.order[low:high]
                key = self.direction(table[rows], most[at])
                cut = (high - low) // 2
                rows = rows[np.argpartition(key, cut)]
                self.order[low:high] = rows
                self.left[at] = len(self.low)
                for a, b in ((low, low + cut), (low + cut, high)):
                    self.low.append(a)
                    self.high.append(b)
                    self.left.append(0)
                    most.append(table[self.order[a:b]].max(0))
            at += 1
        self.most = np.array(most)

    @staticmethod
    def direction(rows: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How near each row is to one of two unlike rows rather than to the other."""
        scaled = rows / np.maximum(most, 1)
        a = scaled[int(scaled.sum(1).argmax())]
        b = scaled[int((scaled @ a - scaled.sum(1)).argmin())]
        return scaled @ (a - b)


class Search:
    """The k best documents of every item of one tree among all batches that this task has seen.

    ``items``: their numbers; ``columns``: the terms that they have, ``weights``: one row of these per item; ``kth``: scores
    that k documents of the corpus are known to reach.
    """

    def __init__(self, items: np.ndarray, columns: np.ndarray, weights: np.ndarray, kth: np.ndarray, k: int):
        self.items, self.columns, self.weights, self.start, self.k = items, columns, weights, kth, k
        self.tree = Tree(weights, LEAF_ITEMS)
        self.below = np.array(self.tree.left)
        self.scores = np.zeros((len(weights), k), np.int64)
        self.ids = np.full((len(weights), k), NONE)
        self.compared = self.pairs = 0
        self.rise()

    def rise(self) -> None:
        """What a document must reach for each item (1 while there are fewer than k), and the least of that per node."""
        self.bar = np.maximum(np.maximum(self.start, self.scores[:, -1]), 1)
        placed = self.bar[self.tree.order]
        self.weakest = np.array([placed[a:b].min() for a, b in zip(self.tree.low, self.tree.high)])

    def batch(self, ids: np.ndarray, table: np.ndarray, columns: np.ndarray) -> None:
        """Search documents (rows of earnings, in the given columns of the weights)."""
        exact = float(table.max(initial=0)) * float(self.weights.max(initial=0)) * len(columns) < EXACT
        kind = np.float64 if exact else np.int64
        docs, weights, most = Tree(table, LEAF_DOCS), self.weights[:, columns].astype(kind), self.tree.most[:, columns].astype(kind)
        table, upper = table.astype(kind), docs.most.astype(kind)
        todo = [(0, np.array([0]))]
        while todo:
            node, items = todo.pop()
            items = items[most[items] @ upper[node] >= self.weakest[items]]
            if not len(items):
                continue
            left = self.below[items]
            if docs.left[node]:
                # both sides go one level down; an item leaf stays as it is
                below = np.concatenate((items[left == 0], left[left > 0], left[left > 0] + 1))
                children = [docs.left[node], docs.left[node] + 1]
                sums = [float(upper[c].sum()) for c in children]
                for c in sorted(children, key=lambda c: sums[c - children[0]]):  # the richer child is searched first
                    todo.append((c, below))
                continue
            while (left > 0).any():
                below = np.concatenate((left[left > 0], left[left > 0] + 1))
                items = np.concatenate((items[left == 0], below[most[below] @ upper[node] >= self.weakest[below]]))
                left = self.below[items]
            own = np.concatenate([self.tree.order[self.tree.low[i]:self.tree.high[i]] for i in items] or [np.zeros(0, int)])
            rows = docs.order[docs.low[node]:docs.high[node]]
            if len(own):
                self.merge(own, ids[rows], (weights[own] @ table[rows].T).astype(np.int64))
                self.compared += len(own) * len(rows)
        self.pairs += len(self.weights) * len(ids)

    def merge(self, items: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        better = (scores >= self.bar[items, None]).any(1)
        items, scores = items[better], scores[better]
        if not len(items):
            return
        scores = np.concatenate((self.scores[items], scores), axis=1)
        ids = np.concatenate((self.ids[items], np.broadcast_to(ids, (len(items), len(ids)))), axis=1)
        best = np.lexsort((ids, -scores))[:, :self.k]
        self.scores[items] = np.take_along_axis(scores, best, 1)
        self.ids[items] = np.take_along_axis(ids, best, 1)
        self.rise()


# --- search over Spark's partitions ----------------------------------------------------------------------


def earned(tf: np.ndarray, n: np.ndarray, texts: int, words: int) -> np.ndarray:
    """What a unit of weight earns: a whole number, rounded down."""
    m = 50 + (50 * n * texts) // max(words, 1)
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


def searched(rows: DataFrame, trees: list[tuple], kth: np.ndarray, texts: int, words: int, k: int) -> DataFrame:
    """(item, doc_id, score): for every item the k best documents of each task, without those that cannot be among the k best of all.

    ``trees``: (items, columns, weights) of the items that share a tree.
    """
    given = rows.sparkSession.sparkContext.broadcast((trees, kth))

    def tables(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(ids, lengths, owner, terms, tfs) of batches of bounded size."""
        sizes = np.diff(batch.column(2).offsets.to_numpy())
        group = np.maximum(np.arange(len(sizes)) // BATCH_DOCS, np.cumsum(sizes) // BATCH_POSTINGS)
        for start, end in zip(*bounds(group)):
            part = batch.slice(start, end - start)
            terms, tfs = (part.column(c).flatten().to_numpy() for c in (2, 3))
            yield (part.column(0).fill_null(NONE).to_numpy(), part.column(1).to_numpy(),
                   np.repeat(np.arange(len(part)), sizes[start:end]), terms, tfs)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, kth = given.value
        searches = [Search(items, columns, weights, kth[items], k) for items, columns, weights in held]
        for batch in batches:
            if not len(batch):
                continue
            for ids, n, owner, terms, tfs in tables(batch):
                earnings = earned(tfs, n[owner], texts, words)
                for search in searches:
                    at = np.minimum(np.searchsorted(search.columns, terms), len(search.columns) - 1)
                    own = np.flatnonzero(search.columns[at] == terms)
                    columns = np.unique(at[own])
                    place = np.searchsorted(columns, at[own])
                    step = max(1, DENSE // max(len(columns), 1))
                    for low in range(0, len(ids), step):  # a dense table of bounded size
                        a, b = np.searchsorted(owner[own], (low, low + step))
                        table = np.zeros((min(step, len(ids) - low), len(columns)), np.int64)
                        table[owner[own[a:b]] - low, place[a:b]] = earnings[own[a:b]]
                        if a < b:
                            search.batch(ids[low:low + step], table, columns)
        for search in searches:
            item, rank = np.nonzero((search.scores > 0) & (search.scores >= search.start[:, None]))
            ids = search.ids[item, rank]
            yield pa.RecordBatch.from_arrays([
                pa.array(search.items[item]), pa.array(ids, mask=ids == NONE), pa.array(search.scores[item, rank])],
                ["item", "doc_id", "score"])

    return rows.mapInArrow(work, "item long, doc_id long, score long")


#: cells of a batch's dense table
DENSE = 1 << 22
#: stands for a null doc_id inside the workers, and for no document
NONE = np.iinfo(np.int64).max


def bounds(group: np.ndarray) -> tuple[list[int], list[int]]:
    """Starts and ends of the runs of equal numbers."""
    cuts = (np.flatnonzero(np.diff(group)) + 1).tolist()
    return [0, *cuts], [*cuts, len(group)]


def best(found: DataFrame, k: int) -> DataFrame:
    """The k first rows of every item with their ``rank``; lists of many tasks are first merged in parts."""
    order = [F.desc("score"), F.col("doc_id").asc_nulls_last()]
    parts = found.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(PARTS)))
    few = parts.withColumn("r", F.row_number().over(W.partitionBy("item", "part").orderBy(*order))).filter(F.col("r") <= k)
    rank = F.row_number().over(W.partitionBy("item").orderBy(*order))
    return few.select("item", rank.alias("rank"), "doc_id", "score").filter(F.col("rank") <= k)


def rounds_of(items: DataFrame) -> Iterator[list[tuple]]:
    """(item_id, text) of the query set in parts of bounded bytes, cut by a hash of the text."""
    text = text_column(items)
    rows = items.select(items["item_id"].alias("item_id"), text.alias("text")).distinct()
    size = rows.agg(F.sum(F.octet_length("text").cast("bigint") + 64)).first()[0] or 0
    parts = -(-size // ROUND_BYTES)
    for part in range(parts):
        own = rows if parts == 1 else rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part)
        yield sorted(map(tuple, own.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def planted(asked: list[tuple], held: list[set], numbers: dict[bytes, int], weight: np.ndarray) -> Iterator[tuple]:
    """(items, columns, weights) of the items that share a tree: neighbours in the list, of TREE_BYTES of text."""
    group = np.cumsum([len(text.encode()) + 64 for _, text in asked]) // TREE_BYTES
    for start, end in zip(*bounds(group)):
        own = [np.array(sorted(numbers[w] for w in words), np.int64) for words in held[start:end]]
        columns = np.unique(np.concatenate(own))
        if len(columns):
            weights = np.zeros((end - start, len(columns)), np.int64)
            for row, at in zip(weights, own):
                row[np.searchsorted(columns, at)] = weight[at]
            yield np.arange(start, end), columns, weights


def rank(docs: DataFrame, items: DataFrame, k: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): for every item its k best documents with a score above 0.

    Terms are runs of ASCII letters, digits and characters beyond ASCII, A-Z lower-cased; the weights follow how many documents hold a
    term, and earnings how often a document holds it against its length (see the constants in ``earned``).  Equal
    scores are ordered by doc_id, a null doc_id last (several of these in any order).  Null and empty texts have no
    terms and find nothing; repeated documents are ranked as often as they come, item rows equal
    in id and text are one item.
    Texts are read whole.  Other columns play no part; empty tables give no rows.

    The query set may be of any size: it is searched in rounds of about ROUND_BYTES of text, each against all documents.
    """
    spark = docs.sparkSession
    settings.ensure_checkpoint_dir(spark)
    out = None
    for asked in rounds_of(items):
        held = [set(terms_of(t.encode())) for _, t in asked]
        numbers = {w: i for i, w in enumerate(sorted(set().union(*held)))}
        if not numbers:
            continue
        rows = postings(docs, numbers).checkpoint()
        texts, words = rows.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
        if not texts:
            continue
        df = frequencies(rows, len(numbers))
        weight = [math.floor(1000 * math.log((2 * texts + 2) / (2 * d + 1))) for d in df.tolist()]
        trees = list(planted(asked, held, numbers, np.array(weight)))
        none = np.zeros(len(asked), np.int64)
        sample = rows.filter(F.pmod(F.xxhash64("doc_id", "n", "terms"), F.lit(FIRST)) == 0)
        first = best(searched(sample, trees, none, texts, words, k), k).filter(F.col("rank") == k).toArrow()  # one row per item
        none[first["item"].to_numpy()] = first["score"].to_numpy()
        found = best(searched(rows, trees, none, texts, words, k), k)
        names = spark.createDataFrame([(i, r[0]) for i, r in enumerate(asked)], f"at long, item_id {items.schema['item_id'].dataType.simpleString()}")
        part = found.join(F.broadcast(names), F.col("item") == F.col("at")).select("item_id", "rank", "doc_id", "score")
        out = part if out is None else out.unionByName(part)
    if out is None:
        kind = items.schema["item_id"].dataType.simpleString()
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    return out
