"""Graph jobs on edge tables (src, dst[, w]), as rounds of joins.

Every round writes its state to the checkpoint folder, so the plan stays short and
a lost executor costs one round at most.  Edges meet vertex tables through
``lookup``: a vertex with a huge share of the edges does not end up in one task.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern import settings
from quern.operators.joins import lookup
from quern.operators.ordered import Ordered, position, shift

PIECES = 8  # broadcasts that a round may need before edges are shuffled instead


def _rows(df: DataFrame, column: str, rows: int) -> int | None:
    """The known number of rows where that bounds the bytes too; vertices that are texts have to be measured."""
    return None if dict(df.dtypes)[column] in ("string", "binary") else rows


def vertices_of(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("src").alias("v")).unionByName(edges.select(F.col("dst").alias("v"))).distinct()


def _leaving(edges: DataFrame, frontier: DataFrame) -> DataFrame:
    """Edges that leave the vertices (v, ...) of ``frontier``: these are broadcast, in up to PIECES pieces, so that the edges stay where they are."""
    spark, kind = edges.sparkSession, dict(frontier.dtypes)["v"]
    width = F.octet_length("v") + 24 if kind in ("string", "binary") else F.lit(16)
    rows, size = frontier.agg(F.count(F.lit(1)), F.sum(width.cast("bigint"))).first()
    most, most_bytes = settings.limit(spark, settings.BROADCAST_ROWS), settings.limit(spark, settings.BROADCAST_BYTES)
    if rows > PIECES * most or (size or 0) > PIECES * most_bytes:
        return lookup(edges, frontier, [("src", "v")])
    pieces = max(1, -(-rows // max(most, 1)), -(-(size or 0) // max(most_bytes, 1)))
    part = lambda i: frontier.filter(F.pmod(F.xxhash64("v"), F.lit(pieces)) == i)
    return reduce(DataFrame.unionByName, [edges.join(F.broadcast(part(i)), F.col("src") == F.col("v")) for i in range(pieces)])


def shortest_paths(edges: DataFrame, source, stored: bool = False) -> DataFrame:
    """(v, dist): least weight from the source, which has a row itself; only improved vertices travel each round.

    Edges stay where they lie: a round broadcasts the improved vertices and sends at most one row per task and vertex that is
    reached.  Every round reads them again, so they are copied once, unless they are ``stored``: a plain view of a stored table.

    Weights must not be negative: a circle of such edges has no least weight.  Edges without a weight are left out.
    """
    spark = edges.sparkSession
    settings.ensure_checkpoint_dir(spark)
    edges = edges.filter(F.col("w").isNotNull()).select("src", "dst", "w")
    if not stored:
        edges = edges.checkpoint()
    if (edges.agg(F.min("w")).first()[0] or 0) < 0:
        raise ValueError("an edge has a negative weight")
    kinds = dict(edges.dtypes)
    start = spark.range(1).select(F.lit(source).cast(kinds["src"]).alias("v"), F.lit(0).cast(kinds["w"]).alias("dist"))
    known = frontier = start.checkpoint()
    while not frontier.isEmpty():
        reached = _leaving(edges, frontier).groupBy(F.col("dst").alias("v")).agg(
            F.min(F.col("dist") + F.col("w")).alias("new"))
        merged = known.join(reached, "v", "full").select(
            "v", F.least("dist", "new").alias("dist"),
            (F.col("new").isNotNull() & (F.col("dist").isNull() | (F.col("new") < F.col("dist")))).alias("better")).checkpoint()
        frontier = merged.filter("better").drop("better")
        known = merged.drop("better")
    return known


def network_delay(edges: DataFrame, source, vertices: DataFrame | None = None, stored: bool = False) -> DataFrame:
    """Largest shortest distance from the source, -1 if a vertex is out of reach.

    ``vertices`` (column v) names all vertices; without it only those with an edge count.  ``stored`` as in ``shortest_paths``.
    """
    every = vertices_of(edges) if vertices is None else vertices.select("v").distinct()
    found = every.join(shortest_paths(edges, source, stored), "v", "left")
    return found.agg(
        F.when(F.count("dist") == F.count(F.lit(1)), F.max("dist")).otherwise(F.lit(-1)).cast("bigint").alias("delay"))


def levels(edges: DataFrame, vertices: DataFrame, failed: DataFrame | None = None) -> DataFrame:
    """(v, level): a vertex comes one level after the last of its predecessors.

    Vertices on or behind a cycle, and those behind a ``failed`` vertex, get no row; edges to vertices that are not
    listed play no part.  The state is one table of the vertices that still wait, with the number of
    predecessors they wait for.  A round places those that wait for none, writes them as one file set, and only edges that leave
    them are touched.  Long thin graphs would take a round per vertex, so once the edges that are left are no more than a
    task may hold (``quern.block.rows``), one task goes through the rest.  Plans do not grow with the number of rounds.
    """
    spark = edges.sparkSession
    settings.ensure_checkpoint_dir(spark)
    cap = settings.limit(spark, settings.BLOCK_ROWS)
    kind = vertices.schema["v"].dataType.simpleString()
    edges = edges.select(F.col("src").cast(kind).alias("src"), F.col("dst").cast(kind).alias("dst")).distinct().checkpoint()
    stops = vertices.select("v", F.lit(False).alias("stops")).limit(0) if failed is None else failed.select("v").distinct().withColumn("stops", F.lit(True))
    waiting = vertices.select("v").filter(F.col("v").isNotNull()).distinct().join(
        edges.groupBy(F.col("dst").alias("v")).agg(F.count(F.lit(1)).alias("need")), "v", "left").join(stops, "v", "left").select(
        "v", F.coalesce("need", F.lit(0).cast("bigint")).alias("need"), F.coalesce("stops", F.lit(False)).alias("stops")).checkpoint()
    path, level, left = settings.scratch(spark, "levels"), 0, edges.count()
    while left > cap:
        ready, waiting = waiting.filter("need = 0"), waiting.filter("need > 0")
        ready.select("v", F.lit(level).cast("bigint").alias("level")).write.mode("append").parquet(path)
        pushing = ready.filter("NOT stops").select(F.col("v").alias("_v")).checkpoint()
        size = pushing.count()
        if not size:
            waiting = waiting.limit(0)
            break
        leaving = lookup(edges, pushing, [("src", "_v")], dim_rows=_rows(pushing, "_v", size))
        met = leaving.groupBy(F.col("dst").alias("v")).agg(F.count(F.lit(1)).alias("met")).checkpoint()
        left -= met.agg(F.sum("met")).first()[0] or 0
        level += 1
        waiting = waiting.join(met, "v", "left").select(
            "v", (F.col("need") - F.coalesce("met", F.lit(0))).alias("need"), "stops").checkpoint()
    if level:
        edges = edges.join(waiting.select(F.col("v").alias("dst")), "dst", "left_semi")
    rest = _rest(edges, waiting, level, kind)
    return rest.unionByName(spark.read.schema(f"v {kind}, level bigint").parquet(path)) if level else rest


def _rest(edges: DataFrame, waiting: DataFrame, level: int, kind: str) -> DataFrame:
    """Levels from ``level`` on of a graph whose edges fit into one task: level by level over edges sorted by their source.

    Vertices without any of these edges, however many, wait for nothing and do not go through that task.
    """
    ends = vertices_of(edges)
    alone = waiting.join(ends, "v", "left_anti").filter("need = 0").select("v", F.lit(level).cast("bigint").alias("level"))
    waiting = waiting.join(ends, "v", "left_semi")

    def place(table: pa.Table) -> pa.Table:
        names = pa.chunked_array([*table["v"].chunks, *table["dst"].chunks]).combine_chunks().dictionary_encode()
        numbers = names.indices.fill_null(-1).to_numpy()
        v, dst = np.split(numbers, 2)
        is_edge = dst >= 0
        n = len(names.dictionary)
        need, stops, listed = np.zeros(n, np.int64), np.zeros(n, bool), np.zeros(n, bool)
        own = ~is_edge
        need[v[own]] = table["need"].to_numpy()[own]
        stops[v[own]] = table["stops"].to_numpy()[own]
        listed[v[own]] = True
        order = np.argsort(v[is_edge], kind="stable")
        targets = dst[is_edge][order]
        first = np.searchsorted(v[is_edge][order], np.arange(n + 1))
        placed, now, ready = np.full(n, -1, np.int64), level, np.flatnonzero(listed & (need == 0))
        while len(ready):
            placed[ready] = now
            pushing = ready[~stops[ready]]
            sizes = first[pushing + 1] - first[pushing]
            starts = np.repeat(first[pushing] - np.cumsum(sizes) + sizes, sizes)
            met, times = np.unique(targets[starts + np.arange(sizes.sum())], return_counts=True)
            need[met] -= times
            ready = met[(need[met] == 0) & listed[met]]
            now += 1
        done = np.flatnonzero(placed >= 0)
        return pa.table({"v": names.dictionary.take(pa.array(done)), "level": placed[done]})

    none = F.lit(None)
    rows = waiting.select("v", none.cast(kind).alias("dst"), "need", "stops").unionByName(
        edges.select(F.col("src").alias("v"), "dst", F.lit(0).cast("bigint").alias("need"), F.lit(False).alias("stops")))
    return alone.unionByName(rows.groupBy().applyInArrow(place, f"v {kind}, level bigint"))


def is_acyclic(edges: DataFrame) -> DataFrame:
    """One row: number of vertices and whether all of them can be ordered."""
    vertices = vertices_of(edges)
    placed = levels(edges, vertices).count()
    return vertices.agg(F.count(F.lit(1)).alias("vertices")).withColumn("acyclic", F.col("vertices") == placed)


def letter_rules(words: DataFrame, word: str) -> DataFrame:
    """Edges first letter -> later letter from neighbouring words of a sorted list.

    ``words``: word and its place ``i``.  A word that is followed by its own proper
    prefix contradicts every order and gives the edge of a letter to itself.
    """
    pairs = Ordered(words.select("i", word), [], ["i"], settle=True).scan(before=shift(word)).rows().filter(F.col("before").isNotNull())
    a, b = F.col("before"), F.col(word)
    places = F.sequence(F.lit(1), F.greatest(F.least(F.length(a), F.length(b)), F.lit(1)))
    differs = F.filter(places, lambda p: F.substring(a, p, F.lit(1)) != F.substring(b, p, F.lit(1)))
    at = F.get(differs, F.lit(0))
    prefix = at.isNull() & (F.length(a) > F.length(b))
    rules = pairs.select(
        F.when(prefix, F.substring(a, 1, 1)).otherwise(F.substring(a, at, F.lit(1))).alias("src"),
        F.when(prefix, F.substring(a, 1, 1)).otherwise(F.substring(b, at, F.lit(1))).alias("dst"))
    return rules.filter(F.col("src").isNotNull()).distinct()


def letter_levels(words: DataFrame, word: str) -> DataFrame:
    """(v, level) of every letter; letters that no order can hold are missing."""
    letters = words.select(F.explode(F.array_distinct(F.split(word, ""))).alias("v")).filter("v <> ''").distinct()
    return levels(letter_rules(words, word), letters)


def components(edges: DataFrame, vertices: DataFrame) -> DataFrame:
    """(v, label): the smallest vertex of each connected component.

    Labels spread to neighbours and are then replaced by their label's label,
    which shortens long chains and keeps the number of rounds small.
    """
    settings.ensure_checkpoint_dir(edges.sparkSession)
    both = edges.select("src", "dst").unionByName(
        edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct().checkpoint()
    state = vertices.select("v", F.col("v").alias("label")).distinct().checkpoint()
    size = state.count()
    while True:
        heard = lookup(both, state, [("src", "v")], dim_rows=_rows(state, "v", size)).groupBy(F.col("dst").alias("v")).agg(F.min("label").alias("new"))
        roots = state.select(F.col("v").alias("_v"), F.col("label").alias("_root"))
        told = lookup(state.join(heard, "v", "left"), roots, [("label", "_v")], "left", dim_rows=_rows(state, "v", size)).select(
            "v", "label", F.least("label", "new", "_root").alias("new")).checkpoint()
        state = told.select("v", F.col("new").alias("label"))
        if told.filter("new <> label").isEmpty():
            return state


def merges(pairs: DataFrame) -> int:
    """By how many the edges (a, b) make the components fewer than the vertices.

    Every vertex with a smaller neighbour is put into the smallest of these.  That makes trees; each vertex finds its root by
    doubling, and only edges between different roots are left for the next round, which has at most half of the vertices.
    """
    n = 0
    while True:
        up = pairs.groupBy("a").agg(F.min("b").alias("up")).checkpoint()
        size = up.count()
        if not size:
            return n
        n += size
        while True:
            above = up.select(F.col("a").alias("_a"), F.col("up").alias("_up"))
            jumped = lookup(up, above, [("up", "_a")], "left", dim_rows=_rows(up, "a", size)).select(
                "a", F.coalesce("_up", "up").alias("up"), F.col("_up").isNotNull().alias("moved")).checkpoint()
            up = jumped.drop("moved")
            if jumped.filter("moved").isEmpty():
                break
        of = lambda c: (up.select(F.col("a").alias(f"_{c}"), F.col("up").alias(f"_{c}_up")), [(c, f"_{c}")], "left", _rows(up, "a", size))
        ends = lookup(lookup(pairs, *of("a")), *of("b")).select(F.coalesce("_a_up", "a").alias("a"), F.coalesce("_b_up", "b").alias("b"))
        pairs = ends.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct().checkpoint()


def is_tree(edges: DataFrame, vertices: DataFrame | None = None) -> DataFrame:
    """One row: vertices, edges, components, and whether that makes a tree.

    Without ``vertices`` all that have an edge count; edges to vertices that are not listed join nothing.
    """
    settings.ensure_checkpoint_dir(edges.sparkSession)
    edges = edges.select("src", "dst").checkpoint()
    pairs = edges.filter("src <> dst").select(F.greatest("src", "dst").alias("a"), F.least("src", "dst").alias("b"))
    if vertices is None:
        vertices = vertices_of(edges)
    else:
        vertices = vertices.select("v").distinct().checkpoint()
        for c in ("a", "b"):
            pairs = pairs.join(vertices.select(F.col("v").alias(c)), c, "left_semi")
    merged = merges(pairs.checkpoint())
    counts = vertices.agg(F.count(F.lit(1)).alias("vertices"), (F.count("v") - merged).alias("components"))
    return counts.withColumn("edges", F.lit(edges.count()).cast("bigint")).select(
        "vertices", "edges", "components",
        ((F.col("edges") == F.col("vertices") - 1) & (F.col("components") == 1)).alias("is_tree"))


def leaf_sequence(nodes: DataFrame, tree: list[str]) -> DataFrame:
    """(tree, i, value): leaves of every tree from left to right.

    ``nodes``: tree columns, node, parent (NULL at the root), side (0 or 1), value.
    The path from the root is put together by doubling: each round joins a node
    to the ancestor it has reached, so a tree of depth d takes log2(d) rounds.
    """
    settings.ensure_checkpoint_dir(nodes.sparkSession)
    paths = nodes.select(
        *tree, "node", "value", F.col("parent").alias("up"),
        F.when(F.col("parent").isNull(), "").otherwise(F.col("side").cast("string")).alias("path")).checkpoint()
    parents = paths.select(*tree, F.col("up").alias("node")).filter(F.col("node").isNotNull()).distinct()
    leaves = paths.select(*tree, "node").join(parents, [*tree, "node"], "left_anti").checkpoint()
    steps, most = 1, paths.count()
    while not paths.filter(F.col("up").isNotNull()).isEmpty():
        if steps > most:  # a path from the root is never longer than the number of nodes
            raise ValueError("parents form a circle")
        steps *= 2
        above = paths.select(*[F.col(c).alias(f"_{c}") for c in tree], F.col("node").alias("_node"),
                             F.col("up").alias("_up"), F.col("path").alias("_path"))
        # towards the end most nodes of a tree ask for the same few ancestors
        joined = lookup(paths, above, [*[(c, f"_{c}") for c in tree], ("up", "_node")], "left")
        paths = joined.select(
            *tree, "node", "value", F.col("_up").alias("up"),
            F.concat(F.coalesce("_path", F.lit("")), "path").alias("path")).checkpoint()
    found = paths.join(leaves, [*tree, "node"]).select(*tree, "path", "value")
    return Ordered(found, tree, ["path"]).scan(i=position()).rows().select(*tree, "i", "value")


def same_leaves(nodes: DataFrame, key: str, tree: str) -> DataFrame:
    """(key, same): whether the two trees of each key have equal leaf sequences.

    ``tree`` tells the two apart (0 and 1).  Leaves are compared place by place.
    """
    leaves = leaf_sequence(nodes, [key, tree])
    side = lambda x, name: F.max(F.when(F.col(tree) == x, F.col("value"))).alias(name)
    places = leaves.groupBy(key, "i").agg(side(0, "a"), side(1, "b"))
    return places.groupBy(key).agg(F.bool_and(F.col("a").eqNullSafe(F.col("b"))).alias("same"))


def task_levels(tasks: DataFrame) -> DataFrame:
    """(task_id, level, state): when each task runs, or that it is stuck.

    ``tasks``: task_id, depends_on, status.  A task behind a failed, missing or
    circular dependency never runs: level -1, state "stuck".
    """
    edges = tasks.select(F.explode("depends_on").alias("src"), F.col("task_id").alias("dst"))
    placed = levels(
        edges, tasks.select(F.col("task_id").alias("v")),
        tasks.filter("status = 'failed'").select(F.col("task_id").alias("v")))
    return tasks.join(placed, F.col("task_id") == F.col("v"), "left").select(
        "task_id", F.coalesce("level", F.lit(-1).cast("bigint")).alias("level"),
        F.when(F.col("level").isNull(), "stuck").otherwise(F.col("status")).alias("state"))
