"""What a step sends through the cluster, counted: it must not grow faster than its input."""

import random

from pyspark.sql import functions as F

from quern.operators import graph, similarity


def test_vectors_are_copied_a_few_times_only(spark):
    n = 600
    rows = [(i, i, [i, i + 1], [0.8, 0.6], None, True, True) for i in range(n)]
    df = spark.createDataFrame(rows, "v bigint, key bigint, tokens array<bigint>, weights array<double>, least bigint, asks boolean, gives boolean")
    spread, tiles = similarity.block_tiles(df.withColumn("least", F.lit(-similarity.NONE)), 7)
    assert tiles <= similarity.BLOCKS * (similarity.BLOCKS + 1) // 2
    assert n < spread.count() <= n * (similarity.BLOCKS + 1)
    few = df.withColumns({"least": F.lit(-similarity.NONE), "asks": F.col("v") > n - 4})
    assert similarity.block_tiles(few, 7)[0].count() <= n + 3 * similarity.BLOCKS


def test_greedy_dedup_looks_again_behind_struck_rows(spark):
    rng = random.Random(5)
    # windows of a long row of words: each resembles its neighbours, so that chains of struck rows arise; some keys come twice
    starts = [rng.randrange(60) for _ in range(80)]
    texts = [" ".join(f"w{chr(97 + j // 26)}{chr(97 + j % 26)}" for j in range(s, s + 12)) for s in starts]
    keys = [i if i % 9 else i + 1 for i in range(80)]
    want, accepted = set(), []
    for k, s in sorted(zip(keys, starts)):
        by = min((a for a, t in accepted if a < k and 12 - abs(s - t) >= 0.6 * 12 - 1e-9), default=None)
        want.add((k, s, by))
        if by is None:
            accepted.append((k, s))
    df = spark.createDataFrame(list(zip(keys, starts, texts)), "id bigint, s int, text string")
    for block in (1024, 6):
        got = similarity.greedy_dedup(similarity.unit_vectors(df, "id", "text"), "id", 0.6, None, block).collect()
        assert len(got) == 80 and {(r["id"], r.duplicate_of) for r in got} == {(k, by) for k, _, by in want}


def _shuffles(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_edges_stay_where_they_are_while_paths_grow(spark):
    edges = spark.range(300).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"), F.lit(1).alias("w"))
    frontier = spark.range(40).select(F.col("id").alias("v"), F.lit(0).alias("dist"))
    spark.conf.set("quern.broadcast.rows", "10")
    try:
        left = graph._leaving(edges, frontier)
        assert _shuffles(left) == 0 and sorted(r.dst for r in left.collect()) == list(range(1, 41))
    finally:
        spark.conf.unset("quern.broadcast.rows")


def test_components_are_counted_by_contraction(spark, both_ways, monkeypatch):
    """Labels of all vertices over all edges, round by round, are not needed to count."""
    monkeypatch.setattr(graph, "components", None)
    rng = random.Random(7)
    pairs = [(i // 2, i) for i in range(1, 40)] + [(50 + rng.randrange(30), 50 + rng.randrange(30)) for _ in range(25)] + [(90, 90), (3, 200), (None, 5)]
    pairs += [(300 - i, 299 - i) for i in range(20)]
    listed = [v for v in range(100)] + list(range(280, 301))
    label = {v: v for v in listed}
    for _ in range(200):
        for a, b in pairs:
            if a in label and b in label:
                label[a] = label[b] = min(label[a], label[b])
    df = spark.createDataFrame(pairs, "src int, dst int")
    got = graph.is_tree(df, spark.createDataFrame([(v,) for v in listed * 2], "v int")).first()
    assert (got.vertices, got.edges, got.components) == (len(listed), len(pairs), sum(v == x for v, x in label.items()))


def test_paths_never_shuffle_edges(spark, tmp_path, monkeypatch):
    """Edges of a stored table are read where they lie, others are copied as they are; rounds send the vertices that they reach."""
    path, seen = str(tmp_path / "edges"), []
    n = 40
    rows = [(a, b, 1 + (a * 7 + b * 3) % 11) for a in range(n) for b in range(n) if a != b] * 2 + [(0, 1, None), (None, 3, 1), (900, 901, 1)]
    spark.createDataFrame(rows, "src int, dst int, w int").write.parquet(path)
    edges = spark.read.parquet(path)
    leaving = graph._leaving
    monkeypatch.setattr(graph, "_leaving", lambda e, f: seen.append(e._jdf.queryExecution().executedPlan().toString()) or leaving(e, f))
    dist = {0: 0}
    for _ in range(n):
        for a, b, w in rows:
            if w is not None and a in dist:
                dist[b] = min(dist.get(b, 10 ** 6), dist[a] + w)
    for stored in (True, False):
        assert {r.v: r.dist for r in graph.shortest_paths(edges, 0, stored).collect()} == dist
    assert seen and all("Exchange" not in plan for plan in seen) and any("FileScan" in plan for plan in seen)
    assert graph.network_delay(edges.filter("src < 900"), 0, stored=True).first()[0] == max(dist.values())
    assert graph.network_delay(edges, 0, stored=True).first()[0] == -1


def _windows(rng, n, words=60, width=12):
    """Texts that are windows of a row of words: neighbours resemble each other; some keys come twice, some are missing."""
    starts = [rng.randrange(words) for _ in range(n)]
    texts = [" ".join(f"w{chr(97 + j // 26)}{chr(97 + j % 26)}" for j in range(s, s + width)) for s in starts]
    return [(None if i % 31 == 30 else i if i % 9 else i + 1, s, text, i % 5 > 0) for i, (s, text) in enumerate(zip(starts, texts))]


def test_vectors_are_not_copied_to_blocks_when_there_are_many(spark, monkeypatch):
    rows = _windows(random.Random(3), 90)
    df = spark.createDataFrame([*((k, s, x) for k, s, x, _ in rows), (3, -1, ""), (95, -1, "")], "id bigint, s int, text string")
    monkeypatch.setattr(similarity, "MOST_ROWS", 20)
    monkeypatch.setattr(similarity, "block_tiles", None)
    keyed = [(k, s) for k, s, *_ in rows if k is not None]
    want = set()
    for k, s in keyed:
        by = min((a for a, t in keyed if a < k and 12 - abs(s - t) >= 0.6 * 12 - 1e-9), default=None)
        want |= {(k, by)} - {(k, None)}
    for most, entries in ((32768, 6_000_000), (7, 6_000_000), (32768, 40)):
        monkeypatch.setattr(similarity, "ROUND_ROWS", most)
        monkeypatch.setattr(similarity, "ROUND_ENTRIES", entries)
        got = similarity.earlier_match(similarity.unit_vectors(df, "id", "text"), "id", 0.6).collect()
        assert {(r["id"], r["match"]) for r in got} == want


def test_greedy_dedup_lists_what_resembles_a_vector(spark, monkeypatch):
    monkeypatch.setattr(similarity, "LISTED", 2)
    rows = _windows(random.Random(4), 90)
    df = spark.createDataFrame(rows, "id bigint, s int, text string, good boolean")
    units = similarity.unit_vectors(df.withColumn("id", F.col("id") * 2 + F.col("good").cast("int")), "id", "text").withColumn("good", F.col("id") % 2 == 1)
    want, accepted = {}, []
    for k, s, good in sorted((2 * k + good, s, good) for k, s, _, good in rows if k is not None):
        by = min((a for a, t in accepted if a < k and 12 - abs(s - t) >= 0.6 * 12 - 1e-9), default=None)
        want[k, s] = by
        if by is None and good:
            accepted.append((k, s))
    for block in (1000, 7):
        got = similarity.greedy_dedup(units, "id", 0.6, "good", block).collect()
        assert len(got) == len(rows)
        assert {(r["id"], r.duplicate_of) for r in got} == {(k, by) for (k, _), by in want.items()} | {(None, None)}


def test_rounds_of_greedy_selection_do_not_follow_chains(spark):
    """Each text resembles the one before it only, which is struck for every second text."""
    texts = [" ".join(f"w{chr(97 + j // 26)}{chr(97 + j % 26)}" for j in range(i, i + 12)) for i in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "id bigint, text string")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("chain", "chain")
    got = similarity.greedy_dedup(similarity.unit_vectors(df, "id", "text"), "id").collect()
    jobs = len(tracker.getJobIdsForGroup("chain"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert {r["id"]: r.duplicate_of for r in got} == {i: i - 1 if i % 2 else None for i in range(60)}
    assert jobs < 30
