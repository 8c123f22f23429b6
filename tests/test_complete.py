"""No row, value or group is lost: cases that a sample, a prefix or an inner join would drop."""

import math
import random

import pytest
from pyspark.sql import functions as F

from quern import settings
from quern.operators import graph, matrix, sequence, similarity
from quern.operators.ordered import ranked
from quern.plans import QUERIES
from quern.plans.curation import conversation_pairs
from quern.sources import files
from quern.streaming import trailing
from quern.tables import Tables


def test_types_come_from_all_rows(spark):
    path = settings.scratch(spark, "csv")
    rows = ["a,b,c,d,e"] + [f"{i},{i / 2},true,NA,{i}" for i in range(2000)] + ["word,NaN,NA,,12"]
    spark.createDataFrame([(r,) for r in rows], "value string").coalesce(1).write.text(path)
    df = files.read_csv_inferred(spark, path)
    assert dict(df.dtypes) == {"a": "string", "b": "double", "c": "boolean", "d": "double", "e": "bigint"}
    assert df.filter("a = 'word' AND b IS NULL AND c IS NULL AND d IS NULL AND e = 12").count() == 1
    typed = files.read_csv(spark, path, "a string, b double, c boolean, d double, e bigint")
    assert typed.filter("isnan(b)").count() == 0 and typed.filter("b IS NULL").count() == 1


def test_streams_read_files_and_folders(spark, tmp_path):
    rows = [(i, float(i * 7 % 50)) for i in range(90)]
    df = spark.createDataFrame(rows, "id bigint, v double")
    df.repartition(3).write.parquet(f"{tmp_path}/orders.parquet")
    df.limit(5).write.parquet(f"{tmp_path}/orders_other.parquet")
    want = sorted(rows, key=lambda r: (-r[1], r[0]))[:10]
    stream = trailing.stream_parquet(spark, str(tmp_path), "orders")
    assert [tuple(r) for r in trailing.running_top(stream, [F.desc("v"), "id"], ["id", "v"], 10, "top").collect()] == want


def test_late_events_count_what_came_before(spark):
    path = settings.scratch(spark, "late")
    batches = [[(0, 0), (1, 1000), (2, 2000), (3, 20_000)], [(4, 2500)], [(5, 21_000), (6, 1_000_000)]]
    for part, batch in enumerate(batches):  # the second file holds an event from long before the newest
        spark.createDataFrame([(i, 1, t + 100_000) for i, t in batch], "id bigint, k bigint, ms bigint").select(
            "id", "k", F.timestamp_millis("ms").alias("ts")).coalesce(1).write.parquet(f"{path}/{part}")
    schema = spark.read.parquet(f"{path}/0").schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/*")
    out = trailing.replay(trailing.trailing_counts(stream, "k", "ts", "id", window=3_000_000, bucket=10_000_000), "late")
    assert {r["id"]: r.n for r in out.collect()} == {0: 1, 1: 2, 2: 3, 3: 1, 4: 4, 5: 2, 6: 1}


def test_replay_of_files_in_any_order_counts_all_events(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(trailing, "FILES", 1)
    rng = random.Random(6)
    rows = [(i, rng.randrange(4), 1_700_000_000_000 + i * 45_000 + rng.randrange(3) * 1000) for i in range(400)]
    rows += [(1000 + i, k, ms + 1500) for i, k, ms in rows[::3]]
    spark.createDataFrame(rows, "event_id bigint, user_id bigint, ms bigint").select(
        "event_id", "user_id", F.timestamp_millis("ms").alias("ts")).repartition(6, "event_id").write.parquet(f"{tmp_path}/events.parquet")
    got = {r.event_id: r.n for r in QUERIES["k01_streaming_trailing_count"](spark, str(tmp_path)).collect()}
    assert got == {i: sum(l == k and m - 3000 <= o and (o, j) <= (m, i) for j, l, o in rows) for i, k, m in rows}


def test_pairs_of_long_conversations(spark, tmp_path):
    turns = [(c, i, "user" if i % 2 == 0 else "assistant", f"t{i}") for c in (1, 2) for i in range(1200)]
    spark.createDataFrame(turns, "conv_id bigint, turn int, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    pairs = conversation_pairs(Tables(spark, str(tmp_path)))
    assert pairs.count() == pairs.select("id").distinct().count() == 1200


def test_groups_and_days_are_complete(spark, tmp_path):
    orders = [(i, i % 3, f"p{min(i // 4, 3)}", float(i), f"20{10 + i:02d}-01-01") for i in range(15)]  # p3 has three rows
    spark.createDataFrame(orders, "o_orderkey bigint, o_custkey bigint, o_orderpriority string, o_totalprice double, d string").withColumn(
        "o_orderdate", F.col("d").cast("timestamp_ntz")).write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(i, f"c{i}", 0) for i in range(3)], "c_custkey bigint, c_name string, c_nationkey bigint").withColumn(
        "c_mktsegment", F.lit("x")).write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(0, "n", 0)], "n_nationkey bigint, n_name string, n_regionkey bigint").write.parquet(f"{tmp_path}/nation.parquet")
    spark.createDataFrame([(0, "r")], "r_regionkey bigint, r_name string").write.parquet(f"{tmp_path}/region.parquet")
    kth = {r[0]: (r.fourth_largest, r.fourth_smallest) for r in QUERIES["f20_kth_value"](spark, str(tmp_path)).collect()}
    assert kth == {"p0": (0.0, 3.0), "p1": (4.0, 7.0), "p2": (8.0, 11.0), "p3": (None, None)}
    days = QUERIES["l17_rolling_orders_by_region"](spark, str(tmp_path)).agg(F.min("dt"), F.max("dt")).first()
    assert tuple(days) == ("2010-01-01", "2024-01-01")


def test_product_has_a_cell_wherever_entries_meet(spark):
    a = spark.createDataFrame([(0, 0, 0.0), (0, 1, 0.0), (1, 0, 2.0), (1, 0, 3.0), (2, 1, float("nan"))], "i bigint, j bigint, v double")
    b = spark.createDataFrame([(0, 0, 1.0), (0, 1, 4.0), (1, 1, 0.0)], "i bigint, j bigint, v double")
    got = {(r.i, r.j): r.v for r in matrix.product(a, b, 2).collect()}
    assert math.isnan(got.pop((2, 1)))  # and only there
    assert got == {(0, 0): 0.0, (0, 1): 0.0, (1, 0): 5.0, (1, 1): 20.0}


def test_missing_values_come_last_and_can_be_all(spark, tmp_path, both_ways):
    df = spark.createDataFrame([(i, None if i % 3 == 0 else i) for i in range(12)], "id bigint, v bigint").withColumn("k", F.lit(1))
    rows = ranked(df, ["k"], "v", "id").rows().orderBy("row_number").collect()
    assert [r["v"] for r in rows] == [11, 10, 8, 7, 5, 4, 2, 1, None, None, None, None]
    spark.createDataFrame([(1, -5.0)], "c_custkey bigint, c_acctbal double").write.parquet(f"{tmp_path}/customer.parquet")
    assert [tuple(r) for r in QUERIES["c13_fill_mean"](spark, str(tmp_path)).collect()] == [(1, None)]


def test_rounds_of_greedy_selection_do_not_follow_the_rows(spark):
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(3000)]
    texts = [" ".join(rng.choice(words) for _ in range(12)) for _ in range(3000)]
    df = spark.createDataFrame(list(enumerate(texts + texts[:500])), "id bigint, text string")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("greedy", "greedy")
    got = similarity.greedy_dedup(similarity.unit_vectors(df, "id", "text"), "id").collect()
    jobs = len(tracker.getJobIdsForGroup("greedy"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert {r["id"]: r.duplicate_of for r in got} == {i: i - 3000 if i >= 3000 else None for i in range(3500)}
    assert jobs < 60


@pytest.mark.parametrize("rows", [[], [("a", "b")]])
def test_cosine_of_empty_texts(spark, rows):
    df = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(rows)] + [(9, None, ""), (10, "one two", "two one one")],
                               "id bigint, x string, y string")
    got = {r["id"]: round(r.cosine, 6) for r in similarity.pair_cosine(df, "id", "x", "y").collect()}
    assert got[9] == 0 and got[10] == round(3 / (2 ** 0.5 * 5 ** 0.5), 6)


def test_dot_products_of_common_and_rare_tokens(monkeypatch):
    import numpy as np

    rng = np.random.default_rng(0)
    rows = [np.unique(rng.integers(0, 400, 40)) for _ in range(50)] + [np.zeros(0, np.int64)]
    sides = [similarity.Side(r, [rng.random(len(x)) for x in r]) for r in (rows, rows[::-1][:30])]
    dense = [np.zeros((s.n, 400)) for s in sides]
    for d, s in zip(dense, sides):
        d[s.rows, s.words] = s.values
    for most in (1000, 50, 0):
        monkeypatch.setattr(similarity, "DENSE", most)
        assert np.allclose(similarity.dots(*sides), dense[0] @ dense[1].T)


def test_paths_from_any_source_to_all_vertices(spark):
    edges = spark.createDataFrame([(1, 2, 5)], "src int, dst int, w int")
    assert [tuple(r) for r in graph.shortest_paths(edges, 2).collect()] == [(2, 0)]
    vertices = spark.createDataFrame([(1,), (2,), (3,)], "v int")
    assert graph.network_delay(edges, 1).first()[0] == 5
    assert graph.network_delay(edges, 1, vertices).first()[0] == -1
    with pytest.raises(ValueError):
        graph.shortest_paths(spark.createDataFrame([(1, 2, -5)], "src int, dst int, w int"), 1)


def test_circles_of_parents_end(spark):
    nodes = spark.createDataFrame([(1, 1, 2, 0, "a"), (1, 2, 1, 1, "b")], "t int, node int, parent int, side int, value string")
    with pytest.raises(ValueError):
        graph.leaf_sequence(nodes, ["t"]).count()


def test_head_start_with_a_stock(spark, both_ways):
    df = spark.createDataFrame([(1, i, x, 1) for i, x in enumerate([1, 1, 1, 50])], "k int, i int, x int, e int")
    assert [r.extra for r in sequence.head_start(df, ["k"], ["i"], "x", "x", 1, "e", 1).collect()] == [51]
    assert [r.extra for r in sequence.head_start(df, ["k"], ["i"], "x", "x", 1, "e", 9).collect()] == [47]


def test_levels_of_a_long_chain(spark):
    n = 2000
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(0, n // 2), (n + 5, n + 6), (n + 6, n + 5)], "src bigint, dst bigint")
    vertices = spark.createDataFrame([(i,) for i in range(n + 1)] + [(n + 5,), (n + 6,), (n + 9,)], "v bigint")
    got = {r.v: r.level for r in graph.levels(edges, vertices).collect()}
    assert got == {i: i for i in range(n + 1)} | {n + 9: 0}


def test_levels_in_rounds_and_at_once(spark, both_ways):
    """The two ways meet in the middle: rounds while there are many edges, one task for the rest."""
    rng = random.Random(5)
    names = [f"t{i:02d}" for i in range(40)]
    edges = {(names[a], names[b]) for a, b in (sorted(rng.sample(range(40), 2)) for _ in range(60))} | {("missing", "t03"), ("t39", "t38")}
    failed = ["t05"]
    want = {}
    for _ in names:
        for v in names:
            before = [a for a, b in edges if b == v]
            if v not in want and all(a in want and a not in failed for a in before):
                want[v] = max((want[a] + 1 for a in before), default=0)
    got = graph.levels(spark.createDataFrame(sorted(edges), "src string, dst string"), spark.createDataFrame([(v,) for v in names], "v string"),
                       spark.createDataFrame([(v,) for v in failed], "v string"))
    assert {r.v: r.level for r in got.collect()} == want and len(want) < 40


def test_edges_without_a_weight_are_left_out(spark):
    edges = spark.createDataFrame([(1, 2, None), (1, 3, 2), (3, 2, 5)], "src int, dst int, w int")
    assert {r.v: r.dist for r in graph.shortest_paths(edges, 1).collect()} == {1: 0, 3: 2, 2: 7}
    assert {r.v: r.dist for r in graph.shortest_paths(edges.limit(1), 1).collect()} == {1: 0}


def test_busy_keys_are_cut_by_time(spark):
    path = settings.scratch(spark, "busy")
    rng = random.Random(8)
    rows = [(i, i % 2, 1_000_000 + rng.randrange(40_000)) for i in range(300)]
    for part in range(3):
        spark.createDataFrame(rows[part::3], "id bigint, k bigint, ms bigint").select(
            "id", "k", F.timestamp_millis("ms").alias("ts")).coalesce(1).write.parquet(f"{path}/{part}")
    stream = spark.readStream.schema(spark.read.parquet(f"{path}/0").schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/*")
    out = trailing.replay(trailing.trailing_counts(stream, "k", "ts", "id", hot=[0], bucket=10_000_000), "busy")
    got = {r.id: r.n for r in out.groupBy("id").agg(F.max("n").alias("n")).collect()}
    assert got == {i: sum(l == k and m - 3000 <= o and (o, j) <= (m, i) for j, l, o in rows) for i, k, m in rows}
