"""Operators against brute force on random data, with plain windows and with split keys."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quern.operators import curation, graph, profile, regress, sequence, similarity
from quern.operators import quantiles
from quern.operators.ordered import Ordered, position, running, shift, total


def sequences(seed, keys=4, most=60, items=5):
    rng = random.Random(seed)
    # one key holds most of the rows, one order column has many ties
    return {k: [rng.randint(0, items) for _ in range(most if k == 0 else rng.randint(1, 9))] for k in range(keys)}


def frame(spark, data):
    rows = [(k, i // 3, i, v) for k, values in data.items() for i, v in enumerate(values)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "k int, a int, b int, v bigint")


def test_scans(spark, both_ways):
    data = sequences(3)
    o = Ordered(frame(spark, data), ["k"], ["a", "b"]).scan(
        i=position(), s=running("sum", "v"), m=running("max", "v", before=True), r=running("min", "v", reverse=True),
        p=shift("v"), q=shift("v", reverse=True), t=total("sum", "v"))
    for row in o.rows().collect():
        values, i = data[row.k], row.b
        assert (row.i, row.s, row.t) == (i + 1, sum(values[: i + 1]), sum(values))
        assert row.m == (max(values[:i]) if i else None) and row.r == min(values[i:])
        assert row.p == (values[i - 1] if i else None) and row.q == (values[i + 1] if i + 1 < len(values) else None)


def test_scan_with_null_keys_and_values(spark, both_ways):
    rows = [(None, i, None if i % 2 else i) for i in range(20)] + [(1, 0, None)]
    o = Ordered(spark.createDataFrame(rows, "k int, i int, v int"), ["k"], ["i"]).scan(
        s=running("sum", "v"), p=shift("v"), n=position())
    for r in o.rows().collect():
        if r.k is None:
            assert r.n == r.i + 1 and r.s == sum(x for x in range(r.i + 1) if x % 2 == 0)
            assert r.p == (r.i - 1 if r.i and (r.i - 1) % 2 == 0 else None)


def test_scan_without_keys(spark, both_ways):
    values = [random.Random(5).randint(0, 9) for _ in range(50)]
    df = spark.createDataFrame(list(enumerate(values)), "i int, v int").repartition(4)
    rows = Ordered(df, [], ["i"]).scan(s=running("sum", "v"), p=shift("v")).rows().collect()
    assert {r.i: (r.s, r.p) for r in rows} == {i: (sum(values[: i + 1]), values[i - 1] if i else None) for i in range(50)}


@pytest.mark.parametrize("probs", [[0.25, 0.5, 0.75], [0.0, 0.9, 1.0]])
def test_quantiles(spark, both_ways, probs):
    data = sequences(7, most=700, items=300)
    for r in quantiles.exact_quantiles(frame(spark, data), ["k"], ["v"], probs).collect():
        assert [r[f"q{i}"] for i in range(3)] == pytest.approx(list(np.quantile(data[r.k], probs)))


def test_quantiles_of_doubles_of_all_sizes(spark, both_ways):
    """Signs, neighbouring doubles, infinities of scale, ties and missing values, several columns at once."""
    rng = np.random.default_rng(3)
    wild = np.concatenate([rng.choice([-1, 1], 500) * 10.0 ** rng.uniform(-300, 300, 500), np.nextafter(1.0, 2.0) * np.ones(40), np.ones(41), [0.0, -0.0]])
    near = 1e15 + rng.integers(0, 4000, len(wild)) / 8
    rows = [(i % 3 if i % 50 else None, float(a), float(b) if i % 7 else None, float("nan") if i % 5 == 0 else 1.5) for i, (a, b) in enumerate(zip(wild, near))]
    df = spark.createDataFrame(rows, "k int, a double, b double, c double")
    probs = [0.0, 0.1, 0.5, 0.77, 1.0]
    got = {(r.k, r.column): r for r in quantiles.exact_quantiles(df, ["k"], ["a", "b", "c"], probs).collect()}
    for k in range(3):
        for c in range(3):
            held = [r[c + 1] for r in rows if r[0] == k and r[c + 1] is not None and r[c + 1] == r[c + 1]]
            assert got[k, c].n == len(held)
            assert [got[k, c][f"q{i}"] for i in range(len(probs))] == pytest.approx(list(np.quantile(held, probs)), rel=1e-12)
    assert len(got) == 9
    assert quantiles.exact_quantiles(df.filter("a > 1e301"), ["k"], ["a", "b"], probs).count() == 0


def test_nan_is_missing_in_profiles(spark):
    df = spark.createDataFrame([(1, 1.0, None), (1, 2.0, None), (1, float("nan"), None), (1, 4.0, None)], "k int, v double, none double")
    v, none = profile.describe_numeric(df, ["v", "none"]).orderBy(F.desc("column_name")).collect()
    assert tuple(v)[:3] == ("v", 3, pytest.approx(7 / 3)) and (v["min"], v["p50"], v["max"]) == (1.0, 2.0, 4.0)
    assert tuple(none) == ("none", 0, *[None] * 7)
    box = profile.box_plot(df, ["k"], "v").first()
    assert (box.q1, box.median, box.q3, box.outliers) == (1.5, 2.0, 3.0, 0)


@pytest.mark.parametrize("k", [1, 2, 3])
def test_longest_with_distinct(spark, both_ways, k):
    data = sequences(11)
    for r in sequence.longest_with_distinct(frame(spark, data), ["k"], ["a", "b"], "v", k).collect():
        v = data[r.k]
        assert r.longest == max(b - a for a in range(len(v)) for b in range(a + 1, len(v) + 1) if len(set(v[a:b])) <= k)


def test_reuse_distance(spark, both_ways):
    data = sequences(13, items=12)
    for r in sequence.reuse_distance(frame(spark, data), ["k"], ["a", "b"], "v").collect():
        v, i = data[r.k], r.i - 1
        past = [j for j in range(i) if v[j] == v[i]]
        assert r.distance == (len(set(v[past[-1] + 1 : i])) if past else None)


@pytest.mark.parametrize("target", [1, 9, 40, 1000])
def test_shortest_run(spark, both_ways, target):
    data = sequences(17)
    for r in sequence.shortest_run_reaching(frame(spark, data), ["k"], ["a", "b"], "v", target).collect():
        v = data[r.k]
        hits = [b - a for a in range(len(v)) for b in range(a + 1, len(v) + 1) if sum(v[a:b]) >= target]
        assert r.shortest == min(hits, default=0)


def texts(seed, n=60):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcde") for _ in range(rng.randint(2, 5))) for _ in range(30)]
    out = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 12))) for _ in range(n)]
    return out + [out[0]] * 20  # a group of copies


def vector(text):
    return Counter(w for w in text.split() if len(w) >= 3)


def cos(a, b):
    dot = sum(n * b[w] for w, n in a.items())
    size = (sum(n * n for n in a.values()) * sum(n * n for n in b.values())) ** 0.5
    return dot / size if size else 0.0


@pytest.mark.parametrize("threshold", [0.4, 0.85])
def test_near_duplicates(spark, threshold):
    given = texts(19)
    vs = [vector(x) for x in given]
    df = spark.createDataFrame(list(enumerate(given)), "id bigint, text string")
    units = similarity.unit_vectors(df, "id", "text")
    want = {}
    for i in range(len(vs)):
        hits = [j for j in range(i) if cos(vs[i], vs[j]) >= threshold - 1e-12]
        if hits:
            want[i] = hits[0]
    for block in (512, 7):
        got = {r["id"]: r["match"] for r in similarity.earlier_match(units, "id", threshold, block).collect()}
        assert got == want
    bad = {3, 8}
    accepted, struck = [], {}
    for i in range(len(vs)):
        by = next((j for j in accepted if cos(vs[i], vs[j]) >= threshold - 1e-12), None)
        struck[i] = by
        if by is None and i not in bad:
            accepted.append(i)
    flagged = units.withColumn("good", ~F.col("id").isin(*bad))
    for chunk in (1024, 9):
        rows = similarity.greedy_dedup(flagged, "id", threshold, "good", chunk).collect()
        assert {r["id"]: r.duplicate_of for r in rows} == struck and len(rows) == len(vs)


def test_most_similar(spark):
    rng = np.random.default_rng(2)
    m = rng.normal(size=(40, 8))
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(m)], "id bigint, v array<double>")
    unit = m / np.linalg.norm(m, axis=1, keepdims=True)
    c = unit @ unit.T - 5 * np.eye(40)
    for block in (4096, 6):
        got = {r["id"]: (r.nearest, round(r.cosine, 9)) for r in similarity.most_similar(df, "id", "v", block).collect()}
        assert got == {i: (int(c[i].argmax()), round(float(c[i].max()), 9)) for i in range(40)}


def test_components_and_paths(spark, both_ways):
    rng = random.Random(23)
    pairs = [(rng.randrange(40), rng.randrange(40), rng.randint(1, 9)) for _ in range(35)] + [(0, j, 50) for j in range(1, 25)]
    df = spark.createDataFrame(pairs, "src int, dst int, w int")
    vertices = spark.createDataFrame([(i,) for i in range(45)], "v int")
    label = list(range(45))
    for _ in range(45):
        for a, b, _w in pairs:
            label[a] = label[b] = min(label[a], label[b])
    assert {r.v: r.label for r in graph.components(df, vertices).collect()} == dict(enumerate(label))
    dist = {0: 0}
    for _ in range(45):
        for a, b, w in pairs:
            if a in dist:
                dist[b] = min(dist.get(b, 10**9), dist[a] + w)
    assert {r.v: r.dist for r in graph.shortest_paths(df, 0).collect()} == dist


def test_ridge_matches_closed_form(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(200, 3)) * [1.0, 5.0, 0.3]
    y = x @ [2.0, -1.0, 4.0] + 7 + rng.normal(size=200)
    df = spark.createDataFrame([(*map(float, r), float(t)) for r, t in zip(x, y)], "a double, b double, c double, y double")
    got = {r.term: r.value for r in regress.ridge(df, df, ["a", "b", "c"], "y", 0.1).collect()}
    xc, yc = x - x.mean(axis=0), y - y.mean()
    beta = np.linalg.solve(xc.T @ xc + 0.1 * np.eye(3), xc.T @ yc)
    assert [got["a"], got["b"], got["c"]] == pytest.approx(list(beta), rel=1e-6)
    plain = {r.term: r.value for r in regress.fit(df, ["a", "b", "c"], "y").collect()}
    exact = np.linalg.lstsq(np.c_[x, np.ones(200)], y, rcond=None)[0]
    assert [plain["a"], plain["b"], plain["c"], plain["intercept"]] == pytest.approx(list(exact), rel=1e-6)


def test_transcript_lines(spark, both_ways):
    turns = spark.createDataFrame([(c, i, f"{c}-{i}" + "x" * i) for c in range(2) for i in range(30)], "c int, i int, t string")
    rows = curation.transcripts(turns, ["c"], "i", F.col("t")).orderBy("c", "place").collect()
    for c in range(2):
        mine = [r for r in rows if r.c == c]
        whole = "\n".join(r.line for r in mine)
        assert whole == "\n".join(f"{c}-{i}" + "x" * i for i in range(30))
        assert all(whole[r.start:].startswith(r.line) and r.place == i for i, r in enumerate(mine))


def test_streaming_matches_batch(spark):
    """A busy key crosses several buckets; three files arrive one after the other."""
    from quern import settings
    from quern.streaming import trailing

    rng = random.Random(29)
    at = sorted(rng.randrange(0, 60_000) for _ in range(300))
    rows = [(i, 1 if i % 3 else 2, t) for i, t in enumerate(at)]
    path = settings.scratch(spark, "replay")
    for part in range(3):
        chunk = spark.createDataFrame(rows[part * 100 : part * 100 + 100], "id bigint, k bigint, ms bigint")
        chunk.select("id", "k", F.timestamp_millis("ms").alias("ts")).coalesce(1).write.parquet(f"{path}/events{part}.parquet")
    schema = spark.read.parquet(f"{path}/events0.parquet").schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/*")
    out = trailing.trailing_counts(stream, "k", "ts", "id", window=3_000_000, bucket=10_000_000)
    got = {r["id"]: r.n for r in trailing.replay(out, "replayed").collect()}
    assert got == {i: sum(1 for j, kk, u in rows if kk == k and j <= i and u >= t - 3000) for i, k, t in rows}
