"""Small inputs with known right answers, with and without splitting keys."""

import pytest
from pyspark.sql import functions as F

from quern.functions import expressions as X
from quern.operators import curation, graph, intervals, joins, matrix, sequence
from quern.operators.ordered import ntile, ranked
from quern.plans.aggregates import anagram_groups, is_one_to_one


def seq(spark, values, kind="bigint"):
    return spark.createDataFrame([(1, i, v) for i, v in enumerate(values)], f"k int, i int, v {kind}")


def one(df, column):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0][column]


def scalar(spark, make, *values):
    df = spark.createDataFrame([values], [f"c{i}" for i in range(len(values))])
    return df.select(make(*[F.col(f"c{i}") for i in range(len(values))]).alias("x")).first()["x"]


@pytest.mark.parametrize("given, want", [
    ([(1, 4), (0, 2), (3, 5)], [(0, 5)]),
    ([(1, 3), (2, 6), (8, 10), (15, 18)], [(1, 6), (8, 10), (15, 18)]),
    ([(1, 4), (4, 5)], [(1, 5)]),
])
def test_merge(spark, both_ways, given, want):
    df = spark.createDataFrame([(1, a, b) for a, b in given], "k int, start int, end int")
    assert sorted((r.start, r.end) for r in intervals.merge(df, ["k"]).collect()) == want


def test_max_concurrent(spark, both_ways):
    given = [(0, 30), (10, 20), (20, 30), (5, 10), (15, 20)]
    df = spark.createDataFrame([(1, a, b) for a, b in given], "k int, start int, end int")
    assert one(intervals.max_concurrent(df, ["k"]), "rooms") == 3


def test_cover_counts(spark, both_ways):
    df = spark.createDataFrame([(1, 17, 86)], "k int, start int, end int")
    points = spark.createDataFrame([(1, p) for p in (16, 17, 39, 86, 87)], "k int, at int")
    got = {r.at: r.n for r in intervals.cover_counts(df, points, ["k"]).collect()}
    assert got == {16: 0, 17: 1, 39: 1, 86: 1, 87: 0}


@pytest.mark.parametrize("brackets, income, want", [
    ([(3, 50), (7, 10), (12, 25)], 10.0, 2.65), ([(1, 0), (4, 25), (5, 50)], 2.0, 0.25), ([(2, 50)], 0.0, 0.0)])
def test_bracket_tax(spark, brackets, income, want):
    assert scalar(spark, lambda c: X.bracket_tax(c, brackets), income) == pytest.approx(want)


def test_pairs_at_distance(spark):
    got = joins.pairs_at_distance(seq(spark, [1, 3, 5, 7, 9]), ["k"], "v", 2).collect()
    assert sorted((r.low, r.high) for r in got) == [(1, 3), (3, 5), (5, 7), (7, 9)]


@pytest.mark.parametrize("values, target, want", [([1, 2, 3, 4], 5, 2), ([3, 1, 3, 4, 3], 6, 1)])
def test_pair_operations(spark, values, target, want):
    assert one(joins.pair_operations(seq(spark, values), ["k"], "v", target), "operations") == want


def test_nearest_item(spark, both_ways):
    text = "a very sleepy teapot"
    out = intervals.nearest_item(seq(spark, list(text), "string"), ["k"], ["i"], "v", "e")
    want = [min(abs(i - j) for j, c in enumerate(text) if c == "e") for i in range(len(text))]
    assert [r.distance for r in out.orderBy("i").collect()] == want


def test_closest_pairs(spark, both_ways):
    got = intervals.closest_pairs(seq(spark, [4, 2, 1, 3, 9]), ["k"], "v").collect()
    assert sorted((r.low, r.high) for r in got) == [(1, 2), (2, 3), (3, 4)]


@pytest.mark.parametrize("text, size", [("aabbccc", 6), ("a" + 12 * "b", 4)])
def test_run_length(spark, both_ways, text, size):
    assert one(sequence.rle_size(seq(spark, list(text), "string"), ["k"], ["i"], "v"), "size") == size


@pytest.mark.parametrize("colors, cost, want", [
    ("abaac", [1, 2, 3, 4, 5], 3), ("aabaa", [1, 2, 3, 4, 1], 2), ("aaabbbabbbb", [3, 5, 10, 7, 5, 3, 5, 5, 4, 8, 1], 26)])
def test_keep_one_per_run(spark, both_ways, colors, cost, want):
    df = spark.createDataFrame([(1, i, c, n) for i, (c, n) in enumerate(zip(colors, cost))], "k int, i int, c string, n bigint")
    assert one(sequence.keep_one_per_run(df, ["k"], ["i"], "c", "n"), "cost") == want


def test_break_triples(spark, both_ways):
    assert one(sequence.break_triples(seq(spark, list("baaaaaaaab"), "string"), ["k"], ["i"], "v"), "changes") == 2


@pytest.mark.parametrize("bed, want", [([0, 0, 1, 0, 1], 1), ([1, 0, 0, 0, 1], 1), ([0, 0, 0], 2), ([1, 0, 0, 0, 0, 0], 2)])
def test_free_slots(spark, both_ways, bed, want):
    df = seq(spark, [bool(b) for b in bed], "boolean")
    assert one(sequence.free_slots(df, ["k"], ["i"], "v"), "capacity") == want


def test_beams(spark, both_ways):
    rows = [(1, r, c == "1") for r, line in enumerate(["011001", "000000", "010100", "001000"]) for c in line]
    df = spark.createDataFrame(rows, "k int, r int, m boolean")
    assert one(sequence.beams(df, ["k"], "r", "m"), "beams") == 8


@pytest.mark.parametrize("code, k, want", [
    ([5, 7, 1, 4], 3, [12, 10, 16, 13]), ([1, 2, 3, 4], 0, [0, 0, 0, 0]), ([5, 2, 2, 3, 1], 3, [7, 6, 9, 8, 9]),
    ([2, 4, 9, 3], -2, [12, 5, 6, 13])])
def test_circular_sum(spark, both_ways, code, k, want):
    out = sequence.circular_sum(seq(spark, code), ["k"], ["i"], "v", k)
    assert [r.circular for r in out.orderBy("i").collect()] == want


@pytest.mark.parametrize("values, want", [([2, 3, 1], 11), ([3, 1, 1, 2], 13), ([1, 2, 3], 10)])
def test_variable_frame(spark, both_ways, values, want):
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate(values)], "k int, o int, v bigint")
    assert one(sequence.variable_frame_sum(df, ["k"], ["o"], "v"), "total") == want


@pytest.mark.parametrize("values, target, want", [
    ([2, 3, 1, 2, 4, 3], 7, 2), ([1, 4, 4], 4, 1), ([1] * 8, 11, 0), ([1, 2, 3, 4, 6], 6, 1), ([5, 1, 3, 5, 10, 7, 4, 9, 2, 8], 15, 2)])
def test_shortest_run(spark, both_ways, values, target, want):
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate(values)], "k int, o int, v bigint")
    assert one(sequence.shortest_run_reaching(df, ["k"], ["o"], "v", target), "shortest") == want


@pytest.mark.parametrize("text, want", [("pwwkew", 3), ("abcabcbb", 3), ("bbbbb", 1), ("aab", 2), ("dvdf", 3), ("abad", 3)])
def test_longest_without_repeat(spark, both_ways, text, want):
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate(text)], "k int, o int, v string")
    assert one(sequence.longest_without_repeat(df, ["k"], ["o"], "v"), "longest") == want


@pytest.mark.parametrize("text, k, want", [("eceba", 2, 3), ("abcabc", 3, 6), ("abaccc", 2, 4), ("aaaa", 1, 4), ("abcd", 1, 1)])
def test_longest_with_distinct(spark, both_ways, text, k, want):
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate(text)], "k int, o int, v string")
    assert one(sequence.longest_with_distinct(df, ["k"], ["o"], "v", k), "longest") == want


def test_every_third_free(spark, both_ways):
    for prices, want in (([9, 9, 9, 9], 27), ([6, 5, 7, 9, 2, 2], 23)):
        rows = ranked(seq(spark, prices), ["k"], "v", "i").rows()
        assert sum(r.v for r in rows.filter(F.col("row_number") % 3 != 0).collect()) == want


def test_kth(spark, both_ways):
    rows = ranked(seq(spark, [3, 2, 3, 1, 2, 4, 5, 5, 6]), ["k"], "v", "i").rows().collect()
    largest = {r.row_number: r.v for r in rows}
    assert (largest[2], largest[4]) == (5, 4)
    assert (largest[9 - 2 + 1], largest[9 - 4 + 1]) == (2, 3)


def test_head_start(spark, both_ways):
    df = spark.createDataFrame([(1, i, 1, t) for i, t in enumerate([1, 1, 1, 50])], "k int, i int, v bigint, t bigint")
    # energy: sum + 1 - 1 = 4, experience: 47 more
    assert 4 + one(sequence.head_start(df, ["k"], ["i"], "v", "t", 1), "extra") == 51


@pytest.mark.parametrize("names, want", [("abab", True), ("aaaa", True), ("abba", False), ("aa", False), ("xxabab", True)])
def test_repeated_pair(spark, both_ways, names, want):
    assert one(sequence.repeated_pair(seq(spark, list(names), "string"), ["k"], ["i"], F.col("v")), "looping") is want


def test_trailing_count(spark, both_ways):
    df = spark.createDataFrame([(1, i, t) for i, t in enumerate([1, 100, 3001, 3002])], "k int, id int, t bigint")
    out = sequence.trailing_count(df, ["k"], "t", "id", 3000)
    assert [r.n for r in out.orderBy("id").collect()] == [1, 2, 3, 3]


def test_softmax(spark, both_ways):
    rows = sequence.softmax(seq(spark, [1.0, 2.0, 3.0], "double"), ["k"], ["i"], "v").orderBy("i").collect()
    assert [round(r.softmax, 4) for r in rows] == [0.09, 0.2447, 0.6652]


def test_reuse_distance(spark, both_ways):
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate("abcbacdd")], "k int, o int, v string")
    rows = sequence.reuse_distance(df, ["k"], ["o"], "v").orderBy("i").collect()
    assert [r.distance for r in rows] == [None, None, None, 1, 2, 2, None, 0]


def test_ntile(spark, both_ways):
    for n in (1, 3, 4, 7, 10):
        rows = ranked(seq(spark, list(range(n))), ["k"], "v", "i").rows().withColumn("t", ntile(4))
        tiles = [r.t for r in rows.orderBy("row_number").collect()]
        sizes = [n // 4 + (i < n % 4) for i in range(4)]
        assert tiles == [i + 1 for i, s in enumerate(sizes) for _ in range(s)]


def test_anagrams(spark, both_ways):
    words = "eat tea tan ate nat bat ac bd ca abc cba bac bca cab".split()
    rows = anagram_groups(spark.createDataFrame([(w,) for w in words], "word string")).collect()
    groups = {}
    for r in rows:
        groups.setdefault(r.letters, set()).add(r.word)
        assert r.size == len({w for w in words if sorted(w) == sorted(r.word)})
    assert {frozenset(g) for g in groups.values()} >= {frozenset({"eat", "tea", "ate"}), frozenset({"tan", "nat"})}


@pytest.mark.parametrize("pattern, words, want", [
    ("abba", "dog dog dog dog", False), ("abba", "dog cat cat dog", True), ("aaaa", "dog cat cat dog", False),
    ("abba", "dog cat cat fish", False)])
def test_one_to_one(spark, pattern, words, want):
    df = spark.createDataFrame(list(zip(pattern, words.split())), "a string, b string")
    assert one(is_one_to_one(df, "a", "b"), "one_to_one") is want


def test_emails(spark):
    mails = ["test.email+alex@host.com", "test.e.mail+bob.cathy@host.com", "testemail+david@ho.st.com"]
    df = spark.createDataFrame([(m,) for m in mails], "m string")
    assert df.select(X.canonical_email(F.col("m")).alias("c")).distinct().count() == 2
    valid = {"a_1@host.com": True, "a@host.com.au": False, "a@h0st.com": False, "a b@host.com": False}
    for mail, want in valid.items():
        assert scalar(spark, X.is_valid_email, mail) is want


@pytest.mark.parametrize("text, want", [
    ("SN1234-5678", True), ("x SN1234-5678 y", True), ("SN1234-56789", False), ("SN123-5678", False)])
def test_serial(spark, text, want):
    assert scalar(spark, X.has_valid_serial, text) is want


@pytest.mark.parametrize("text, want", [
    ("1337c0d3", 1337), ("  -042", -42), ("words 1", 0), ("+7", 7), ("99999999999999999999", 2147483647), ("-91283472332", -2147483648)])
def test_lenient_int(spark, text, want):
    assert scalar(spark, X.lenient_int, text) == want


def test_words(spark):
    assert scalar(spark, X.reverse_words, "the sky is blue") == "blue is sky the"
    assert scalar(spark, X.reverse_words, "  a   b ") == "b a"
    assert scalar(spark, X.last_word_length, "Hello World  ") == 5
    weights = [5, 3, 12, 14, 1, 2, 3, 2, 10, 6, 6, 9, 7, 8, 7, 10, 8, 9, 6, 9, 9, 8, 3, 7, 7, 2]
    assert scalar(spark, lambda c: X.word_weights(c, weights), ["abcd", "def", "xyz"]) == "rij"


def test_fit_context(spark):
    df = spark.createDataFrame([("non-think", 192), ("non-think", 9000)], "m string, r int").withColumn(
        "t", F.transform(F.sequence(F.lit(0), F.lit(9999)), lambda x: x.cast("string")))
    rows = df.select(X.fit_context(F.col("t"), F.col("m"), F.col("r")).alias("x")).collect()
    assert [int(x) for x in rows[0].x] == list(range(2000, 10000)) and rows[1].x == []
    with pytest.raises(Exception, match="invalid mode"):
        df.select(X.fit_context(F.col("t"), F.lit("deep"), F.col("r"))).collect()


def test_cosine(spark):
    assert scalar(spark, matrix.cosine, [1.0, 2.0, 3.0], [2.0, 4.0, 6.0]) == pytest.approx(1.0)
    assert scalar(spark, matrix.cosine, [0.0, 0.0], [2.0, 4.0]) is None


def coords(spark, rows):
    return spark.createDataFrame([(i, j, float(v)) for i, r in enumerate(rows) for j, v in enumerate(r)], "i bigint, j bigint, v double")


@pytest.mark.parametrize("block", [512, 2])
def test_product(spark, block):
    a = [[3 * i + j + 1 for j in range(5)] for i in range(3)]
    b = [[9 - 2 * i + j for j in range(7)] for i in range(5)]
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # keep the blocks in separate partitions
    try:
        rows = matrix.product(coords(spark, a), coords(spark, b), block).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert {(r.i, r.j): r.v for r in rows} == {
        (i, j): sum(a[i][k] * b[k][j] for k in range(5)) for i in range(3) for j in range(7)}


def test_covariance(spark):
    df = spark.createDataFrame([([1.0, 4.0, 7.0],), ([2.0, 5.0, 8.0],), ([3.0, 6.0, 9.0],)], "v array<double>")
    assert {round(r.v, 9) for r in matrix.covariance(df, "v").collect()} == {1.0}


def test_skyline(spark):
    grid = coords(spark, [[3, 0, 8, 4], [2, 4, 5, 7], [9, 2, 6, 3], [0, 3, 1, 0]])
    assert one(matrix.skyline_gain(grid), "gain") == 35


def test_neighbour_counts(spark):
    marks = spark.createDataFrame([(1, 1), (1, 1), (3, 3)], "i bigint, j bigint")
    got = {(r.i, r.j): r.n for r in matrix.neighbour_counts(marks, 3, 3).collect()}
    assert got[1, 1] == -1 and got[2, 2] == 2 and got[1, 2] == 1 and got[1, 3] == 0 and len(got) == 9


def edges(spark, rows):
    return spark.createDataFrame(rows, "src int, dst int, w int")


def test_network_delay(spark, both_ways):
    assert one(graph.network_delay(edges(spark, [(2, 1, 1), (2, 3, 1), (3, 4, 1)]), 2), "delay") == 2
    assert one(graph.network_delay(edges(spark, [(1, 2, 1), (2, 3, 2), (1, 3, 4)]), 1), "delay") == 3
    assert one(graph.network_delay(edges(spark, [(1, 2, 1)]), 2), "delay") == -1


def test_levels_and_cycles(spark, both_ways):
    circle = edges(spark, [(0, 1, 0), (1, 2, 0), (2, 0, 0)])
    assert graph.levels(circle, graph.vertices_of(circle)).count() == 0
    assert one(graph.is_acyclic(circle), "acyclic") is False
    line = edges(spark, [(0, 1, 0), (1, 2, 0), (0, 2, 0)])
    assert sorted(map(tuple, graph.levels(line, graph.vertices_of(line)).collect())) == [(0, 0), (1, 1), (2, 2)]


def letters(spark, words):
    out = graph.letter_levels(spark.createDataFrame(list(enumerate(words)), "i int, w string"), "w").collect()
    return "".join(r.v for r in sorted(out, key=lambda r: r.level)) if len(out) == len(set("".join(words))) else ""


def test_letter_order(spark):
    assert letters(spark, ["wrt", "wrf", "er", "ett", "rftt"]) == "wertf"
    assert letters(spark, ["z", "x", "z"]) == ""
    assert letters(spark, ["abc", "ab"]) == ""


def test_is_tree(spark, both_ways):
    vertices = spark.createDataFrame([(i,) for i in range(5)], "v int")
    tree = [(0, 1, 0), (0, 2, 0), (0, 3, 0), (1, 4, 0)]
    assert one(graph.is_tree(edges(spark, tree), vertices), "is_tree") is True
    assert one(graph.is_tree(edges(spark, [(0, 1, 0), (1, 2, 0), (2, 3, 0), (1, 3, 0), (1, 4, 0)]), vertices), "is_tree") is False
    assert one(graph.is_tree(edges(spark, [(0, 1, 0), (1, 2, 0), (2, 0, 0), (3, 4, 0)]), vertices), "is_tree") is False


def tree_rows(key, tree, levels):
    """Nodes of a tree given in level order, None for a missing child."""
    rows, parents, at = [(key, tree, 0, None, 0, levels[0])], [0], 1
    while at < len(levels):
        parent = parents.pop(0)
        for side in (0, 1):
            if at < len(levels) and levels[at] is not None:
                rows.append((key, tree, at, parent, side, levels[at]))
                parents.append(at)
            at += 1
    return rows


def test_same_leaves(spark, both_ways):
    pairs = [([3, 5, 1, 6, 2, 9, 8, None, None, 7, 4], [3, 5, 1, 6, 7, 4, 2, None, None, None, None, None, None, 9, 8]),
             ([1, 2, 3], [1, 3, 2]), ([1, 2], [2, 2]), ([1], [2])]
    rows = [r for k, (a, b) in enumerate(pairs) for r in tree_rows(k, 0, a) + tree_rows(k, 1, b)]
    nodes = spark.createDataFrame(rows, "k int, tree int, node int, parent int, side int, value int")
    got = {r.k: r.same for r in graph.same_leaves(nodes, "k", "tree").collect()}
    assert got == {0: True, 1: False, 2: True, 3: False}


def test_task_levels(spark):
    rows = [(1, [], "done"), (2, [1], "failed"), (3, [1], "done"), (4, [3], "done"), (5, [2, 4], "done"), (6, [7], "done"),
            (7, [6], "done"), (8, [99], "done")]
    out = graph.task_levels(spark.createDataFrame(rows, "task_id int, depends_on array<int>, status string")).collect()
    got = {r.task_id: (r.level, r.state) for r in out}
    assert got == {1: (0, "done"), 2: (1, "failed"), 3: (1, "done"), 4: (2, "done"), 5: (-1, "stuck"), 6: (-1, "stuck"),
                   7: (-1, "stuck"), 8: (-1, "stuck")}


def test_tier_targets():
    assert list(curation.tier_targets(500).values()) == [100, 125, 125, 60, 50, 40]
    assert list(curation.tier_targets(20).values()) == [4, 5, 5, 2, 2, 2]


def test_one_letter_neighbours(spark):
    words = spark.createDataFrame([(w,) for w in ("hit", "hot", "dot", "dog", "cog", "hits")], "w string")
    got = {(r.a, r.b) for r in joins.one_letter_neighbours(words, "w").collect()}
    assert got == {("hit", "hot"), ("dot", "hot"), ("dog", "dot"), ("cog", "dog")}
