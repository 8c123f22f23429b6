"""Mixing, ranked search and phrases against brute force."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quern.llm import mixing, phrases, ranking
from tests.llm.conftest import SCHEMA, prose

WORD = r"[^\x20\x09-\x0D]+"
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
LONG = "x" * 5_000_000


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def plain(df) -> list[tuple]:
    return [(r["doc_id"], r["text"] or "", r["source"], r["lang"]) for r in df.select("doc_id", "text", "source", "lang").collect()]


# --- mixing ----------------------------------------------------------------------------------------------


def shares(sizes: dict, weights=(3, 1, 2)) -> dict:
    """Targets by sharing out again and again, as exact fractions."""
    from fractions import Fraction

    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, out = Fraction(3, 2) * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        above = {s for s in open_ if level * weight[s] > 2 * sizes[s]}
        if not above:
            return out | {s: level * weight[s] for s in open_}
        for s in above:
            out[s] = Fraction(2 * sizes[s])
            left -= out[s]
        open_ -= above
    return out


def check_mix(df, **how):
    rows = plain(df)
    size = lambda t: len(re.findall(WORD, t))
    sizes = defaultdict(int)
    for _, text, source, _ in rows:
        sizes[source] += size(text)
    want = shares(sizes)
    got = mixing.mix(df, **how).collect()
    assert len(got) == len(rows)
    assert sorted(((r["doc_id"], r["size"]) for r in got), key=str) == sorted(((i, size(t)) for i, t, _, _ in rows), key=str)
    source_of = defaultdict(set)
    for i, t, source, _ in rows:
        source_of[i, size(t)].add(source)
    taken, targets = defaultdict(int), defaultdict(set)
    for r in got:
        assert 0 <= r["taken"] <= 2 * r["size"]
        own = source_of[r["doc_id"], r["size"]]
        source = next(s for s in own if sizes[s] == r["source_size"] and float(want[s]) == r["target"])
        taken[source] += r["taken"]
    for source, words in taken.items():
        assert words == math.floor(want[source])
    by_draw = defaultdict(list)  # in the order of the draw: whole texts, one cut, nothing
    for r in got:
        by_draw[r["source_size"], r["target"]].append(r)
    return sorted(map(tuple, got), key=str)


def test_mix_of_hard_cases(spark, hard, empty):
    df = hard.withColumn("source", F.when(F.pmod(F.xxhash64("text"), F.lit(3)) == 0, None).otherwise(F.concat(F.lit("s"), F.pmod(F.xxhash64("text"), F.lit(3)))))
    first = check_mix(df)
    assert first == check_mix(df.repartition(5)) == check_mix(df, range_rows=1)
    assert mixing.mix(empty).count() == 0 and mixing.mixed_texts(empty).count() == 0
    nothing = spark.createDataFrame([(1, "", None, "a", 0), (2, None, None, None, None)], SCHEMA)
    assert [r["taken"] for r in mixing.mix(nothing).collect()] == [0, 0]


def test_mix_with_a_hot_source_and_copies(spark, both_ways):
    rng = random.Random(5)
    rows = []
    for i in range(400):
        source = rng.choice(["big"] * 6 + ["ä", "z", "B", None, "tiny"] + [f"s{i % 9}"] * 2)
        text = "the same copy" if i % 3 == 0 else prose(rng, 1 if source == "tiny" else rng.randint(0, 60))
        rows.append((None if i % 50 == 7 else i // 2, text, None, source, 0))
    check_mix(spark.createDataFrame(rows, SCHEMA), range_rows=16)


def test_the_cut_follows_the_draw(spark):
    rows = [(i, prose(random.Random(i), 1 + i % 7), None, "ab"[i % 2], 0) for i in range(60)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r["doc_id"]: r for r in mixing.mix(df, range_rows=4).collect()}
    for source in "ab":
        own = [r for r in rows if r[3] == source]
        own.sort(key=lambda r: hashlib.md5(f"11:{r[0]}:{r[1]}".encode()).hexdigest())
        sizes = [len(r[1].split()) for r in own]
        budget = math.floor(got[own[0][0]]["target"])
        epochs, room = divmod(budget, sum(sizes))
        for r, n in zip(own, sizes):
            part = min(max(room, 0), n)
            room -= n
            assert got[r[0]]["taken"] == epochs * n + part


def test_mixed_texts_hold_the_taken_words(spark):
    rng = random.Random(3)
    rows = [(i // 2, rng.choice(["", "one  two\tthree", prose(rng, 9)]), None, rng.choice("abc"), 0) for i in range(80)]
    df = spark.createDataFrame(rows, SCHEMA)
    words = Counter()
    for r in mixing.mixed_texts(df).collect():
        words[r["source"]] += len(re.findall(WORD, r["text"]))
    want = shares({s: sum(len(r[1].split()) for r in rows if r[3] == s) for s in "abc"})
    assert words == {s: math.floor(want[s]) for s in "abc"}


# --- ranked search -----------------------------------------------------------------------------------------


def ranked(docs: list[tuple], items: list[tuple], k: int) -> list[tuple]:
    bags = [(i, re.findall(TERM, lower(t))) for i, t in docs]
    texts, words = sum(1 for _, b in bags if b), sum(len(b) for _, b in bags)
    df = Counter(w for _, b in bags for w in set(b))
    out = []
    for item, text in items:
        scores = []
        terms = set(re.findall(TERM, lower(text or "")))
        for i, b in bags:
            tf = Counter(b)
            m = 50 + (50 * len(b) * texts) // max(words, 1)
            score = sum(math.floor(1000 * math.log((2 * texts + 2) / (2 * df[t] + 1))) * ((10 ** 9 * tf[t]) // (1000 * tf[t] + 20 * m)) for t in terms if tf[t])
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out += [(item, n + 1, s[3], -s[0]) for n, s in enumerate(sorted(scores, key=lambda s: s[:3])[:k])]
    return sorted(out, key=str)


def found(docs, items, **how) -> list[tuple]:
    return sorted(map(tuple, ranking.rank(docs, items, **how).collect()), key=str)


def test_ranking_of_hard_cases(spark, hard, empty):
    items = [(1, "ONE two the"), (2, "the re on an"), (3, None), (4, ""), (5, "..."), (None, "repeated row"), (6, "é 日本 𝄞 x"), (7, "x" * 5000)]
    asked = spark.createDataFrame(items, "item_id long, text string").withColumns({"rank": F.lit(0), "term": F.lit("t")})
    docs = [(i, t) for i, t, _, _ in plain(hard)]
    assert found(hard, asked) == ranked(docs, items, 50)
    assert found(hard, asked.unionByName(asked), k=3) == ranked(docs, items, 3)
    assert found(empty, asked) == [] and found(hard, asked.limit(0)) == []
    assert ranking.rank(empty, asked).columns == ["item_id", "rank", "doc_id", "score"]


def test_ranking_with_copies_ties_and_small_trees(spark, monkeypatch):
    rng = random.Random(4)
    docs = [(i, "one common text of copies" if i % 3 == 0 else prose(rng, rng.randint(0, 40))) for i in range(900)]
    items = [(i, prose(rng, rng.randint(1, 12)) + rng.choice(["", " copies", " common text"])) for i in range(40)]
    frame = spark.createDataFrame([(i, t, None, None, None) for i, t in docs], SCHEMA).repartition(3)
    asked = spark.createDataFrame(items, "item_id long, text string")
    want = ranked(docs, items, 50)
    assert found(frame, asked) == want
    for name, value in {"ROUND_BYTES": 2000, "TREE_BYTES": 500, "BATCH_DOCS": 64, "LEAF_DOCS": 4, "LEAF_ITEMS": 2, "FIRST": 2, "DENSE": 2000}.items():
        monkeypatch.setattr(ranking, name, value)
    assert found(frame, asked) == want
    monkeypatch.setattr(ranking, "EXACT", 0)  # whole numbers all the way
    assert found(frame, asked) == want


def test_trees_leave_pairs_out_and_lose_none():
    rng = np.random.default_rng(2)
    topics = rng.integers(0, 40, 2000)
    table = np.where(rng.random((2000, 400)) < 0.01, rng.integers(1, 300, (2000, 400)), 0)
    for topic in range(40):
        table[topics == topic, topic * 10:topic * 10 + 10] = rng.integers(500, 1000, ((topics == topic).sum(), 10))
    weights = np.zeros((80, 400), np.int64)
    for i in range(80):
        weights[i, (i % 40) * 10:(i % 40) * 10 + 10] = rng.integers(1, 100, 10)
    search = ranking.Search(np.arange(80), np.arange(400), weights, np.zeros(80, np.int64), 5)
    for at in range(0, 2000, 500):
        search.batch(np.arange(at, at + 500), table[at:at + 500], np.arange(400))
    scores = weights @ table.T
    for i in range(80):
        best = sorted(zip(-scores[i], range(2000)))[:5]
        assert list(zip(-search.scores[i], search.ids[i])) == best
    assert search.compared < search.pairs / 2


def test_very_long_texts_are_ranked_whole(spark):
    docs = spark.createDataFrame([(1, LONG, None, None, None), (2, "a b " * 600_000 + "needle", None, None, None), (3, "a", None, None, None)], SCHEMA)
    asked = spark.createDataFrame([(1, "needle"), (2, LONG)], "item_id long, text string")
    assert [(r["item_id"], r["doc_id"]) for r in ranking.rank(docs, asked).orderBy("item_id").collect()] == [(1, 2), (2, 1)]


# --- phrases -----------------------------------------------------------------------------------------------


def collocations(rows: list[tuple], least: int, first: int, longest: int = 4) -> list[tuple]:
    counts, totals = defaultdict(Counter), Counter()
    for _, text, _, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for n in range(1, longest + 1):
                counts[lang].update(tuple(words[i:i + n]) for i in range(len(words) - n + 1))
    out = []
    for lang, held in counts.items():
        good = {p: a for p, a in held.items() if len(p) > 1 and a >= least}
        scored, longer = [], Counter()
        for q, f in good.items():
            for size in range(2, len(q)):
                for i in range(len(q) - size + 1):
                    longer[q[i:i + size]] = max(longer[q[i:i + size]], f)
        for p, a in good.items():
            cuts = [(2_000_000 * a // (held[p[:k]] + held[p[k:]]), k, held[p[:k]], held[p[k:]]) for k in range(1, len(p))]
            score, _, left, right = min(cuts, key=lambda c: c[:2])
            if 100 * longer[p] < 80 * a:
                scored.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, n + 1, p.decode(), -a, left, right, totals[lang], -s) for n, (s, a, p, left, right) in enumerate(sorted(scored)[:first])]
    return sorted(out)


def mined(df, **how) -> list[tuple]:
    return sorted(map(tuple, phrases.collocations(df, **how).collect()))


def test_phrases_of_hard_cases(hard, empty):
    rows = plain(hard)
    assert mined(hard, least=2) == collocations(rows, 2, 2000)
    assert mined(hard) == collocations(rows, 30, 2000)
    assert mined(empty) == []


@pytest.mark.parametrize("how, split", [({}, True), ({"shards": 1, "longest": 3}, False), ({"shards": 29, "first": 15, "bits": 1 << 16}, False)])
def test_phrases_with_copies_and_languages(spark, request, how, split, monkeypatch):
    if split:
        request.getfixturevalue("tiny_blocks")
    monkeypatch.setattr(phrases, "SLICE", 4000)
    rng = random.Random(8)
    names = ["new york", "New York City", "the of", "a b c d e", "ça va", "x\tx  x"]
    rows = []
    for i in range(500):
        text = "".join(rng.choice([f" {rng.choice(names)}", f" {prose(rng, 1)}", " of the", ". ", ", ", "\n", "\v"]) for _ in range(rng.randint(0, 25)))
        rows.append((None if i % 9 == 0 else i, "copied words here, again copied words" if i % 3 == 0 else text, rng.choice(["en"] * 5 + ["de", None, "und", "tiny"]), None, 0))
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"phrase": F.lit("own"), "key": F.lit(1), "shard": F.lit("own")})
    want = collocations(plain(df), 30, how.get("first", 2000), how.get("longest", 4))
    assert len(want) > 20
    assert mined(df, **how) == want


def test_phrases_in_a_very_long_text(spark):
    df = spark.createDataFrame([(1, "red fish " * 100_000, "en", None, 0), (2, LONG, "en", None, 0), (3, "one " * 40, None, None, 0)], SCHEMA)
    assert mined(df) == collocations(plain(df), 30, 2000)


def test_counts_beyond_64_bits_stay_exact(spark):
    found_ = spark.createDataFrame([(6_000_000_000_000_000_000, 6_000_000_000_000_000_001, 6_100_000_000_000_000_000)], "a long, l long, r long")
    exact = F.expr(f"cast(a as decimal(20,0)) * {phrases.UNIT}BD div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    a, left, right = found_.first()
    assert found_.select(exact).first()[0] == 2_000_000 * a // (left + right)
