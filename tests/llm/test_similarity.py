"""SimHash groups and decontamination against brute force."""

import random
import re

import xxhash
from pyspark.sql import functions as F

from quern.llm import decontaminate, simhash
from tests.llm.conftest import SCHEMA, prose, texts_of


def fingerprint(text: str) -> int:
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(rows: list[tuple]) -> list[tuple]:
    prints = [fingerprint(t) for _, t in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                a, b = label[i], label[j]
                label = [b if x == a else x for x in label]
    least = {x: min((rows[i][0] for i in range(len(rows)) if label[i] == x and rows[i][0] is not None), default=None) for x in label}
    return sorted([(rows[i][0], f"{prints[i]:016x}", least[label[i]]) for i in range(len(rows))], key=str)


def found(df, **how) -> list[tuple]:
    return sorted([tuple(r) for r in simhash.near_duplicates(df, **how).collect()], key=str)


def test_hard_cases(hard):
    assert found(hard) == groups(texts_of(hard))


def test_chains_of_near_copies_in_crowded_shards(spark):
    rng = random.Random(1)
    base = prose(rng, 400).split()
    rows = []
    for i in range(300):  # one crowd that blocks cannot split, copies, and strangers
        words = list(base)
        words[rng.randrange(400)] = "changed"
        rows.append((i, " ".join(words) if i % 3 else prose(rng, 30), None, None, None))
    df = spark.createDataFrame(rows, SCHEMA)
    expected = groups(texts_of(df))
    assert found(df) == expected
    assert found(df, sample=40, leaf_rows=4) == expected


def test_trees_lose_no_link(monkeypatch):
    import numpy as np

    monkeypatch.setattr(simhash, "CELLS", 64)  # split down to small blocks
    rng = np.random.default_rng(5)
    for radius in (2, 3):
        seeds = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
        flips = np.uint64(1) << rng.integers(0, 20, (60, 30, 2)).astype(np.uint64)
        values = np.unique(np.concatenate((seeds, (seeds[:, None] ^ flips[:, :, 0] ^ flips[:, :, 1]).ravel())))
        near = np.bitwise_count(values[:, None] ^ values[None]) <= radius
        brute = np.arange(len(values))
        simhash.joined(brute, *np.nonzero(near))
        labels = np.arange(len(values))
        for tree, mask in zip(simhash.plant(values[::2], 8, radius), simhash.blocks_of(radius)):
            homes = np.zeros(len(values), int)
            for _, rows, home in simhash.route(tree, values):
                homes[rows[home]] += 1
                own = np.arange(len(values))
                simhash.link(values, rows[home], rows, own, simhash.FULL if not home.all() else mask, radius)
                simhash.joined(labels, np.arange(len(values)), own)
            assert (homes == 1).all()
        assert (labels == brute).all()


def test_one_of_each_group_stays(hard, empty):
    kept = simhash.keep_one(hard)
    assert kept.columns == hard.columns
    rows = texts_of(kept)
    prints = [fingerprint(t) for _, t in rows]
    assert len(set(rows)) == len(rows)
    assert all((a ^ b).bit_count() > 2 for i, a in enumerate(prints) for b in prints[:i])
    everything = {fingerprint(t) for _, t in texts_of(hard)}
    assert all(any((a ^ b).bit_count() <= 2 for b in prints) for a in everything)
    assert simhash.keep_one(empty).count() == 0
    assert simhash.near_duplicates(empty).count() == 0


def test_the_stage_keeps_one_of_each_group(spark, hard, empty):
    import corpus_pipeline

    rng = random.Random(21)
    rows = []
    for _ in range(30):  # crowds of copies with more and more edits, exact copies and strangers
        base = last = prose(rng, rng.choice((7, 30, 120, 400))).split()
        for _ in range(8):
            own = list(rng.choice((base, last)))
            for _ in range(rng.randint(0, max(1, len(own) // 30))):
                own[rng.randrange(len(own))] = prose(rng, 1)
            last = own
            rows.append((len(rows), " ".join(own)))
    docs = spark.createDataFrame([(*r, None, None, None) for r in rows], SCHEMA)
    stage = dict(corpus_pipeline.STAGES)["near_duplicates"]
    want = sorted({c for _, _, c in groups(rows)})
    assert 30 < len(want) < len(rows)
    assert sorted(r["doc_id"] for r in stage(spark, docs, "").collect()) == want
    assert stage(spark, hard, "").columns == hard.columns and stage(spark, empty, "").count() == 0


def words(text: str) -> list[str]:
    return [w for w in re.split(r"[\W_]+", text.lower()) if w]


def bag(tokens: list[str]) -> dict:
    k = min(5, len(tokens))
    out: dict = {}
    for i in range(len(tokens) - k + 1) if k else ():
        gram = tuple(tokens[i:i + k])
        out[gram] = out.get(gram, 0) + 1
    return out


def best_windows(docs: list[tuple], items: list[tuple], similarity: float = 0.8) -> dict:
    """Best similarity of all item-sized windows of all documents where it is enough, and the starts that have it."""
    out = {}
    for doc_id, text in docs:
        tokens = words(text)
        for item_id, item in items:
            own = words(item)
            target, m = bag(own), len(own)
            k = min(5, m)
            if not m or len(tokens) < k:
                continue
            for start in range(max(len(tokens) - m, 0) + 1):
                window = tokens[start:start + m]
                got: dict = {}
                for i in range(len(window) - k + 1):
                    gram = tuple(window[i:i + k])
                    got[gram] = got.get(gram, 0) + 1
                both = sum(min(n, got.get(g, 0)) for g, n in target.items())
                alike = both / (sum(target.values()) + sum(got.values()) - both)
                if alike >= similarity:
                    best, starts = out.get((doc_id, item_id), (0, set()))
                    out[doc_id, item_id] = max(best, alike), ({start} if alike > best else starts | {start} if alike == best else starts)
    return out


def test_passages_of_a_benchmark(spark):
    rng = random.Random(3)
    items = [(i, prose(rng, rng.randint(12, 40))) for i in range(12)]
    items += [(20, "two words"), (21, ""), (22, None), (None, prose(rng, 15)), (23, "a b c d e " * 6), (23, "a b c d e " * 6)]
    docs = []
    for i in range(60):
        passage = (rng.choice(items)[1] or "").split()
        if i % 4 == 1 and passage:
            passage[rng.randrange(len(passage))] = "swapped"
        if i % 4 == 2 and len(passage) > 3:
            passage.insert(rng.randrange(len(passage)), "added")
        if i % 4 == 3:
            passage = [w.upper() + "," for w in passage[:-1]]
        docs.append((i, " ".join([prose(rng, rng.randint(0, 30)), *passage, prose(rng, rng.randint(0, 30))])))
    docs += [(70, None), (71, ""), (72, items[0][1]), (72, items[0][1])]
    table = spark.createDataFrame([(*d, None, None, None) for d in docs], SCHEMA).withColumns({"id": F.lit(1), "item": F.lit(1), "h": F.lit(0)})
    benchmark = spark.createDataFrame(items, "item_id long, text string").withColumns({"m": F.lit(0), "words": F.lit("x")})
    got = {(r["doc_id"], r["item_id"]): (r["similarity"], r["start"]) for r in decontaminate.contaminated(table, benchmark).collect()}
    expected = best_windows([(i, t or "") for i, t in docs], [(i, t or "") for i, t in items if t])
    lost = expected.keys() - got.keys()
    assert got.keys() <= expected.keys()
    assert all(expected[k][0] < 0.9 for k in lost) and len(lost) <= 0.02 * len(expected)  # SimHash may miss weak ones
    assert all(abs(got[k][0] - expected[k][0]) < 1e-12 and got[k][1] in expected[k][1] for k in got)
    clean = decontaminate.remove_contaminated(table, benchmark)
    assert clean.columns == table.columns
    dirty = {d for d, _ in got}
    assert sorted(r["doc_id"] for r in clean.select("doc_id").collect()) == sorted(i for i, _ in docs if i not in dirty)


def test_fingerprint_in_sql_is_the_majority_vote(spark):
    rng = random.Random(5)
    rows = [([rng.randrange(-(1 << 63), 1 << 63) for _ in range(n)],) for n in (1, 2, 3, 50, 301)]
    df = spark.createDataFrame(rows, "g array<long>").select("g", decontaminate.fingerprint("g").alias("fp"))
    for grams, fp in df.collect():
        want = sum(1 << b for b in range(64) if 2 * sum(g >> b & 1 for g in grams) > len(grams))
        assert fp % (1 << 64) == want


def test_blocks_find_all_within_the_radius(spark):
    """Any two fingerprints at most 19 bits apart share a block up to one bit."""
    rng = random.Random(9)
    for _ in range(300):
        a, b = rng.getrandbits(64), 0
        b = a
        for bit in rng.sample(range(64), 2 * decontaminate.BLOCKS - 1):
            b ^= 1 << bit
        assert any(((a ^ b) >> s & (1 << n) - 1).bit_count() <= 1 for s, n in decontaminate.cuts())


def test_empty_tables(spark, empty, hard):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "one two three four five six")], "item_id long, text string")
    assert decontaminate.contaminated(hard, none).count() == 0
    assert decontaminate.contaminated(empty, some).count() == 0
    assert decontaminate.remove_contaminated(hard, none).count() == hard.count()
