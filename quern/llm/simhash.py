"""SimHash near-duplicates, found with vantage-point trees over the fingerprints.

A text's fingerprint is the majority vote of its shingles' hashes, bit by bit.  Two
texts are linked if their fingerprints differ in at most ``radius`` bits.

The distinct fingerprints are dealt into shards by vantage-point trees: every node
has a vantage point and a distance; fingerprints within it go left, the others right.
A fingerprint lives in the one leaf that it falls into and also visits each leaf that
the ball around it touches (triangle bound), so a pair within the radius meets in the
home leaf of either.  Distances of random fingerprints are all close to 32, which
makes balls touch nearly every leaf of such a tree.  Therefore the upper nodes measure
the distance over a block of the bits only: of ``radius + 1`` blocks one must be equal in a
linked pair, so one tree per block with a ball of radius 0 loses nothing and prunes all
but one branch.  Where a block no longer tells fingerprints apart (a crowd of near copies),
the nodes go on with all 64 bits and the full radius, and fingerprints near a boundary
visit both sides.

The trees are built from a bounded sample (``sample`` fingerprints); every fingerprint is
dealt out.  Inside a shard the same splitting continues down to small blocks, which are
compared pair by pair.  A shard returns a spanning forest of its links, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from quern import settings
from quern.llm.common import binaries, give_back, pieces_of, semi_or_anti, text_column
from quern.operators.graph import components

#: fingerprints that the trees are built from, and that a leaf should hold
SAMPLE, LEAF_ROWS = 1 << 18, 2048
#: sampled fingerprints that a leaf needs before it is split, and cells that are compared at once
LEAST, CELLS = 16, 1 << 20
#: rows of bits that are summed at once
ROWS = 1 << 16
#: bytes of text that are held as Python objects at once
SLICE = 4 << 20


def vote(hashes: np.ndarray) -> int:
    """Fingerprint of a text from the hashes of its shingles."""
    if not len(hashes):
        return 0
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), ROWS):
        bits = np.unpackbits(hashes[at:at + ROWS].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big")


def fingerprint(text: bytes, shingle: int) -> int:
    words = text.lower().split()  # of bytes: A-Z, and space and \x09-\x0D
    joined = b" ".join(words)
    if len(words) <= shingle:
        return vote(np.array([xxhash.xxh64_intdigest(joined, 42)], np.uint64)) if words else 0
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    spans = zip(starts.tolist(), ends[shingle - 1:].tolist())
    digest = xxhash.xxh64_intdigest
    return vote(np.fromiter((digest(joined[a:b], 42) for a, b in spans), np.uint64, len(words) - shingle + 1))


def simhash(text: Column, shingle: int = 3) -> Column:
    """64-bit fingerprint (as a signed long); 0 for a text without words."""

    @arrow_udf("long")
    def of_batches(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            found = np.array([fingerprint(t, shingle) for part in pieces_of(texts, SLICE) for t in binaries(part)], np.uint64)
            yield pa.array(found.view(np.int64), pa.int64())
            give_back()

    return of_batches(text)


# A node is (mask, vantage, mu, radius, left, right); a leaf has mask 0 and its number in `left`.
NODE = np.dtype([("mask", "u8"), ("vantage", "u8"), ("mu", "i4"), ("radius", "i4"), ("left", "i4"), ("right", "i4")])
FULL = (1 << 64) - 1


def distances(values: np.ndarray, vantage, mask) -> np.ndarray:
    return np.bitwise_count((values ^ np.uint64(vantage)) & np.uint64(mask)).astype(np.int32)


def halves(values: np.ndarray, mask: int, radius: int, whole_radius: int) -> tuple[int, int, int, int] | None:
    """(mask, vantage, mu, radius) of a node that splits the values well; None if none is found."""
    for m, r in [(mask, radius), (FULL, whole_radius)] if mask != FULL else [(FULL, whole_radius)]:
        best = None
        for at in range(0, len(values), max(1, len(values) // 4)):
            d = distances(values, values[at], m)
            counts = np.bincount(d)
            within = np.cumsum(counts)
            mu = int(np.argmin(np.abs(2 * within - len(values))))
            small = min(within[mu], len(values) - within[mu])
            if small * 8 >= len(values) and (best is None or small > best[0]):
                best = int(small), (m, int(values[at]), mu, r)
        if best:
            return best[1]
    return None


def blocks_of(radius: int) -> list[int]:
    """Masks of ``radius + 1`` blocks of neighbouring bits."""
    cuts = [64 * i // (radius + 1) for i in range(radius + 2)]
    return [(1 << b) - (1 << a) for a, b in zip(cuts, cuts[1:])]


def plant(sample: np.ndarray, leaf: int, radius: int) -> list[np.ndarray]:
    """One vantage-point tree per block of bits over the sample, leaves of at most ``leaf`` where they split."""
    trees, leaves = [], 0
    for mask in blocks_of(radius):
        nodes, todo = [[0, 0, 0, 0, -1, -1]], [(0, sample, mask)]
        while todo:
            at, values, m = todo.pop()
            cut = halves(values, m, 0 if m != FULL else radius, radius) if len(values) > leaf else None
            if cut is None:
                nodes[at] = [0, 0, 0, 0, leaves, -1]
                leaves += 1
                continue
            d = distances(values, cut[1], cut[0])
            nodes[at] = [cut[0], cut[1], cut[2], cut[3], len(nodes), len(nodes) + 1]
            for part in (values[d <= cut[2]], values[d > cut[2]]):
                todo.append((len(nodes), part, cut[0]))
                nodes.append([0, 0, 0, 0, -1, -1])
        trees.append(np.array([tuple(n) for n in nodes], NODE))
    return trees


def route(tree: np.ndarray, values: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(leaf, places of the values that live in it or visit it, whether they live there)."""
    todo = [(0, np.arange(len(values)), np.ones(len(values), bool))]
    while todo:
        at, rows, home = todo.pop()
        node = tree[at]
        if not len(rows):
            continue
        if not node["mask"]:
            yield int(node["left"]), rows, home
            continue
        d, mu, r = distances(values[rows], node["vantage"], node["mask"]), node["mu"], node["radius"]
        for child, inside, touched in (("left", d <= mu, d - r <= mu), ("right", d > mu, d + r > mu)):
            todo.append((int(node[child]), rows[touched], (home & inside)[touched]))


def joined(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Give the ends of all links (a, b) one label, the smallest; in place."""
    while True:
        low = np.minimum(labels[a], labels[b])
        if (labels[a] == low).all() and (labels[b] == low).all():
            return
        for side in (a, b):
            np.minimum.at(labels, labels[side], low)
            np.minimum.at(labels, side, low)
        while (nearer := labels[labels] != labels).any():
            labels[nearer] = labels[labels[nearer]]


def link(values: np.ndarray, home: np.ndarray, visits: np.ndarray, labels: np.ndarray, mask: int, radius: int) -> None:
    """Join the labels of all pairs (one at home, one visiting) within the radius; in place."""
    todo = [(home, visits, mask)]
    while todo:
        h, v, m = todo.pop()
        if not len(h) or len(v) < 2:
            continue
        small = len(h) * len(v) <= CELLS
        cut = None if small else halves(values[h], m, 0 if m != FULL else radius, radius)
        if cut is None:
            step = max(1, CELLS // len(v))
            for at in range(0, len(h), step):
                near = np.bitwise_count(values[h[at:at + step], None] ^ values[v][None]) <= radius
                a, b = np.nonzero(near)
                a, b = h[at + a], v[b]
                joined(labels, a[a != b], b[a != b])
            continue
        used, vantage, mu, r = cut
        dh, dv = distances(values[h], vantage, used), distances(values[v], vantage, used)
        todo.append((h[dh <= mu], v[dv - r <= mu], used))
        todo.append((h[dh > mu], v[dv + r > mu], used))


def links(fingerprints: DataFrame, radius: int = 2, sample: int = SAMPLE, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """(src, dst): a spanning forest of the links between distinct fingerprints (column ``fp``), shard by shard."""
    total = fingerprints.count()
    few = fingerprints.orderBy(F.xxhash64("fp"), "fp").limit(sample) if total > sample else fingerprints
    drawn = few.toArrow()["fp"].to_numpy().view(np.uint64)  # at most `sample` numbers
    trees = plant(np.sort(drawn), max(LEAST, leaf_rows * len(drawn) // max(total, 1)), radius)
    masks = blocks_of(radius)
    first = [int(min(t["left"][t["mask"] == 0])) for t in trees]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for tree in trees:
                for leaf, rows, home in route(tree, values):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(rows), leaf)), pa.array(values[rows].view(np.int64)), pa.array(home)],
                        ["shard", "fp", "home"])

    def search(shard: pa.Table) -> pa.Table:
        values = shard["fp"].to_numpy().view(np.uint64)
        order = np.argsort(values, kind="stable")
        values, home = values[order], shard["home"].to_numpy()[order]
        labels, every = np.arange(len(values)), np.arange(len(values))
        number = int(shard["shard"][0].as_py())
        mask = masks[max(i for i, at in enumerate(first) if at <= number)]
        # visitors came over a boundary of whole distances: blocks may differ between them and those at home
        link(values, every[home], every, labels, mask if home.all() else FULL, radius)
        far = labels != every
        return pa.table({"src": values[far].view(np.int64), "dst": values[labels[far]].view(np.int64)})

    dealt = fingerprints.select("fp").mapInArrow(deal, "shard long, fp long, home boolean")
    return dealt.groupBy("shard").applyInArrow(search, "src long, dst long")


def classes(rows: DataFrame, radius: int = 2, **tree) -> DataFrame:
    """(fp, component): every distinct fingerprint with the smallest fingerprint it is connected to."""
    fps = rows.select("fp").distinct().checkpoint()
    edges = links(fps, radius, **tree).checkpoint()
    if edges.isEmpty():
        return fps.withColumn("component", F.col("fp"))
    ends = edges.select(F.col("src").alias("v")).unionByName(edges.select(F.col("dst").alias("v"))).distinct()
    found = components(edges, ends).select(F.col("v").alias("fp"), "label")
    return fps.join(found, "fp", "left").select("fp", F.coalesce("label", "fp").alias("component"))


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 2, **tree) -> DataFrame:
    """(doc_id, fingerprint, component_id), one row per row of ``docs``.

    component_id is the smallest doc_id among all documents that are linked directly or
    through others.  A null text counts as an empty one; texts without words have fingerprint
    0 and are linked like any other.  A null doc_id never is the smallest: a component of
    such rows alone has a null component_id.  Repeated rows stay repeated.  Texts are read
    whole.  Other columns are not looked at.  An empty table gives an empty result.
    """
    settings.ensure_checkpoint_dir(docs.sparkSession)
    rows = docs.select(docs["doc_id"], simhash(text_column(docs), shingle).alias("fp")).checkpoint()
    nodes = rows.groupBy("fp").agg(F.min("doc_id").alias("rep")).join(classes(rows, radius, **tree), "fp")
    nodes = nodes.checkpoint()
    least = nodes.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = nodes.join(least, "component").select("fp", "component_id")
    return rows.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, radius: int = 2, **tree) -> DataFrame:
    """``docs`` with one row per group of near duplicates, the one with the smallest doc_id.

    All columns stay.  A null doc_id comes after all others; of repeated rows one stays.
    """
    settings.ensure_checkpoint_dir(docs.sparkSession)
    text = text_column(docs)
    rows = docs.select(docs["doc_id"].alias("id"), F.xxhash64(text).alias("h"), simhash(text, shingle).alias("fp"))
    rows = rows.groupBy("id", "h", "fp").agg(F.count(F.lit(1)).alias("n")).checkpoint()
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "h", "n")).alias("first")
    nodes = rows.groupBy("fp").agg(first).join(classes(rows, radius, **tree), "fp")
    return one_of_each(docs, nodes.groupBy("component").agg(F.min("first").alias("first")).select("first.*").checkpoint())


def one_of_each(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``kept`` (id, h, n) names; of those that occur n > 1 times one."""
    repeated = kept.filter("n > 1")
    out = semi_or_anti(docs, kept.filter("n = 1"), "left_semi")
    if repeated.isEmpty():
        return out
    return out.unionByName(semi_or_anti(docs, repeated, "left_semi").dropDuplicates(["doc_id", "text"]))
