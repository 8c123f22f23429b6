"""Interpolated modified Kneser-Ney bigram model: counted in Spark, looked up in memory-mapped arrays.

Counting takes two passes over the training texts.  Words are 64-bit hashes; the first pass counts
them, and a word's number is its place among all hashes in order.  In the second pass a bigram is the
pair of its words' numbers in one 64-bit key.  Workers pre-aggregate, cut their sorted keys into
ranges of about equal weight (a word with more tokens than a range is cut along the second word)
and send one compressed block per range; each range is merged by one task.

The model is a folder of sorted arrays in the shared folder: hashes and counts of words, keys and counts of
bigrams, what the discounts need for each context, and in how many contexts a word occurs.  Scoring workers map these
files into memory and look up sorted queries, so a worker holds a batch, not the model.  In a
store that cannot be mapped, a worker copies a file into an unlinked temporary one first.

All sizes that the driver sees (ranges, cut points, totals) follow the number of ranges.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern import settings
from quern.llm.common import lowered, pieces_of, raw, span_hashes, text_column, word_spans
from quern.llm.toxicity import held_out

#: tokens in a range of words and of bigrams, bytes worked on at once, counts that a worker gathers before it sends
RANGE, SLICE, GATHERED = 4_000_000, 4 << 20, 4_000_000
#: hash of the end of a text; no word hashes to it but by chance of 2^-64
END = np.uint64(0xE5D0F7EC7A3B9165)


class Store:
    """Files of numbers in one folder of a shared file system."""

    def __init__(self, uri: str):
        self.uri = uri if "://" in uri else "file:" + uri if uri.startswith("/") else uri

    def opened(self) -> tuple[pafs.FileSystem, str]:
        system, path = pafs.FileSystem.from_uri(self.uri.replace("file:/", "file:///", 1) if self.uri.startswith("file:/")
                                                and not self.uri.startswith("file://") else self.uri)
        return system, path

    def put(self, name: str, array: np.ndarray) -> None:
        """Write under another name first: a file with the right name is always whole."""
        system, path = self.opened()
        system.create_dir(path, recursive=True)
        part = f"{path}/{name}.{uuid.uuid4().hex}"
        with system.open_output_stream(part) as out:
            out.write(np.ascontiguousarray(array).tobytes())
        system.move(part, f"{path}/{name}")

    def get(self, name: str, kind) -> np.ndarray:
        """The file as an array mapped into memory."""
        system, path = self.opened()
        path = f"{path}/{name}"
        if not system.get_file_info(path).size:
            return np.zeros(0, kind)
        if isinstance(system, pafs.LocalFileSystem):
            return np.memmap(path, kind, "r")
        with tempfile.TemporaryFile() as copy, system.open_input_stream(path) as source:
            while block := source.read(1 << 24):
                copy.write(block)
            copy.flush()
            return np.memmap(copy, kind, "r")

    def drop(self) -> None:
        system, path = self.opened()
        if system.get_file_info(path).type == pafs.FileType.Directory:
            system.delete_dir(path)


def packed(values: np.ndarray) -> bytes:
    """Sorted or small whole numbers as compressed bytes: steps between them, byte by byte."""
    values = values.astype(np.uint64)
    steps = np.diff(values, prepend=np.uint64(0))
    return len(values).to_bytes(8, "big") + pa.compress(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes(), "zstd", asbytes=True)


def unpacked(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:8], "big")
    bytes_ = np.frombuffer(pa.decompress(data[8:], 8 * n, "zstd", asbytes=True), np.uint8).reshape(8, n)
    return np.cumsum(np.ascontiguousarray(bytes_.T).view(np.uint64)[:, 0], dtype=np.uint64)


def summed(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sum of their counts (1 each if there are none)."""
    if not len(keys):
        return keys.astype(np.uint64), np.zeros(0, np.int64)
    if counts is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
    heads = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[heads], np.add.reduceat(counts, heads) if counts is not None else np.diff(np.append(heads, len(keys)))


class Gathered:
    """Sums keys and gives them out as one block per range whenever there are many."""

    def __init__(self, cuts: np.ndarray):
        self.cuts, self.parts, self.size = cuts, [], 0

    def add(self, keys: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.parts.append(summed(keys))
        self.size += len(self.parts[-1][0])
        if self.size >= GATHERED:
            yield from self.blocks()

    def blocks(self) -> Iterator[pa.RecordBatch]:
        if not self.parts:
            return
        keys, counts = summed(*map(np.concatenate, zip(*self.parts)))
        self.parts, self.size = [], 0
        at = np.concatenate(([0], np.searchsorted(keys, self.cuts, "left"), [len(keys)]))
        for r, (a, b) in enumerate(zip(at, at[1:])):
            if b > a:
                yield block(r, packed(keys[a:b]), packed(np.cumsum(counts[a:b])))


BLOCK = "part long, a binary, b binary"


def block(part: int, a: bytes, b: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([a], pa.binary()), pa.array([b], pa.binary())], ["part", "a", "b"])


def merged(blocks: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    keys = [unpacked(x) for x in blocks["a"].to_pylist()]
    counts = [np.diff(unpacked(x).astype(np.int64), prepend=0) for x in blocks["b"].to_pylist()]
    return summed(np.concatenate(keys), np.concatenate(counts))


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text) of all tokens in order: the words in lower case, then one end per text."""
    data, offsets = raw(texts)
    data = lowered(data)
    starts, ends, doc = word_spans(data, offsets)
    words = np.bincount(doc, minlength=len(texts))
    tops = np.cumsum(words + 1)
    out = np.full(len(doc) + len(texts), END)
    place = np.arange(len(doc)) + doc
    out[place] = span_hashes(data, starts, ends)
    owner = np.repeat(np.arange(len(texts)), words + 1)
    assert len(texts) == 0 or tops[-1] == len(out)
    return out, owner


class Model:
    """Where the arrays lie, and the few totals that formulas need."""

    def __init__(self, store: Store, word_bases: list[int], word_cuts: list[int], bigram_cuts: list[int], tokens: int,
                 texts: int, discounts: list[float], low: list[float], bigrams: int, shared: dict[int, list[int]]):
        self.store, self.word_bases, self.word_cuts, self.bigram_cuts = store, word_bases, word_cuts, bigram_cuts
        self.tokens, self.texts, self.discounts, self.low = tokens, texts, discounts, low
        self.bigrams, self.shared = bigrams, shared

    @property
    def distinct(self) -> int:
        return self.word_bases[-1]


def discounts_of(n: list[int]) -> list[float]:
    """Modified Kneser-Ney discounts for counts of 1, 2, and 3 or more, from how many keys have counts 1 to 4."""
    n1, n2, n3, n4 = n
    y = n1 / (n1 + 2 * n2) if n1 + n2 else 0.0
    raw_ = [1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return [min(max(d, 0.05 * (i + 1)), 0.95 * (i + 1)) for i, d in enumerate(raw_)]


def counted(texts: DataFrame, store: Store) -> Model:
    """Count words and bigrams of the column ``text`` into the store."""
    spark = texts.sparkSession
    total_bytes, n_texts = texts.agg(F.sum(F.octet_length("text")), F.count(F.lit(1))).first()
    ranges = max(1, (total_bytes or 0) // 6 // RANGE)  # a word and its space have about six bytes
    word_cuts = np.array([(r << 64) // ranges for r in range(1, ranges)], np.uint64)

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered = Gathered(word_cuts)
        for batch in batches:
            for part in pieces_of(batch.column(0), SLICE):
                yield from gathered.add(tokens(part)[0])
        yield from gathered.blocks()

    def put_words(blocks: pa.Table) -> pa.Table:
        part = blocks["part"][0].as_py()
        keys, counts = merged(blocks)
        store.put(f"word-{part}.hash", keys)
        store.put(f"word-{part}.count", counts.astype(np.uint64))
        # cut points: every RANGE / 4 tokens, so that a few of them make a range of bigrams
        steps = np.cumsum(counts) // max(RANGE // 4, 1)
        at = np.flatnonzero(np.diff(steps, prepend=0))
        return pa.table({"part": [part], "n": [len(keys)], "tokens": [int(counts.sum())],
                         "at": pa.array([at.tolist()], pa.list_(pa.int64())), "held": pa.array([counts[at].tolist()], pa.list_(pa.int64()))})

    found = texts.select("text").mapInArrow(words, BLOCK).groupBy("part").applyInArrow(
        put_words, "part long, n long, tokens long, at array<long>, held array<long>").collect()
    rows = {r["part"]: r for r in found}
    bases = [0]
    for r in range(ranges):
        bases.append(bases[-1] + (rows[r]["n"] if r in rows else 0))
    distinct, n_tokens = bases[-1], sum(r["tokens"] for r in found)
    if distinct >= 1 << 32:
        raise ValueError("more than 2^32 different words")
    quarter = [(bases[r] + i, c) for r in range(ranges) if r in rows for i, c in zip(rows[r]["at"], rows[r]["held"])]
    cuts, since = [], 0
    every_w = [w for w, _ in quarter]
    for k, (v, c) in enumerate(quarter):  # a cut after four quarters, and inside words that hold several
        since += 1
        pieces = c // RANGE
        if since >= 4 or pieces:
            cuts.append(v << 32)
            since = 0
        if pieces:
            cuts += sorted({(v << 32) | every_w[len(every_w) * j // (pieces + 1)] for j in range(1, pieces + 1)} - {v << 32})
            cuts.append((v + 1) << 32)
    bigram_cuts = np.array(sorted(set(cuts)), np.uint64)
    model = Model(store, bases, word_cuts.tolist(), bigram_cuts.tolist(), n_tokens, n_texts, [], [], 0, {})

    def bigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup, gathered = Lookup(model), Gathered(bigram_cuts)
        for batch in batches:
            for part in pieces_of(batch.column(0), SLICE):
                hashes, owner = tokens(part)
                ids, _ = lookup.words(hashes)
                yield from gathered.add(lookup.keys(ids, owner))
        yield from gathered.blocks()

    def put_bigrams(blocks: pa.Table) -> Iterator[pa.RecordBatch]:
        part = blocks["part"][0].as_py()
        keys, counts = merged(blocks)
        store.put(f"bigram-{part}.key", keys)
        store.put(f"bigram-{part}.count", np.minimum(counts, 255).astype(np.uint8))
        large = np.flatnonzero(counts >= 255)
        store.put(f"bigram-{part}.large", np.concatenate((large, counts[large])).astype(np.uint64))
        v, w = (keys >> np.uint64(32)).astype(np.int64), keys & np.uint64(0xFFFFFFFF)
        first = int(v[0])
        kinds = np.stack([np.bincount(v[counts == 1] - first, minlength=v[-1] - first + 1),
                          np.bincount(v[counts == 2] - first, minlength=v[-1] - first + 1),
                          np.bincount(v[counts >= 3] - first, minlength=v[-1] - first + 1)], 1)
        store.put(f"context-{part}.kinds", np.concatenate(([first], kinds.ravel())).astype(np.uint32))
        n = [int((counts == c).sum()) for c in (1, 2, 3, 4)]
        edge = [first, *kinds[0].tolist(), int(v[-1]), *kinds[-1].tolist()]
        yield block(-1 - part, packed(np.array(n + [len(keys)])), packed(np.array(edge)))
        words_, n_w = summed(w)
        at = np.concatenate(([0], np.searchsorted(words_, np.array(bases[1:-1], np.uint64), "left"), [len(words_)]))
        for r, (a, b) in enumerate(zip(at, at[1:])):
            if b > a:
                yield block(r, packed(words_[a:b]), packed(np.cumsum(n_w[a:b])))

    def merge_bigrams(blocks: pa.Table) -> pa.Table:
        return pa.Table.from_batches(list(put_bigrams(blocks)))

    def put_contexts(blocks: pa.Table) -> pa.Table:
        part = blocks["part"][0].as_py()
        if part < 0:
            return blocks.slice(0, 1)
        keys, counts = merged(blocks)
        dense = np.zeros(bases[part + 1] - bases[part], np.uint32)
        dense[keys.astype(np.int64) - bases[part]] = counts
        store.put(f"word-{part}.contexts", dense)
        n = [int((counts == c).sum()) for c in (1, 2, 3)] + [int((counts == 4).sum()), int((counts >= 3).sum()), len(counts)]
        return pa.Table.from_batches([block(part, packed(np.array(n)), b"")])

    if not distinct:
        return model
    rows = texts.select("text").mapInArrow(bigrams, BLOCK).groupBy("part").applyInArrow(merge_bigrams, BLOCK).groupBy(
        "part").applyInArrow(put_contexts, BLOCK).collect()  # a line of totals per range
    numbers = {r["part"]: unpacked(bytes(r["a"])).astype(np.int64) for r in rows}
    high = sum((n for p, n in numbers.items() if p < 0), np.zeros(5, np.int64))
    low = sum((n for p, n in numbers.items() if p >= 0), np.zeros(6, np.int64))
    model.discounts, model.bigrams = discounts_of(high[:4].tolist()), int(high[4])
    d = discounts_of(low[:4].tolist())
    spare = (d[0] * low[0] + d[1] * low[1] + d[2] * low[4]) / max(int(high[4]), 1)
    model.low = [*d, float(spare)]
    # contexts that lie in several ranges: the ends of ranges, added up
    for r in rows:
        if r["part"] < 0:
            e = unpacked(bytes(r["b"])).astype(np.int64).tolist()
            for v, kinds in {e[0]: e[1:4], e[4]: e[5:8]}.items():
                model.shared[v] = [x + y for x, y in zip(model.shared.get(v, [0, 0, 0]), kinds)]
    return model


class Lookup:
    """The mapped arrays of a model in one worker."""

    def __init__(self, model: Model):
        self.model = model
        store, ranges = model.store, range(len(model.word_bases) - 1)
        there = [r for r in ranges if model.word_bases[r + 1] > model.word_bases[r]]
        self.hashes = {r: store.get(f"word-{r}.hash", np.uint64) for r in there}
        self.counts = {r: store.get(f"word-{r}.count", np.uint64) for r in there}
        self.cuts = np.array(model.word_cuts, np.uint64)
        self.bigram_cuts = np.array(model.bigram_cuts, np.uint64)
        self.files: dict[str, np.ndarray] = {}

    def file(self, name: str, kind) -> np.ndarray:
        if name not in self.files:
            system, path = self.model.store.opened()
            there = system.get_file_info(f"{path}/{name}").type == pafs.FileType.File
            self.files[name] = self.model.store.get(name, kind) if there else np.zeros(0, kind)
        return self.files[name]

    def words(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number, count) of every token; an unknown word has the number -1 and the count 0."""
        distinct, back = np.unique(hashes, return_inverse=True)
        ids, counts = np.full(len(distinct), -1, np.int64), np.zeros(len(distinct), np.int64)
        at = np.concatenate(([0], np.searchsorted(distinct, self.cuts, "left"), [len(distinct)]))
        for r, table in self.hashes.items():
            part = distinct[at[r]:at[r + 1]]
            place = np.minimum(np.searchsorted(table, part), len(table) - 1)
            found = np.flatnonzero(table[place] == part)
            ids[at[r] + found] = self.model.word_bases[r] + place[found]
            counts[at[r] + found] = self.counts[r][place[found]]
        return ids[back], counts[back]

    def keys(self, ids: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """Bigram of every token with the one before it; the number after the last word's stands before a text."""
        before = np.concatenate(([0], ids[:-1]))
        before[np.concatenate(([True], owner[1:] != owner[:-1]))[:len(ids)]] = self.model.distinct
        return (before[:len(ids)].astype(np.uint64) << np.uint64(32)) | (ids.astype(np.uint64) & np.uint64(0xFFFFFFFF))

    def contexts(self, ids: np.ndarray) -> np.ndarray:
        """In how many contexts each known word occurs."""
        out = np.zeros(len(ids), np.int64)
        bases = np.array(self.model.word_bases)
        part = np.searchsorted(bases, ids, "right") - 1
        for r in np.unique(part):
            own = np.flatnonzero(part == r)
            table = self.file(f"word-{r}.contexts", np.uint32)
            if len(table):
                out[own] = table[ids[own] - bases[r]]
        return out

    def bigram(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For sorted keys: (count, discount mass of the context in counts of 1, 2 and more) ."""
        counts, kinds = np.zeros(len(keys), np.int64), np.zeros((len(keys), 3), np.int64)
        at = np.concatenate(([0], np.searchsorted(keys, self.bigram_cuts, "left"), [len(keys)]))
        for r, (a, b) in enumerate(zip(at, at[1:])):
            table = self.file(f"bigram-{r}.key", np.uint64) if b > a else ()
            if not len(table):
                continue
            place = np.minimum(np.searchsorted(table, keys[a:b]), len(table) - 1)
            found = np.flatnonzero(table[place] == keys[a:b])
            n = self.file(f"bigram-{r}.count", np.uint8)[place[found]].astype(np.int64)
            large = self.file(f"bigram-{r}.large", np.uint64).astype(np.int64).reshape(2, -1)
            if large.shape[1]:
                many = np.flatnonzero(n == 255)
                n[many] = large[1, np.searchsorted(large[0], place[found][many])]
            counts[a + found] = n
            held = self.file(f"context-{r}.kinds", np.uint32)
            first, held = int(held[0]), held[1:].reshape(-1, 3)
            v = (keys[a:b] >> np.uint64(32)).astype(np.int64) - first
            inside = np.flatnonzero((v >= 0) & (v < len(held)))
            kinds[a + inside] = held[v[inside]]
        v = (keys >> np.uint64(32)).astype(np.int64)
        for word in np.unique(v[np.isin(v, list(self.model.shared))]) if self.model.shared else ():
            kinds[np.searchsorted(v, word, "left"):np.searchsorted(v, word, "right")] = self.model.shared[int(word)]
        return counts, kinds

    def score(self, texts: pa.Array) -> dict[str, np.ndarray]:
        """Per text: tokens, known tokens, log10 probability under smoothed unigrams and under the model."""
        m = self.model
        hashes, owner = tokens(texts)
        ids, counts = self.words(hashes)
        base = np.log10((counts + 0.1) / (m.tokens + 0.1 * (m.distinct + 1)))
        low = np.full(len(ids), 1.0 / (m.distinct + 1))
        if m.low:
            known = np.flatnonzero(ids >= 0)
            n = self.contexts(ids[known])
            d = np.array([0.0, *m.low[:3]])[np.minimum(n, 3)]
            low *= m.low[3]
            low[known] += (n - d) / m.bigrams
        else:
            low *= 1.0
        p = low
        if m.discounts:
            keys = self.keys(ids, owner)
            context = np.concatenate(([0], counts[:-1]))[:len(ids)]
            begins = np.concatenate(([True], owner[1:] != owner[:-1]))[:len(ids)]
            context[begins] = m.texts
            usable = np.flatnonzero((context > 0))
            distinct, back = np.unique(keys[usable], return_inverse=True)
            c, kinds = self.bigram(distinct)
            c, kinds = c[back], kinds[back]
            c[ids[usable] < 0] = 0
            d = np.array([0.0, *m.discounts])[np.minimum(c, 3)]
            total = context[usable]
            p = low.copy()
            p[usable] = (c - d) / total + (kinds @ np.array(m.discounts)) / total * low[usable]
        n = len(texts)
        return {"n_tokens": np.bincount(owner, minlength=n), "n_known": np.bincount(owner, counts > 0, n).astype(np.int64),
                "base_score": np.bincount(owner, base, n), "score": np.bincount(owner, np.log10(p), n)}


def score_documents(docs: DataFrame, held: Column | None = None) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), one row per row of ``docs``.

    The model learns from the rows that are not ``held`` out (a condition on doc_id; a tenth by crc32 of the id).
    Null texts are taken as empty: they have one token, the end.  Without training rows every token has the
    same probability.  Null ids and repeated rows stay; texts are read whole; other columns play no part; an
    empty table gives no rows.  The model's folder stays in the checkpoint folder until the session's folder goes.
    """
    spark = docs.sparkSession
    held = held_out(10, 0) if held is None else held
    rows = docs.select(docs["doc_id"], text_column(docs).alias("text")).withColumn("held_out", held)
    settings.ensure_checkpoint_dir(spark)
    model = counted(rows.filter(~F.col("held_out")).select("text"), Store(settings.scratch(spark, "ngrams")))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = Lookup(model)
        for batch in batches:
            at = 0
            for part in pieces_of(batch.column(1), SLICE):
                got = lookup.score(part)
                own = batch.slice(at, len(part))
                at += len(part)
                yield pa.RecordBatch.from_arrays([
                    own.column(0), own.column(2), pa.array(got["n_tokens"], pa.int64()), pa.array(got["n_known"], pa.int64()),
                    pa.array(np.full(len(part), model.tokens), pa.int64()), pa.array(got["base_score"]), pa.array(got["score"])],
                    ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(scored, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                                   "base_score double, score double")
