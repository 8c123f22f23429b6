"""Quality of texts: fixed rules, and a classifier trained on labelled rows.

The rules count characters, symbols, repeated lines and repeated five-word windows.  The
classifier is a logistic regression over hashed n-grams of bytes and words; a feature's value
is its share among the text's n-grams of that kind, so the length of a text does not matter.
It is fitted on a bounded sample of labelled rows, its output is made a probability on a part of
the sample that it has not seen (Platt), and compared with a fixed threshold.  Texts are scored in Arrow
batches with array operations over all their bytes at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from quern import settings
from quern.llm.common import BASE, mixed, pieces_of, raw, span_hashes, text_column, word_spans

#: labelled rows that the classifier is fitted on, about; every which of them is kept for calibration
FIT_ROWS, FOLDS = 4096, 4
#: buckets per kind of n-gram: 1, 2 and 3 bytes, 1 and 2 words
BITS, KINDS = 15, 5
#: probability of good quality from which a text is kept
KEEP = 0.5
#: bytes that are worked on at once
SLICE = 2 << 20
#: what shares are multiplied by, so that weights stay small
SCALE = 50.0
#: words of a window, and the rules' limits: fewest words, percent of words in repeated windows
WINDOW, LEAST_WORDS, MOST_REPEATED = 5, 10, 20

SYMBOLS = np.frombuffer(b"#*$%&|<>", np.uint8)


def bucket(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - BITS)).astype(np.int64)


class Batch:
    """Words and lines of a few texts as arrays."""

    def __init__(self, texts: pa.Array):
        self.data, self.offsets = raw(texts)
        self.n = len(texts)
        self.starts, self.ends, self.doc = word_spans(self.data, self.offsets)
        self.hashes = span_hashes(self.data, self.starts, self.ends)
        self.words = np.bincount(self.doc, minlength=self.n)

    def per_text(self, marks: np.ndarray) -> np.ndarray:
        """Sum over the bytes of every text."""
        sums = np.concatenate(([0], np.cumsum(marks)))
        return sums[self.offsets[1:]] - sums[self.offsets[:-1]]

    def base(self) -> dict[str, np.ndarray]:
        first_byte = (self.data & 0xC0) != 0x80
        sums = np.concatenate(([0], np.cumsum(first_byte)))
        chars = np.bincount(self.doc, sums[self.ends] - sums[self.starts], self.n).astype(np.int64)
        return {"n_words": self.words, "word_chars": chars, "n_symbols": self.per_text(np.isin(self.data, SYMBOLS)),
                "n_dup_lines": self.repeated_lines(), "n_repeat_words": self.repeated_words()}

    def repeated_lines(self) -> np.ndarray:
        breaks = np.flatnonzero(self.data == 10)
        starts = np.unique(np.concatenate((self.offsets[:-1], breaks + 1)))
        starts = starts[starts < len(self.data)]
        ends = np.append(starts[1:], len(self.data))
        doc = np.searchsorted(self.offsets, starts, "right") - 1
        ends = np.where(np.isin(ends - 1, breaks), ends - 1, ends)
        filled = np.searchsorted(self.starts, ends) > np.searchsorted(self.starts, starts)
        doc, h = doc[filled], span_hashes(self.data, starts[filled], ends[filled])
        own = np.unique(mixed(h + doc.astype(np.uint64) * BASE), return_index=True)[1]
        return np.bincount(doc, minlength=self.n) - np.bincount(doc[own], minlength=self.n)

    def repeated_words(self) -> np.ndarray:
        n = len(self.hashes)
        if n < WINDOW:
            return np.zeros(self.n, np.int64)
        h = self.doc[:n - WINDOW + 1].astype(np.uint64)
        for k in range(WINDOW):
            h = mixed(h * BASE + self.hashes[k:n - WINDOW + 1 + k])
        at = np.flatnonzero(self.doc[:n - WINDOW + 1] == self.doc[WINDOW - 1:])
        order = at[np.argsort(h[at], kind="stable")]
        same = h[order[1:]] == h[order[:-1]]
        again = order[np.concatenate((same, [False])) | np.concatenate(([False], same))] if len(order) else order
        cover = np.zeros(n + 1, np.int64)
        cover[again] += 1
        np.add.at(cover, again + WINDOW, -1)
        return np.bincount(self.doc[np.cumsum(cover[:n]) > 0], minlength=self.n)

    def grams(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For every kind: (bucket of every n-gram, text that it is in), in the order of the texts."""
        owner = np.repeat(np.arange(self.n), np.diff(self.offsets))
        wide = self.data.astype(np.uint64)
        yield self.data.astype(np.int64), owner
        for size in (2, 3):
            m = max(len(wide) - size + 1, 0)
            h = np.zeros(m, np.uint64)
            for k in range(size):
                h = h * np.uint64(257) + wide[k:k + m]
            inside = owner[:m] == owner[len(owner) - m:]
            yield bucket(h * BASE)[inside], owner[:m][inside]
        yield bucket(self.hashes), self.doc
        inside = self.doc[1:] == self.doc[:-1]
        yield bucket(mixed(self.hashes[:-1] * BASE + self.hashes[1:]))[inside], self.doc[1:][inside]

    def margins(self, weights: np.ndarray) -> np.ndarray:
        """The regression's value for every text."""
        total = np.full(self.n, weights[-1])
        for kind, (h, doc) in enumerate(self.grams()):
            own = weights[kind << BITS:(kind + 1) << BITS]
            count = np.bincount(doc, minlength=self.n)
            total += SCALE * np.bincount(doc, own[h], self.n) / np.maximum(count, 1)
        return total

    def shares(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per text (features, values)."""
        found = [[] for _ in range(self.n)]
        for kind, (h, doc) in enumerate(self.grams()):
            ends = np.cumsum(np.bincount(doc, minlength=self.n))
            for i, part in enumerate(np.split(h, ends[:-1])):
                f, n = np.unique(part, return_counts=True)
                found[i].append((f + (kind << BITS), SCALE * n / max(len(part), 1)))
        return [tuple(map(np.concatenate, zip(*parts))) for parts in found]


def sample_of(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """(text, quality, calibrates) of about ``rows`` labelled documents; of contradicting labels the lower one counts."""
    marks = labels.filter(labels["quality"].isin(0, 1) & labels["doc_id"].isNotNull()).groupBy(
        labels["doc_id"].alias("id")).agg(F.min("quality").cast("int").alias("quality"))
    total = marks.count()
    share = min(1.0, rows / max(total, 1))
    spread = F.pmod(F.xxhash64("id"), F.lit(1_000_000))
    drawn = marks.filter(spread < int(share * 1_000_000))  # about `rows` ids
    known = docs.select(docs["doc_id"].alias("own"), text_column(docs).alias("text"))
    return known.join(F.broadcast(drawn), F.col("own") == F.col("id")).select("text", "quality", (
        F.pmod(F.xxhash64("id", F.lit(1)), F.lit(FOLDS)) == 0).alias("last"))


def fitted(rows: np.ndarray, features: np.ndarray, values: np.ndarray, y: np.ndarray, width: int,
           ridge: float = 1e-3, steps: int = 150) -> np.ndarray:
    """Logistic regression on a sparse matrix by steps that shrink with each weight's own history; intercept last."""
    w, size = np.zeros(width + 1), np.full(width + 1, 1e-6)
    for _ in range(steps):
        z = np.bincount(rows, w[features] * values, len(y)) + w[-1]
        e = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / len(y)
        g = np.append(np.bincount(features, e[rows] * values, width), e.sum())
        g[:-1] += ridge * w[:-1] / len(y)
        size += g * g
        w -= 0.3 * g / np.sqrt(size)
    return w


def train(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> np.ndarray | None:
    """Weights whose margin is the log-odds of good quality; None without labels of both classes."""
    settings.ensure_checkpoint_dir(docs.sparkSession)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for part in pieces_of(batch.column(0), SLICE):
                found = Batch(part).shares()
                kinds = [pa.array([f.astype(np.int32) for f, _ in found], pa.list_(pa.int32())),
                         pa.array([v.astype(np.float32) for _, v in found], pa.list_(pa.float32()))]
                marks = [batch.column(c).slice(at, len(part)) for c in (1, 2)]
                at += len(part)
                yield pa.RecordBatch.from_arrays([*kinds, *marks], ["f", "v", "quality", "last"])

    drawn = sample_of(docs, labels, rows).mapInArrow(measured, "f array<int>, v array<float>, quality int, last boolean").toArrow()
    y, last = drawn["quality"].to_numpy().astype(float), drawn["last"].to_numpy().astype(bool)
    if len(set(y[~last])) < 2:
        return None
    sizes = np.array([len(x) for x in drawn["f"]])
    f = drawn["f"].combine_chunks().flatten().to_numpy().astype(np.int64)
    v = drawn["v"].combine_chunks().flatten().to_numpy().astype(float)
    row = np.repeat(np.arange(len(y)), sizes)
    used = ~last[row]
    number = np.cumsum(~last) - 1
    w = fitted(number[row[used]], f[used], v[used], y[~last], KINDS << BITS)
    if len(set(y[last])) < 2:
        return w
    z = (np.bincount(row, w[f] * v, len(y)) + w[-1])[last]
    ones = np.zeros(len(z), np.int64)
    a, b = fitted(np.arange(len(z)), ones, z, (y[last] * (len(z) - 2) + 1) / len(z), 1, 0.0, 2000)
    return np.append(w[:-1] * max(a, 1e-3), w[-1] * max(a, 1e-3) + b)


def rated(text: Column, weights: np.ndarray | None) -> Column:
    """A struct of the rules' counts and the probability of good quality."""
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    @arrow_udf("struct<" + ", ".join(f"{n}: long" for n in names) + ", good: double>")
    def of_batches(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            parts = []
            for piece in pieces_of(batch, SLICE):
                texts = Batch(piece)
                counts = texts.base()
                z = texts.margins(weights) if weights is not None else np.full(texts.n, 30.0)
                good = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
                columns = [pa.array(np.asarray(counts[n], np.int64)) for n in names] + [pa.array(good)]
                parts.append(pa.StructArray.from_arrays(columns, [*names, "good"]))
            yield pa.concat_arrays(parts) if parts else pa.array([], pa.struct([(n, pa.int64()) for n in names] + [("good", pa.float64())]))

    return of_batches(text)


def judge(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, good), one row per row.

    good is the calibrated probability of label 1; kept texts pass the rules and reach the threshold. Null and
    empty texts have counts of 0 and fail the rules.  Without labels of both classes only the rules decide.
    Null ids and repeated rows stay; texts are read whole; other columns play no part; an empty table gives no rows.
    """
    weights = train(docs, labels, rows)
    q = docs.select(docs["doc_id"], rated(text_column(docs), weights).alias("q")).select("doc_id", "q.*")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return q.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("good") >= KEEP)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "good")
