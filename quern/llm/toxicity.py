"""Toxicity of texts that may be disguised: decode first, then score.

Writers hide words behind look-alike signs ("1d10t"), separators ("s.t.u.p.i.d", "i d i o t")
and repeated letters ("looooser").  A noisy channel undoes that: each sign of a suspicious
stretch may stand for some letters, for itself as a word boundary, or for nothing, and
Viterbi's algorithm finds the likeliest reading of this lattice under a letter-bigram
model counted over the whole corpus.

Two kinds of stretches go through it.  Some look disguised: signs beside letters, a letter three times, single letters with
separators.  Others could be ordinary text ("iddiot", "id-iot", "stu pid"): of these all are read in which one of
the words that the classifier has found to be toxic would stand if separators and repetitions were taken away, and the
reading counts if it has such a word.

The restored text is scored by a logistic regression over its words and word beginnings
(a disguised or inflected word keeps its beginning).  Features that do not set the classes
apart are left out by a likelihood-ratio test; labels come from a bounded sample of
labelled rows.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from quern import settings
from quern.llm.common import binaries, give_back, lowered, pieces_of, raw, text_column

#: labelled rows that the classifier is fitted on, at most (by hash of the id, so about that many)
FIT_ROWS = 20_000
#: features that the classifier may use, buckets they are hashed into, and the test they must pass
FEATURES, BUCKETS, EVIDENCE = 4096, 1 << 20, 25.0
#: lengths of word beginnings that are features besides the whole word
BEGINNINGS = (4, 5, 6)
#: distinct stretches and words that a worker remembers, and bytes that it works on at once
REMEMBERED, SLICE = 200_000, 4 << 20

#: fixed values: letters that a sign may stand for
LOOKS_LIKE = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c",
}
#: signs that may separate the letters of one word
SEPARATORS = " ._-*'~"
#: log-probabilities of the channel: sign read as a letter, dropped, read as a boundary, letter repeated
AS_LETTER, DROPPED, BOUNDARY, REPEATED = -0.3, -9.0, -3.0, -0.7
DROPPED_SEPARATOR = -0.3

SIGNS = re.escape("".join(LOOKS_LIKE))
#: single characters with the same separator between each two; a token with signs beside letters or a letter three times
SUSPICIOUS = re.compile(
    rf"(?<![^\W_])[a-z{SIGNS}]([ ._\-*'~])(?:[a-z{SIGNS}]\1)+[a-z{SIGNS}](?![a-z{SIGNS}]|[^\W_])"
    rf"|(?<![a-z{SIGNS}])(?=[{SIGNS}]*[a-z])(?=[a-z]*[{SIGNS}]|[a-z{SIGNS}]*?([a-z])\2\2)[a-z{SIGNS}]{{3,}}")
EDGE, OTHER, STATES = 0, 27, 28  # state of the letter model: 0 is a word boundary, 1 to 26 are a to z


def codes(data: np.ndarray) -> np.ndarray:
    """Letter-model state of every byte of lower-case text; bytes of other letters share one state."""
    table = np.zeros(256, np.int64)
    table[97:123] = np.arange(1, 27)
    table[128:] = OTHER
    return table[data]


def letter_model(docs: DataFrame, column: str = "text") -> np.ndarray:
    """log P(letter | letter before), 28 x 28, counted over all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(STATES * STATES, np.int64)
        for batch in batches:
            for part in pieces_of(batch.column(0), SLICE):
                data, offsets = raw(part)
                c = np.insert(codes(lowered(data)), offsets, EDGE)  # an edge on either side of every text
                total += np.bincount(c[:-1] * STATES + c[1:], minlength=STATES * STATES)
        cells = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(total[cells])], ["cell", "n"])

    counted = docs.select(text_column(docs, column).alias("text")).mapInArrow(count, "cell long, n long")
    counts = np.ones(STATES * STATES)
    for cell, n in counted.groupBy("cell").agg(F.sum("n")).collect():  # at most 784 rows
        counts[cell] += n
    counts = counts.reshape(STATES, STATES)
    return np.log(counts / counts.sum(1, keepdims=True))


def readings(stretches: list[str], model: np.ndarray) -> list[str]:
    """The likeliest plain text of every stretch: Viterbi over all lattices of one length at a time."""
    out = [""] * len(stretches)
    lengths = np.array([len(s) for s in stretches])
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        score = np.full((len(rows), STATES), -np.inf)
        score[:, EDGE] = 0.0
        back = []  # per place: state before, and whether anything was written
        for at in range(length):
            new = np.full_like(score, -np.inf)
            came = np.zeros(score.shape, np.int8)
            wrote = np.zeros(score.shape, bool)
            signs = np.array([ord(stretches[r][at]) for r in rows])
            for sign in np.unique(signs):
                who, ch = np.flatnonzero(signs == sign), chr(sign)
                s, n, c, w = score[who], new[who], came[who], wrote[who]
                letters = ch if ch.isalpha() else LOOKS_LIKE.get(ch, "")
                for letter in letters:
                    to = ord(letter) - 96
                    steps = s + model[:, to]
                    best = steps.argmax(1)
                    n[:, to] = steps[np.arange(len(who)), best] + (0.0 if ch.isalpha() else AS_LETTER)
                    c[:, to], w[:, to] = best, True
                    stay = s[:, to] + REPEATED  # the letter again, written once
                    better = stay > n[:, to]
                    n[better, to], c[better, to], w[better, to] = stay[better], to, False
                if not ch.isalpha():
                    drop = s + (DROPPED_SEPARATOR if ch in SEPARATORS else DROPPED)
                    better = drop > n
                    n = np.where(better, drop, n)
                    c = np.where(better, np.arange(STATES, dtype=np.int8), c)
                    w &= ~better
                if ch in SEPARATORS:
                    steps = s + model[:, EDGE]
                    best = steps.argmax(1)
                    edge = steps[np.arange(len(who)), best] + BOUNDARY
                    better = edge > n[:, EDGE]
                    n[better, EDGE], c[better, EDGE], w[better, EDGE] = edge[better], best[better], True
                new[who], came[who], wrote[who] = n, c, w
            score = new
            back.append((came, wrote))
        state = (score + model[:, EDGE]).argmax(1)
        text = [[] for _ in rows]
        for came, wrote in reversed(back):
            for i in np.flatnonzero(wrote[np.arange(len(rows)), state]):
                text[i].append(chr(96 + state[i]) if state[i] else " ")
            state = came[np.arange(len(rows)), state].astype(np.int64)
        for i, r in enumerate(rows):
            out[r] = "".join(reversed(text[i]))
    return out


def may_be_suspicious(texts: pa.Array) -> np.ndarray:
    """For each text whether it may hold a suspicious stretch: a cheap test of all bytes at once that misses none."""
    data, offsets = raw(texts)
    data = lowered(data)
    letter = (data >= 97) & (data <= 122)
    sign, separator = (np.isin(data, np.frombuffer(x.encode(), np.uint8)) for x in ("".join(LOOKS_LIKE), SEPARATORS))
    odd = np.zeros(len(data), bool)
    odd[1:] |= (sign[1:] & (letter | sign)[:-1]) | (letter[1:] & sign[:-1])
    odd[2:] |= letter[2:] & (data[2:] == data[1:-1]) & (data[1:-1] == data[:-2])
    one = letter | sign
    odd[4:] |= one[4:] & separator[3:-1] & one[2:-2] & separator[1:-3] & one[:-4] & (data[3:-1] == data[1:-3])
    found = np.zeros(len(texts), bool)
    found[np.searchsorted(offsets, np.flatnonzero(odd), "right") - 1] = True
    return found


#: letters of the shortest word that is looked for between separators
SHORTEST = 4
BREAK = 10


def _alike() -> np.ndarray:
    """Per byte: a letter (signs as the first one they stand for, l as i), 0 for a separator, a break for all else."""
    table = np.full(256, BREAK, np.uint8)
    table[97:123] = np.arange(97, 123)
    for sign, letters in LOOKS_LIKE.items():
        table[ord(sign)] = ord(letters[0])
    table[ord("l")] = ord("i")
    table[[ord(c) for c in SEPARATORS]] = 0
    return table


ALIKE = _alike()
#: bytes that belong to the word they stand beside
BESIDE = np.isin(np.arange(256), [*range(97, 123), *range(48, 58), *b"@$", *range(128, 256)])


def squeezed(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(letters, places): what is left of lower-case bytes without separators and repetitions."""
    alike = ALIKE[data]
    places = np.flatnonzero(alike)
    letters = alike[places]
    new = np.ones(len(letters), bool)
    new[1:] = letters[1:] != letters[:-1]
    return letters[new], places[new]


class Hidden:
    """Stretches of a text in which a word may be hidden between separators and repeated letters."""

    def __init__(self, words: list[str]):
        self.words, self.automaton = set(words), ahocorasick.Automaton()
        for word in words:
            letters = squeezed(np.frombuffer(word.encode(), np.uint8))[0]
            if len(letters) >= SHORTEST and BREAK not in letters:
                self.automaton.add_word(letters.tobytes().decode(), len(letters))
        if len(self.automaton):
            self.automaton.make_automaton()

    def stretches(self, data: np.ndarray) -> list[tuple[int, int]]:
        """(start, end) of whole words around every place where one of the words may stand, but for those that stand there plainly."""
        if not len(self.automaton) or not len(data):
            return []
        letters, places = squeezed(data)
        found: list[tuple[int, int]] = []
        for last, size in self.automaton.iter(letters.tobytes().decode()):
            start, end = int(places[last - size + 1]), int(places[last]) + 1
            while start and BESIDE[data[start - 1]]:
                start -= 1
            while end < len(data) and BESIDE[data[end]]:
                end += 1
            if found and start < found[-1][1]:
                start, end = min(start, found[-1][0]), max(end, found.pop()[1])
            found.append((start, end))
        held = ((a, b, data[a:b].tobytes()) for a, b in found)
        return [(a, b) for a, b, text in held if text.isascii() and text.decode() not in self.words]


class Decoder:
    """Restores texts; remembers what stretches were read as."""

    def __init__(self, model: np.ndarray, words: list[str] = ()):
        self.model, self.known, self.hidden = model, {}, Hidden(words)

    def learn(self, new: set[str]) -> None:
        if len(self.known) + len(new) > REMEMBERED:
            self.known = {}
        ordered = sorted(new - self.known.keys())
        for at in range(0, len(ordered), 4096):
            part = ordered[at:at + 4096]
            self.known.update(zip(part, readings(part, self.model)))

    def reveal(self, texts: list[str]) -> list[str]:
        """The texts with words in the place of stretches that read as one of the words looked for."""
        joined = [t.encode() for t in texts]
        data = np.frombuffer(b"\n".join(joined), np.uint8)
        spans = [(a, b, data[a:b].tobytes().decode()) for a, b in self.hidden.stretches(data)]
        self.learn({text for _, _, text in spans})
        starts = np.concatenate(([0], np.cumsum([len(j) + 1 for j in joined])))
        cut: dict[int, list] = {}
        for a, b, text in spans:
            if not self.hidden.words.isdisjoint(WORDS.findall(self.known[text])):
                cut.setdefault(int(np.searchsorted(starts, a, "right")) - 1, []).append((a, b, self.known[text]))
        for i, found in cut.items():
            parts, at = [], 0
            for a, b, reading in found:
                parts += [joined[i][at:a - starts[i]], reading.encode()]
                at = b - starts[i]
            texts[i] = b"".join([*parts, joined[i][at:]]).decode()
        return texts

    def restore(self, texts: pa.Array) -> list[str]:
        out = [t.decode().lower() for t in binaries(texts)]
        spans = {int(i): list(SUSPICIOUS.finditer(out[i])) for i in np.flatnonzero(may_be_suspicious(texts))}
        self.learn({m[0] for found in spans.values() for m in found})
        for i, found in spans.items():
            parts, at = [], 0
            for m in found:
                parts += [out[i][at:m.start()], self.known[m[0]]]
                at = m.end()
            out[i] = "".join([*parts, out[i][at:]])
        return self.reveal(out)


def restored(text: Column, model: np.ndarray) -> Column:
    """The text in lower case with disguised words decoded."""

    @arrow_udf("string")
    def of_batches(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        decoder = Decoder(model)
        for batch in batches:
            parts = [decoder.restore(part) for part in pieces_of(batch, SLICE)]
            yield pa.array([t for part in parts for t in part], pa.string())
            del parts
            give_back()
        del decoder
        give_back()

    return of_batches(text)


WORDS = re.compile(r"[^\W_]+")


def features(word: str) -> list[int]:
    """Buckets of a word and its beginnings."""
    names = {"=" + word, *("^" + word[:n] for n in BEGINNINGS if len(word) >= n)}
    return sorted({zlib.crc32(n.encode()) % BUCKETS for n in names})


def present(texts: list[str], known: dict[str, tuple], wanted: dict[int, int] | None) -> list[list[int]]:
    """Distinct features of every text, numbered as in ``wanted`` (None: all buckets)."""
    out = []
    for text in texts:
        words = set(WORDS.findall(text))
        if len(known) + len(words) > REMEMBERED:
            known.clear()
        found = set()
        for word in words:
            if (mine := known.get(word)) is None:
                mine = features(word)
                known[word] = mine = tuple(mine if wanted is None else (wanted[f] for f in mine if f in wanted))
            if mine:
                found.update(mine)
        out.append(sorted(found))
    return out


def fit(rows: list[list[int]], y: np.ndarray, width: int, ridge: float = 0.05, steps: int = 400) -> np.ndarray:
    """Weights of a logistic regression on 0/1 features, intercept last; few rows and features, so in the driver."""
    i = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    j = np.array([f for r in rows for f in r], np.int64)
    w, slope = np.zeros(width + 1), np.zeros(width + 1)
    size = np.full(width + 1, 1e-8)
    for _ in range(steps):
        z = np.bincount(i, w[j], len(rows)) + w[-1]
        e = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y
        g = np.append(np.bincount(j, e[i], width), e.sum())
        g[:-1] += ridge * w[:-1]
        size += g * g
        slope = 0.9 * slope + g / np.sqrt(size)
        w -= 0.1 * slope
    return w


class Scorer:
    """What scoring needs: the letter model, the features' numbers, the weights, the words that are looked for."""

    def __init__(self, model: np.ndarray, wanted: dict[int, int], weights: np.ndarray, words: list[str] = ()):
        self.model, self.wanted, self.weights, self.words = model, wanted, weights, words

    def score(self, text: Column) -> Column:
        """Probability that the text is toxic, between 0 and 1."""
        model, wanted, weights, words = self.model, self.wanted, self.weights, self.words

        @arrow_udf("double")
        def of_batches(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            decoder, known = Decoder(model, words), {}
            for batch in batches:
                found = [f for part in pieces_of(batch, SLICE) for f in present(decoder.restore(part), known, wanted)]
                z = np.array([weights[f].sum() for f in found]) + weights[-1]
                yield pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))), pa.float64())
                del found, z
                give_back()
            del decoder, known
            give_back()

        return of_batches(text)


def train(docs: DataFrame, labels: DataFrame, held_out: Column | None = None, rows: int = FIT_ROWS) -> Scorer:
    """Fit on about ``rows`` labelled documents, none of which is ``held_out`` (a condition on doc_id).

    Labels are 0 or 1 in ``toxic``; other labels and null ids are ignored, and an id with both
    counts as toxic.  Without labels of both classes every text gets the share of toxic
    labels as its score (0 without any labels).
    """
    settings.ensure_checkpoint_dir(docs.sparkSession)
    model = letter_model(docs)
    marks = labels.filter(labels["toxic"].isin(0, 1) & labels["doc_id"].isNotNull()).groupBy(
        labels["doc_id"]).agg(F.max("toxic").cast("int").alias("toxic"))
    if held_out is not None:
        marks = marks.filter(~held_out)
    total = marks.count()
    share = min(1.0, rows / max(total, 1))
    marks = marks.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000))
    ids = marks.select(F.col("doc_id").alias("id"), "toxic")
    known = docs.select(docs["doc_id"].alias("own"), text_column(docs).alias("text"))
    drawn = known.join(F.broadcast(ids), F.col("own") == F.col("id")).select(  # about `rows` ids
        restored(F.col("text"), model).alias("text"), "toxic").checkpoint()
    n = dict(drawn.groupBy("toxic").count().collect())
    if len(n) < 2:
        rate = 1 - 1e-6 if n.get(1) else 1e-6
        return Scorer(model, {}, np.array([np.log(rate / (1 - rate))]))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((2, BUCKETS), np.int32)
        known: dict[str, tuple] = {}
        for batch in batches:
            marks = batch.column(1).to_pylist()
            for mark, found in zip(marks, present(batch.column(0).to_pylist(), known, None)):
                totals[mark, found] += 1
        seen = np.flatnonzero(totals[1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen), pa.array(totals[1, seen]), pa.array(totals[0, seen])], ["f", "a", "b"])

    # buckets that toxic rows never have are of no use; those they have need the count of clean rows everywhere
    toxic = drawn.filter("toxic = 1").mapInArrow(count, "f long, a int, b int").groupBy("f").agg(F.sum("a").alias("a"))
    toxic = toxic.filter("a >= 3")
    clean = drawn.filter("toxic = 0").withColumn("toxic", F.lit(1)).mapInArrow(count, "f long, a int, b int").groupBy(
        "f").agg(F.sum("a").alias("b"))
    a, b = F.col("a").cast("double"), F.coalesce("b", F.lit(0)).cast("double")
    na, nb = F.lit(float(n[1])), F.lit(float(n[0]))

    def part(x, n, rate):  # of the log-likelihood
        return x * F.log(rate) + (n - x) * F.log(F.greatest(1 - rate, F.lit(1e-12)))

    rate, eps = (a + b) / (na + nb), F.lit(1e-12)
    gain = 2 * (part(a, na, F.greatest(a / na, eps)) + part(b, nb, F.greatest(b / nb, eps)) - part(a, na, rate) - part(b, nb, rate))
    best = toxic.join(clean, "f", "left").filter(a / na > b / nb).select("f", gain.alias("gain")).filter(
        F.col("gain") >= EVIDENCE).orderBy(F.desc("gain"), "f").limit(FEATURES).collect()
    wanted = {int(r["f"]): i for i, r in enumerate(best)}

    @arrow_udf("array<int>")
    def chosen(texts: pa.Array) -> pa.Array:
        return pa.array(present(texts.to_pylist(), {}, wanted), pa.list_(pa.int32()))

    sample = drawn.select(chosen("text").alias("found"), "toxic").collect()  # about `rows` short lists
    weights = fit([r["found"] for r in sample], np.array([r["toxic"] for r in sample], float), len(wanted))

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Words of each text that are features themselves."""
        for batch in batches:
            found = [w for t in batch.column(0).to_pylist() for w in set(WORDS.findall(t))
                     if w.isascii() and zlib.crc32(f"={w}".encode()) % BUCKETS in wanted]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], ["word"])

    # at most as many as fit into `rows` texts; a word that only shares the bucket of a feature is seldom in three of them
    words = drawn.filter("toxic = 1").select("text").mapInArrow(named, "word string").groupBy("word").count().filter("count >= 3")
    return Scorer(model, wanted, weights, sorted(r["word"] for r in words.collect()))


def held_out(modulus: int, remainder: int) -> Column:
    """Documents kept from training: crc32 of the id as text leaves this remainder; a null id counts as "null"."""
    ident = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    return F.crc32(ident.cast("binary")) % modulus == remainder


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per row of ``docs``.

    Learns from labelled rows outside the held-out quarter.  Null and empty texts get the
    score of a text without features; null ids keep their row; repeated rows repeat;
    texts are read whole; other columns play no part; an empty table gives no rows.
    """
    out = held_out(4, 2)
    scorer = train(docs, labels, out)
    scored = docs.select(docs["doc_id"], scorer.score(text_column(docs)).alias("score"))
    return scored.select("doc_id", out.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def reject_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """``docs`` without the rows that are scored as toxic; all columns stay.

    Null and empty texts are scored as texts without features; null ids are kept or not by their text, repeated rows together;
    texts are read whole; an empty table stays empty.
    """
    scorer = train(docs, labels, held_out(4, 2))
    return docs.filter(scorer.score(text_column(docs)) < threshold)
