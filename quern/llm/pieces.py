"""SentencePiece encoding and decoding (BPE models) by matching all pieces at once.

A batch of texts is cut where no piece of the vocabulary can reach over: before each run of spaces, between a letter
and most other signs, around characters that it lacks.  The distinct stretches are put one after the other into one array of characters.  A suffix
array over it, sorted by as many characters as the longest piece has, is searched by halving for
every piece of the vocabulary: the suffixes that begin with a piece are one range.  The
ranges are edges (start, end, piece); sorted by end they are relaxed from left to right.

What is relaxed is not a sum of scores but the rule of byte-pair merging.  The merging of any
prefix of a stretch ends in one certain piece, and two pieces may stand side by side exactly
if merging their joined text gives back the two.  So an edge holds if its piece may follow the one that
ends where it starts, and of all edges that end at a place one holds.  The check undoes
the merges of both pieces, the latest first, and looks for an earlier merge across the border.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from quern.llm.common import binaries, give_back, pieces_of, text_column

#: the public vocabulary used where none is named
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
#: bytes of text that are encoded at once, stretches that a worker remembers, and ids that it remembers for each
BATCH_BYTES, REMEMBERED, SHORT = 2 << 20, 300_000, 16
#: characters of new stretches that are matched at once
MATCHED = 1 << 18
#: rows of ids that are decoded at once hold about so many ids
BATCH_IDS = 1 << 20
START, NONE = -2, -1
UNIT = re.compile(f"{SPACE}+[^{SPACE}]*")


def merged(text: str, score: dict[str, float]) -> tuple[list[str], tuple[str, str] | None]:
    """The pieces that byte-pair merging leaves of a text, and the last two that it merged."""
    parts: list[str | None] = list(text)
    after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
    heap: list[tuple[float, int, str]] = []

    def offer(i: int) -> None:
        if i >= 0 and after[i] < len(parts) and (joint := parts[i] + parts[after[i]]) in score:
            heapq.heappush(heap, (-score[joint], i, joint))

    for i in range(len(parts)):
        offer(i)
    last = None
    while heap:
        _, i, joint = heapq.heappop(heap)
        if parts[i] is None or after[i] >= len(parts) or parts[i] + parts[after[i]] != joint:
            continue
        gone = after[i]
        last = parts[i], parts[gone]
        parts[i], parts[gone] = joint, None
        after[i] = after[gone]
        if after[i] < len(parts):
            before[after[i]] = i
        offer(before[i])
        offer(i)
    return [p for p in parts if p is not None], last


class Vocabulary:
    """A BPE model's pieces, numbered by rank: single characters first, then in order of merging."""

    def __init__(self, path: str = MODEL):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        every = range(model.get_piece_size())
        special = {i for i in every if model.is_control(i) or model.is_unknown(i) or model.is_unused(i)}
        self.bytes = {int(model.id_to_piece(i)[1:-1], 16): i for i in every if model.is_byte(i)}
        score = {model.id_to_piece(i): model.get_score(i) for i in every if i not in special and not model.is_byte(i)}
        ident = {model.id_to_piece(i): i for i in every if i not in special}
        inner = [p for p in score if SPACE in p.lstrip(SPACE)]
        ranks = [s for p, s in score.items() if len(p) > 1 and p.strip(SPACE)]
        if (inner or len(self.bytes) != 256 or len(set(ranks)) != len(ranks) or any(c not in score for p in score for c in p)
                or model.encode(" a", out_type=str)[0] == SPACE + "a" or SPACE not in model.encode("a", out_type=str)[0]):
            raise ValueError(f"{path}: only BPE models with byte fallback and plain text with a space before it are supported")
        self.score, self.ident = score, ident
        singles = sorted(p for p in score if len(p) == 1)
        self.pieces = singles + sorted((p for p in score if len(p) > 1 and p.strip(SPACE)), key=lambda p: -score[p])
        rank = {p: i for i, p in enumerate(self.pieces)}
        self.unknown = len(self.pieces)  # a character that the vocabulary lacks
        split = np.repeat(np.arange(len(self.pieces) + 1)[:, None], 2, axis=1)
        proper = np.ones(len(self.pieces), bool)
        for p in self.pieces[len(singles):]:
            left, last = merged(p, score)
            proper[rank[p]] = left == [p]
            if left == [p]:
                split[rank[p]] = rank[last[0]], rank[last[1]]
        self.split, self.proper = split.astype(np.int64), proper
        joints = {}
        for p in self.pieces[len(singles):]:
            for cut in range(1, len(p)):
                a, b = rank.get(p[:cut]), rank.get(p[cut:])
                if a is not None and b is not None:
                    joints[a * (self.unknown + 1) + b] = rank[p]
        keys = np.array(sorted(joints), np.int64)
        self.joint_keys, self.joint = keys, np.array([joints[k] for k in keys.tolist()], np.int64)
        self.ids = np.array([ident[p] for p in self.pieces] + [0], np.int32)
        self.alphabet = np.array([ord(p) for p in singles], np.uint32)
        self.longest = max(len(p) for p in self.pieces)
        self.lengths = np.array([len(p) for p in self.pieces], np.int64)
        self.spelled = np.zeros((len(self.pieces), self.longest), np.uint16)
        for i, p in enumerate(self.pieces):
            self.spelled[i, :len(p)] = self.letters(p)
        alphabetical = np.lexsort(self.spelled.T[::-1])  # neighbours are searched for one after the other
        self.sought = alphabetical[proper[alphabetical]].astype(np.int32)
        self.spelled = self.spelled[self.sought]
        # a joint that is not marked here is none; few others are marked by chance
        self.marked = np.zeros(1 << 20, bool)
        self.marked[self.mark(self.joint_keys)] = True
        # characters that never follow a letter or digit inside a piece, and ASCII that is in no piece at all
        after = {b for p in score for a, b in zip(p, p[1:]) if a.isalnum()}
        apart = "".join(c for c in singles if not c.isalnum() and c != SPACE and c not in after)
        lacking = "".join(c for c in map(chr, range(128)) if c not in score)
        self.apart, self.lacking = (f"[{re.escape(x)}]" if x else "[^\\s\\S]" for x in (apart, lacking))
        shown = [model.id_to_piece(i).replace(SPACE, " ").encode() if i not in special else b"" for i in every]
        for value, i in self.bytes.items():
            shown[i] = bytes([value])
        self.shown = shown

    def stretches(self) -> re.Pattern:
        """Cuts a text into stretches that merge each by itself."""
        own, no = self.apart[1:-1] if self.apart != "[^\\s\\S]" else "", self.lacking[1:-1] if self.lacking != "[^\\s\\S]" else ""
        inner = f"[^{SPACE}{own}{no}]"
        return re.compile(f"{self.lacking}+|(?:{SPACE}+|{self.apart}|{inner})(?:{inner}+|(?<![^\\W_]){self.apart})*")

    def letters(self, text: str) -> np.ndarray:
        """Number of every character: 1 if the vocabulary lacks it; 0 is kept for the gaps between stretches."""
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        at = np.minimum(np.searchsorted(self.alphabet, points), len(self.alphabet) - 1)
        return np.where(self.alphabet[at] == points, at + 2, 1).astype(np.uint16)

    @staticmethod
    def mark(keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).astype(np.int64)

    def may_follow(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging the joined text of pieces a and b gives a and b (START: nothing before)."""
        out = np.ones(len(a), bool)
        live = np.flatnonzero((a != START) & (a != self.unknown) & (b != self.unknown))
        x, y = a[live], b[live]
        limit = np.full(len(live), np.iinfo(np.int64).max)
        while len(live):
            key = x * (self.unknown + 1) + y
            may = np.flatnonzero(self.marked[self.mark(key)])
            at = np.minimum(np.searchsorted(self.joint_keys, key[may]), len(self.joint_keys) - 1)
            crossed = np.zeros(len(key), bool)
            crossed[may] = (self.joint_keys[at] == key[may]) & (self.joint[at] < limit[may])
            out[live[crossed]] = False
            sx, sy = self.split[x, 1], self.split[y, 0]
            # undo the later of the two merges; at equal rank the right one, since the left one came first
            left = (x > y) & (sx != x) | (sy == y)
            ended = crossed | (sx == x) & (sy == y)
            limit = np.where(left, x, y + 1)
            x, y = np.where(left, sx, x), np.where(left, y, sy)
            go = ~ended
            live, x, y, limit = live[go], x[go], y[go], limit[go]
        return out

    def edges(self, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, piece) of every occurrence of a piece, by suffix array and binary search."""
        # the characters that occur, numbered anew in the same order: most often they fit a byte
        there = np.bincount(chars, minlength=len(self.alphabet) + 2) > 0
        there[:2] = True
        number = np.cumsum(there) - 1
        kind, width = (np.dtype(np.uint8), 8) if number[-1] < 255 else (np.dtype(">u2"), 16)
        wide = np.concatenate((number[chars], np.zeros(self.longest, np.int64))).astype(kind)
        suffixes = np.ndarray((len(chars),), f"S{kind.itemsize * self.longest}", wide.data, 0, (kind.itemsize,))
        order = np.flatnonzero(chars > 1)
        step = 64 // width
        for at in range((self.longest - 1) // step * step, -1, -step):  # stable sorts, `step` characters at a time
            word = np.zeros(len(chars), np.uint64)
            for k in range(at, min(at + step, self.longest)):
                word = (word << np.uint64(width)) | wide[k:k + len(chars)].astype(np.uint64)
            order = order[np.argsort(word[order], kind="stable")]
        ordered = suffixes[order]
        usable = np.flatnonzero(there[self.spelled].all(1))
        spelled = self.spelled[usable]
        low, high = number[spelled], np.where(spelled > 0, number[spelled], (1 << width) - 1)
        low, high = (np.ascontiguousarray(x.astype(kind)).view(ordered.dtype)[:, 0] for x in (low, high))
        low = np.searchsorted(ordered, low, "left").astype(np.int32)
        n = np.searchsorted(ordered, high, "right").astype(np.int32) - low
        del ordered
        place = np.arange(n.sum(), dtype=np.int32) + np.repeat(low - np.cumsum(n, dtype=np.int32) + n, n)
        return order.astype(np.int32)[place], np.repeat(self.sought[usable], n)

    def match(self, stretches: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """``matched`` for about MATCHED characters at a time: its arrays take some hundred bytes per character."""
        group = np.cumsum([len(s) + 1 for s in stretches]) // MATCHED
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(stretches)]
        ids, count = zip(*(self.matched(stretches[a:b]) for a, b in zip(cuts, cuts[1:])))
        return np.concatenate(ids), np.concatenate(count)

    def matched(self, stretches: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all stretches in a row, number of ids of each): at most one space character, at a stretch's beginning."""
        sizes = np.array([len(s) for s in stretches])
        begin = np.cumsum(sizes + 1) - sizes - 1
        chars = np.zeros(int((sizes + 1).sum()), np.uint16)
        inside = np.repeat(begin - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        joined = "".join(stretches)
        chars[inside] = self.letters(joined)
        first = np.zeros(len(chars), np.int32)
        first[inside] = np.repeat(begin, sizes)
        start, piece = self.edges(chars)
        lacking = np.flatnonzero(chars == 1)
        start = np.concatenate((start, lacking.astype(np.int32)))
        piece = np.concatenate((piece, np.full(len(lacking), self.unknown, np.int32)))
        end = start + np.append(self.lengths, 1).astype(np.int32)[piece]
        due = end - first[start]
        by = np.argsort(due.astype(np.uint16) if sizes.max(initial=0) < 1 << 16 else due, kind="stable")
        start, piece, end, due = start[by], piece[by], end[by], due[by]
        del by
        ends = np.full(len(chars) + 1, NONE, np.int64)  # the piece that ends at a place
        ends[begin] = START
        came = np.zeros(len(chars) + 1, np.int64)
        at = 0
        for upto in np.flatnonzero(np.bincount(due)) if len(due) else ():
            stop = int(np.searchsorted(due, upto, "right"))
            s, p, e = start[at:stop], piece[at:stop], end[at:stop]
            at = stop
            live = ends[s] != NONE
            s, p, e = s[live], p[live], e[live]
            holds = self.may_follow(ends[s], p)
            ends[e[holds]], came[e[holds]] = p[holds], s[holds]
        return self.collected(begin, sizes, ends, came, chars, joined, inside)

    def collected(self, begin, sizes, ends, came, chars, joined, inside) -> tuple[np.ndarray, np.ndarray]:
        """Walk all stretches from their ends to their beginnings; unknown characters become bytes."""
        owner, place, found = [], [], []
        who, at = np.arange(len(begin)), begin + sizes
        while len(who):
            going = at > begin[who]
            who, at = who[going], at[going]
            owner.append(who)
            found.append(ends[at])
            at = came[at]
            place.append(at)
        owner, place, found = map(np.concatenate, (owner, place, found))
        order = np.lexsort((place, owner))
        owner, place, found = owner[order], place[order], found[order]
        ids, count = self.ids[found], np.ones(len(found), np.int64)
        lacking = np.flatnonzero(found == self.unknown)
        if len(lacking):
            back = np.zeros(len(chars), np.int64)
            back[inside] = np.arange(len(inside))
            coded = [joined[i].encode("utf-8", "replace") for i in back[place[lacking]]]
            count[lacking] = [len(c) for c in coded]
            ids = np.repeat(ids, count)
            heads = (np.cumsum(count) - count)[lacking]
            for head, c in zip(heads.tolist(), coded):
                ids[head:head + len(c)] = [self.bytes[x] for x in c]
        return ids, np.bincount(owner, count, len(begin)).astype(np.int64)

    def run(self, n: int) -> list[int]:
        """Ids of n spaces in a row."""
        return [self.ident[p] for p in merged(SPACE * n, self.score)[0]]

    def stretch_ids(self, stretches: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for stretches that may begin with several spaces: the last joins the word, if it merges with it."""
        many = [i for i, s in enumerate(stretches) if s.startswith(SPACE * 2)]
        cores, spaces = list(stretches), {}
        for i in many:
            s = stretches[i]
            spaces[i] = len(s) - len(s.lstrip(SPACE)) - 1 if s.strip(SPACE) else len(s)
            cores[i] = s[spaces[i]:]
        ids, count = self.match(cores)
        if not many:
            return ids, count
        parts = np.split(ids, np.cumsum(count)[:-1])
        for i in many:
            n, own = spaces[i], parts[i]
            if len(own) and own[0] == self.ident[SPACE]:
                n, own = n + 1, own[1:]
            parts[i] = np.concatenate((np.array(self.run(n), np.int32), own))
        return np.concatenate(parts), np.array([len(x) for x in parts], np.int64)


class Memory:
    """Ids of texts that were seen before, in one array that grows until there are too many."""

    def __init__(self, make):
        self.make = make  # texts -> (ids of all in a row, number of ids of each)
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids, self.ends = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def look_up(self, lists: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts of all lists in a row, number of ids of each list)."""
        used = list(chain.from_iterable(lists))
        new = set(used).difference(self.known)
        if len(self.known) + len(new) > REMEMBERED or len(self.ids) > REMEMBERED * SHORT:
            self.forget()
            new = set(used)
        if new:
            names = list(new)
            ids, count = self.make(names)
            self.known.update(zip(names, range(len(self.known), len(self.known) + len(names))))
            self.ids = np.concatenate((self.ids, ids))
            self.ends = np.concatenate((self.ends, self.ends[-1] + np.cumsum(count)))
        number = np.fromiter(map(self.known.__getitem__, used), np.int64, len(used))
        n = self.ends[number + 1] - self.ends[number]
        tops = np.cumsum(n)
        place = np.arange(n.sum()) + np.repeat(self.ends[number] - tops + n, n)
        return self.ids[place], np.diff(np.concatenate(([0], tops))[np.cumsum([0, *map(len, lists)])])


class Encoder:
    """Encodes texts batch by batch: texts from words, new words from stretches, new stretches by matching."""

    def __init__(self, vocabulary: Vocabulary):
        self.cut = vocabulary.stretches().findall
        self.stretches = Memory(vocabulary.stretch_ids)
        self.words = Memory(lambda words: self.stretches.look_up([self.cut(w if w[0] == SPACE else SPACE + w) for w in words]))

    def encode(self, texts: pa.Array) -> pa.Array:
        """A list of ids per text."""
        ids, count = self.words.look_up([self.units(t) for t in pc.fill_null(texts, "").to_pylist()])
        return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(count))), pa.int32()), pa.array(ids, pa.int32()))

    @staticmethod
    def units(text: str) -> list[str]:
        """Words, and with several spaces before it a word together with them; joined they are the text."""
        if not text:
            return []
        if "  " in text or text[0] == " " or text[-1] == " " or SPACE in text:
            every = UNIT.findall(SPACE + text.replace(" ", SPACE))
            return [u[1:] if len(u) > 1 and u[1] != SPACE else u for u in every]
        return text.split(" ")


def encode(text: Column, vocabulary: Vocabulary) -> Column:
    """Ids of a text, as the model's own merging gives them; none for an empty or null text."""

    @arrow_udf("array<int>")
    def of_batches(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = Encoder(vocabulary)
        for batch in batches:
            parts = [encoder.encode(part) for part in pieces_of(batch, BATCH_BYTES)]
            yield pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int32()))
            del parts
            give_back()
        del encoder
        give_back()

    return of_batches(text)


class Decoder:
    """Bytes of every id, and texts made of them."""

    def __init__(self, vocabulary: Vocabulary):
        self.shown = pa.array(vocabulary.shown, pa.large_binary())

    def texts(self, lists: pa.Array) -> Iterator[bytes]:
        """UTF-8 of every list of ids, without the space that encoding puts before a text."""
        flat = lists.flatten()
        if len(flat) and (pc.min(flat).as_py() < 0 or pc.max(flat).as_py() >= len(self.shown)):
            raise ValueError("an id is outside the vocabulary")
        taken = self.shown.take(flat)  # one after the other in one buffer
        ends = np.frombuffer(taken.buffers()[1], np.int64) if len(flat) else np.zeros(1, np.int64)
        joined = memoryview(taken.buffers()[2] or b"") if len(flat) else memoryview(b"")
        cuts = ends[np.cumsum([0, *pc.list_value_length(lists).to_pylist()])].tolist()
        for a, b in zip(cuts, cuts[1:]):
            yield bytes(joined[a + 1:b] if joined[a:a + 1] == b" " and b > a else joined[a:b])


def decode(ids: Column, vocabulary: Vocabulary) -> Column:
    """Text of a list of ids; bytes that are no text become U+FFFD."""
    decoder = Decoder(vocabulary)

    @arrow_udf("string")
    def of_batch(lists: pa.Array) -> pa.Array:
        lists = pc.fill_null(lists, [])
        group = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False)) // BATCH_IDS
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(lists)]
        return pa.array([t.decode("utf-8", "replace") for a, b in zip(cuts, cuts[1:]) for t in decoder.texts(lists.slice(a, b - a))], pa.string())

    return of_batch(ids)


def tokenize(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """(doc_id, n_tokens, ids, round_trip), one row per row of ``docs``.

    round_trip tells whether the text made from the ids again equals the text: always, but for texts with
    U+2581, which the model itself cannot tell from a space.  Null texts are taken as empty; empty texts have no ids;
    null ids and repeated rows stay; texts are read whole; other columns play no part; an empty table gives no rows.
    """
    vocabulary = Vocabulary(model)

    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = Encoder(vocabulary), Decoder(vocabulary)
        for batch in batches:
            at = 0
            for part in pieces_of(batch.column(1), BATCH_BYTES):  # each goes out by itself: a batch of long texts is never held whole
                own = batch.column(0).slice(at, len(part))
                at += len(part)
                ids = encoder.encode(part)
                same = [a == b for a, b in zip(decoder.texts(ids), binaries(part))]
                yield pa.RecordBatch.from_arrays(
                    [own, pa.array(np.diff(ids.offsets.to_numpy()), pa.int32()), ids, pa.array(same, pa.bool_())],
                    ["doc_id", "n_tokens", "ids", "round_trip"])
            give_back()
        del encoder, decoder
        give_back()

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select(docs["doc_id"], text_column(docs).alias("text"))
    return rows.mapInArrow(both, f"doc_id {kind}, n_tokens int, ids array<int>, round_trip boolean")
