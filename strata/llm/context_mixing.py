"""Language-model scoring by logistic context mixing (op 6).

A text is its words (A-Z lower-cased) and an end. A word is coded as its bytes and a space, the end as a line feed;
each byte is a path of bits in a Huffman code of the training bytes, so a text's probability is a product of bits.

* Predictors: for each bit, the counts of 0 and 1 seen after a hashed context: the last one, two, three and four
  bytes of the text (across the space, into the word before), the whole word so far, and the word so far with the whole
  word before (for a word's first ``OPEN`` bytes). Counts of all training words are gathered in tables of ``2 ** bits``
  cells (``TABLE_BITS``, fixed lengths; every task's tables are summed by Spark, in rounds).
* What is coded once: a byte's contexts are a word and, near its start, something of the word before. So of some MB
  of texts (``CHUNK``) each distinct opening (word before, first ``OPEN`` bytes), each third byte with the last byte
  before the word, and each distinct word's rest are coded once, times how often they occur.
* Mixing: the predictors' stretched probabilities (and how sure they are) are combined by weights that a gate
  chooses (the place in the word and the number of contexts that know the case), trained online by gradient steps
  on documents that the tables leave out until the weights are found (``MIX_FOLD``); then their counts are added.
* Refinement: an adaptive probability map per gate corrects the mixed probability by the bits seen at it, in the
  same pass.

* At a word's end its probability is averaged with the exact share that the word has among the most frequent
  training words. The weight is fitted on the same documents by expectation maximisation, each against the counts of the
  others (without such documents: the Good-Turing estimate of the mass that those words hold).

The sum over a text's words is its score, a proper probability of the word sequence (every byte string has a code).
``bits_per_byte`` divides by the coded bytes. The base score counts whole words exactly: counts of the most
frequent words are broadcast (``FREQUENT``, a fixed bound), the others are joined.

Learning uses documents whose crc32(doc_id as text) mod ``folds`` is not ``held``; a null doc_id counts as
training. Null and empty texts are one end. Texts of any length are scored whole; repeated rows score alike. Only
``doc_id`` and ``text`` are read. Without training rows bits are even and N and V are 0 (the base is 0 then). An
empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import _SPACE, bounded_batches, keep, lean, merged_parts, mix, pack, part_of, text_bytes, word_hashes
from strata.llm.quality import fold

CONTEXTS, TABLE_BITS = 6, (16, 18, 20, 21, 21, 21)
FREQUENT = 1 << 18
#: Of the training documents, the remainder of crc32 mod 10 * folds / 10 that trains weights before it joins the tables.
MIX_FOLD = 1
SPACE, END = 0x20, 0x0A
#: Bytes of a word that are coded with the whole word before; the next one sees that word's last byte.
OPEN = 2
GATES, MAP_CELLS, LIMIT = 4 * (CONTEXTS + 1), 33, 24.0
END_HASH = np.uint64(0x9D5C3A1B2F4E6071)
#: Bytes coded at a time, and bytes of texts whose distinct words are coded together.
AT_ONCE, CHUNK = 1 << 13, 6 << 20


class Code:
    """Huffman code of bytes: for byte b, nodes[b, d] and bits[b, d] at depth d < length[b]."""

    def __init__(self, counts: np.ndarray):
        heap = [(int(c) * 256 + 1, b, b) for b, c in enumerate(counts)]
        heapq.heapify(heap)
        children: dict[int, tuple[int, int]] = {}
        name = 256
        while len(heap) > 1:
            a, b = heapq.heappop(heap), heapq.heappop(heap)
            children[name] = (a[2], b[2])
            heapq.heappush(heap, (a[0] + b[0], name, name))
            name += 1
        paths: dict[int, list[tuple[int, int]]] = {}
        todo = [(name - 1, [])]
        while todo:
            node, path = todo.pop()
            if node < 256:
                paths[node] = path
            else:
                todo += [(child, [*path, (node - 256, bit)]) for bit, child in enumerate(children[node])]
        self.length = np.array([len(paths[b]) for b in range(256)])
        self.nodes = np.zeros((256, self.length.max()), dtype=np.int64)
        self.bits = np.zeros((256, self.length.max()), dtype=np.int64)
        for b, path in paths.items():
            for d, (node, bit) in enumerate(path):
                self.nodes[b, d], self.bits[b, d] = node, bit
        used = np.arange(self.length.max()) < self.length[:, None]
        self.first = np.cumsum(self.length) - self.length  # of a byte's bits in the flat arrays
        self.flat_node = self.nodes[used].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        self.flat_bit = self.bits[used]


class Units(NamedTuple):
    """Byte strings of which the bytes from place ``skip`` on are coded, the others are context.

    ``history`` has the four bytes before each (plus 1, the nearest first, 0 for none), ``before`` the hash of the word
    before; without it that context is left out."""

    data: np.ndarray
    size: np.ndarray
    skip: int
    history: np.ndarray
    before: np.ndarray | None


def cut_out(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Pieces of ``data``, one after the other."""
    return data[np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())]


def runs(units: Units) -> Iterator[tuple[slice, Units]]:
    """Runs of units of about AT_ONCE bytes at most (a longer unit is one run)."""
    total = np.cumsum(units.size)
    at = 0
    while at < len(total):
        done = int(total[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(total, done + AT_ONCE, side="right")))
        part = slice(at, to)
        yield part, Units(units.data[done:int(total[to - 1])], units.size[part], units.skip, units.history[part],
                          None if units.before is None else units.before[part])
        at = to


def joined(texts: list) -> tuple[bytes, np.ndarray]:
    """Lower-cased bytes of all texts, a space and a line feed after each, and where that line feed is."""
    pieces = [text_bytes(t).lower() for t in texts]
    return b" \n".join([*pieces, b""]), np.cumsum([len(p) + 2 for p in pieces]) - 1


class Words:
    """Tokens of texts: hash and text of each (``word``, ``owner``), the distinct ones, and what is coded of them once."""

    def __init__(self, texts: list):
        data, stop = joined(texts)
        h, start, end = word_hashes(data)
        size = np.diff(np.searchsorted(start, stop), prepend=0) + 1
        last = np.cumsum(size) - 1
        self.owner = np.repeat(np.arange(len(texts)), size)
        ends = np.zeros(len(self.owner), dtype=bool)
        ends[last] = True
        self.word = np.full(len(ends), END_HASH)
        self.word[~ends] = h
        self.distinct, self.which = np.unique(self.word, return_inverse=True)
        self.data = np.frombuffer(data + bytes(OPEN + 1), dtype=np.uint8).copy()
        self.data[_SPACE[self.data]] = SPACE
        self.data[stop] = END
        at, size = np.empty(len(ends), dtype=np.int64), np.ones(len(ends), dtype=np.int64)
        at[~ends], at[ends] = start, stop
        size[~ends] = end - start + 1
        any_of = np.empty(len(self.distinct), dtype=np.int64)
        any_of[self.which] = np.arange(len(ends))
        #: Place and coded bytes (the terminator too) of each distinct word.
        self.start, self.size = at[any_of], size[any_of]
        #: The distinct word before each token, len(distinct) at a text's start.
        self.before = np.append(len(self.distinct), self.which[:-1])
        self.before[last[:-1] + 1] = len(self.distinct)

    def _byte(self, place: int) -> np.ndarray:
        """The byte at a place of each distinct word, plus 1; 0 where the word is shorter."""
        return np.where(self.size > place, self.data[self.start + np.minimum(place, self.size - 1)].astype(np.int64) + 1, 0)

    def units(self) -> Iterator[tuple[Units, np.ndarray, np.ndarray, np.ndarray]]:
        """What is coded once: the units, how often each occurs, the tokens that have one (a slice or places), and
        which one each of them has."""
        n = len(self.distinct)
        tail = np.zeros((n + 1, 4), dtype=np.int64)  # what a word leaves before the next one
        tail[:, 0] = SPACE + 1  # a text's start is like a space
        for k in range(1, 4):
            tail[:n, k] = np.where(self.size > k, self.data[np.maximum(self.start + self.size - 1 - k, 0)].astype(np.int64) + 1, 0)
        first = [self._byte(k) for k in range(OPEN + 1)]
        head = first[0]
        for k in range(1, OPEN):
            head = head * 257 + first[k]
        heads, kind = np.unique(head, return_inverse=True)
        of_head = np.empty(len(heads), dtype=np.int64)
        of_head[kind] = np.arange(n)
        key, which = np.unique(self.before * len(heads) + kind[self.which], return_inverse=True)
        before, word = key // len(heads), of_head[key % len(heads)]
        size = np.minimum(self.size[word], OPEN)
        hashes = np.append(self.distinct, np.uint64(0))
        yield (Units(cut_out(self.data, self.start[word], size), size, 0, tail[before], hashes[before]),
               np.bincount(which, minlength=len(key)), slice(None), which)

        where = np.flatnonzero((self.size > OPEN)[self.which])
        head = head * 257 + first[OPEN]
        key, at, which = np.unique(head[self.which[where]] * 257 + tail[self.before[where], 1], return_index=True, return_inverse=True)
        word, before = self.which[where[at]], self.before[where[at]]
        size = np.full(len(word), OPEN + 1)
        yield (Units(cut_out(self.data, self.start[word], size), size, OPEN, tail[before], None),
               np.bincount(which, minlength=len(key)), where, which)

        longer = np.flatnonzero(self.size > OPEN + 1)
        place = np.full(n, -1)
        place[longer] = np.arange(len(longer))
        where = np.flatnonzero(place[self.which] >= 0)
        which = place[self.which[where]]
        size = self.size[longer]
        yield (Units(cut_out(self.data, self.start[longer], size), size, OPEN + 1, np.repeat(tail[-1:], len(longer), 0), None),
               np.bincount(which, minlength=len(longer)), where, which)

    def coded_bytes(self) -> np.ndarray:
        """Coded bytes of each token."""
        return self.size[self.which]


def coded(units: Units, code: Code):
    """Per coded bit: unit, bit, place in the word (0 to 3), and its cell in each context's table."""
    size, data = units.size, units.data.astype(np.int64)
    start = np.cumsum(size) - size
    unit = np.repeat(np.arange(len(size)), size)
    place = np.arange(len(data)) - start[unit]
    power = (data + 1).astype(np.uint64) * np.cumprod(np.append(np.uint64(1), np.full(
        max(0, size.max() - 1), 0x9E3779B97F4A7C15, dtype=np.uint64)), dtype=np.uint64)[place]
    total = np.append(np.uint64(0), np.cumsum(power, dtype=np.uint64))
    here = np.flatnonzero(place >= units.skip)
    unit, place = unit[here], place[here]
    so_far = total[here] - total[start[unit]]  # hash of the word's bytes before this one
    last = []
    for k in range(4):
        far = place > k
        byte = np.empty(len(here), dtype=np.int64)
        byte[far] = data[here[far] - k - 1] + 1
        byte[~far] = units.history[unit[~far], k - place[~far]]
        last.append(byte.astype(np.uint64))
    base = np.uint64(0x100000001B3)
    one = last[0]
    two = one * base + last[1]
    three = two * base + last[2]
    four = three * base + last[3]
    contexts = [one, two + np.uint64(1 << 40), three + np.uint64(2 << 40), four + np.uint64(3 << 40),
                mix(so_far + np.uint64(5))]
    if units.before is not None:
        contexts.append(mix(so_far + np.uint64(7)) + mix(units.before + np.uint64(11))[unit])
    data = data[here]
    many = code.length[data]
    at = np.repeat(np.arange(len(data)), many)
    flat = np.repeat(code.first[data] - (np.cumsum(many) - many), many) + np.arange(len(at))
    node = code.flat_node[flat]
    cells = [((mix(c)[at] + node >> np.uint64(20)) & np.uint64((1 << b) - 1)).view(np.int64)
             for c, b in zip(contexts, TABLE_BITS, strict=False)]
    return unit[at], code.flat_bit[flat], np.minimum(place, 3)[at], cells


def packed(table: np.ndarray) -> np.ndarray:
    """A table's two rows as the upper halves of their floats, both in one number a cell: half the memory, and one
    access a look-up."""
    half = [(row.astype(np.float32).view(np.uint32) + np.uint32(0x8000)) >> np.uint32(16) for row in table]
    return half[0] | half[1] << np.uint32(16)


def predictors(cells: list, tables: list) -> tuple[np.ndarray, np.ndarray]:
    """Per bit (rows): stretched probabilities of bit 1 by context, as they are and scaled by how sure they are; and how
    many contexts know the case. ``tables`` are ``packed``."""
    x = np.empty((len(cells[0]), 2 * len(cells)), dtype=np.float32)
    raw = x.view(np.uint32)
    known = np.zeros(len(x), dtype=np.int64)
    for k, cell in enumerate(cells):
        both = tables[k][cell]
        raw[:, 2 * k] = both << np.uint32(16)
        raw[:, 2 * k + 1] = both & np.uint32(0xFFFF0000)
        known += x[:, 2 * k] != 0
    return x, known


def finished_tables(counts: np.ndarray) -> np.ndarray:
    """Per cell: stretched probability of 1, and that times a confidence between 0 and 1 (both 0 if never seen), packed."""
    zero, one = counts[:, 0].astype(np.float32), counts[:, 1].astype(np.float32)
    n = zero + one
    s = np.where(n > 0, np.clip(np.log((one + 0.02) / (zero + 0.02)), -12, 12), 0)
    s = np.where((n > 0) & (s == 0), 1e-6, s)
    return packed(np.stack([s, s * (n / (n + 3.0))]))


def mixed(x: np.ndarray, gate: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Sum of the predictors times the gate's weights."""
    chosen = weights[:, :x.shape[1]].astype(np.float32)
    return np.clip(np.einsum("ij,ij->i", x, np.take(chosen, gate, axis=0)), -LIMIT / 2, LIMIT / 2)


def refined(s: np.ndarray, gate: np.ndarray, maps: np.ndarray) -> np.ndarray:
    """Probability of bit 1: the map's, interpolated, averaged with the mixed one."""
    place = (s + np.float32(LIMIT / 2)) * np.float32((MAP_CELLS - 1) / LIMIT)
    low = np.minimum(place.astype(np.int64), MAP_CELLS - 2)
    share = place - low
    cell = gate * MAP_CELLS + low
    flat = maps.ravel()
    p = flat[cell]
    p = p + (flat[cell + 1] - p) * share
    return np.clip(0.5 * p + 0.5 / (1 + np.exp(-s)), 1e-5, 1 - 1e-5)


def add_counts(total: list, words: Words, code: Code) -> None:
    """Adds the bits of all tokens to the contexts' tables."""
    for units, count, *_ in words.units():
        for part, run in runs(units):
            unit, bit, _, cells = coded(run, code)
            times = count[part].astype(np.float32)[unit]
            for k, cell in enumerate(cells):
                np.add.at(total[k], cell * 2 + bit, times)


def no_counts() -> list[np.ndarray]:
    return [np.zeros(2 << b, dtype=np.float32) for b in TABLE_BITS]


def shares(words: Words, known: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Count of each distinct word among the frequent ones (``known``, sorted hashes), 0 for the others."""
    w = words.distinct.view(np.int64)
    if not len(known):
        return np.zeros(len(w), dtype=np.int64)
    at = np.minimum(np.searchsorted(known, w), len(known) - 1)
    return np.where(known[at] == w, counts[at], 0)


def fitted_weight(coded_part: np.ndarray, share: np.ndarray, weight: float, rounds: int = 20) -> float:
    """The weight of ``share`` beside the coded probabilities that makes the tokens likeliest."""
    for _ in range(rounds):
        mine = weight * share
        weight = float(np.mean(mine / np.maximum(mine + (1 - weight) * coded_part, 1e-300)))
    return weight


class Mixer:
    """Weights by gate, map counts and bits seen, from online passes over units (with how often they occur); and the
    tokens' weight of their share among the frequent words."""

    def __init__(self, code: Code, tables: list, frequent: tuple, share_weight: float, rate: float = 0.15):
        self.code, self.tables, self.rate = code, tables, rate
        self.frequent, self.share_weight, self.share_sum, self.tokens = frequent, share_weight, 0.0, 0
        self.weights = np.full((GATES, 2 * CONTEXTS), 0.15)
        self.maps = np.zeros((GATES, MAP_CELLS, 2))
        self.seen = 0.0

    def learn(self, words: Words) -> None:
        score = np.zeros(len(words.word))
        for units, count, where, which in words.units():
            score[where] += self.learn_units(units, count)[which]
        c = shares(words, *self.frequent)
        others = np.maximum(c - np.bincount(words.which, minlength=len(c)), 0)  # leaves these texts out
        if others.any() and self.share_weight:
            w = fitted_weight(10 ** score, (others / others.sum())[words.which], self.share_weight)
            self.share_sum, self.tokens = self.share_sum + w * len(score), self.tokens + len(score)

    def learn_units(self, units: Units, count: np.ndarray) -> np.ndarray:
        """log10 probability of each unit, mixed by the weights as they were when it came."""
        out = np.zeros(len(units.size))
        for part, run in runs(units):
            unit, bit, place, cells = coded(run, self.code)
            x, known = predictors(cells, self.tables)
            gate, times = place * (CONTEXTS + 1) + known, count[part].astype(np.float64)[unit]
            share, s = np.minimum(times, 500), np.empty(len(bit), dtype=np.float32)
            for at in range(0, len(bit), 2048):
                step = slice(at, at + 2048)
                s[step] = self._step(bit[step], x[step], gate[step], share[step])
            out[part] = np.bincount(unit, weights=-np.logaddexp(0, np.where(bit == 1, -s, s)), minlength=part.stop - part.start) / np.log(10)
            cell = np.rint((s + LIMIT / 2) / LIMIT * (MAP_CELLS - 1)).astype(np.int64)
            self.maps += np.bincount((gate * MAP_CELLS + cell) * 2 + bit, weights=times, minlength=self.maps.size).reshape(self.maps.shape)
            self.seen += len(bit)
        return out

    def _step(self, bit: np.ndarray, x: np.ndarray, gate: np.ndarray, share: np.ndarray) -> np.ndarray:
        """Moves the weights; the mixed values before that."""
        s = mixed(x, gate, self.weights)
        error = (bit - 1 / (1 + np.exp(-s))) * share
        order = np.argsort(gate.astype(np.uint8), kind="stable")
        gates, first = np.unique(gate[order], return_index=True)
        size = np.add.reduceat(share[order], first)
        total = np.add.reduceat(x[order] * error[order, None], first, axis=0)
        self.weights[gates, :x.shape[1]] += self.rate / 8 * total / np.sqrt(np.maximum(size, 1))[:, None]
        return s


def chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of batches put together up to about CHUNK characters of text."""
    held, weight = [], 0
    for pdf in batches:
        if len(pdf):
            held.append(pdf)
            weight += sum(len(t) for t in pdf["text"] if isinstance(t, str))
        if weight >= CHUNK:
            yield pd.concat(held, ignore_index=True) if len(held) > 1 else held[0]
            held, weight = [], 0
    if held:
        yield pd.concat(held, ignore_index=True)


def sums_of_words(docs: DataFrame, start, add, finish, slots: int) -> DataFrame:
    """Rows ``slot``, ``part``, ``blob``: the packed arrays that ``finish`` makes of a task's state, which begins as
    ``start()`` and takes the task's texts by ``add(state, words)``."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state = None
        for pdf in chunks(batches):
            state = start() if state is None else state
            add(state, Words(pdf["text"].tolist()))
        if state is not None:
            part, got = TaskContext.get().partitionId(), finish(state)
            for k in range(slots):
                yield pd.DataFrame({"slot": [k], "part": [part], "blob": [pack(got[k])]})

    return docs.select("text").mapInPandas(lean(run), "slot int, part long, blob binary")


def count_tables(docs: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """Stored ``word`` (hash), ``c``: exact counts of the tokens, the end included; and counts of their bytes."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        letters = np.zeros(256, dtype=np.int64)
        for pdf in chunks(batches):
            data, stop = joined(pdf["text"].tolist())
            letters += np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256)
            letters[SPACE] -= len(stop)
            word, c = np.unique(word_hashes(data)[0], return_counts=True)
            yield pd.DataFrame({"kind": 0, "word": np.append(word, END_HASH).view(np.int64), "c": np.append(c, len(stop))})
        yield pd.DataFrame({"kind": 1, "word": np.arange(256), "c": letters})

    got = docs.select("text").mapInPandas(lean(run), "kind int, word long, c long").groupBy("kind", "word").agg(F.sum("c").alias("c"))
    got = keep(got, "words")
    letters = np.zeros(256, dtype=np.int64)
    for r in got.filter("kind = 1").collect():
        letters[r.word] = r.c
    letters[9:14] = 0
    letters[[SPACE, END]] += 1
    return got.filter("kind = 0").select("word", "c"), letters


class Model:
    def __init__(self, code: Code, tables: list, weights: np.ndarray, maps: np.ndarray):
        self.code, self.weights, self.maps = code, weights, maps
        self.tables = [t if t.ndim == 1 else packed(t) for t in tables]

    def of_units(self, units: Units) -> np.ndarray:
        """log10 probability of the coded bytes of each unit."""
        out = np.zeros(len(units.size))
        for part, run in runs(units):
            unit, bit, place, cells = coded(run, self.code)
            x, known = predictors(cells, self.tables)
            gate = place * (CONTEXTS + 1) + known
            p = refined(mixed(x, gate, self.weights), gate, self.maps)
            out[part] = np.bincount(unit, weights=np.log10(np.where(bit == 1, p, 1 - p)), minlength=part.stop - part.start)
        return out

    def of_words(self, words: Words) -> np.ndarray:
        """log10 probability of each token, given the words before it."""
        out = np.zeros(len(words.word))
        for units, _, where, which in words.units():
            out[where] += self.of_units(units)[which]
        return out

    def log10(self, words: list[bytes], before: list[bytes] | None = None) -> np.ndarray:
        """log10 probability of each byte string that begins a word, after the word ``before`` it or at a text's start."""
        size = np.array([len(w) for w in words])
        history, hashes = np.zeros((len(words), 4), dtype=np.int64), np.zeros(len(words), dtype=np.uint64)
        for k, b in enumerate(before or []):
            hashes[k] = word_hashes(b)[0][0]
            last = np.frombuffer(b[::-1][:3], dtype=np.uint8)
            history[k, 1:1 + len(last)] = last.astype(np.int64) + 1
        history[:, 0] = SPACE + 1
        data = np.frombuffer(b"".join(words), dtype=np.uint8)
        start = np.cumsum(size) - size
        opening = np.minimum(size, OPEN)
        out = self.of_units(Units(cut_out(data, start, opening), opening, 0, history, hashes))
        longer = size > OPEN
        if longer.any():
            out[longer] += self.of_units(Units(cut_out(data, start[longer], size[longer]), size[longer], OPEN, history[longer], None))
        return out


def with_shares(score: np.ndarray, share: np.ndarray, weight: float) -> np.ndarray:
    """Averages the coded probability (log10) with the word's share among the frequent words."""
    if not weight:
        return score
    out = score + np.log1p(-weight) / np.log(10)
    some = np.flatnonzero(share > 0)
    out[some] = np.logaddexp(out[some] * np.log(10), np.log(share[some] * weight)) / np.log(10)
    return out


def train_model(training: DataFrame, mixing: DataFrame, letters: np.ndarray, frequent, share_weight: float) -> tuple[Model, float]:
    """Weights and maps from ``mixing`` with the tables of ``training`` (both with ``text``), then tables of both; a
    code of ``letters``. And the weight of the ``frequent`` words' shares (broadcast), fitted from ``share_weight`` on."""
    sc = training.sparkSession.sparkContext
    code = Code(letters + 1)

    def add(total: list, words: Words) -> None:
        add_counts(total, words, code)

    def finished(k: int, *sums: DataFrame) -> np.ndarray:
        size = 2 << TABLE_BITS[k]  # the driver holds one table's counts at a time
        return finished_tables(sum(part_of(x, k, "float32", size) for x in sums).reshape(-1, 2))

    counts = keep(merged_parts(sums_of_words(training, no_counts, add, lambda total: total, CONTEXTS), "float32"), "tables")
    shared = sc.broadcast((code, [finished(k, counts) for k in range(CONTEXTS)]))

    def begin() -> tuple[Mixer, list]:
        return Mixer(*shared.value, frequent.value, share_weight), no_counts()

    def learn(state: tuple, words: Words) -> None:
        state[0].learn(words)
        add_counts(state[1], words, state[0].code)

    def learned(state: tuple) -> list[np.ndarray]:
        m, total = state
        rest = np.append(m.weights.ravel() * m.seen, m.seen), m.maps.ravel(), np.array([m.share_sum, m.tokens])
        return [*total, *(x.astype(np.float32) for x in rest)]

    sums = keep(merged_parts(sums_of_words(mixing, begin, learn, learned, CONTEXTS + 3), "float32"), "tables")
    shared.destroy()
    weights = np.full((GATES, 2 * CONTEXTS), 0.15)
    maps = part_of(sums, CONTEXTS + 1, "float32", GATES * MAP_CELLS * 2).reshape(GATES, MAP_CELLS, 2)
    gathered = part_of(sums, CONTEXTS, "float32", weights.size + 1)
    if gathered[-1]:
        weights = (gathered[:-1] / gathered[-1]).reshape(weights.shape)
    told = part_of(sums, CONTEXTS + 2, "float32", 2)
    if told[1]:
        share_weight = min(float(told[0] / told[1]), 0.99)
    middle = 1 / (1 + np.exp(-np.linspace(-LIMIT / 2, LIMIT / 2, MAP_CELLS)))
    maps = (maps[..., 1] + 20 * middle) / (maps.sum(-1) + 20)
    return Model(code, [finished(k, counts, sums) for k in range(CONTEXTS)], weights.astype(np.float32), maps.astype(np.float32)), share_weight


def score_texts(docs: DataFrame, folds: int = 10, held: int = 0) -> DataFrame:
    """``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score`` and
    ``bits_per_byte`` for every row of ``docs``."""
    spark = docs.sparkSession
    bounded_batches(spark)
    key = fold(F.col("doc_id").cast("long"), folds)
    training = docs.filter(F.coalesce(key != held, F.lit(True)))
    apart = F.coalesce(fold(F.col("doc_id").cast("long"), folds * 10) % 10 == MIX_FOLD, F.lit(False))
    mixes = apart & F.coalesce(key != held, F.lit(True))
    words, letters = count_tables(training)
    totals = words.agg(F.sum("c"), F.count(F.lit(1)), F.count_if(F.col("c") == 1)).first()
    n, v = int(totals[0] or 0), int(totals[1])
    # the frequent words: those of the larger counts, and of the next count as many as there is room for (by hash)
    sizes = words.groupBy("c").agg(F.count(F.lit(1)).alias("k")).orderBy(F.desc("c")).limit(FREQUENT).toArrow()
    count, many = (sizes[x].to_numpy() for x in ("c", "k"))
    whole = int(np.count_nonzero(np.cumsum(many) <= FREQUENT))
    chosen = F.col("c") >= int(count[whole - 1]) if whole else F.lit(False)
    if whole < len(many):
        room = FREQUENT - int(many[:whole].sum())
        chosen = chosen | ((F.col("c") == int(count[whole])) & (F.pmod(F.xxhash64("word"), F.lit(int(many[whole]))) < room))
    common = words.filter(chosen).toArrow()
    ids, often = (common[x].to_numpy() for x in ("word", "c"))
    # Good-Turing: words met once measure what is new; what the frequent words don't hold is left to the code as well
    covered = int(often.sum())
    weight = min(max(0.0, 1 - (int(totals[2]) + n - covered) / n), 0.99) if n else 0.0
    order = np.argsort(ids)
    shared = spark.sparkContext.broadcast((ids[order], often[order]))
    trained, weight = train_model(training.filter(~apart), docs.filter(mixes), letters, shared, weight)
    model = spark.sparkContext.broadcast(trained)

    def base(c: np.ndarray) -> np.ndarray:
        return np.log10((c + 0.1) / (n + 0.1 * (v + 1))) if n else np.zeros(len(c))

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, counts = shared.value
        all_known = max(1, counts.sum())
        for pdf in chunks(batches):
            words = Words(pdf["text"].tolist())
            size = len(pdf)
            w = words.distinct.view(np.int64)
            c = shares(words, known, counts)
            hit = c > 0
            of_token = with_shares(model.value.of_words(words), (c / all_known)[words.which], weight)
            rare = np.flatnonzero(~hit[words.which])
            rest, times = np.unique(words.owner[rare] * len(w) + words.which[rare], return_counts=True)
            cut = np.searchsorted(rest, np.arange(1, size) * len(w))
            per_row = lambda x: np.bincount(words.owner, weights=x, minlength=size)
            yield pd.DataFrame({
                "row": pdf["row"], "doc": pdf["doc"], "n_tokens": np.bincount(words.owner, minlength=size),
                "n_hit": per_row(hit[words.which]).astype(np.int64), "hit_score": per_row(np.where(hit, base(c), 0.0)[words.which]),
                "score": per_row(of_token), "bytes": per_row(words.coded_bytes()).astype(np.int64),
                "rare": np.split(w[rest % len(w)], cut), "times": np.split(times, cut)})

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("string").alias("doc"), "text")
    got = keep(rows.mapInPandas(lean(score), "row long, doc string, n_tokens long, n_hit long, hit_score double, score double, "
                                "bytes long, rare array<long>, times array<long>"), "scored")
    if v > len(ids):
        # words beyond the broadcast ones: joined by hash; the sums go back by row
        left = got.select("row", F.explode(F.arrays_zip("rare", "times")).alias("t")).select(
            "row", F.col("t.rare").alias("word"), F.col("t.times").alias("times"))
        c = F.coalesce("c", F.lit(0))
        value = F.log10((c + 0.1) / F.lit(n + 0.1 * (v + 1)))
        more = left.join(words, "word", "left").groupBy("row").agg(
            F.sum(F.col("times") * value).alias("rare_score"), F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("n_rare"))
    else:
        unseen = float(base(np.zeros(1))[0])
        more = got.select("row", F.aggregate("times", F.lit(0).cast("long"), lambda a, x: a + x).alias("m")).select(
            "row", (F.col("m") * F.lit(unseen)).alias("rare_score"), F.lit(0).cast("long").alias("n_rare"))
    out = got.drop("rare", "times").join(more, "row", "left").withColumn("doc_id", F.col("doc").cast("long"))
    return out.select(
        "doc_id", F.coalesce(fold(F.col("doc_id"), folds) == held, F.lit(False)).alias("held_out"), "n_tokens",
        (F.col("n_hit") + F.coalesce("n_rare", F.lit(0))).alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
        (F.col("hit_score") + F.coalesce("rare_score", F.lit(0.0))).alias("base_score"), "score",
        (-F.col("score") * F.lit(np.log2(10.0)) / F.col("bytes")).alias("bits_per_byte"))
