"""SentencePiece unigram encoding and decoding (op 4).

Encoding finds the best-scored split of a text into pieces (Viterbi) over a double-array trie of the pieces' UTF-8
bytes. A space becomes the marker U+2581 and one marker is put before the text; a character that no piece covers
falls back to its byte pieces. Decoding joins pieces and bytes, turns markers into spaces and drops the first one.

The vocabulary is a public ``.model`` file whose path is a parameter (read on the driver, sent to tasks; its size is
that of the vocabulary). Scores of a unigram file are log probabilities and are used as they are
(``scores="file"``). A BPE file holds merge ranks instead; ``scores="zipf"`` turns rank r into
-log(r + 1) - log(ln(number of pieces)), the log probability of a Zipf distribution.

No piece has a marker after another character, so a text splits exactly at spaces; the parts ("chunks") of a batch
are encoded once each, all at the same time with numpy, and kept in a bounded cache of the task.

A null text has no tokens and decodes to an empty text; an empty one likewise. Texts of any length are encoded whole.
A literal U+2581 in a text is written as bytes, so that decoding gives back every text exactly. Of equally scored
splits the one whose last piece starts first wins. Repeated rows give equal rows; columns other than ``doc_id`` and
``text`` are not read by ``encode`` (``encode_column`` keeps all). An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import bounded_batches, lean

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
#: What a character without a piece costs below the least score.
UNKNOWN_PENALTY = 10.0
#: Chunks held in a task's cache, characters of texts that are taken together, and of new chunks encoded at a time.
CACHE, AT_ONCE, VITERBI = 120_000, 1 << 15, 1 << 13
_CHUNK = re.compile(r" *[^ ]+| +")


@dataclass
class Pieces:
    """Vocabulary and double array: a state's child by byte b is ``base[state] + b`` if ``check`` there is the state."""

    text: list[bytes]
    score: np.ndarray
    byte_id: np.ndarray
    base: np.ndarray
    check: np.ndarray
    value: np.ndarray

    @property
    def unknown_score(self) -> float:
        return float(self.score[self.value[self.value >= 0]].min()) - UNKNOWN_PENALTY


def double_array(keys: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``base``, ``check`` and ``value`` (id of the key that ends at the state, or -1) over byte strings."""
    words = sorted(keys)
    size = 1 << 12
    base, check, value = [0] * size, [-1] * size, [-1] * size
    check[0] = 0
    reached: dict[int, int] = {}  # by number of children: where the last search ended
    todo = [(0, 0, len(words), 0)]
    while todo:
        state, low, high, depth = todo.pop()
        if low < high and len(words[low]) == depth:
            value[state] = keys[words[low]]
            low += 1
        children = []
        at = low
        while at < high:
            b = words[at][depth]
            end = at
            while end < high and words[end][depth] == b:
                end += 1
            children.append((b, at, end))
            at = end
        if not children:
            continue
        kind = min(len(children), 8)
        offset = reached.get(kind, 1)
        while True:
            if offset + 256 >= len(check):
                grow = len(check)
                base += [0] * grow
                check += [-1] * grow
                value += [-1] * grow
            if all(check[offset + b] < 0 for b, _, _ in children):
                break
            offset += 1
        reached[kind] = offset
        base[state] = offset
        for b, _, _ in children:
            check[offset + b] = state
        todo += [(offset + b, lo, hi, depth + 1) for b, lo, hi in children]
    return (np.array(base, dtype=np.int64), np.array(check, dtype=np.int64), np.array(value, dtype=np.int64))


def load_pieces(path: str = MODEL, scores: str = "zipf") -> Pieces:
    from sentencepiece import SentencePieceProcessor
    sp = SentencePieceProcessor(model_file=path)
    n = sp.get_piece_size()
    text = [sp.id_to_piece(i).encode() for i in range(n)]
    byte_id = np.full(256, sp.unk_id(), dtype=np.int32)
    keys = {}
    for i in range(n):
        if sp.is_byte(i):
            byte_id[int(text[i][3:5], 16)] = i
            text[i] = bytes([int(text[i][3:5], 16)])
        elif sp.is_control(i) or sp.is_unknown(i):
            text[i] = b""
        elif not sp.is_unused(i):
            keys[text[i]] = i
    score = np.array([sp.get_score(i) for i in range(n)], dtype=np.float64)
    if scores == "zipf":
        score = -np.log(1.0 - np.minimum(score, 0.0)) - np.log(np.log(n))
        score = np.round(score * 1024) / 1024  # sums are exact then, and ties are ties
    mark = MARK.encode()
    bad = [k for k in keys if MARK in k.decode().lstrip(MARK)]
    if bad:
        raise ValueError(f"a piece has a marker after another character: {bad[0]!r}")
    base, check, value = double_array(keys)
    return Pieces([t.replace(mark, b" ") for t in text], score, byte_id, base, check, value)


def encode_chunks(pieces: Pieces, chunks: list[bytes]) -> list[np.ndarray]:
    """Piece ids of each chunk (UTF-8 with markers for spaces), all chunks at the same time."""
    data = np.frombuffer(b"".join(chunks), dtype=np.uint8).astype(np.int64)
    size = np.array([len(c) for c in chunks])
    first = np.cumsum(size) - size
    end = np.repeat(first + size, size)
    offset = np.arange(len(data)) - np.repeat(first, size)
    head = (data & 0xC0) != 0x80
    start = np.flatnonzero(head)
    width = np.diff(np.append(start, len(data)))
    # all matches of the trie, one byte deeper in every round
    at, state = start, np.zeros(len(start), dtype=np.int64)
    found = []
    single = np.zeros(len(data), dtype=bool)
    one = np.zeros(len(data), dtype=np.int64)
    one[start] = width
    depth = 0
    while len(at):
        inside = at + depth < end[at]
        at, state = at[inside], state[inside]
        to = pieces.base[state] + data[at + depth]
        ok = (to < len(pieces.check)) & (pieces.check[np.minimum(to, len(pieces.check) - 1)] == state)
        at, state = at[ok], to[ok]
        depth += 1
        hit = pieces.value[state] >= 0
        found.append((at[hit], np.full(int(hit.sum()), depth), pieces.value[state[hit]]))
        whole = at[hit][one[at[hit]] == depth]
        single[whole] = True
    lone = start[~single[start]]
    found.append((lone, one[lone], np.full(len(lone), -1)))
    begin, length, piece = (np.concatenate(x) for x in zip(*found, strict=True))
    gain = np.where(piece >= 0, pieces.score[piece], pieces.unknown_score)
    # by place in the chunk (matches of one place reach different ends, so their order is free)
    place = offset[begin]
    order = np.argsort(place.astype(np.uint16) if len(place) and place.max() < 1 << 16 else place, kind="stable")
    begin, length, piece, gain = begin[order], length[order], piece[order], gain[order]
    # best score of a path that ends before byte k of its chunk (places are shifted by one a chunk)
    shift = np.repeat(np.arange(len(chunks)), size)
    source = begin + shift[begin]
    target = source + length
    best = np.full(len(data) + len(chunks), -np.inf)
    best[first + np.arange(len(chunks))] = 0.0
    last = np.full(len(best), -1, dtype=np.int64)
    steps = np.flatnonzero(np.diff(offset[begin], prepend=-1))
    for a, b in zip(steps, np.append(steps[1:], len(begin)), strict=True):
        score = best[source[a:b]] + gain[a:b]
        better = np.flatnonzero(score > best[target[a:b]])
        best[target[a:b][better]] = score[better]
        last[target[a:b][better]] = a + better
    # back from the ends, all chunks at the same time
    owner = np.arange(len(chunks))[size > 0]
    place = (first + size + np.arange(len(chunks)))[size > 0]
    trail = []
    while len(owner):
        edge = last[place]
        trail.append((owner, edge))
        place = source[edge]
        more = place > (first + np.arange(len(chunks)))[owner]
        owner, place = owner[more], place[more]
    if not trail:
        return [np.empty(0, dtype=np.int32) for _ in chunks]
    owner, edge = (np.concatenate(x)[::-1] for x in zip(*trail, strict=True))
    order = np.argsort(owner, kind="stable")
    owner, edge = owner[order], edge[order]
    ids = piece[edge]
    many = np.where(ids >= 0, 1, length[edge])
    out = np.repeat(ids, many)
    lost = np.flatnonzero(out < 0)
    if len(lost):
        within = np.arange(len(out)) - np.repeat(np.cumsum(many) - many, many)
        out[lost] = pieces.byte_id[data[(np.repeat(begin[edge], many) + within)[lost]]]
    cut = np.concatenate([[0], np.cumsum(np.bincount(owner, weights=many, minlength=len(chunks)).astype(np.int64))])
    out = out.astype(np.int32)
    return [out[a:b] for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]


def keys_of(part: str) -> list[str]:
    """Keys of a part's chunks: a word that follows one space is its own key, any other chunk has a space at the end."""
    if part.startswith(" ") and "  " not in part and not part.endswith(" "):
        return part[1:].split(" ")
    return [c[1:] if len(c) > 1 and c[0] == " " and c[1] != " " else c + " " for c in _CHUNK.findall(part)]


class Encoder:
    """Encodes the texts of a task. Ids of chunks met before come from a cache of two generations: a full one becomes
    the old one, and what is met again moves to the new one, so frequent chunks stay and rare ones go."""

    def __init__(self, pieces: Pieces):
        self.pieces, self.cache, self.old = pieces, {}, {}
        self.mark = pieces.byte_id[list(MARK.encode())].astype(np.int32).tobytes()

    def _learn(self, keys: set[str]) -> None:
        """Put ``keys``, which are not in the cache, there."""
        met = keys & self.old.keys()
        self.cache.update((c, self.old[c]) for c in met)
        todo, weight = [], 0
        for c in [*(keys - met), None]:
            if todo and (c is None or weight + len(c) > VITERBI):
                chunks = [x[:-1] if x.endswith(" ") else " " + x for x in todo]
                ids = encode_chunks(self.pieces, [x.replace(" ", MARK).encode("utf-8", "surrogatepass") for x in chunks])
                self.cache.update(zip(todo, (x.tobytes() for x in ids), strict=True))
                todo, weight = [], 0
            if c is not None:
                todo.append(c)
                weight += len(c)

    def __call__(self, texts) -> Iterator[np.ndarray]:
        """The ids of each text, taken in groups of about ``AT_ONCE`` characters."""
        group, weight = [], 0
        for k, text in enumerate(texts):
            text = text if isinstance(text, str) else ""
            group.append([keys_of(part) for part in (" " + text).split(MARK)] if text else [])
            weight += len(text)
            if weight > AT_ONCE or k == len(texts) - 1:
                yield from self._encode(group)
                group, weight = [], 0

    def _encode(self, group: list[list[list[str]]]) -> Iterator[np.ndarray]:
        if len(self.cache) > CACHE // 2:
            self.cache, self.old = {}, self.cache
        known = [[list(map(self.cache.get, part)) for part in parts] for parts in group]
        new = {c for parts, got in zip(group, known, strict=True) for part, ids in zip(parts, got, strict=True) if None in ids
               for c, x in zip(part, ids, strict=True) if x is None}
        self._learn(new)
        for parts, got in zip(group, known, strict=True):
            whole = [ids if None not in ids else map(self.cache.__getitem__, part) for part, ids in zip(parts, got, strict=True)]
            yield np.frombuffer(self.mark.join(map(b"".join, whole)), dtype=np.int32)


def decode_ids(pieces: Pieces, ids) -> str:
    """Text of piece ids; without the marker that encoding puts before it."""
    data = b"".join(map(pieces.text.__getitem__, ids.tolist() if isinstance(ids, np.ndarray) else ids))
    return (data[1:] if data.startswith(b" ") else data).decode("utf-8", "replace")


def _shared(spark: SparkSession, path: str, scores: str):
    return spark.sparkContext.broadcast(load_pieces(path, scores))


def encode_column(spark: SparkSession, text: Column, path: str = MODEL, scores: str = "zipf") -> Column:
    pieces = _shared(spark, path, scores)

    @F.pandas_udf("array<int>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        def work(batches):
            encoder = Encoder(pieces.value)
            for batch in batches:
                yield pd.Series(list(encoder(batch.tolist())), index=batch.index, dtype=object)

        yield from lean(work)(batches)

    return run(text)


def decode_column(spark: SparkSession, ids: Column, path: str = MODEL, scores: str = "zipf") -> Column:
    pieces = _shared(spark, path, scores)

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(["" if x is None else decode_ids(pieces.value, x) for x in batch], index=batch.index)

    return run(ids)


def coded_column(spark: SparkSession, text: Column, path: str = MODEL, scores: str = "zipf") -> Column:
    """``ids`` of a text and the text ``decoded`` from them, in one pass."""
    pieces = _shared(spark, path, scores)

    @F.pandas_udf("ids array<int>, decoded string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        def work(batches):
            encoder = Encoder(pieces.value)
            for batch in batches:
                ids = list(encoder(batch.tolist()))
                back = [decode_ids(pieces.value, x) for x in ids]
                yield pd.DataFrame({"ids": pd.Series(ids, dtype=object), "decoded": pd.Series(back, dtype=object)}).set_index(batch.index)

        yield from lean(work)(batches)

    return run(text)


def encode(docs: DataFrame, path: str = MODEL, scores: str = "zipf") -> DataFrame:
    """``doc_id``, ``ids``, ``n_tokens`` and ``round_trip`` (whether decoding gives the text back) for every row."""
    spark = docs.sparkSession
    bounded_batches(spark)
    coded = docs.select("doc_id", "text", coded_column(spark, F.col("text"), path, scores).alias("coded"))
    same = F.col("coded.decoded") == F.coalesce("text", F.lit(""))
    return coded.select("doc_id", "coded.ids", F.size("coded.ids").alias("n_tokens"), same.alias("round_trip"))
