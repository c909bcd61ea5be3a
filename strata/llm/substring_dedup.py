"""Substring deduplication by prefix-partitioned suffix trees (op 1).

A window is ``WINDOW`` consecutive words of a document. A word is removed when a window covers it whose word
sequence also starts in a document with a smaller ``doc_id``; windows are judged on the input.

* Only suffixes that may repeat enter a tree. Every window names its anchor, the run of ``GRAM`` words in it with
  the least hash (equal windows name equal anchors), and anchors that one document alone has are dropped. Of
  exact copies only the first enters; the others are repeats as a whole.
* Suffixes are split by anchor into groups of about ``GROUP`` segments. An anchor with more than ``HOT`` segments
  is split further: its suffixes get prefixes of the full window length, so each group is one tree node and Spark
  needs its smallest document only (pre-aggregated before the shuffle).
* In a group, suffixes are ranked by their first 1, 2, 4, ... words by doubling: the classes of equal rank at a
  depth are the nodes of the group's suffix tree there. Nodes at depth ``WINDOW`` with a smaller document are
  repeats, and runs of such suffixes are the maximal repeated spans.

Null and empty texts have no words; a document shorter than a window keeps all. Repeated rows of one ``doc_id``
don't remove one another's words (none is smaller). A null ``doc_id`` is neither smaller nor larger: it keeps all
and removes nothing. Only ``doc_id`` and ``text`` are read. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import (
    BROADCAST_ROWS, as_long, bounded_batches, broadcast_if_small, checkpointed, grams, keep, mix, text_bytes, word_hashes)

WINDOW, GRAM = 50, 20
#: Segments (some 65 words each) of one group, and segments beyond which an anchor is split.
GROUP, HOT = 4_000, 2_000


def digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def anchors(h: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Gram hashes, and for the window at each start the place of its least gram (the first of equals)."""
    g = grams(h, gram)
    reach = window - gram + 1
    if len(g) < reach:
        return g, np.empty(0, dtype=np.int64)
    view = np.lib.stride_tricks.sliding_window_view(g, reach)
    return g, view.argmin(axis=1) + np.arange(len(view))


def ranks(words: np.ndarray, ends: np.ndarray, depth: int) -> np.ndarray:
    """Rank, by the first ``depth`` words, of the suffix at each place; -1 where its segment ends before that.

    ``ends`` has the end of each place's segment. Ranks double in depth, as when building a suffix array.
    """
    rank = np.unique(words, return_inverse=True)[1].astype(np.int64)
    at, have, done = np.arange(len(words)), 1, 0
    result = np.zeros(len(words), dtype=np.int64)
    left = depth
    while left:
        if left & have:
            other = np.where(at + done < len(words), rank[np.minimum(at + done, len(words) - 1)], -1)
            result = np.unique(result * (len(words) + 2) + other + 1, return_inverse=True)[1]
            done += have
            left -= have
        if left:
            other = np.where(at + have < len(words), rank[np.minimum(at + have, len(words) - 1)], -1)
            rank = np.unique(rank * (len(words) + 2) + other + 1, return_inverse=True)[1]
            have *= 2
    return np.where(at + depth <= ends, result, -1)


def _runs(starts: np.ndarray, window: int) -> list[list[int]]:
    """Spans (first word, end) covered by windows at the sorted ``starts``."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > window)
    first, last = np.concatenate([[0], cut + 1]), np.concatenate([cut, [len(starts) - 1]])
    return [[int(starts[a]), int(starts[b]) + window] for a, b in zip(first, last, strict=True)]


def tree_repeats(pdf: pd.DataFrame, window: int) -> pd.DataFrame:
    """Starts of repeated windows by document, from one group's suffix tree.

    A row is a segment: ``doc_id``, ``id``, ``at`` (places of its first word) and ``words`` (hashes).
    """
    sizes = np.array([len(w) for w in pdf["words"]])
    words = np.concatenate([np.asarray(w) for w in pdf["words"]])
    ends = np.repeat(np.cumsum(sizes), sizes)
    segment = np.repeat(np.arange(len(pdf)), sizes)
    node = ranks(words, ends, window)
    suffix = np.flatnonzero(node >= 0)
    docs = pdf["doc_id"].to_numpy()
    own = docs[segment[suffix]]
    least = np.full(node.max() + 1, np.iinfo(np.int64).max)
    np.minimum.at(least, node[suffix], own)
    again = suffix[least[node[suffix]] < own]
    inside = again - (np.cumsum(sizes) - sizes)[segment[again]]
    cut = np.flatnonzero(np.diff(segment[again], prepend=-1))
    owner = segment[again][cut]
    at = pdf["at"].to_numpy()
    starts = [np.unique(np.add.outer(np.asarray(at[s]), x)) for s, x in zip(owner, np.split(inside, cut[1:]), strict=True)] if len(cut) else []
    return pd.DataFrame({"doc_id": docs[owner], "id": pdf["id"].to_numpy()[owner], "starts": starts})


def repeated_spans(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, group: int = GROUP,
                   hot: int = HOT) -> DataFrame:
    """``doc_id``, ``ids``: for each distinct word sequence of that ``doc_id`` with repeats its digest ``id`` and
    sorted ``spans`` [first word, end) that are repeats of smaller documents."""
    bounded_batches(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("doc_id is not null")

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for doc, text in zip(pdf["doc_id"], pdf["text"], strict=True):
                data = text_bytes(text)
                h = word_hashes(data)[0]
                if len(h) >= window:
                    g, at = anchors(h, window, gram)
                    out.append((doc, digest(b" ".join(data.split())), len(h), as_long(np.unique(g[np.unique(at)]))))
            yield pd.DataFrame(out, columns=["doc_id", "id", "n", "anchors"])

    signed = keep(texts.mapInPandas(sign, "doc_id long, id binary, n long, anchors array<long>"), "anchors")
    first = signed.groupBy("id").agg(F.min("doc_id").alias("first"))
    copies = signed.join(first, "id").filter("doc_id > first").select(
        "doc_id", "id", F.array(F.array(F.lit(0).cast("long"), "n")).alias("spans")).distinct()
    copies = checkpointed(copies)
    lead = signed.join(broadcast_if_small(copies.select("doc_id", "id")), ["doc_id", "id"], "left_anti")
    entries = lead.select("doc_id", "id", F.explode("anchors").alias("anchor"))
    shared = keep(lead.select("doc_id", F.explode("anchors").alias("anchor")).groupBy("anchor").agg(
        F.count(F.lit(1)).alias("k"), F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).filter("a < b")
        .select("anchor", (F.col("k") > hot).alias("hot"), "k"), "shared")
    total = shared.filter("not hot").agg(F.sum("k")).first()[0] or 0
    buckets = int(total // group) + 1
    wanted = keep(entries.join(shared.select("anchor", "hot"), "anchor").groupBy("doc_id", "id").agg(
        F.collect_set(F.when(~F.col("hot"), F.col("anchor"))).alias("cold"),
        F.collect_set(F.when(F.col("hot"), F.col("anchor"))).alias("hot"))
        .groupBy("doc_id").agg(F.collect_list(F.struct("id", "cold", "hot")).alias("ids")), "wanted")
    weight = wanted.agg(F.sum(F.aggregate("ids", F.lit(0), lambda a, x: a + F.size(x["cold"]) + F.size(x["hot"])))).first()[0]
    side = F.broadcast(wanted) if (weight or 0) <= 2 * BROADCAST_ROWS else wanted
    chosen = texts.join(side, "doc_id")

    def parts(batches: Iterator[pd.DataFrame], of_hot: bool):
        """Document, id, word hashes and the runs (anchor, first start, last start) of its wanted anchors."""
        for pdf in batches:
            for doc, text, ids in zip(pdf["doc_id"], pdf["text"], pdf["ids"], strict=True):
                data = text_bytes(text)
                own = digest(b" ".join(data.split()))
                for x in ids:
                    want = x["hot"] if of_hot else x["cold"]
                    if bytes(x["id"]) != own or not len(want):
                        continue
                    h = word_hashes(data)[0]
                    g, at = anchors(h, window, gram)
                    turn = np.flatnonzero(np.diff(at, prepend=-1))
                    last = np.append(turn[1:], len(at)) - 1
                    values = as_long(g[at[turn]])
                    for k in np.flatnonzero(np.isin(values, np.asarray(want))):
                        yield doc, own, h, values[k], int(turn[k]), int(last[k])

    def batched(rows, columns: list[str], size: int = 4000) -> Iterator[pd.DataFrame]:
        out = []
        for r in rows:
            out.append(r)
            if len(out) == size:
                yield pd.DataFrame(out, columns=columns)
                out = []
        yield pd.DataFrame(out, columns=columns)

    def segments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def rows():
            # equal segments of one document (a text that repeats itself has many) go once, with all their places
            for (doc, own), found in groupby(parts(batches, False), key=lambda x: x[:2]):
                places: dict[tuple[int, bytes], list[int]] = {}
                for _, _, h, v, a, b in found:
                    places.setdefault((int(v), h[a:b + window].tobytes()), []).append(a)
                for (v, words), at in places.items():
                    yield v % buckets, doc, own, at, np.frombuffer(words, dtype=np.int64)
        yield from batched(rows(), ["bucket", "doc_id", "id", "at", "words"])

    def nodes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def rows():
            for doc, own, h, _, a, b in parts(batches, True):
                one = grams(h[a:b + window], window)
                two = grams(mix(h[a:b + window] + np.uint64(1)), window)
                for k in range(b - a + 1):
                    yield doc, own, a + k, one[k].astype(np.int64), two[k].astype(np.int64)
        yield from batched(rows(), ["doc_id", "id", "start", "one", "two"], 50_000)

    schema = "doc_id long, id binary, starts array<long>"
    found = (chosen.mapInPandas(segments, "bucket long, doc_id long, id binary, at array<long>, words array<long>")
             .groupBy("bucket").applyInPandas(lambda pdf: tree_repeats(pdf, window), schema))
    if not shared.filter("hot").isEmpty():
        deep = keep(chosen.mapInPandas(nodes, "doc_id long, id binary, start long, one long, two long"), "nodes")
        least = deep.groupBy("one", "two").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).filter("least < most")
        found = found.unionByName(deep.join(least, ["one", "two"]).filter("least < doc_id").groupBy("doc_id", "id").agg(
            F.collect_set("start").alias("starts")))

    def spans(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            starts = [np.unique(np.concatenate([np.asarray(y) for y in x])) for x in pdf["starts"]]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "id": pdf["id"], "spans": [_runs(s, window) for s in starts]})

    merged = found.groupBy("doc_id", "id").agg(F.collect_list("starts").alias("starts"))
    merged = merged.mapInPandas(spans, "doc_id long, id binary, spans array<array<long>>")
    return keep(merged.unionByName(copies).groupBy("doc_id").agg(
        F.collect_list(F.struct("id", "spans")).alias("ids")), "spans")


def remove_repeats(docs: DataFrame, window: int = WINDOW, **options) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed``, ``kept`` (kept words joined by one space) for every row of ``docs``."""
    found = repeated_spans(docs, window, **options)
    weight = found.agg(F.sum(F.aggregate("ids", F.lit(0), lambda a, x: a + 2 + F.size(x["spans"])))).first()[0] or 0
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    joined = texts.join(F.broadcast(found) if weight <= 2 * BROADCAST_ROWS else found, "doc_id", "left")
    joined = joined.withColumn("doc_id", F.col("doc_id").cast("string"))  # pandas has no null among integers

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for text, ids in zip(pdf["text"], pdf["ids"], strict=True):
                words = text_bytes(text).split()
                kept = words
                if ids is not None:
                    own = digest(b" ".join(words))
                    gone = np.zeros(len(words), dtype=bool)
                    for x in ids:
                        if bytes(x["id"]) == own:
                            for a, b in x["spans"]:
                                gone[a:b] = True
                    kept = [w for w, g in zip(words, gone, strict=True) if not g]
                out.append((len(words), len(words) - len(kept), b" ".join(kept).decode("utf-8", "surrogatepass")))
            got = pd.DataFrame(out, columns=["n_words", "n_removed", "kept"], index=pdf.index)
            yield pd.concat([pdf[["doc_id"]], got], axis=1)

    done = joined.mapInPandas(cut, "doc_id string, n_words long, n_removed long, kept string")
    return done.withColumn("doc_id", F.col("doc_id").cast("long"))
