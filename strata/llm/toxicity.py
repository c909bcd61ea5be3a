"""Toxicity by weak supervision (op 3).

1. Words and word beginnings (inflected forms share them) that mark toxic documents are mined from the labelled
   training rows (at most ``LABELLED`` of them, those of the least id hashes; the bound is the parameter
   ``limit``) and join a general English list.
2. Voters: lexicon groups, counts of distinct list words, and patterns (insults addressed at someone, masked words,
   shouting, long exclamation runs) vote 1; texts without any sign vote 0; otherwise a voter abstains.
3. The generative label model is fitted on all documents: Spark counts vote patterns (a table bounded by the voters'
   possible patterns), and EM on these counts estimates each voter's accuracy, and its correlation with the voter
   it depends on most (a Chow-Liu tree given the label). Labelled training rows enter EM with their labels.
4. A linear classifier (ridge logistic regression) over votes and mined words is trained on the label model's
   posterior labels of the sampled rows and scores every whole text.

Rows whose crc32(doc_id as text) mod ``folds`` is ``held`` never enter 1, 3 (as labels) or 4. Labels, lang, source
and doc_id are never inputs of a score. Null and empty texts get the score of a text without any sign. Several
labels of one document count by their mean (1 from 0.5 on); null labels and labels of absent documents are passed
over; a null doc_id has no label and isn't held out. Without training rows the general list decides alone. Columns
other than ``doc_id`` and ``text`` are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import re
import string
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import bounded_batches, checkpointed, free_name, give_back, keep, lean
from strata.llm.quality import fold

LABELLED = 20_000
#: General English insults and slurs on worth, in groups that vote separately.
LEXICONS = {
    "people": ("idiot", "moron", "imbecile", "loser", "clown", "fool", "coward", "creep", "jerk", "freak", "bastard",
               "dumbass", "dimwit", "halfwit", "scumbag", "lowlife", "bitch", "asshole", "dickhead", "retard"),
    "things": ("scum", "trash", "garbage", "filth", "vermin", "crap", "shit", "bullshit", "dirt", "parasite", "pig"),
    "qualities": ("pathetic", "worthless", "disgusting", "stupid", "dumb", "idiotic", "ugly", "vile", "useless",
                  "moronic", "brainless", "repulsive", "despicable", "fucking", "damned", "nasty"),
}
MINED_WORDS, MINED_GROUPS, LEAST = 192, 2, 4
#: Least log-likelihood ratio of a mined entry: chance reaches it once in about ten million candidates.
RATIO = 15.0
#: Lengths of word beginnings; an entry of a list that ends in * is one.
STEMS = (3, 5, 7)
_WORD = re.compile(r"[^\W\d_]+")
_MASKED = re.compile(r"\b[a-z][*@#$%]{2,}[a-z]*\b")
#: Group 1 is the word addressed; only the first word is consumed, so that no word that follows is passed over.
_ADDRESSED = re.compile(
    r"\b(?:you|your|you're|he|she|they|such|a|an|these|those)\s+(?=(?:(?:are|a|an)\s+)*([^\W\d_]+))")
_RUN = re.compile(r"!{3,}")
_WIDE = re.compile(r"[^\x00-\x7f]+")


def word_set(text) -> set[str]:
    return set(_WORD.findall(text.lower())) if isinstance(text, str) else set()


def signs(words: set[str]) -> set[str]:
    """The words, and their beginnings with a * after them."""
    out = set(words)
    for k in STEMS:
        out |= {w[:k] + "*" for w in words if len(w) > k}
    return out


def case_counts(text: str) -> tuple[int, int]:
    """Letters and capitals of the whole text (ASCII ones counted as bytes)."""
    data = text.encode("utf-8", "surrogatepass")
    letters = len(data) - len(data.translate(None, string.ascii_letters.encode()))
    upper = len(data) - len(data.translate(None, string.ascii_uppercase.encode()))
    wide = "" if text.isascii() else "".join(_WIDE.findall(text))
    return letters + sum(map(str.isalpha, wide)), upper + sum(map(str.isupper, wide))


class Voters:
    """Votes of all voters on one text: 1 toxic, 0 clean, -1 abstains."""

    def __init__(self, mined: list[list[str]]):
        self.groups = [*map(set, LEXICONS.values()), *map(set, mined)]
        self.every = set().union(*self.groups)
        self.stems = [(k, {x[:-1] for x in self.every if len(x) == k + 1 and x[-1] == "*"}) for k in STEMS]
        self.names = [*LEXICONS, *(f"mined_{k}" for k in range(MINED_GROUPS)),
                      "two_words", "four_words", "addressed", "masked", "shouting", "exclaims", "no_sign"]

    def __call__(self, text) -> tuple[list[int], set[str]]:
        words = word_set(text)
        hits = words & self.every
        for k, stems in self.stems:
            if stems:
                hits |= {x + "*" for x in {w[:k] for w in words if len(w) > k} & stems}
        raw = text if isinstance(text, str) else ""
        votes = [1 if hits & g else -1 for g in self.groups]
        votes += [1 if len(hits) >= 2 else -1, 1 if len(hits) >= 4 else -1]
        addressed = bool(hits) and any(self.hit(m[1], hits) for m in _ADDRESSED.finditer(raw.lower()))
        letters, upper = case_counts(raw)
        votes += [1 if addressed else -1, 1 if _MASKED.search(raw) else -1,
                  1 if letters > 20 and upper > 0.6 * letters else -1, 1 if _RUN.search(raw) else -1]
        votes.append(0 if not hits and max(votes) < 1 else -1)
        return votes, hits

    def hit(self, word: str, hits: set[str]) -> bool:
        """Whether the word is one of ``hits``, or one of its beginnings is."""
        return word in hits or any(len(word) > k and word[:k] + "*" in hits for k in STEMS)


def training_rows(docs: DataFrame, labels: DataFrame, label: str, folds: int, held: int, limit: int) -> DataFrame:
    """``text`` and ``y`` of at most ``limit`` labelled documents outside the held-out fold."""
    y = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("double").alias("y"))
         .filter("doc_id is not null and y is not null").filter(fold(F.col("doc_id"), folds) != held)
         .groupBy("doc_id").agg((F.avg("y") >= 0.5).cast("int").alias("y")))
    few = checkpointed(y.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(few), "doc_id")
    return rows.dropDuplicates(["text", "y"])  # copies are no further evidence


def mine_words(rows: DataFrame, count: int = MINED_WORDS) -> list[list[str]]:
    """Words and beginnings with the largest log-likelihood ratio among those mostly in toxic documents: those met
    often and never in clean ones, and the others."""
    def counted(wanted):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            seen: dict[str, int] = {}
            for pdf in batches:
                for text in pdf["text"]:
                    found = signs(word_set(text))
                    for w in found if wanted is None else found & wanted.value:
                        seen[w] = seen.get(w, 0) + 1
            yield pd.DataFrame(list(seen.items()), columns=["word", "n"])
        return run

    def counts(y: int, wanted) -> DataFrame:
        part = rows.filter(F.col("y") == y).select("text").mapInPandas(lean(counted(wanted)), "word string, n long")
        return part.groupBy("word").agg(F.sum("n").alias("n"))

    total = rows.agg(F.sum(1 - F.col("y")), F.sum("y")).first()
    if not total[0] or not total[1]:
        return [[] for _ in range(MINED_GROUPS)]
    toxic = {r.word: r.n for r in counts(1, None).filter(F.col("n") >= LEAST).collect()}
    clean = {r.word: r.n for r in counts(0, rows.sparkSession.sparkContext.broadcast(set(toxic))).collect()}

    def ratio(word: str) -> float:
        a, b = toxic[word], clean.get(word, 0)
        share = (a + b) / (total[0] + total[1])
        return a * np.log(a / (total[1] * share)) + (b * np.log(b / (total[0] * share)) if b else 0.0)

    mostly = [w for w, a in toxic.items() if a > 10 * clean.get(w, 0)]
    gain = {w: r for w in mostly if (r := ratio(w)) >= RATIO}
    chosen: list[str] = []
    for w in sorted(gain, key=lambda w: (-gain[w], -len(w), w)):
        own = w.rstrip("*")
        covered = any(c[-1] == "*" and own.startswith(c[:-1]) for c in chosen)
        if not covered and not (w[-1] == "*" and any(c.startswith(own) and gain[c] >= gain[w] for c in chosen)):
            chosen.append(w)
            if len(chosen) == count:
                break
    rank = lambda w: int(toxic[w] < 10 or w in clean)
    return [[w for w in chosen if rank(w) == k] for k in range(MINED_GROUPS)]


def label_model(votes: np.ndarray, count: np.ndarray, known: np.ndarray, rounds: int = 60) -> np.ndarray:
    """Posterior of label 1 per vote pattern, by EM over a tree of voters.

    ``votes`` (patterns by voters, -1, 0 or 1), ``count`` (documents of each pattern), ``known`` (patterns by 2:
    of these, documents labelled 0 and 1).
    """
    n, m = votes.shape
    v = votes + 1
    yes, no = (votes == 1).sum(1), (votes == 0).sum(1)
    post = np.where(yes > 0, 0.5 + 0.4 * np.minimum(yes, 3) / 3, np.where(no > 0, 0.02, 0.2))
    free = np.maximum(count - known.sum(1), 0)
    parent = np.full(m, -1)
    onehot = np.eye(3)[v]
    for turn in range(rounds):
        weight = np.stack([known[:, 0] + free * (1 - post), known[:, 1] + free * post], 1)
        if turn % 20 == 10:  # the tree: most mutual information given the label first (Prim)
            info = np.zeros((m, m))
            for y in (0, 1):
                w = weight[:, y] / max(weight.sum(), 1e-9)
                joint = np.einsum("n,nia,njb->ijab", w, onehot, onehot) + 1e-9
                one = joint.sum(3).mean(1)
                one = one / one.sum(1, keepdims=True) * w.sum()
                info += (joint * np.log(joint * w.sum() / (one[:, None, :, None] * one[None, :, None, :] + 1e-12) + 1e-12)).sum((2, 3))
            np.fill_diagonal(info, -1)
            inside = [0]
            while len(inside) < m:
                rest = [j for j in range(m) if j not in inside]
                sub = info[np.ix_(inside, rest)]
                a, b = np.unravel_index(sub.argmax(), sub.shape)
                parent[rest[b]] = inside[a]
                inside.append(rest[b])
        logp = np.log(weight.sum(0) + 1.0) - np.log(weight.sum() + 2.0)
        score = np.repeat(logp[None, :], n, 0)
        for j in range(m):
            for y in (0, 1):
                w = weight[:, y]
                if parent[j] < 0:
                    table = np.bincount(v[:, j], weights=w, minlength=3) + 0.1
                    score[:, y] += np.log(table / table.sum())[v[:, j]]
                else:
                    table = np.zeros((3, 3))
                    np.add.at(table, (v[:, parent[j]], v[:, j]), w)
                    table += 0.1
                    score[:, y] += np.log(table / table.sum(1, keepdims=True))[v[:, parent[j]], v[:, j]]
        post = 1 / (1 + np.exp(np.clip(score[:, 0] - score[:, 1], -30, 30)))
    return post


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.2, rounds: int = 25) -> np.ndarray:
    """Weights (constant last) of ridge logistic regression on labels between 0 and 1, by Newton steps."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-3
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty), x.T @ (y - p) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _inputs(votes: np.ndarray, hits: list, words: list[str]) -> np.ndarray:
    place = {w: k for k, w in enumerate(words)}
    x = np.zeros((len(votes), len(words)))
    for k, h in enumerate(hits):
        for w in h:
            x[k, place[w]] = 1.0
    return np.hstack([(votes == 1), (votes == 0), x]).astype(float)


def score_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = 4, held: int = 2,
                   threshold: float = 0.3, limit: int = LABELLED, keep_columns: bool = False) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` for every row of ``docs`` (with ``keep_columns`` after
    all columns of ``docs``, as ``toxicity_score`` and ``toxicity_predicted``, or those names after underscores where
    ``docs`` has them)."""
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = keep(training_rows(docs, labels, label, folds, held, limit), "labelled")
    voters = Voters(mine_words(rows))
    words = sorted(voters.every)

    def vote(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = [voters(t) for t in pdf["text"]]
            yield pd.DataFrame({"votes": [v for v, _ in out], "hits": [sorted(h) for _, h in out], "y": pdf["y"].tolist()},
                               columns=["votes", "hits", "y"])

    schema = "votes array<int>, hits array<string>, y int"
    # every document's votes; a label joins its pattern's counts
    all_votes = docs.select("text", F.lit(0).alias("y")).mapInPandas(lean(vote), schema).groupBy("votes").agg(
        F.count(F.lit(1)).alias("n")).collect()
    sample = rows.select("text", "y").mapInPandas(lean(vote), schema).collect()
    patterns = {tuple(r.votes): [r.n, 0, 0] for r in all_votes}
    for r in sample:
        patterns.setdefault(tuple(r.votes), [1, 0, 0])[1 + r.y] += 1
    weights = None
    if sample:
        table = np.array(list(patterns))
        counts = np.array(list(patterns.values()), dtype=float)
        post = dict(zip(patterns, label_model(table, counts[:, 0], counts[:, 1:]), strict=True))
        x = _inputs(np.array([r.votes for r in sample]), [r.hits for r in sample], words)
        weights = logistic(x, np.array([post[tuple(r.votes)] for r in sample]))

    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        out = [voters(t) for t in text]
        if not out:
            return pd.Series([], dtype=float)
        votes = np.array([v for v, _ in out])
        if weights is None:
            return pd.Series(np.where((votes == 1).any(1), 0.9, 0.05), index=text.index)
        x = _inputs(votes, [h for _, h in out], words)
        give_back()
        return pd.Series(1 / (1 + np.exp(-np.clip(x @ weights[:-1] + weights[-1], -30, 30))), index=text.index)

    if keep_columns:
        at, decided = free_name(docs, "toxicity_score"), free_name(docs, "toxicity_predicted")
        return docs.withColumn(at, score("text")).withColumn(decided, (F.col(at) >= threshold).cast("int"))
    got = docs.select(F.col("doc_id").cast("long").alias("doc_id"), score("text").alias("score"))
    return got.select("doc_id", F.coalesce(fold(F.col("doc_id"), folds) == held, F.lit(False)).alias("held_out"),
                      "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
