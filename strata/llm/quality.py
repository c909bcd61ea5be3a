"""Quality classifier: random Fourier features, ridge regression, isotonic calibration (op 8).

1. Every whole text becomes a row of document statistics (``STATISTICS``), stored once.
2. Statistics are standardised by the means and deviations of the labelled training rows, and mapped to
   ``FEATURES`` random Fourier features, whose inner products approximate a Gaussian kernel of width ``WIDTH``.
3. Normal equations are summed over partitions (a fixed-size matrix each, merged in rounds) and solved on the
   driver, whose share is FEATURES * FEATURES numbers whatever the input. Rows are weighted so that both labels
   have the same total weight.
4. Ridge scores of the calibration fold (training rows, not used in 3) are counted in ``BINS`` bins; pooling
   adjacent violators over the bins gives a monotone map to the share of label 1.

Training uses rows whose crc32(doc_id as text) mod ``folds`` is not 0, all of them; a fifth of these calibrates.
Labels, lang, source and doc_id are never inputs. Null and empty texts have all statistics 0 and are scored like
any other. Several labels of one document count by their mean; null labels and labels without a document are
passed over; a null doc_id has no label and is not held out. Without training rows every score is 0.5. Columns
other than ``doc_id`` and ``text`` are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import bounded_batches, keep, merged_sum, pack

STATISTICS = ("log_words", "word_length", "upper", "digits", "symbols", "pipes", "exclaim", "commas", "stops",
              "distinct", "top_word", "repeated", "log_lines", "line_words", "same_lines", "symbol_words",
              "upper_words", "long_words", "spaces", "non_ascii")
FEATURES, WIDTH, RIDGE, BINS, SEED = 256, 4.0, 1e-3, 2048, 20240501
_SYMBOLS = re.compile(r"[#$%&*@^~<>{}\[\]\\/=+_|`]")
_SYMBOL_WORD = re.compile(r"(?:[#$%&*@^~|]{2,}|\|)")


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds`` (0 to folds - 1; null for a null id)."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds))


def statistics(text) -> list[float]:
    """The document statistics of one whole text."""
    if not isinstance(text, str) or not text.strip():
        return [0.0] * len(STATISTICS)
    words = text.split()
    n, chars = len(words), len(text)
    count = lambda c: text.count(c) / n
    seen: dict[str, int] = {}
    for w in words:
        seen[w] = seen.get(w, 0) + 1
    lines = [x for x in text.split("\n") if x.strip()]
    upper = sum(map(str.isupper, words))
    return [
        np.log1p(n), min(chars / n, 40.0), sum(map(str.isupper, text)) / chars, len(re.findall(r"[0-9]", text)) / chars,
        len(_SYMBOLS.findall(text)) / n, count("|"), count("!"), count(","), count("."),
        len(seen) / n ** 0.8, max(seen.values()) / n, sum(a == b for a, b in zip(words, words[1:])) / n,
        np.log1p(len(lines)), np.log1p(n / len(lines)), 1.0 - len(set(lines)) / len(lines),
        sum(1 for w in words if _SYMBOL_WORD.search(w)) / n, upper / n, sum(1 for w in words if len(w) > 20) / n,
        sum(map(str.isspace, text)) / chars, (len(text.encode("utf-8", "surrogatepass")) - chars) / chars]


def measured(docs: DataFrame) -> DataFrame:
    """Stored ``doc_id`` and ``x`` (statistics) of every row."""
    bounded_batches(docs.sparkSession)

    @F.pandas_udf("array<double>")
    def run(text: pd.Series) -> pd.Series:
        return pd.Series([statistics(t) for t in text], index=text.index)

    return keep(docs.select(F.col("doc_id").cast("long").alias("doc_id"), run("text").alias("x")), "statistics")


def fourier(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Random Fourier features of standardised statistics, and a constant."""
    r = np.random.RandomState(SEED)
    w = r.normal(size=(x.shape[1], FEATURES)) / WIDTH
    phase = r.uniform(0, 2 * np.pi, FEATURES)
    z = np.clip((x - mean) / scale, -8, 8)
    return np.hstack([np.sqrt(2.0 / FEATURES) * np.cos(z @ w + phase), np.ones((len(x), 1))])


def isotonic(total: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Monotone share of ones per bin by pooling adjacent violators; empty bins take interpolated values."""
    filled = np.flatnonzero(total > 0)
    if not len(filled):
        return np.full(len(total), 0.5)
    blocks: list[list[float]] = []
    for k in filled:
        blocks.append([ones[k], total[k], 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            a, b, c = blocks.pop()
            blocks[-1] = [blocks[-1][0] + a, blocks[-1][1] + b, blocks[-1][2] + c]
    level = np.concatenate([np.full(int(c), (a + 0.5) / (b + 1.0)) for a, b, c in blocks])
    return np.interp(np.arange(len(total)), filled, np.maximum.accumulate(level))


def labelled(rows: DataFrame, labels: DataFrame, label: str, folds: int, held: int) -> DataFrame:
    """Training rows: ``rows`` outside the held-out fold, with ``y`` (mean label of the document)."""
    y = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("double").alias("y"))
         .filter("doc_id is not null and y is not null").groupBy("doc_id").agg(F.avg("y").alias("y")))
    return rows.filter(fold(F.col("doc_id"), folds) != held).join(y, "doc_id")


def _summed(rows: DataFrame, fn, length: int) -> np.ndarray:
    """Sum of ``fn(x, y, calibrate)`` (a float array of ``length``) over all batches of ``rows``."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(length)
        for pdf in batches:
            if len(pdf):
                total += fn(np.stack(pdf["x"].to_numpy()), pdf["y"].to_numpy(), pdf["cal"].to_numpy())
        yield pd.DataFrame({"slot": [0], "part": [TaskContext.get().partitionId()], "blob": [pack(total)]})

    return merged_sum(rows.mapInPandas(run, "slot int, part long, blob binary"), "float64").get(0, np.zeros(length))


def train(rows: DataFrame) -> dict:
    """Model from rows with ``x``, ``y`` and ``cal`` (whether a row calibrates)."""
    d, m = len(STATISTICS), FEATURES + 1

    def moments(x, y, cal):
        return np.concatenate([[len(x), y.sum()], x.sum(0), (x * x).sum(0)])

    got = _summed(rows, moments, 2 + 2 * d)
    n, ones = got[0], got[1]
    if not n:
        return {}
    mean = got[2:2 + d] / n
    scale = np.sqrt(np.maximum(got[2 + d:] / n - mean ** 2, 1e-12)) + 1e-6
    weight = (0.5 * n / max(n - ones, 1.0), 0.5 * n / max(ones, 1.0))

    def normal(x, y, cal):
        x, y = x[~cal], y[~cal]
        z, w = fourier(x, mean, scale), weight[0] * (1 - y) + weight[1] * y
        return np.concatenate([(z.T @ (z * w[:, None])).ravel(), z.T @ (w * y)])

    eq = _summed(rows, normal, m * m + m)
    beta = np.linalg.solve(eq[:m * m].reshape(m, m) + RIDGE * n * np.eye(m) / m, eq[m * m:])

    def calibrate(x, y, cal):
        k = bins(fourier(x[cal], mean, scale) @ beta)
        return np.concatenate([np.bincount(k, minlength=BINS), np.bincount(k, weights=y[cal], minlength=BINS)])

    counts = _summed(rows, calibrate, 2 * BINS)
    return {"mean": mean, "scale": scale, "beta": beta, "level": isotonic(counts[:BINS], counts[BINS:])}


def bins(raw: np.ndarray) -> np.ndarray:
    return np.clip(((raw + 0.5) / 2.0 * BINS).astype(np.int64), 0, BINS - 1)


def score_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 5, held: int = 0,
                  threshold: float = 0.3) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` for every row of ``docs``."""
    stats = measured(docs)
    mine = labelled(stats, labels, label, folds, held).withColumn("cal", fold(F.col("doc_id"), 5 * folds) % 5 == 4)
    model = docs.sparkSession.sparkContext.broadcast(train(keep(mine.select("x", "y", "cal"), "training")))

    @F.pandas_udf("double")
    def score(x: pd.Series) -> pd.Series:
        m = model.value
        if not len(x) or not m:
            return pd.Series(np.full(len(x), 0.5), index=x.index)
        raw = fourier(np.stack(x.to_numpy()), m["mean"], m["scale"]) @ m["beta"]
        # the raw score breaks ties inside a calibrated step, without leaving the step's order
        return pd.Series(np.clip(m["level"][bins(raw)] * (1 - 1e-6) + 1e-6 * np.clip(raw, 0, 1), 0, 1), index=x.index)

    got = stats.select("doc_id", F.coalesce(fold(F.col("doc_id"), folds) == held, F.lit(False)).alias("held_out"),
                       score("x").alias("score"))
    return got.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
