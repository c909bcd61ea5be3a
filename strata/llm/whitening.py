"""Embedding whitening by QDWH spectral divide-and-conquer (op 11).

A component ``c`` becomes the integer ``x = floor(scale * c) + offset``. The covariance is that of the distinct vectors
(the fit list), so copies don't weigh: ``distinct`` merges copies before its shuffle, and sums and products are formed a
partition at a time and added in rounds, so the driver gets one matrix of dims x dims whatever the table holds. Vectors
are centred at the exact mean ``S / n`` before they are multiplied.

The components are split off recursively: the unitary polar factor of the covariance shifted by ``s`` (QDWH: dynamically
weighted Halley steps, each one QR factorisation) is the matrix sign, so ``(U + I) / 2`` projects on the subspace of the
eigenvalues above ``s``. An orthonormal basis of it and of its complement makes the covariance block diagonal, and each block is
split again until it is diagonal to rounding. Only blocks that hold wanted components are split. The map to at most
``components`` numbers a row (dims x components) is broadcast, and every row of the table is whitened by it.

Rows whose vector is null or holds null or non-finite numbers are dropped; null ids and repeated rows stay. Where lengths
differ, missing entries count as 0.0. Components without variance (to rounding) have no whitened value and are left
out, so a table with fewer than two distinct vectors, or an empty one, gives an empty result. A deviation beyond a
long ends the query with an error. Only ``vec_id`` and ``embedding`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import keep, merged_sum, pack

SCALE, OFFSET, COMPONENTS, SEED = 64, 1_000_000, 16, 11
_EPS = float(np.finfo(np.float64).eps)


def polar_factor(a: np.ndarray) -> np.ndarray:
    """Unitary polar factor of a symmetric matrix by QDWH; for a nonsingular one this is its matrix sign."""
    d = len(a)
    x = a / (np.linalg.norm(a) or 1.0)
    try:  # a lower bound of the least singular value
        low = 1.0 / np.linalg.norm(np.linalg.inv(x))
    except np.linalg.LinAlgError:
        low = _EPS
    low = min(1.0, max(low, _EPS))
    for _ in range(30):
        t = np.cbrt(4.0 * (1.0 - low * low) / low ** 4)
        root = np.sqrt(1.0 + t)
        p = root + 0.5 * np.sqrt(8.0 - 4.0 * t + 8.0 * (2.0 - low * low) / (low * low * root))
        q = (p - 1.0) ** 2 / 4.0
        r = p + q - 1.0
        basis, _ = np.linalg.qr(np.vstack([np.sqrt(r) * x, np.eye(d)]))
        y = (q / r) * x + (p - q / r) / np.sqrt(r) * (basis[:d] @ basis[d:].T)
        y = (y + y.T) / 2
        low = min(1.0, low * (p + q * low * low) / (1.0 + r * low * low))
        step, x = np.linalg.norm(y - x), y
        if step < 1e-10 and 1.0 - low < 1e-8:  # steps are of third order: the next would be below rounding
            break
    return x


def split(a: np.ndarray, shift: float) -> tuple[np.ndarray, int, float]:
    """Orthonormal basis that starts with the subspace above ``shift``, its dimension, and the blocks' coupling."""
    d = len(a)
    projector = (polar_factor(a - shift * np.eye(d)) + np.eye(d)) / 2
    r = int(round(float(np.trace(projector))))
    if not 0 < r < d:
        return np.eye(d), r, np.inf
    start = np.random.RandomState(SEED).standard_normal((d, d))
    one, _ = np.linalg.qr(projector @ np.linalg.qr(projector @ start[:, :r])[0])
    two = start[:, r:] - projector @ start[:, r:]
    basis, _ = np.linalg.qr(np.hstack([one, two - one @ (one.T @ two)]))
    return basis, r, float(np.linalg.norm(basis[:, :r].T @ a @ basis[:, r:]))


def components_of(a: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues, falling, and their unit eigenvectors as columns."""
    whole = np.linalg.norm(a)

    def down(block: np.ndarray, basis: np.ndarray, wanted: int) -> tuple[list[float], list[np.ndarray]]:
        diagonal = np.diag(block)
        if np.linalg.norm(block - np.diag(diagonal)) <= 4 * _EPS * whole:
            order = np.argsort(-diagonal, kind="stable")[:wanted]
            return list(diagonal[order]), [basis[:, k] for k in order]
        middle, mean = float(np.median(diagonal)), float(np.mean(diagonal))
        spread = float(np.sqrt(np.mean((block - mean * np.eye(len(block))) ** 2) * len(block)))
        found = None
        for shift in (middle, mean, mean + spread / 7, mean - spread / 7, mean + spread / 3, mean - spread / 3):
            tried = split(block, shift)
            if found is None or tried[2] < found[2]:
                found = tried
            if found[2] <= 16 * _EPS * whole:
                break
        if not np.isfinite(found[2]):  # equal eigenvalues to rounding: any basis will do
            order = np.argsort(-diagonal, kind="stable")[:wanted]
            return list(diagonal[order]), [basis[:, k] for k in order]
        turn, r, _ = found
        turned = turn.T @ block @ turn
        turned, basis = (turned + turned.T) / 2, basis @ turn
        values, vectors = down(turned[:r, :r], basis[:, :r], min(wanted, r))
        if wanted > r:
            more = down(turned[r:, r:], basis[:, r:], wanted - r)
            values, vectors = values + more[0], vectors + more[1]
        return values, vectors

    _, vectors = down((a + a.T) / 2, np.eye(len(a)), min(wanted, len(a)))
    v = np.stack(vectors, 1)
    v /= np.linalg.norm(v, axis=0)
    values = ((a @ v) * v).sum(0)
    order = np.argsort(-values, kind="stable")
    return values[order], v[:, order]


def integer_rows(table: DataFrame, scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """Stored ``vec_id`` and ``x`` (longs of one length) of the rows that remain."""
    v = F.col("embedding").cast("array<double>")
    fine = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    x = F.transform(v, lambda c: F.floor(c * F.lit(float(scale))) + F.lit(offset))
    good = keep(table.filter(fine).select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x")), "integers")
    size = good.agg(F.min(F.size("x")).alias("least"), F.max(F.size("x")).alias("most")).first()
    if size.least == size.most:
        return good
    missing = F.array_repeat(F.lit(offset).cast("long"), F.lit(size.most) - F.size("x"))  # floor(0.0) + offset
    return good.withColumn("x", F.concat("x", missing))


def partial_products(fit: DataFrame, to_rows) -> np.ndarray:
    """Sum over the fit list of the outer product of ``to_rows(x)``, a matrix of one row a vector, with itself."""
    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for pdf in batches:
            if len(pdf):
                y = to_rows(np.stack(pdf["x"].to_numpy()))
                total = y.T @ y if total is None else total + y.T @ y
        if total is not None:
            yield pd.DataFrame({"slot": [0], "part": [TaskContext.get().partitionId()], "blob": [pack(total)]})

    flat = merged_sum(fit.mapInPandas(part, "slot int, part long, blob binary"), "f8")[0]
    side = int(round(np.sqrt(len(flat))))
    return flat.reshape(side, side)


def whiten(table: DataFrame, components: int = COMPONENTS, scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """``vec_id``, ``component``, ``n``, ``deviation``, ``whitened``, ``explained``, ``identity_error``."""
    spark = table.sparkSession
    rows = integer_rows(table, scale, offset)
    empty = spark.createDataFrame([], "vec_id long, component int, n long, deviation long, whitened double, "
                                      "explained double, identity_error double")
    fit = keep(rows.select("x").distinct(), "fit")
    some = fit.select(F.size("x").alias("d")).first()
    if some is None or not some.d:
        return empty
    sums = fit.agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.get("x", F.lit(k))).alias(f"s{k}") for k in range(some.d)]).first()
    n, s = int(sums[0]), np.array(sums[1:], dtype=np.int64)

    def exact(x: np.ndarray) -> np.ndarray:
        """``n * x - S`` as whole numbers: around the mean ``S / n`` in integers, then times n."""
        near = s // n
        return (x - near) * n - (s - near * n)

    def centred(x: np.ndarray) -> np.ndarray:
        return exact(x) / n

    v = partial_products(fit, centred) / n
    values, vectors = components_of(v, components)
    fine = values > len(v) * 8 * _EPS * np.linalg.norm(v)
    values, vectors = values[fine], vectors[:, fine]
    if not len(values):
        return empty
    explained = values / np.trace(v)
    to_white = spark.sparkContext.broadcast(vectors / np.sqrt(values))
    again = partial_products(fit, lambda x: centred(x) @ to_white.value) / n
    error = float(np.abs(again - np.eye(len(values))).max())

    @F.pandas_udf("deviation long, y array<double>")
    def whitened(x: pd.Series) -> pd.DataFrame:
        if not len(x):
            return pd.DataFrame({"deviation": pd.Series([], dtype="int64"), "y": pd.Series([], dtype=object)})
        off = exact(np.stack(x.to_numpy()))
        most = int(np.abs(off).max())
        if most * most * off.shape[1] >= 1 << 63:  # Python's integers; what a long can't hold raises
            deviation = np.array([sum(int(c) * int(c) for c in r) for r in off], dtype=np.int64)
        else:
            deviation = (off * off).sum(1)
        return pd.DataFrame({"deviation": deviation, "y": list((off / n) @ to_white.value)}, index=x.index)

    # computed once a row (the optimiser would put the function below once for each field that is used)
    each = rows.withColumn("w", F.explode(F.array(whitened("x")))).select("vec_id", "w.deviation", F.posexplode("w.y").alias("at", "whitened"))
    share = F.element_at(F.array(*[F.lit(float(e)) for e in explained]), F.col("at") + 1)
    return each.select("vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation",
                       "whitened", share.alias("explained"), F.lit(error).alias("identity_error"))
