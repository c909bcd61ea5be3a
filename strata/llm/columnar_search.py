"""Exact top-k by integer inner product: columnar branch-and-bound (op 13).

Components become ``floor(scale * c)``, so scores are integers and ties are exact. Candidates are dealt by a hash of
their row number into shards of at most about ``SHARD`` vectors, stored dimension by dimension. Queries go in blocks to
every shard; a task streams them past the shard that it holds, so it never has more than a shard and one block.

For a block and a tile of candidates the products are accumulated ``STEP`` dimensions at a time. After each step the
remaining mass bounds what a pair can still gain (the product of the norms of both vectors' remaining dimensions,
by Cauchy and Schwarz); pairs that cannot reach their query's k-th best so far are done with. While many pairs are alive the
step is a matrix product; then the survivors are compacted into a list that only shrinks. A query's first bound is its
k-th best among ``SEEDS`` candidates (by a hash of the row number), which can only be too low, so nothing is lost:
the result is exact. Of equal vectors a shard keeps the ``k + 1`` first ids (others cannot be in a result), which is
what a hot vector's copies come down to. Spark merges the shards' best.

Vectors that are null or hold null or non-finite numbers take no part, nor rows without an id, which no result could
name; zero and empty vectors do. Where lengths differ, missing components count as 0. Repeated rows are rows of
their own. Ties go to the smaller ``vec_id``, then to the earlier row. With fewer candidates than ``k`` all are
returned. An empty table, or one without queries, gives an empty result. A score beyond a long ends the query with an
error. Only ``vec_id`` and ``embedding`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import checkpointed, keep

SHARD, LEAST_SHARD, BLOCK, TILE, STEP, SEEDS = 131_072, 1024, 512, 8192, 16, 4096
#: Beyond this share of pairs alive, a step over all of them is cheaper than over a list.
DENSE = 0.125
_GRID = "shard int, kind int, ids binary, rows binary, data binary, least binary"
_FOUND = "q_row long, query_id long, row long, vec_id long, score long"


def integer_vectors(table: DataFrame, is_query, scale: int) -> DataFrame:
    """Stored ``row``, ``vec_id``, ``x`` (longs) and ``asks`` of the vectors that take part."""
    v = F.col("embedding").cast("array<double>")
    fine = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & F.col("vec_id").isNotNull()
    x = F.transform(v, lambda c: F.floor(c * F.lit(float(scale))))
    return keep(table.filter(fine).select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"),
                                          x.alias("x"), F.coalesce(is_query, F.lit(False)).alias("asks")), "integers")


def padded(x, dims: int):
    return F.when(F.size(x) < dims, F.concat(x, F.array_repeat(F.lit(0).cast("long"), F.lit(dims) - F.size(x)))).otherwise(x)


def working_types(dims: int, largest: int) -> tuple[str, str, float]:
    """Type stored, type of the sums (exact for all of them), and the slack of a bound."""
    total = dims * largest * largest
    stored = "<i2" if largest < 1 << 15 else "<i4" if largest < 1 << 31 else "<i8"
    if total < 1 << 22:
        return stored, "f4", 0.5 + total * 1e-6
    if total < 1 << 51:
        return stored, "f8", 0.5 + total * 1e-12
    return stored, "i8" if total < 1 << 62 else "O", 0.5 + total * 1e-12


def rest_norms(x: np.ndarray, axis: int) -> np.ndarray:
    """Norm of what remains after each full step, dimensions along ``axis``: row s is after s steps."""
    sq = np.moveaxis(x, axis, 0).astype(np.float64) ** 2
    cuts = range(0, len(sq), STEP)
    return np.stack([np.sqrt(sq[at:].sum(0)) for at in cuts] + [np.zeros(sq.shape[1])])


def tile_survivors(q: np.ndarray, q_rest: np.ndarray, x: np.ndarray, x_rest: np.ndarray, least: np.ndarray,
                   slack: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (query, candidate of the tile) whose exact score is at least the query's bound, with the score."""
    dims, steps = len(x), len(x_rest) - 1
    total = alive = None
    for s in range(steps):
        d = slice(s * STEP, min((s + 1) * STEP, dims))
        part = q[:, d] @ x[d]
        total = part if total is None else total + part
        reach = total + np.outer(q_rest[s + 1], x_rest[s + 1]).astype(total.dtype if total.dtype.kind == "f" else "f8")
        alive = (reach >= (least - slack)[:, None]).astype(bool)
        if s == steps - 1 or np.count_nonzero(alive) < DENSE * alive.size:
            break
    i, j = np.nonzero(alive)
    score = total[i, j]
    for s in range(s + 1, steps):
        for d in range(s * STEP, min((s + 1) * STEP, dims)):
            score = score + q[i, d] * x[d, j]
        on = (score + q_rest[s + 1][i] * x_rest[s + 1][j] >= (least - slack)[i]).astype(bool)
        i, j, score = i[on], j[on], score[on]
    return i, j, score


def best_of_block(q: np.ndarray, q_rows: np.ndarray, least: np.ndarray, x: np.ndarray, x_rest: np.ndarray,
                  rows: np.ndarray, top: int, slack: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, candidate, score) of the ``top`` best of each query of a block; candidates are in order of id."""
    q_rest, least = rest_norms(q, 1), least.copy()
    best = (np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64), np.empty(0, dtype=q.dtype))
    for at in range(0, x.shape[1], TILE):
        i, j, s = tile_survivors(q, q_rest, x[:, at:at + TILE], x_rest[:, at:at + TILE], least, slack)
        j = j + at
        on = q_rows[i] != rows[j]
        i, j, s = (np.concatenate(z) for z in zip(best, (i[on], j[on], s[on]), strict=True))
        order = np.lexsort((j, -s, i))
        i, j, s = i[order], j[order], s[order]
        first = np.searchsorted(i, i)
        on = np.arange(len(i)) - first < top
        best = i, j, s = i[on], j[on], s[on]
        full = np.flatnonzero(np.bincount(i, minlength=len(q)) == top)
        last = np.searchsorted(i, full, side="right") - 1
        least[full] = np.maximum(least[full], s[last].astype(np.float64))
    return best


def without_copies(x: np.ndarray, top: int) -> np.ndarray:
    """Places of the first ``top + 1`` columns of each distinct vector, for columns in order of id."""
    _, which = np.unique(np.ascontiguousarray(x.T).view(np.dtype((np.void, x.dtype.itemsize * len(x)))).ravel(), return_inverse=True)
    order = np.argsort(which, kind="stable")
    nth = np.arange(len(order)) - np.searchsorted(which[order], which[order])
    return np.sort(order[nth <= top])


def top_k(table: DataFrame, is_query, top: int = 20, scale: int = 64) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score`` of the ``top`` highest scores of every row with ``is_query``."""
    spark = table.sparkSession
    good = integer_vectors(table, is_query, scale)
    size = good.agg(F.count(F.lit(1)).alias("n"), F.count_if("asks").alias("asked"), F.max(F.size("x")).alias("dims"),
                    F.max(F.array_max(F.transform("x", lambda c: F.abs(c.cast("double"))))).alias("largest")).first()
    if not size.asked:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    dims = max(1, size.dims)
    stored, sums, slack = working_types(dims, int(size.largest or 0))
    good = good.withColumn("x", padded(F.col("x"), dims))
    shards = max(-(-size.n // SHARD), min(-(-size.n // LEAST_SHARD), 4 * spark.sparkContext.defaultParallelism))
    share = min(1 << 20, -(-SEEDS * (1 << 20) // size.n))  # about SEEDS rows, whatever the table holds
    seeds = good.filter(F.pmod(F.xxhash64(F.lit(13), "row"), F.lit(1 << 20)) < share).select("row", "x").collect()
    seeds = spark.sparkContext.broadcast((np.array([r.row for r in seeds], dtype=np.int64),
                                          np.array([r.x for r in seeds], dtype=stored).reshape(-1, dims)))

    def matrix(x: pd.Series) -> np.ndarray:
        return np.stack(x.to_numpy()).astype(stored)

    def first_bound(q: np.ndarray, rows: np.ndarray) -> np.ndarray:
        seed_rows, x = seeds.value
        if len(x) <= top:
            return np.full(len(q), -np.inf)
        s = (q.astype(sums) @ x.astype(sums).T).astype(np.float64)
        s[rows[:, None] == seed_rows[None]] = -np.inf
        return np.partition(s, -top, axis=1)[:, -top]

    def candidates(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for shard, part in pdf.groupby("shard"):
                yield pd.DataFrame({"shard": [shard], "kind": [0], "ids": [part["vec_id"].to_numpy().tobytes()],
                                    "rows": [part["row"].to_numpy().tobytes()],
                                    "data": [np.ascontiguousarray(matrix(part["x"]).T).tobytes()], "least": [b""]})

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for at in range(0, len(pdf), BLOCK):
                part = pdf.iloc[at:at + BLOCK]
                q, rows = matrix(part["x"]), part["row"].to_numpy()
                yield pd.DataFrame({"shard": [0], "kind": [1], "ids": [part["vec_id"].to_numpy().tobytes()],
                                    "rows": [rows.tobytes()], "data": [q.tobytes()], "least": [first_bound(q, rows).tobytes()]})

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard, held, x = None, [], None
        for pdf in batches:
            for r in pdf.itertuples():
                if r.shard != shard:
                    shard, held, x = r.shard, [], None
                ids, rows = np.frombuffer(r.ids, dtype=np.int64), np.frombuffer(r.rows, dtype=np.int64)
                if r.kind == 0:
                    held.append((ids, rows, np.frombuffer(r.data, dtype=stored).reshape(dims, -1)))
                    continue
                if not held:
                    continue
                if x is None:
                    c_ids, c_rows, x = (np.concatenate(z, axis=-1) for z in zip(*held, strict=True))
                    held = held[:1]
                    order = np.lexsort((c_rows, c_ids))
                    order = order[without_copies(np.ascontiguousarray(x[:, order]), top)]
                    c_ids, c_rows, x = c_ids[order], c_rows[order], np.ascontiguousarray(x[:, order]).astype(sums)
                    x_rest = rest_norms(x, 0)
                q = np.frombuffer(r.data, dtype=stored).reshape(-1, dims).astype(sums)
                i, j, s = best_of_block(q, rows, np.frombuffer(r.least, dtype=np.float64), x, x_rest, c_rows, top, slack)
                yield pd.DataFrame({"q_row": rows[i], "query_id": ids[i], "row": c_rows[j], "vec_id": c_ids[j],
                                    "score": s.astype(np.int64)})

    left = (good.withColumn("shard", F.pmod(F.xxhash64(F.lit(7), "row"), F.lit(shards)).cast("int"))
            .select("shard", "row", "vec_id", "x").mapInPandas(candidates, _GRID))
    asks = good.filter("asks").select("row", "vec_id", "x")
    right = (asks.repartition(max(1, -(-size.asked // BLOCK)), "row").mapInPandas(blocks, _GRID)
             .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))))
    grid = left.unionByName(right).repartition(shards, "shard").sortWithinPartitions("shard", "kind")
    order = Window.partitionBy("q_row").orderBy(F.desc("score"), "vec_id", "row")
    return (checkpointed(grid.mapInPandas(search, _FOUND)).withColumn("rank", F.row_number().over(order))
            .filter(F.col("rank") <= top).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
