"""Approximate nearest neighbours by inner product over an inverted multi-index (op 2).

Both halves of the vectors are quantised separately with ``k`` centroids each (k-means on at most ``SAMPLE``
vectors, those of the least id hashes); a vector's cell is its pair of centroids, and every vector is indexed. For
a query, cells are visited in order of the summed inner products of its halves with the pair's centroids, with a
heap over the two sorted centroid lists, until the cells visited hold ``PROBE`` of the vectors. The vectors of
those cells are ranked again by the exact inner product, in double precision.

The index is cut into shards of about ``SHARD`` vectors by id hash (so a crowded cell is spread as well), queries
into blocks; a task ranks one block against one shard, and Spark merges the tasks' ``top`` best. Of equal vectors
only the ``top + 1`` smallest ids can be among the nearest, so the others (a hot vector's copies) leave before.

Vectors that are null, empty, zero or hold null or non-finite numbers take no part, nor do vectors of another
length than the most frequent one; a null id likewise. Repeated rows are rows of their own. Ties go to the smaller
vec_id. With fewer candidates than ``top`` all found are returned. An empty table gives an empty result. Only
``vec_id`` and ``embedding`` are read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import checkpointed, keep

SAMPLE, PROBE, SHARD, BLOCK = 20_000, 0.75, 20_000, 512
MAX_CENTROIDS, ROUNDS, SEED = 256, 12, 7


def valid_vectors(table: DataFrame) -> DataFrame:
    """Stored ``row``, ``vec_id``, ``v`` (doubles) of the vectors that take part."""
    v = F.col("embedding").cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    good = keep(table.select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"),
                             v.alias("v")).filter(fine & F.col("vec_id").isNotNull()), "vectors")
    size = good.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return good.filter(F.size("v") == (size.n if size else 0))


def k_means(x: np.ndarray, k: int) -> np.ndarray:
    c = x[np.random.RandomState(SEED).choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(ROUNDS):
        near = nearest_centroid(x, c)
        count = np.bincount(near, minlength=len(c))
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        c[count > 0] = total[count > 0] / count[count > 0, None]
    return c


def nearest_centroid(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return (x @ c.T - 0.5 * (c * c).sum(1)).argmax(1)


def visit(one: np.ndarray, two: np.ndarray, count: np.ndarray, goal: float) -> np.ndarray:
    """Cells (pairs of centroids) by falling ``one[i] + two[j]`` until they hold ``goal`` vectors."""
    a, b = np.argsort(-one, kind="stable"), np.argsort(-two, kind="stable")
    p, q = one[a].tolist(), two[b].tolist()
    heap, seen, got, held = [(-(p[0] + q[0]), 0, 0)], {(0, 0)}, [], 0
    while heap and held < goal:
        _, i, j = heapq.heappop(heap)
        cell = int(a[i]) * len(q) + int(b[j])
        if count[cell]:
            got.append(cell)
            held += count[cell]
        for x, y in ((i + 1, j), (i, j + 1)):
            if x < len(p) and y < len(q) and (x, y) not in seen:
                seen.add((x, y))
                heapq.heappush(heap, (-(p[x] + q[y]), x, y))
    return np.array(got, dtype=np.int64)


def best_of_task(queries: pd.DataFrame, index: pd.DataFrame, cells: int, top: int) -> pd.DataFrame:
    """The ``top`` nearest of a block's queries among a shard's vectors in the cells that each query visits."""
    empty = pd.DataFrame(columns=["q_row", "query_id", "row", "vec_id", "score"])
    if not len(queries) or not len(index):
        return empty
    index = index.sort_values(["vec_id", "row"])
    x, cell = np.stack(index["v"].to_numpy()), index["cell"].to_numpy()
    ids, rows = index["vec_id"].to_numpy(), index["row"].to_numpy()
    q, q_rows = np.stack(queries["v"].to_numpy()), queries["row"].to_numpy()
    open_cells = np.stack([np.unpackbits(np.frombuffer(b, dtype=np.uint8))[:cells] for b in queries["cells"]]).astype(bool)
    best = (np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64), np.empty(0))
    least = np.full(len(q), -np.inf)
    for at in range(0, len(x), 2048):
        part = slice(at, at + 2048)
        s = np.where(open_cells[:, cell[part]] & (q_rows[:, None] != rows[None, part]), q @ x[part].T, -np.inf)
        if s.shape[1] >= top:
            least = np.maximum(least, np.partition(s, -top, axis=1)[:, -top])
        i, j = np.nonzero((s >= least[:, None] - 1e-9) & (s > -np.inf))
        j += at
        exact = (q[i] * x[j]).sum(1)  # in one order for all, so that equal vectors have equal scores
        i, j, s = (np.concatenate(z) for z in zip(best, (i, j, exact), strict=True))
        order = np.lexsort((j, -s, i))  # the shard is in order of vec_id
        i, j, s = i[order], j[order], s[order]
        rank = np.arange(len(i)) - np.searchsorted(i, i)
        best = tuple(z[rank < top] for z in (i, j, s))
        full = np.bincount(best[0], minlength=len(q)) == top
        last = np.searchsorted(best[0], np.flatnonzero(full), side="right") - 1
        least[full] = np.maximum(least[full], best[2][last])
    i, j, s = best
    return pd.DataFrame({"q_row": q_rows[i], "query_id": queries["vec_id"].to_numpy()[i], "row": rows[j],
                         "vec_id": ids[j], "score": s})


def nearest(table: DataFrame, is_query, top: int = 20, probe: float = PROBE, k: int | None = None) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score`` of the ``top`` nearest found of every row with ``is_query``."""
    spark = table.sparkSession
    good = valid_vectors(table)
    same = Window.partitionBy("v").orderBy("vec_id", "row")
    lead = keep(good.withColumn("r", F.row_number().over(same)).filter(F.col("r") <= top + 1).drop("r"), "lead")
    n = lead.count()
    schema = "query_id long, rank int, vec_id long, score double"
    if not n:
        return spark.createDataFrame([], schema)
    sample = np.array([r.v for r in lead.select("v").orderBy(F.xxhash64("vec_id"), "vec_id", "row").limit(SAMPLE).collect()])
    k = k or int(np.clip(2 ** np.round(np.log2(np.sqrt(n / 50))), 16, MAX_CENTROIDS))
    half = sample.shape[1] // 2
    books = spark.sparkContext.broadcast((k_means(sample[:, :half], k), k_means(sample[:, half:], k)))
    k1, k2 = len(books.value[0]), len(books.value[1])

    @F.pandas_udf("long")
    def cell_of(v: pd.Series) -> pd.Series:
        if not len(v):
            return pd.Series([], dtype="int64")
        x = np.stack(v.to_numpy())
        one, two = books.value
        return pd.Series(nearest_centroid(x[:, :half], one) * len(two) + nearest_centroid(x[:, half:], two), index=v.index)

    index = keep(lead.withColumn("cell", cell_of("v")), "index")
    count = np.zeros(k1 * k2, dtype=np.int64)
    for r in index.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect():  # at most k * k rows
        count[r.cell] = r.n
    goal = max(probe * n, min(n, 20 * (top + 1)))  # small tables are searched whole

    def plan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        one, two = books.value
        for pdf in batches:
            out = []
            for v in pdf["v"]:
                v = np.asarray(v)
                bits = np.zeros(k1 * k2, dtype=np.uint8)
                bits[visit(one @ v[:half], two @ v[half:], count, goal)] = 1
                out.append(np.packbits(bits).tobytes())
            yield pdf.assign(cells=out)

    queries = good.filter(is_query)
    total = queries.count()
    shards, blocks = -(-n // SHARD), max(1, -(-total // BLOCK))
    asked = keep(queries.repartition(max(1, min(blocks * 4, 64))).mapInPandas(plan, "row long, vec_id long, v array<double>, cells binary"), "asked")
    each = lambda size: F.explode(F.sequence(F.lit(0), F.lit(size - 1)))
    place = lambda size, salt: F.pmod(F.xxhash64(F.lit(salt), "row"), F.lit(size)).cast("int")
    left = asked.withColumn("block", place(blocks, 1)).withColumn("shard", each(shards))
    right = index.withColumn("shard", place(shards, 2)).withColumn("block", each(blocks))
    found = left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block")).applyInPandas(
        lambda a, b: best_of_task(a, b, k1 * k2, top),
        "q_row long, query_id long, row long, vec_id long, score double")
    order = Window.partitionBy("q_row").orderBy(F.desc("score"), "vec_id", "row")
    return (checkpointed(found).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
