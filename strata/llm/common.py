"""Helpers shared by the operators: word hashing in numpy, shared tables, bounded broadcasts, merged blobs."""

from __future__ import annotations

import ctypes
import hashlib
import zlib
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import scratch_path, shared_dir

#: A side is broadcast only after a count has shown that it holds at most this many (narrow) rows.
BROADCAST_ROWS = 1_000_000

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE = np.random.RandomState(12345).randint(0, 1 << 63, size=256, dtype=np.int64).astype(np.uint64)
#: Bytes hashed at a time (every worker keeps the powers for so many).
_SLICE = 1 << 17
_POWERS: list[np.ndarray] = []


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the queries made and run inside go when these end, not whenever the driver collects garbage.

    For results that are stored: nothing reads their shuffles again. The session's own setting is put back.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back (cuts the lineage, survives lost executors)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with shuffles_dropped(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    spark = df.sparkSession
    shared_dir(spark)  # registers the checkpoint folder of the cluster
    with shuffles_dropped(spark):
        return df.select("*").checkpoint()


def bounded_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Send Python workers at most ``rows`` texts at a time (Spark's default of 10 000 is kept if set otherwise)."""
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def give_back() -> None:
    """Return this Python worker's freed memory to the machine: workers outlive their tasks, and idle ones add up."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def lean(work: Callable) -> Callable:
    """A function of batches that gives its task's memory back at the end."""
    def run(batches: Iterator) -> Iterator:
        yield from work(batches)
        give_back()

    return run


def lean_group(work: Callable[[pd.DataFrame], pd.DataFrame]) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """A function of a group that gives the group's memory back at the end."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = work(pdf)
        give_back()
        return out

    return run


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint for a side counted to be within ``limit`` rows; beyond it Spark shuffles the join.

    ``df`` should be stored already (``keep`` or ``checkpointed``): it is counted here.
    """
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def only_rows(df: DataFrame, column: str, rows: DataFrame, without: bool = False) -> DataFrame:
    """Those of ``df`` whose ``column`` (row numbers) is (``without``: is not) among the ``row`` of ``rows`` (stored).

    64 neighbouring rows are one narrow row of bits: a broadcast reaches up to 64 times as many rows.
    """
    words = keep(rows.groupBy(F.shiftright("row", 6).alias("__word")).agg(
        F.bit_or(F.expr("shiftleft(1L, int(row & 63))")).alias("__bits")), "bits")
    at = F.col(column)
    held = (F.shiftright(at, 6) == F.col("__word")) & F.expr(f"(shiftrightunsigned(__bits, int(`{column}` & 63)) & 1L) = 1L")
    return df.join(broadcast_if_small(words), held, "left_anti" if without else "left_semi")


def free_name(docs: DataFrame, name: str) -> str:
    """``name``, with underscores before it while ``docs`` has a column of that name."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def stored(docs: DataFrame) -> DataFrame:
    """``docs`` itself if its rows can be numbered as they are read, else a stored copy (see ``numbered``)."""
    try:
        docs.select(docs.metadataColumn("_metadata").getField("row_index"))
        return docs
    except AnalysisException:
        return keep(docs, "rows")


def numbered(docs: DataFrame, name: str = "row") -> DataFrame:
    """``docs`` with a unique long per row that is the same on every read.

    The number is the row's place in its file and the file's place in the sorted list of files. It doesn't depend on how
    Spark packs files into partitions, which moves with the number of cores when executors come and go. A frame
    that isn't a scan of Parquet files (with filters and projections) is stored first. The lookup of files is as long
    as the listing that the scan keeps on the driver anyway, and broadcast within ``BROADCAST_ROWS``.
    """
    spark = docs.sparkSession
    plain = lambda c: F.regexp_replace(c, "^([A-Za-z][A-Za-z0-9+.-]*):/+", "$1:/")
    docs = stored(docs)
    at = docs.metadataColumn("_metadata")
    placed = docs.select("*", plain(at.getField("file_path")).alias("__file"), at.getField("row_index").alias("__at"))
    files = sorted(docs.inputFiles())
    if not files:
        return docs.withColumn(name, F.lit(None).cast("long"))
    # as an Arrow table: a list of rows would start further Python workers on the executors, beside those of the operators
    bases = pa.table({"__f": pa.array(files, pa.string()), "__base": pa.array([k << 40 for k in range(len(files))], pa.int64())})
    lookup = spark.createDataFrame(bases).withColumn("__f", plain(F.col("__f")))
    if len(files) <= BROADCAST_ROWS:
        lookup = F.broadcast(lookup)
    known = F.coalesce("__base", F.raise_error(F.concat(F.lit("unknown file "), F.col("__file"))))
    return (placed.join(lookup, F.col("__file") == F.col("__f"), "left").withColumn(name, known + F.col("__at"))
            .drop("__file", "__at", "__f", "__base"))


def mix(x: np.ndarray) -> np.ndarray:
    """Final 64-bit mixing, so that any bits of a hash can be used."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse, for one slice of bytes."""
    if not _POWERS:
        for b in (_BASE, _BASE_INVERSE):
            p = np.full(_SLICE + 1, b, dtype=np.uint64)
            p[0] = 1
            _POWERS.append(np.cumprod(p, dtype=np.uint64))
    return _POWERS[0], _POWERS[1]


def _slices(data: bytes) -> Iterator[tuple[int, bytes]]:
    """Pieces of at most one slice, cut at white space where there is any."""
    at = 0
    while len(data) - at > _SLICE:
        cut = max(data.rfind(s, at, at + _SLICE) for s in (b" ", b"\n", b"\t", b"\r", b"\v", b"\f"))
        if cut <= at:  # one word longer than a slice: cut after it
            rest = np.flatnonzero(_SPACE[np.frombuffer(data, dtype=np.uint8, offset=at + _SLICE)])
            cut = at + _SLICE + int(rest[0]) if len(rest) else len(data)
        yield at, data[at:cut]
        at = cut
    yield at, data[at:]


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hash, start and end of every word (a run of bytes that are not ASCII white space)."""
    out = []
    for at, piece in _slices(data):
        b = np.frombuffer(piece, dtype=np.uint8)
        space = _SPACE[b]
        edge = np.flatnonzero(np.diff(space.astype(np.int8), prepend=1, append=1))
        start, end = edge[0::2], edge[1::2]
        if len(b) > _SLICE:
            h = np.zeros(len(start), dtype=np.uint64)
        else:
            p, inverse = powers()
            total = np.zeros(len(b) + 1, dtype=np.uint64)
            np.cumsum(_BYTE[b] * p[:len(b)], out=total[1:])
            h = mix((total[end] - total[start]) * inverse[start])
        for k in np.flatnonzero(end - start > _SLICE // 2):  # one rule for such a word wherever slices begin
            h[k] = int.from_bytes(hashlib.blake2b(piece[start[k]:end[k]], digest_size=8).digest(), "little")
        out.append((h, start + at, end + at))
    if len(out) == 1:
        return out[0]
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """64-bit hashes of all runs of ``n`` consecutive items: sums of item k times base ** (n - 1 - k), then mixed.

    Runs are put together from runs half as long, so a run costs log(n) steps.
    """
    if len(h) < n:
        return np.empty(0, dtype=np.uint64)
    total, m = h, 1
    for bit in bin(n)[3:]:
        total, m = total[:-m] * np.uint64(pow(_BASE, m, 1 << 64)) + total[m:], 2 * m
        if bit == "1":
            total, m = total[:-1] * np.uint64(_BASE) + h[m:], m + 1
    return mix(total)


def distinct(x: np.ndarray) -> np.ndarray:
    """Sorted distinct values: numpy's own ``unique`` puts them into a hash table first, at many times the cost."""
    x = np.sort(x)
    return x[np.append(True, x[1:] != x[:-1])] if len(x) else x


def shingles(h: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct shingle hashes; a shorter sequence is one shingle, an empty one has none."""
    if 0 < len(h) < n:
        return grams(np.concatenate([h, np.array([len(h)], dtype=np.uint64)]), len(h) + 1)
    return distinct(grams(h, n))


def as_long(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def needed(n: int | np.ndarray, percent: int):
    """Smallest number of shared items of a set of n in any pair of that similarity: ceil(percent * n / 100)."""
    return -(-percent * n // 100)


def pack(a: np.ndarray) -> bytes:
    return zlib.compress(np.ascontiguousarray(a).view(np.uint8), 1)


def unpack(b: bytes, dtype) -> np.ndarray:
    return np.frombuffer(zlib.decompress(b), dtype=dtype)


def merged_parts(parts: DataFrame, dtype: str, fan_in: int = 16) -> DataFrame:
    """Sum packed arrays (columns ``slot`` int, ``part`` long, ``blob`` binary) per slot, in rounds of ``fan_in``.

    Every group of a round holds at most ``fan_in`` arrays of fixed length, however many tasks made some. The last
    round, one row a slot, isn't stored.
    """
    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = None
        for b in pdf.sort_values("part")["blob"]:  # one order of adding, however the shuffle brought them
            a = unpack(b, dtype)
            if total is None:
                total = a.copy()
            else:
                total += a
        return pd.DataFrame({"slot": [int(pdf["slot"].iloc[0])], "part": [int(pdf["part"].iloc[0]) // fan_in],
                             "blob": [pack(total)]})

    schema = "slot int, part long, blob binary"
    parts = keep(parts, "parts")
    top = parts.agg(F.max("part")).first()[0] or 0
    while top >= fan_in:
        parts = keep(parts.groupBy("slot", F.expr(f"part div {fan_in}").alias("g")).applyInPandas(add, schema), "parts")
        top //= fan_in
    return parts.groupBy("slot").applyInPandas(add, schema)


def merged_sum(parts: DataFrame, dtype: str, fan_in: int = 16) -> dict[int, np.ndarray]:
    """``merged_parts`` on the driver: one array a slot, whose length is a parameter of the caller."""
    return {r.slot: unpack(r.blob, dtype).copy() for r in merged_parts(parts, dtype, fan_in).collect()}


def part_of(parts: DataFrame, slot: int, dtype: str, size: int) -> np.ndarray:
    """One slot's array of stored ``merged_parts``; ``size`` zeros, if it has none."""
    got = parts.filter(F.col("slot") == slot).select("blob").first()
    return np.zeros(size, dtype=dtype) if got is None else unpack(got[0], dtype)


def text_bytes(text) -> bytes:
    """UTF-8 of a text; a null text is empty."""
    return text.encode("utf-8", "surrogatepass") if isinstance(text, str) else b""
