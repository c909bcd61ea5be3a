"""Idempotent writers on plain Parquet table paths (K1-K4, K6, F2).

* ``replace_slices``: the requested slices end up holding exactly the new rows;
  other slices are untouched, and a requested slice without new rows ends up
  empty. Dynamic partition overwrite rewrites the slices that have rows; it
  keeps a slice that has none (S-14), so those directories are removed after
  the write, and only if the write has reported which slices it wrote. Rows
  outside the requested slices stop the job (``raise_error``) instead of silently
  landing in another slice. A killed run can be repeated as it is.
* ``upsert``: keyed merge that never deletes. A table is kept as hash buckets of its
  key (or as partitions); the source is staged once, only the buckets that it touches are
  read, and only their files are replaced. A manifest names the files to take out and to
  put in, so a commit that was cut off is finished by the next access (``recover``).
* ``overwrite``: the new table is staged beside the old one and swapped in by two renames
  with fixed names; a swap that was cut off is undone or tidied up by the next access.
* ``clustered``: range-partitioned, sorted files: each file covers a narrow key range, so
  min/max statistics prune on that key. ``publish_jdbc`` exports.

A table has one writer at a time. Readers go through ``read_table``, which recovers first.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable, Mapping, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.operators.facts import dedupe
from strata.session import scratch_path
from strata.storage import (entries, hadoop_path, make_dirs, path_exists, remove_path, rename_path, stored_bytes,
                            write_text)


def _beside(path: str) -> tuple[str, str, str]:
    """Where a writer stages new data, keeps what it takes out, and puts a commit's manifest."""
    base = path.rstrip("/")
    return f"{base}.__staged", f"{base}.__old", f"{base}.__commit"


def _move(spark: SparkSession, src: str, dst: str) -> None:
    """Rename unless it is done already."""
    if path_exists(spark, src):
        rename_path(spark, src, dst)


def _commit(spark: SparkSession, path: str, adds: Mapping[str, str], removes: Iterable[str]) -> None:
    """Replace entries of the table at ``path``: ``removes`` go, ``adds`` (place in the staged folder -> name) come.

    The manifest appears by a rename when everything is staged. From then on the commit is finished by
    ``recover`` wherever it stops; before that, the table is as it was.
    """
    _, _, manifest = _beside(path)
    write_text(spark, f"{manifest}.part", json.dumps({"adds": dict(adds), "removes": sorted(removes)}))
    rename_path(spark, f"{manifest}.part", manifest)
    recover(spark, path)


def _finish_commit(spark: SparkSession, path: str) -> None:
    """Carry out a manifest. Every step may have been done before; nothing is taken out twice."""
    staged, old, manifest = _beside(path)
    todo = json.loads(spark.read.text(manifest, wholetext=True).first()[0])
    make_dirs(spark, path)
    make_dirs(spark, old)
    gone = entries(spark, old)
    for name in todo["removes"]:
        if name not in gone:  # what has that name now may be the new entry
            _move(spark, f"{path}/{name}", f"{old}/{name}")
    for place, name in todo["adds"].items():
        _move(spark, f"{staged}/{place}", f"{path}/{name}")
    remove_path(spark, manifest)  # the commit is done; what follows is tidying
    remove_path(spark, old)
    remove_path(spark, staged)


def recover(spark: SparkSession, path: str) -> None:
    """Finish a commit, or finish or undo a swap, that was cut off."""
    path = path.rstrip("/")
    _, old, manifest = _beside(path)
    if path_exists(spark, manifest):
        _finish_commit(spark, path)
    elif path_exists(spark, old):
        if path_exists(spark, path):
            remove_path(spark, old)
        else:
            rename_path(spark, old, path)


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """The table at ``path``, after finishing or undoing a write that was cut off."""
    recover(spark, path)
    return (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)


def table_exists(spark: SparkSession, path: str) -> bool:
    """True if the folder holds data (files or partitions), whether or not a success marker is there."""
    recover(spark, path)
    fs, p = hadoop_path(spark, path)
    if not fs.exists(p):
        return False
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return "_SUCCESS" in names or any(not n.startswith(("_", ".")) for n in names)


def _slice_dir(path: str, col: str, value: str) -> str:
    if any(ch in str(value) for ch in "/=%\\:"):
        raise ValueError(f"unsupported slice value {value!r}")
    return f"{path.rstrip('/')}/{col}={value}"


def guard_slices(df: DataFrame, col: str, slices: Sequence[str]) -> DataFrame:
    """Fail the job on a row whose slice is not requested."""
    c = F.col(col)
    msg = F.concat(F.lit(f"row outside requested slices of {col}: "), F.coalesce(c.cast("string"), F.lit("NULL")))
    return df.withColumn(col, F.when(c.isin(*slices), c).otherwise(F.raise_error(msg)))


def replace_slices(df: DataFrame, path: str, col: str, slices: Sequence[str],
                   observe: Observation | None = None, extra_metrics: Sequence = (),
                   rebalance: bool = True) -> dict[str, int]:
    """Replace exactly ``slices`` of the table at ``path`` partitioned by ``col`` (K1, K2).

    Returns the number of rows now stored per requested slice: one aggregation by
    the partition column, which Parquet footers answer. ``extra_metrics`` are
    aggregate Columns observed on the write. With ``rebalance`` the rows are
    redistributed on the slice column first (AQE splits a large slice and merges
    small ones to the advisory size), so a slice is written as a few right-sized
    files instead of one file per task. A frame that is already laid out (e.g.
    ``clustered``) passes ``rebalance=False``.
    """
    spark = df.sparkSession
    slices = list(dict.fromkeys(slices))
    obs = observe or Observation(f"slices_{uuid.uuid4().hex[:8]}")
    out = guard_slices(df, col, slices)
    if rebalance:
        out = out.hint("rebalance", col)
    # Observed right before the writer, above any exchange: when a stage's output is
    # empty, AQE may replace the plan below the exchange and its metrics with it.
    # The set of slices is bounded by the requested ones.
    out = out.observe(obs, F.collect_set(F.col(col).cast("string")).alias("slices_written"), *extra_metrics)
    recover(spark, path)
    out.write.partitionBy(col).option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)
    got = obs.get
    if "slices_written" not in got:
        raise RuntimeError(f"the write to {path} reported no slices; none is removed")
    full = set(got["slices_written"] or ())
    for s in slices:
        if s not in full:
            remove_path(spark, _slice_dir(path, col, s))
    if not full:
        return {s: 0 for s in slices}
    stored = spark.read.schema(df.schema).option("basePath", path).parquet(path).filter(F.col(col).isin(*full))
    rows = {r[0]: r[1] for r in stored.groupBy(F.col(col).cast("string")).count().collect()}
    return {s: int(rows.get(s, 0)) for s in slices}


def replace_tagged(df: DataFrame, tag: str, col: str, slices: Sequence[str],
                   targets: Mapping[object, tuple[str, str, str]]) -> dict[object, dict[str, int]]:
    """Replace ``slices`` of several tables from one frame, evaluated and written once (K1, K2).

    ``targets`` maps a value of ``tag`` to a table: its path, its partition column, and a prefix of its partitions'
    names before the slice. The frame is staged by tag and slice; each table's slices are then swapped in by a commit
    that can be finished after a stop (``recover``), so a table never shows half of one. A requested slice without rows
    ends up empty. Files of all tables have the frame's columns; read them with a table's own schema.
    Returns the rows now stored, by tag and slice.
    """
    spark = df.sparkSession
    slices = list(dict.fromkeys(slices))
    base = next(iter(targets.values()))[0].rstrip("/")
    tagged = f"{base}.__tagged"
    remove_path(spark, tagged)
    guard_slices(df, col, slices).hint("rebalance", tag, col).write.partitionBy(tag, col).parquet(tagged)
    out = {}
    for value, (path, part_col, prefix) in targets.items():
        path = path.rstrip("/")
        recover(spark, path)
        staged, *_ = _beside(path)
        remove_path(spark, staged)
        make_dirs(spark, staged)
        found = f"{tagged}/{tag}={str(value).lower() if isinstance(value, bool) else value}"
        names = {s: _slice_dir("", part_col, f"{prefix}{s}").lstrip("/") for s in slices}
        adds = {}
        for s in slices:
            if path_exists(spark, f"{found}/{col}={s}"):
                rename_path(spark, f"{found}/{col}={s}", f"{staged}/{col}={s}")
                adds[f"{col}={s}"] = names[s]
        _commit(spark, path, adds, set(names.values()) & set(entries(spark, path)))
        out[value] = {s: 0 for s in slices}
        if adds:
            full = {f"{prefix}{s}": s for s in slices if f"{col}={s}" in adds}
            stored = spark.read.option("basePath", path).parquet(*[f"{path}/{n}" for n in adds.values()])
            for name, n in stored.groupBy(F.col(part_col).cast("string")).count().collect():
                out[value][full[name]] = int(n)
    remove_path(spark, tagged)
    return out


def _whole_rows(src: DataFrame, target: DataFrame, path: str) -> DataFrame:
    """The source in the target's columns and types; a merge must not blank or invent columns."""
    missing, extra = set(target.columns) - set(src.columns), set(src.columns) - set(target.columns)
    if missing or extra:
        raise ValueError(f"upsert into {path}: missing columns {sorted(missing)}, unknown columns {sorted(extra)}")
    return src.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in target.schema.fields])


_BUCKET_FILE = re.compile(r"b(\d+)-of-(\d+)-.*\.parquet")
#: A table is dealt into more buckets when they hold this many times the advisory size on average.
_CROWDED = 4


def bucket_count(names: Iterable[str]) -> int | None:
    """Number of buckets that a table's file names tell, or None for a table that is not in buckets."""
    found = [_BUCKET_FILE.fullmatch(n) for n in names]
    counts = {int(m[2]) for m in found if m}
    return counts.pop() if found and all(found) and len(counts) == 1 else None


def bucket_of(keys: Sequence[str], buckets: int):
    return F.pmod(F.hash(*keys), F.lit(buckets))


def _staged_files(spark: SparkSession, staged: str) -> list[tuple[int, str]]:
    """(bucket, place under the staged folder) of every file, from one recursive listing."""
    fs, p = hadoop_path(spark, staged)
    found, files = [], fs.listFiles(p, True)
    while files.hasNext():
        f = files.next().getPath()
        if f.getName().endswith(".parquet"):
            folder = f.getParent().getName()
            found.append((int(folder.removeprefix("_bucket=")), f"{folder}/{f.getName()}"))
    return sorted(found)


def _merged(target: DataFrame | None, src: DataFrame, keys: Sequence[str]) -> DataFrame:
    if target is None:
        return src
    return target.join(src.select(*keys), list(keys), "left_anti").select(*src.columns).unionByName(src)


def upsert(df: DataFrame, path: str, keys: Sequence[str], partition_col: str | None = None,
           buckets: int | None = None) -> dict[str, int]:
    """Keyed upsert (K3): matched keys take the source row, new keys are inserted, nothing is deleted.

    The source must have exactly the target's columns; its values take the target's types. It is de-duplicated
    and staged once. The table's files are hash buckets of the key, named ``b<bucket>-of-<count>-...``: only those that
    the source touches are read, merged and replaced, the others keep their files. ``buckets`` is the count for a
    new table (by default one for each advisory size of the source); a table whose buckets have grown to
    ``_CROWDED`` times that size, or that isn't in buckets yet, is dealt anew in the same commit. With
    ``partition_col`` (which the key must determine, e.g. a date's month; never NULL) the parts are the
    partitions instead. Either way a commit that is cut off leaves the old table or is finished later.
    Returns the number of parts ``touched`` and ``kept``.
    """
    spark = df.sparkSession
    path = path.rstrip("/")
    exists = table_exists(spark, path)
    names = entries(spark, path) if exists else {}
    table = spark.read.parquet(path) if exists else None
    source = dedupe(_whole_rows(df, table, path) if exists else df, keys)
    staged_source = scratch_path(spark, "upsert_source")
    source.write.parquet(staged_source)
    src = spark.read.schema(source.schema).parquet(staged_source)
    staged, *_ = _beside(path)
    remove_path(spark, staged)
    try:
        if partition_col is not None:
            values = {r[0] for r in src.select(partition_col).distinct().collect()}  # at most one a partition
            if None in values:
                raise ValueError(f"upsert into {path}: NULL in the partition column {partition_col}")
            if values or not exists:
                old = table.filter(F.col(partition_col).isin(*values)) if exists else None
                _merged(old, src, keys).hint("rebalance", partition_col).write.partitionBy(partition_col).parquet(staged)
            parts = entries(spark, staged)
            _commit(spark, path, {n: n for n in parts}, set(parts) & set(names))
            if not parts and not exists:
                src.write.mode("overwrite").partitionBy(partition_col).parquet(path)
            return {"touched": len(parts), "kept": len(set(names) - set(parts))}
        n, stored = bucket_count(names), sum(names.values())
        advisory = advisory_bytes(spark)
        deal = n is None or stored > _CROWDED * n * advisory
        if deal:
            n = buckets or max(1, -(-2 * (stored + sum(entries(spark, staged_source).values())) // advisory))
        touched = set(range(n)) if deal else {r[0] for r in src.select(bucket_of(keys, n)).distinct().collect()}
        held = {name: int(m[1]) for name in names if (m := _BUCKET_FILE.fullmatch(name))}
        removes = {name for name in names if deal or held[name] in touched}
        files = [f"{path}/{name}" for name in sorted(removes)]
        old = table if deal else spark.read.schema(table.schema).parquet(*files) if files else None
        (_merged(old, src, keys).withColumn("_bucket", bucket_of(keys, n)).hint("rebalance", "_bucket")
         .write.partitionBy("_bucket").parquet(staged))
        files = _staged_files(spark, staged)
        tag = uuid.uuid4().hex[:12]
        adds = {place: f"b{k:05d}-of-{n:05d}-{tag}-{i:05d}.parquet" for i, (k, place) in enumerate(files)}
        if adds:
            _commit(spark, path, adds, removes)
        elif not exists:
            src.write.mode("overwrite").parquet(path)  # an empty table still has its columns
        else:
            remove_path(spark, staged)
        return {"touched": len({k for k, _ in files}), "kept": len(set(held.values()) - touched)}
    finally:
        remove_path(spark, staged_source)


def input_bytes(df: DataFrame) -> int:
    """Stored size of the files of the tables that ``df`` reads, from one listing of each folder.

    It counts whole tables: Spark names the files before partitions are pruned. Who knows the slices that are
    read takes ``slice_bytes``.
    """
    spark = df.sparkSession
    by_folder: dict[str, set[str]] = {}
    for f in df.inputFiles():
        folder, _, name = f.rpartition("/")
        by_folder.setdefault(folder, set()).add(unquote(name))
    return sum(size for folder, names in by_folder.items()
               for name, size in entries(spark, unquote(folder)).items() if name in names)


def slice_bytes(spark: SparkSession, path: str, col: str, slices: Sequence[str]) -> int:
    """Stored size of the given slices only: one summary a slice folder."""
    return sum(stored_bytes(spark, _slice_dir(path, col, s)) for s in dict.fromkeys(slices))


def advisory_bytes(spark: SparkSession) -> int:
    return int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(
        spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64m")))


def overwrite(df: DataFrame, path: str) -> None:
    """Full replacement with the frame's schema (K4).

    The new table is written beside the old one and swapped in by two renames. A job that stops leaves the old or the
    new table, never none: until the first rename the old one is in place, between the two ``recover`` brings it back, and
    after the second the new one is there. ``df`` may read ``path``.
    """
    spark = df.sparkSession
    path = path.rstrip("/")
    recover(spark, path)
    staged, old, _ = _beside(path)
    remove_path(spark, staged)
    df.write.parquet(staged)
    if path_exists(spark, path):
        rename_path(spark, path, old)
    rename_path(spark, staged, path)
    remove_path(spark, old)


def clustered(df: DataFrame, keys: str | Sequence[str], partitions: int | None = None,
              tiebreak: str | None = None, size: int | None = None) -> DataFrame:
    """Range-partition on ``keys`` and sort within files (F2).

    With the slice column first, each task covers a contiguous run of
    (slice, key), so a partitioned write yields about one file per task, each
    with a narrow key range. A range partitioner cannot split one key value, so
    a hot value (one zone with a third of a month's trips) would land in a single
    task; ``tiebreak`` (a high-cardinality column such as the row id) extends the
    range key so such a value is cut across several tasks and files. The number of
    partitions follows the bytes read (``size``, by default all of the input tables) and the
    advisory partition size.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    spark = df.sparkSession
    size = input_bytes(df) if partitions is None and size is None else size
    n = partitions or max(-(-size // advisory_bytes(spark)), spark.sparkContext.defaultParallelism)
    range_keys = keys + ([tiebreak] if tiebreak else [])
    return df.repartitionByRange(n, *[F.col(k) for k in range_keys]).sortWithinPartitions(*keys)


def publish_jdbc(frames: Mapping[str, DataFrame | None], url: str, options: Mapping[str, str] | None = None,
                 table_prefix: str = "gold_") -> dict[str, int]:
    """Publish each frame to ``<prefix><name>``, keeping the target table (truncate + insert) (K6).

    A missing frame is skipped and reported as 0; row counts come from an
    Observation on the write.
    """
    out = {}
    for name, df in frames.items():
        if df is None:
            out[f"{name}_exported"] = 0
            continue
        obs = Observation(f"jdbc_{name}")
        w = (df.observe(obs, F.count(F.lit(1)).alias("rows")).write.format("jdbc")
             .option("url", url).option("dbtable", f"{table_prefix}{name}").option("truncate", "true"))
        for k, v in (options or {}).items():
            w = w.option(k, v)
        w.mode("overwrite").save()
        out[f"{name}_exported"] = int(obs.get.get("rows", 0))
    return out
