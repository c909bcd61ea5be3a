"""Writers that stop at every step, and what readers find then."""

import shutil

import pytest
from pyspark.sql import functions as F

from strata import storage
from strata.sinks import writers as W

STEPS = ("rename_path", "remove_path", "write_text", "make_dirs")


class Stop(BaseException):
    pass


def stop_at(monkeypatch, n):
    """The n-th change of files raises instead of happening; returns the list of steps taken."""
    taken = []

    def wrap(name):
        real = getattr(storage, name)

        def step(spark, *args):
            taken.append(name)
            if len(taken) == n:
                raise Stop
            return real(spark, *args)
        return step

    for name in STEPS:
        monkeypatch.setattr(W, name, wrap(name))
    return taken


def rows(spark, path):
    return sorted(tuple(r) for r in W.read_table(spark, path).collect())


def test_overwrite_stopped_anywhere_leaves_the_old_or_the_new_table(spark, tmp):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(7,), (8,), (9,)], "n long")
    before, after = [(1, "a"), (2, "b")], [(7,), (8,), (9,)]
    seen = set()
    for n in range(1, 12):
        p = f"{tmp}/o{n}"
        W.overwrite(old, p)
        with pytest.MonkeyPatch.context() as m:
            taken = stop_at(m, n)
            try:
                W.overwrite(new, p)
            except Stop:
                pass
        got = rows(spark, p)
        assert got in (before, after), n
        seen.add(tuple(got))
        W.overwrite(new, p)
        assert rows(spark, p) == after
        assert not any(x for x in storage.entries(spark, tmp) if x.startswith(f"o{n}.__"))
        if len(taken) < n:
            break
    assert len(seen) == 2 and len(taken) < n  # every step was tried


@pytest.mark.parametrize("partition_col", [None, "m"])
def test_upsert_stopped_anywhere_loses_nothing(spark, tmp, partition_col):
    schema = "k int, v string, m string"
    first = spark.createDataFrame([(k, "old", f"m{k % 3}") for k in range(12)], schema)
    batch = spark.createDataFrame([(k, "new", f"m{k % 3}") for k in (0, 3, 12)], schema)
    before = sorted((k, "old", f"m{k % 3}") for k in range(12))
    after = sorted([r for r in before if r[0] not in (0, 3)] + [(k, "new", "m0") for k in (0, 3, 12)])
    W.upsert(first, f"{tmp}/u", ["k"], partition_col, buckets=4)
    n, finished = 0, False
    while not finished:
        n += 1
        p = shutil.copytree(f"{tmp}/u", f"{tmp}/u{n}")
        with pytest.MonkeyPatch.context() as m:
            taken = stop_at(m, n)
            try:
                W.upsert(batch, p, ["k"], partition_col)
            except Stop:
                pass
        finished = len(taken) < n
        got = sorted(tuple(r) for r in W.read_table(spark, p).select("k", "v", "m").collect())
        assert got in (before, after), n
        W.upsert(batch, p, ["k"], partition_col)
        assert sorted(tuple(r) for r in W.read_table(spark, p).select("k", "v", "m").collect()) == after
    assert n > 6


def files_of(path):
    import os
    return {n: os.stat(f"{path}/{n}").st_mtime_ns for n in os.listdir(path) if not n.startswith((".", "_"))}


def test_upsert_rewrites_only_the_buckets_that_it_touches(spark, tmp):
    p = f"{tmp}/b"
    df = spark.range(400).select(F.col("id").alias("k"), F.lit("old").alias("v"))
    assert W.upsert(df, p, ["k"], buckets=8) == {"touched": 8, "kept": 0}
    before = files_of(p)
    assert W.bucket_count(before) == 8
    change = df.filter("k = 7").withColumn("v", F.lit("new"))
    assert W.upsert(change, p, ["k"]) == {"touched": 1, "kept": 7}
    after = files_of(p)
    kept = {n: t for n, t in before.items() if n in after and after[n] == t}
    assert len({n[:6] for n in kept}) == 7 and W.bucket_count(after) == 8
    got = {r.k: r.v for r in spark.read.parquet(p).collect()}
    assert len(got) == 400 and got[7] == "new" and got[8] == "old"
    # every row lies in the bucket that its key says
    where = spark.read.parquet(p).select(W.bucket_of(["k"], 8).alias("b"), F.regexp_extract("_metadata.file_name", r"b(\d+)-", 1).cast("int").alias("f"))
    assert where.filter("b != f").count() == 0


def test_upsert_deals_a_grown_table_and_a_plain_one_anew(spark, tmp):
    p = f"{tmp}/g"
    wide = spark.range(3000).select(F.col("id").cast("int").alias("k"), F.sha2(F.col("id").cast("string"), 512).alias("v"))
    wide.filter("k < 10").write.parquet(p)  # not written by upsert
    assert W.bucket_count(files_of(p)) is None
    W.upsert(wide.filter("k between 5 and 20"), p, ["k"])
    assert W.bucket_count(files_of(p)) == 1 and spark.read.parquet(p).count() == 21
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16k")
    try:
        W.upsert(wide, p, ["k"])
        W.upsert(wide.filter("k = 1"), p, ["k"])
        n = W.bucket_count(files_of(p))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128m")
    assert n > 8
    assert sorted(tuple(r) for r in spark.read.parquet(p).collect()) == sorted(tuple(r) for r in wide.collect())


def test_upsert_takes_the_target_types_and_empty_sources(spark, tmp):
    p = f"{tmp}/t"
    W.upsert(spark.createDataFrame([], "k long, v double"), p, ["k"])
    assert spark.read.parquet(p).count() == 0
    W.upsert(spark.createDataFrame([(k, 1.0) for k in range(50)], "k long, v double"), p, ["k"], buckets=5)
    W.upsert(spark.createDataFrame([(3, 2), (50, 2)], "k int, v int"), p, ["k"])  # ints hash unlike longs
    got = {r.k: r.v for r in spark.read.parquet(p).collect()}
    assert spark.read.parquet(p).dtypes == [("k", "bigint"), ("v", "double")]
    assert len(got) == 51 == spark.read.parquet(p).count() and got[3] == got[50] == 2.0
    assert W.upsert(spark.createDataFrame([], "k long, v double"), p, ["k"])["touched"] == 0
    assert spark.read.parquet(p).count() == 51


def test_upsert_may_read_its_own_table(spark, tmp):
    p = f"{tmp}/self"
    W.upsert(spark.range(20).withColumn("v", F.lit(0)), p, ["id"], buckets=3)
    W.upsert(W.read_table(spark, p).withColumn("v", F.col("v") + 1), p, ["id"])
    W.overwrite(W.read_table(spark, p).withColumn("v", F.col("v") + 1), p)
    assert {r.v for r in spark.read.parquet(p).collect()} == {2}


def test_clustered_files_let_a_filter_skip_the_others(spark, tmp):
    """The layout's point: a filter on one key value needs only the files whose range holds it."""
    df = spark.range(40_000).select((F.col("id") % 100).cast("int").alias("zone"), F.col("id").alias("rid"))
    W.clustered(df, "zone", 10, tiebreak="rid").write.parquet(f"{tmp}/c")
    t = spark.read.parquet(f"{tmp}/c").withColumn("f", F.col("_metadata.file_name"))
    ranges = t.groupBy("f").agg(F.min("zone").alias("a"), F.max("zone").alias("z")).collect()
    for zone in (0, 37, 99):
        needed = {r.f for r in ranges if r.a <= zone <= r.z}
        assert len(needed) <= 2 < len(ranges)
        assert {r.f for r in t.filter(F.col("zone") == zone).select("f").distinct().collect()} == needed


def test_layout_size_counts_the_slices_that_are_read(spark, tmp):
    p = f"{tmp}/s"
    df = spark.range(10_000).select("id", F.concat(F.lit("2025-0"), (F.col("id") % 5 + 1).cast("string")).alias("m"))
    df.repartition(4).write.partitionBy("m").parquet(p)
    whole = W.input_bytes(spark.read.parquet(p))
    one = W.slice_bytes(spark, p, "m", ["2025-01"])
    assert 0 < one < whole / 4 and W.slice_bytes(spark, p, "m", ["2030-01"]) == 0
    assert abs(W.slice_bytes(spark, p, "m", [f"2025-0{k}" for k in range(1, 6)]) - whole) < whole * 0.1


def test_tagged_write_stopped_anywhere_leaves_whole_slices(spark, tmp):
    """Two tables from one write: each has its old or its new slices, and a repetition ends right."""
    schema = "k int, good boolean, m string"
    one = spark.createDataFrame([(k, k % 3 > 0, f"m{k % 2}") for k in range(12)], schema)
    two = spark.createDataFrame([(k + 100, k % 4 > 0, "m0") for k in range(8)], schema)  # m1 empties

    def write(df, p):
        return W.replace_tagged(df, "good", "m", ["m0", "m1"], {False: (f"{p}/bad", "entity", "e_"), True: (f"{p}/fine", "m", "")})

    def state(p):
        return tuple(tuple(sorted((r.k, r[c]) for r in W.read_table(spark, f"{p}/{t}", f"k int, {c} string").collect()))
                     for t, c in (("bad", "entity"), ("fine", "m")))

    assert write(one, f"{tmp}/a") == {False: {"m0": 2, "m1": 2}, True: {"m0": 4, "m1": 4}}
    before = state(f"{tmp}/a")
    shutil.copytree(f"{tmp}/a", f"{tmp}/b")
    assert write(two, f"{tmp}/b") == {False: {"m0": 2, "m1": 0}, True: {"m0": 6, "m1": 0}}
    after = state(f"{tmp}/b")
    assert after[0] == ((100, "e_m0"), (104, "e_m0")) and before[0][0] == (0, "e_m0")
    n, finished = 0, False
    while not finished:
        n += 1
        p = shutil.copytree(f"{tmp}/a", f"{tmp}/t{n}")
        with pytest.MonkeyPatch.context() as m:
            taken = stop_at(m, n)
            try:
                write(two, p)
            except Stop:
                pass
        finished = len(taken) < n
        got = state(p)
        assert got[0] in (before[0], after[0]) and got[1] in (before[1], after[1]), n
        write(two, p)
        assert state(p) == after, n
    assert n > 12
