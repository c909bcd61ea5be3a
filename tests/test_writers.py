import pytest
from pyspark.sql import functions as F

from strata.sinks import writers as W


def _slices(spark, data):
    return spark.createDataFrame(data, "id int, v string, source_year_month string")


def test_replace_slices_idempotent_and_clears_empty(spark, tmp):
    p = f"{tmp}/t"
    first = _slices(spark, [(1, "a", "2025-01"), (2, "b", "2025-01"), (3, "c", "2025-02"), (4, "d", "2025-03")])
    assert W.replace_slices(first, p, "source_year_month", ["2025-01", "2025-02", "2025-03"]) == \
        {"2025-01": 2, "2025-02": 1, "2025-03": 1}
    W.replace_slices(first, p, "source_year_month", ["2025-01", "2025-02", "2025-03"])   # re-run: same table
    assert spark.read.parquet(p).count() == 4
    again = _slices(spark, [(5, "e", "2025-01")])
    W.replace_slices(again, p, "source_year_month", ["2025-01", "2025-02"])
    got = sorted((r.id, r.source_year_month) for r in spark.read.parquet(p).collect())
    assert got == [(4, "2025-03"), (5, "2025-01")]


def test_replace_slices_refuses_rows_outside_request(spark, tmp):
    df = _slices(spark, [(1, "a", "2025-01"), (2, "b", "2025-09")])
    with pytest.raises(Exception, match="outside requested slices"):
        W.replace_slices(df, f"{tmp}/t", "source_year_month", ["2025-01"])


def test_upsert_updates_inserts_keeps(spark, tmp):
    p = f"{tmp}/u"
    W.upsert(spark.createDataFrame([(1, "old"), (2, "keep")], "k int, v string"), p, ["k"])
    W.upsert(spark.createDataFrame([(1, "new"), (3, "ins"), (3, "ins")], "k int, v string"), p, ["k"])
    assert sorted(tuple(r) for r in spark.read.parquet(p).collect()) == [(1, "new"), (2, "keep"), (3, "ins")]
    W.upsert(spark.createDataFrame([(1, "new"), (3, "ins")], "k int, v string"), p, ["k"])   # idempotent
    assert spark.read.parquet(p).count() == 3


def test_clustered_files_have_disjoint_key_ranges(spark, tmp):
    df = spark.range(0, 4000).select((F.col("id") % 200).cast("int").alias("zone"), F.col("id"))
    W.clustered(df, "zone", 4).write.parquet(f"{tmp}/c")
    t = spark.read.parquet(f"{tmp}/c").withColumn("f", F.input_file_name())
    ranges = sorted((r[1], r[2]) for r in t.groupBy("f").agg(F.min("zone"), F.max("zone")).collect())
    assert len(ranges) == 4
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))


def test_publish_jdbc_skips_missing(spark):
    assert W.publish_jdbc({"trips_daily": None}, "jdbc:none") == {"trips_daily_exported": 0}


def test_ensure_creates_typed_empty_tables_once(spark, tmp):
    from strata.sinks import tables as T
    made = T.ensure_all(spark, f"{tmp}/lake")
    assert "bronze.yellow_trips" in made and "bronze.quarantine" in made
    assert T.ensure_all(spark, f"{tmp}/lake") == []
    t = T.read(spark, f"{tmp}/lake", "bronze", "yellow_trips")
    assert t.count() == 0 and "source_year_month" in t.columns and "pickup_datetime" in t.columns


def test_clustered_splits_a_hot_key(spark, tmp):
    hot = spark.range(0, 3000).select(F.lit(7).alias("zone"), F.col("id").cast("string").alias("rid"))
    rest = spark.range(0, 6000).select((F.col("id") % 50).cast("int").alias("zone"), F.col("id").cast("string").alias("rid"))
    W.clustered(hot.unionByName(rest), "zone", 6, tiebreak="rid").write.parquet(f"{tmp}/h")
    t = spark.read.parquet(f"{tmp}/h").withColumn("f", F.input_file_name())
    files_with_hot = t.filter("zone = 7").select("f").distinct().count()
    assert files_with_hot >= 2


def test_partitioned_upsert_rewrites_only_touched_partitions(spark, tmp):
    import os
    p = f"{tmp}/pu"
    first = spark.createDataFrame([(1, "a", "2025-01"), (2, "b", "2025-02")], "k int, v string, m string")
    W.upsert(first, p, ["k"], partition_col="m")
    untouched = sorted(os.listdir(f"{p}/m=2025-02"))
    W.upsert(spark.createDataFrame([(1, "A", "2025-01"), (3, "c", "2025-01")], "k int, v string, m string"),
             p, ["k"], partition_col="m")
    got = sorted((r.k, r.v, r.m) for r in spark.read.parquet(p).collect())
    assert got == [(1, "A", "2025-01"), (2, "b", "2025-02"), (3, "c", "2025-01")]
    assert sorted(os.listdir(f"{p}/m=2025-02")) == untouched


def test_upsert_null_keys_never_match(spark, tmp):
    p = f"{tmp}/n"
    df = spark.createDataFrame([(None, "x"), (1, "y")], "k int, v string")
    W.upsert(df, p, ["k"])
    W.upsert(df, p, ["k"])
    got = sorted((r.k is None, r.v) for r in spark.read.parquet(p).collect())
    assert got == [(False, "y"), (True, "x"), (True, "x")]       # S-16: the NULL-key row is inserted again


@pytest.mark.parametrize("stop_at", [1, 2])
def test_upsert_survives_a_stop_at_either_rename(spark, tmp, monkeypatch, stop_at):
    p = f"{tmp}/crash"
    W.upsert(spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string"), p, ["k"])
    batch = spark.createDataFrame([(1, "new"), (4, "ins")], "k int, v string")
    real, calls = W.rename_path, []

    def stops(s, src, dst):
        calls.append(src)
        if len(calls) == stop_at:
            raise KeyboardInterrupt
        real(s, src, dst)

    monkeypatch.setattr(W, "rename_path", stops)
    with pytest.raises(KeyboardInterrupt):
        W.upsert(batch, p, ["k"])
    monkeypatch.setattr(W, "rename_path", real)
    W.upsert(batch, p, ["k"])
    assert sorted(tuple(r) for r in spark.read.parquet(p).collect()) == [(1, "new"), (2, "b"), (3, "c"), (4, "ins")]


def test_upsert_refuses_other_columns(spark, tmp):
    p = f"{tmp}/cols"
    W.upsert(spark.createDataFrame([(1, "a", 2.0)], "k int, v string, w double"), p, ["k"])
    for bad in ("k int, v string", "k int, v string, w double, x int"):
        row = (1, "b", 3.0, 4)[:len(bad.split(","))]
        with pytest.raises(ValueError, match="columns"):
            W.upsert(spark.createDataFrame([row], bad), p, ["k"])
    assert spark.read.parquet(p).first().w == 2.0


def test_first_load_can_be_repeated_after_a_kill(spark, tmp):
    import os
    p = f"{tmp}/killed"
    os.makedirs(f"{p}/_temporary/0")
    assert not W.table_exists(spark, p)
    assert W.replace_slices(_slices(spark, [(1, "a", "2025-01")]), p, "source_year_month", ["2025-01"]) == {"2025-01": 1}
    os.remove(f"{p}/_SUCCESS") if os.path.exists(f"{p}/_SUCCESS") else None
    assert W.table_exists(spark, p)
    assert W.replace_slices(_slices(spark, [(2, "b", "2025-01")]), p, "source_year_month", ["2025-01"]) == {"2025-01": 1}


def test_clustered_partitions_follow_the_input(spark, tmp):
    spark.range(0, 200_000).select(F.col("id"), F.sha2(F.col("id").cast("string"), 256).alias("h")).write.parquet(f"{tmp}/big")
    df = spark.read.parquet(f"{tmp}/big")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        n = W.clustered(df, "id").rdd.getNumPartitions()
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128m")
    assert n >= W.input_bytes(df) // (256 * 1024) > 8
