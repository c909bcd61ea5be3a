from strata.session import scratch_path, shared_dir


def test_scratch_lives_under_the_shared_checkpoint_dir(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark) == base.rstrip("/")
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a.startswith(base.rstrip("/") + "/strata-scratch/x-") and a != b
