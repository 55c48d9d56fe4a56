from termflow.session import checkpoint_dir, scratch_path


def test_checkpoint_dir_is_set_and_scratch_paths_are_fresh(spark):
    d = checkpoint_dir(spark)
    assert d and spark.sparkContext.getCheckpointDir()
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(d.rstrip("/"))
