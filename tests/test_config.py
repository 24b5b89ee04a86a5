from paylake.config import checkpoint_root, scratch_dir


def test_scratch_lives_under_session_checkpoint_dir(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert checkpoint_root(spark) == root
    a, b = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert a.startswith(root.rstrip("/") + "/paylake/") and a != b
