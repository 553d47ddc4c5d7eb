import pytest

from staykit.session import checkpoint_root, cluster_conf, scratch_path


def test_checkpoint_root_reuses_the_configured_dir(spark):
    configured = spark.sparkContext.getCheckpointDir()
    assert configured  # conftest (or the cluster) set one
    assert checkpoint_root(spark) == configured.rstrip("/")
    # asking again does not move it
    assert checkpoint_root(spark) == configured.rstrip("/")


def test_scratch_paths_are_fresh_and_under_the_root(spark):
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    root = checkpoint_root(spark)
    assert a != b and a.startswith(root + "/") and b.startswith(root + "/")


def test_cluster_conf_scales_with_cores():
    small, big = cluster_conf(64), cluster_conf(8000)
    assert small["spark.sql.adaptive.enabled"] == "true"
    assert small["spark.sql.adaptive.skewJoin.enabled"] == "true"
    assert int(big["spark.sql.shuffle.partitions"]) > int(small["spark.sql.shuffle.partitions"])


def test_a_cluster_without_a_shared_folder_is_refused():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(Session())
