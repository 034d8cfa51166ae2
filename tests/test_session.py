"""Session rules: the checkpoint folder comes from ``spark.checkpoint.dir``
(set here by the test fixture, as a cluster would), scratch paths live under
it, and the cluster profile never overrides explicit settings."""

from stratus.session import CLUSTER_DEFAULTS, checkpoint_dir, get_session, scratch_path


def test_checkpoint_dir_is_read_from_conf(spark):
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert configured and checkpoint_dir(spark) == configured
    assert scratch_path(spark, "streams", "x").startswith(configured)


def test_cluster_profile_fills_only_unset(spark):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before_parts = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.unset(key)
    s = get_session(profile="cluster")
    assert s.conf.get("spark.sql.shuffle.partitions") == before_parts    # explicit: kept
    assert s.conf.get(key) == CLUSTER_DEFAULTS[key]                       # unset: filled
    assert s.conf.get("spark.sql.session.timeZone") == "UTC"


def test_a_cluster_must_name_its_folder():
    import pytest

    class Context:
        applicationId = "app-without-folder"

        def __init__(self, master):
            self.master = master

        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return "set"

    class Session:
        def __init__(self, master):
            self.sparkContext = Context(master)

    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError):
            checkpoint_dir(Session(master))
    assert checkpoint_dir(Session("local[2]"))
