import pytest

from tollgate import session


class _Conf:
    def __init__(self, value):
        self.value = value

    def get(self, key, default=None):
        return self.value if key == "spark.checkpoint.dir" else default

    def set(self, key, value):  # a running session refuses this for core configs
        raise AssertionError("must not set spark.checkpoint.dir on a running session")


class _SC:
    applicationId = "app-test"
    master = "local[2]"

    def __init__(self):
        self.dir = None

    def getCheckpointDir(self):
        return self.dir

    def setCheckpointDir(self, d):
        self.dir = d


class _Spark:
    def __init__(self, value):
        self.conf = _Conf(value)
        self.sparkContext = _SC()


def test_uses_cluster_folder_when_named():
    s = _Spark("hdfs://shared/ckpt")
    assert session.ensure_checkpoint_dir(s) == "hdfs://shared/ckpt"
    assert s.sparkContext.dir == "hdfs://shared/ckpt"


def test_picks_own_folder_only_when_unset():
    s = _Spark(None)
    d = session.ensure_checkpoint_dir(s)
    assert d.startswith("/tmp/tollgate-ckpt-") and s.sparkContext.dir == d
    assert session.ensure_checkpoint_dir(s) == d
    assert session.shared_path(s, "a", "b") == d.rstrip("/") + "/a/b"


def test_refuses_a_local_folder_on_a_cluster():
    s = _Spark(None)
    s.sparkContext.master = "spark://host:7077"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(s)
