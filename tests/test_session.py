"""The shared work folder comes from the session; a folder of our own only when unset."""

from rivulet.session import ensure_work_dir, work_path


def test_work_dir_follows_session_setting(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert ensure_work_dir(spark) == root.rstrip("/")
    a, b = work_path(spark, "x"), work_path(spark, "x")
    assert a != b and a.startswith(root.rstrip("/") + "/rivulet/")


class _NoCheckpointConf:
    def get(self, key, default=None):
        return default


class _SessionWithoutSetting:
    """A session view whose configuration names no checkpoint folder."""

    def __init__(self, spark):
        self.conf = _NoCheckpointConf()
        self.sparkContext = spark.sparkContext


def test_work_dir_chosen_once_when_unset(spark):
    view = _SessionWithoutSetting(spark)
    first = ensure_work_dir(view)
    assert first and ensure_work_dir(view) == first
    # the session's own setting is untouched
    assert spark.conf.get("spark.checkpoint.dir") != first or spark.sparkContext.getCheckpointDir()


def test_work_dir_must_be_named_on_a_cluster():
    import pytest

    class _Cluster:
        conf = _NoCheckpointConf()

        class sparkContext:
            applicationId = "app-on-a-cluster"
            master = "local-cluster[2,1,1024]"

            @staticmethod
            def getCheckpointDir():
                return None

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_work_dir(_Cluster())
