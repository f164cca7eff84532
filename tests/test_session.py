"""Intermediate tables go to the folder the session names in spark.checkpoint.dir."""

import pytest

from callweave import session
from callweave.session import ensure_checkpoint_dir, materialize


def test_materialize_uses_the_session_checkpoint_dir(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    base = ensure_checkpoint_dir(spark)
    if configured:
        assert base == configured                               # read, never replaced
    df = materialize(spark.range(5).withColumnRenamed("id", "x"), "probe")
    files = df.inputFiles()
    assert files and all(base.rstrip("/") in f for f in files)
    assert sorted(r.x for r in df.collect()) == [0, 1, 2, 3, 4]
    again = materialize(spark.range(1), "probe")                # a fresh folder each time
    assert set(again.inputFiles()).isdisjoint(files)


class _Conf:
    def __init__(self):
        self.writes = []

    def get(self, key, default=None):
        return default

    def set(self, key, value):                                  # pragma: no cover
        self.writes.append((key, value))


class _Ctx:
    applicationId = "app-test"

    def __init__(self, master="local[2]"):
        self.master = master

    def setCheckpointDir(self, path):
        self.path = path


class _Session:
    def __init__(self, master="local[2]"):
        self.conf, self.sparkContext = _Conf(), _Ctx(master)


def test_unset_checkpoint_dir_uses_a_private_folder_without_changing_config():
    s = _Session()
    first = ensure_checkpoint_dir(s)
    assert first == ensure_checkpoint_dir(s)                    # stable per application
    assert s.conf.writes == [] and s.sparkContext.path == first
    session._PRIVATE_DIRS.pop("app-test", None)


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "k8s://host", "local-cluster[2,1,1024]"])
def test_a_cluster_without_a_shared_folder_is_an_error(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(_Session(master))


def test_sizing_conf_targets_partition_size():
    from callweave.session import sizing_conf

    c = sizing_conf(1024 ** 4)                                   # 1 TB shuffle
    assert int(c["spark.sql.shuffle.partitions"]) == 8192
    assert c["spark.sql.adaptive.advisoryPartitionSizeInBytes"] == str(128 * 1024 ** 2)
    big = sizing_conf(100 * 1024 ** 4)                           # 100 TB: capped count
    assert int(big["spark.sql.shuffle.partitions"]) == 100_000
    assert int(big["spark.sql.adaptive.advisoryPartitionSizeInBytes"]) * 100_000 >= 100 * 1024 ** 4
    assert sizing_conf(1)["spark.sql.shuffle.partitions"] == "1"
