"""The session leaves a cluster's master, partitions and folders alone."""
from types import SimpleNamespace

import pytest

from orderlake import session


def _fake(master, conf_dir=None):
    set_to = []
    sc = SimpleNamespace(master=master, getCheckpointDir=lambda: None, setCheckpointDir=set_to.append,
                         getConf=lambda: SimpleNamespace(get=lambda key, default=None: conf_dir), setLogLevel=lambda level: None)
    return SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda key, default=None: conf_dir)), set_to


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "local-cluster[2,1,1024]"])
def test_a_cluster_needs_a_shared_folder(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(_fake(master)[0])
    spark, set_to = _fake(master, "hdfs://shared/checkpoints")
    assert session.checkpoint_dir(spark) == "hdfs://shared/checkpoints" and set_to == ["hdfs://shared/checkpoints"]


def test_master_and_partitions_only_when_asked(monkeypatch):
    made = {}

    class Builder:
        def appName(self, name):
            return self

        def master(self, m):
            made["spark.master"] = m
            return self

        def config(self, key, value):
            made[key] = value
            return self

        def getOrCreate(self):
            return _fake("yarn", "hdfs://shared")[0]

    monkeypatch.setattr(session, "SparkSession", SimpleNamespace(builder=Builder()))
    session.build_session()
    assert not {"spark.master", "spark.sql.shuffle.partitions", "spark.checkpoint.dir"} & set(made)
    session.build_session("local[2]", shuffle_partitions=3)
    assert made["spark.master"] == "local[2]" and made["spark.sql.shuffle.partitions"] == "3"
