"""Shared folder rules: configured, set on the context, scratch only on a local master; owned folders."""
import os

import pytest

from inkstream import session as S


class Conf(dict):
    def get(self, key, default=None):
        return dict.get(self, key, default)


class Context:
    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, path):
        self.folder = "file:" + path


class Session:
    def __init__(self, master, conf=None, folder=None):
        self.conf, self.sparkContext = Conf(conf or {}), Context(master, folder)


def test_configured_folder_first():
    assert S.shared_dir(Session("yarn", {"spark.checkpoint.dir": "hdfs://x/y"}, "file:/z")) == "hdfs://x/y"


def test_folder_set_on_the_context():
    assert S.shared_dir(Session("yarn", folder="file:/shared/a")) == "file:///shared/a"


@pytest.mark.parametrize("master", ["yarn", "spark://h:7077", "local-cluster[2,1,1024]"])
def test_no_scratch_folder_on_a_cluster(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        S.shared_dir(Session(master))


def test_scratch_folder_on_a_local_master():
    s = Session("local[2]")
    assert S.shared_dir(s) == S.shared_dir(s) and S.shared_dir(s).startswith("file:///")


def test_owned_folders_are_removed(spark):
    outside = S.fresh_path(spark, "kept")
    spark.range(3).write.parquet(outside)
    with S.owned_folders(spark) as made:
        assert S.materialize(spark.range(5), "mine").count() == 5
        paths = [p.replace("file://", "") for p in made]
        assert len(paths) == 1 and os.path.isdir(paths[0])
    assert not os.path.exists(paths[0])
    assert spark.read.parquet(outside).count() == 3
