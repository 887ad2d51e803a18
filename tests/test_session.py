"""The shared folder: taken from the session; a cluster without one is refused."""

import pytest

from ledgerloom import session


class _Context:
    def __init__(self, master, folder):
        self.master, self._folder = master, folder
        self._jsc = self

    def getConf(self):
        return {"spark.checkpoint.dir": self._folder}

    def sc(self):
        return self

    def getCheckpointDir(self):
        return self

    def isEmpty(self):
        return True


class _Session:
    def __init__(self, master, folder=None):
        self.sparkContext = _Context(master, folder)


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(RuntimeError):
        session.shared_folder(_Session("spark://host:7077"))
    with pytest.raises(RuntimeError):
        session.shared_folder(_Session("local-cluster[3,2,3000]"))
    assert session.shared_folder(_Session("spark://host:7077", "hdfs:///shared")) == "hdfs:///shared"
    assert "ledgerloom-" in session.shared_folder(_Session("local[2]"))
