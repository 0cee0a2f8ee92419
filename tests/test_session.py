"""The shared folder comes from the session; only a local master may go without."""

from types import SimpleNamespace

import pytest

from fabspark.session import shared_dir


class Context:
    applicationId = "app-1"

    def __init__(self, master):
        self.master, self.at = master, None

    def getCheckpointDir(self):
        return self.at

    def setCheckpointDir(self, path):
        self.at = f"file:{path}/x"


def fake(master, named=None):
    return SimpleNamespace(conf=SimpleNamespace(get=lambda k, d: named), sparkContext=Context(master))


def test_named_folder_is_used():
    assert shared_dir(fake("yarn", "s3a://bucket/tmp")) == "s3a://bucket/tmp/fabspark/app-1"


def test_cluster_without_a_folder_is_refused():
    with pytest.raises(RuntimeError):
        shared_dir(fake("yarn"))


def test_local_master_gets_one_folder():
    s = fake("local[2]")
    assert shared_dir(s) == shared_dir(s)
