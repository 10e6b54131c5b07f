from types import SimpleNamespace

import pytest

from folioforge.sources.shared import fresh_path


def session(master, folder=None):
    conf = SimpleNamespace(get=lambda *a: folder)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master, getConf=lambda: conf))


def test_the_folder_named_is_used():
    assert fresh_path(session("spark://a:7077", "hdfs://b/c/"), "x").startswith("hdfs://b/c/x-")


def test_local_mode_alone_may_make_one():
    assert fresh_path(session("local[4]"), "x").startswith("file:///")
    for master in ("spark://a:7077", "yarn", "local-cluster[3,2,1024]"):
        with pytest.raises(ValueError):
            fresh_path(session(master), "x")
