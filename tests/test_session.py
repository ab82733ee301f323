import pytest

from lakestrata.session import ensure_checkpoint_dir


class _Conf:
    def __init__(self, d):
        self._d = d

    def get(self, key, default=None):
        return self._d.get(key, default)


class _Ctx:
    def __init__(self, master, existing=None):
        self.master, self._dir = master, existing

    def getCheckpointDir(self):
        return self._dir

    def setCheckpointDir(self, d):
        self._dir = d


class _Session:
    def __init__(self, master, conf=None, existing=None):
        self.conf, self.sparkContext = _Conf(conf or {}), _Ctx(master, existing)


def test_cluster_without_checkpoint_dir_refuses_a_local_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(_Session("yarn"))


def test_session_checkpoint_dir_is_used_as_configured():
    s = _Session("yarn", {"spark.checkpoint.dir": "hdfs://nn/ckpt"})
    assert ensure_checkpoint_dir(s) == "hdfs://nn/ckpt"
    assert s.sparkContext.getCheckpointDir() == "hdfs://nn/ckpt"


def test_local_session_gets_a_scratch_folder_only_when_unset(tmp_path, monkeypatch):
    monkeypatch.setenv("TMPDIR", str(tmp_path))
    s = _Session("local[2]")
    d = ensure_checkpoint_dir(s)
    assert d.startswith(str(tmp_path)) and s.sparkContext.getCheckpointDir() == d
    assert ensure_checkpoint_dir(_Session("local[2]", existing="/already/set")) == "/already/set"


@pytest.mark.parametrize("folder", ["file:/tmp/somewhere", "file:///tmp/x", "/tmp/somewhere"])
def test_cluster_refuses_a_configured_local_folder(folder):
    with pytest.raises(RuntimeError, match="shared storage"):
        ensure_checkpoint_dir(_Session("yarn", {"spark.checkpoint.dir": folder}))


def test_local_cluster_may_use_its_folder():
    s = _Session("local-cluster[3,2,3000]", {"spark.checkpoint.dir": "file:///tmp/x"})
    assert ensure_checkpoint_dir(s) == "file:///tmp/x"
