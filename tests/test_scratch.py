"""Scratch folders on a cluster: what all executors share is used, whatever its scheme."""

import os

import pytest

from lakestrata import registry, session
from lakestrata.llm import mixing
from lakestrata.llm.common import materialize
from lakestrata.session import confirm_scratch, ensure_checkpoint_dir, scratch_path


@pytest.fixture
def cluster(spark, tmp_path, monkeypatch):
    """The session as a standalone cluster with a folder that all machines mount."""
    conf = {"spark.checkpoint.dir": f"file://{tmp_path}/ckpt", "spark.sql.warehouse.dir": f"file://{tmp_path}/warehouse"}
    get = type(spark.conf).get
    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")
    monkeypatch.setattr(type(spark.conf), "get", lambda self, key, *default: conf[key] if key in conf else get(self, key, *default))
    monkeypatch.setattr(session, "_REACHED", {})
    spark.folders = conf
    yield spark
    del spark.folders


def rows_lost_in(monkeypatch, *folders):
    """Executors write some of their rows to disks of their own."""
    from pyspark.sql import DataFrameWriter

    write = DataFrameWriter.parquet

    def parquet(self, path, *args, **named):
        write(DataFrameWriter(self._df.limit(1)) if path.startswith(folders) else self, path, *args, **named)

    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)


def test_a_folder_that_executors_share_is_used(cluster):
    folder = cluster.folders["spark.checkpoint.dir"]
    assert ensure_checkpoint_dir(cluster) == folder
    out = materialize(cluster.range(7), "rows")
    assert out.count() == 7 and all(f.startswith(f"{folder}/lakestrata-llm-") for f in out.inputFiles())
    assert scratch_path(cluster, "sink").startswith(folder)
    assert not [x for x in os.listdir(folder.removeprefix("file://")) if x.startswith("lakestrata-probe")]


def test_operator_runs_where_scratch_is_a_mount(cluster):
    docs = cluster.createDataFrame([(1, "a", "s"), (2, "b", "s"), (3, "c", "t")], "doc_id long, text string, source string")
    assert mixing.mix_sources(docs).count() == mixing.mix_sources(docs).count() > 0


def test_report_runs_where_scratch_is_a_mount(cluster, tmp_path):
    (tmp_path / "in").mkdir()
    rows = [(1, "Customer#1", 3, 120.5, "BUILDING"), (2, "Customer#2", 4, -3.25, "MACHINERY")]
    cluster.createDataFrame(rows, "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string").write.parquet(str(tmp_path / "in/customer.parquet"))
    assert registry.build_queries()["write_layer_table"](cluster, str(tmp_path / "in")).count() == 2


def test_the_folder_is_tried_once_for_each_set_of_hosts(cluster, monkeypatch):
    tried, hosts = [], {"a"}
    real = type(cluster).range
    monkeypatch.setattr(session, "_hosts", lambda _: frozenset(hosts))
    monkeypatch.setattr(type(cluster), "range", lambda self, *a: tried.append(a) or real(self, *a))
    for _ in range(3):
        ensure_checkpoint_dir(cluster)
    assert len(tried) == 1
    hosts.add("b")
    ensure_checkpoint_dir(cluster)
    hosts.discard("a")
    ensure_checkpoint_dir(cluster)
    assert len(tried) == 2


def test_no_folder_of_another_users_run_is_needed(cluster, tmp_path):
    (tmp_path / "ckpt").mkdir()
    for name in ("lakestrata-llm", "lakestrata-layers"):
        (tmp_path / "ckpt" / name).touch()  # as closed to this user as another's folder
    assert materialize(cluster.range(7), "rows").count() == 7
    path = scratch_path(cluster, "sink")
    cluster.range(3).write.parquet(path)
    assert cluster.read.parquet(path).count() == 3


def test_folder_of_each_machine_gives_way_to_the_warehouse(cluster, monkeypatch):
    rows_lost_in(monkeypatch, cluster.folders["spark.checkpoint.dir"])
    assert ensure_checkpoint_dir(cluster).startswith(cluster.folders["spark.sql.warehouse.dir"])
    assert materialize(cluster.range(7), "rows").count() == 7


def test_without_any_shared_folder_it_refuses(cluster, monkeypatch):
    rows_lost_in(monkeypatch, *cluster.folders.values())
    with pytest.raises(RuntimeError, match="shared storage"):
        materialize(cluster.range(7), "rows")


def test_folder_that_cannot_be_written_is_refused(cluster):
    for key in cluster.folders:
        cluster.folders[key] = "file:///proc/no/such/folder"
    with pytest.raises(RuntimeError, match="shared storage"):
        ensure_checkpoint_dir(cluster)


def test_host_that_joins_without_the_folder_is_an_error_not_a_loss(cluster, monkeypatch):
    hosts = {"a"}
    monkeypatch.setattr(session, "_hosts", lambda _: frozenset(hosts))
    path = scratch_path(cluster, "sink")
    confirm_scratch(cluster, path)
    hosts.add("b")
    rows_lost_in(monkeypatch, cluster.folders["spark.checkpoint.dir"])
    with pytest.raises(RuntimeError, match="not shared by all executors"):
        confirm_scratch(cluster, path)
