"""SparkSession construction with the settings the engine relies on."""

from __future__ import annotations

import os
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import SparkSession

# Settings the plans assume.  AQE re-plans joins on runtime sizes (broadcast
# conversion, skew split, partition coalescing); the session zone is UTC
# because all timestamps are UTC wall-clock values.
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # target post-shuffle partition size: at scale the cluster sets a high
    # spark.sql.shuffle.partitions and AQE coalesces each stage towards this
    # (with coalescePartitions.parallelismFirst=false on a cluster; left at
    # its default here, where data is tiny and parallelism matters more)
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split skewed join partitions even when that costs an extra shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.parquet.aggregatePushdown": "true",
}


def apply_engine_conf(spark: SparkSession) -> SparkSession:
    """Prepare a session that someone else made: only the time zone, which
    results depend on, is set; tuning stays the caller's.  The checkpoint folder
    is looked for by what writes there (:func:`scratch_path`)."""
    spark.conf.set("spark.sql.session.timeZone", ENGINE_CONF["spark.sql.session.timeZone"])
    return spark


def _is_local_folder(spark: SparkSession, path: str) -> bool:
    """True for paths on a machine's own disk: ``file:``, or without a scheme
    where the default file system is not a shared one."""
    scheme = path.split(":", 1)[0] if ":" in path else ""
    if not scheme:
        jsc = getattr(spark, "_jsc", None)
        default = jsc.hadoopConfiguration().get("fs.defaultFS") if jsc else "file:///"
        scheme = (default or "file:///").split(":", 1)[0]
    return scheme == "file"


#: Hosts whose rows were found in a folder, by application and folder; none: it is not shared.
_REACHED: dict[tuple[str, str], frozenset[str]] = {}


def _hosts(spark: SparkSession) -> frozenset[str]:
    """Hosts of the driver and of the executors there are now."""
    names = spark.sparkContext._jsc.sc().getExecutorMemoryStatus().keys().mkString(",")
    return frozenset(x.rsplit(":", 1)[0] for x in names.split(","))


def _reaches_executors(spark: SparkSession, folder: str) -> bool:
    """True for a folder without a scheme of shared storage that is shared all
    the same (a mount that all machines have, or a cluster on one machine): every
    row that tasks on all executors write there is found by the driver and read
    again.  It is tried once, and again when executors run on further hosts; a
    folder that once failed is not tried again."""
    if getattr(spark, "_jsc", None) is None:
        return False
    key = (spark.sparkContext.applicationId, folder)
    hosts, reached = _hosts(spark), _REACHED.get(key)
    if reached is not None and (not reached or hosts <= reached):
        return bool(reached)
    n = max(2 * spark.sparkContext.defaultParallelism, 4 * len(hosts))
    probe = f"{folder.rstrip('/')}/lakestrata-probe-{uuid.uuid4().hex}"
    try:
        spark.range(0, n, 1, n).write.parquet(probe)
        found = spark.read.schema("id long").parquet(probe).count() == n
        where = spark._jvm.org.apache.hadoop.fs.Path(probe)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    except (Py4JJavaError, PySparkException):  # not to be written, or not to be read again
        found = False
    _REACHED[key] = hosts | (reached or frozenset()) if found else frozenset()
    return found


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; only set a scratch one when
    the session has none (local tests).  On a cluster, a folder of the machine's
    own file system counts if all executors share it; if they don't, the
    warehouse is used, which Spark wants shared, too."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    local = sc.master.startswith("local")
    if d and (local or not _is_local_folder(spark, d) or _reaches_executors(spark, d)):
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(d)
        return d
    existing = None if d else sc.getCheckpointDir()
    if existing:
        return existing
    if not local:
        # a machine-local folder is lost with its executor: on a cluster the
        # shared folder must come from the session configuration
        warehouse = spark.conf.get("spark.sql.warehouse.dir", None)
        if warehouse and (not _is_local_folder(spark, warehouse) or _reaches_executors(spark, warehouse)):
            return warehouse
        if d:
            raise RuntimeError(f"spark.checkpoint.dir is {d}, a folder of one machine: point it at shared storage (HDFS, object store)")
        raise RuntimeError("spark.checkpoint.dir is not set: point it at shared storage (HDFS, object store)")
    d = tempfile.mkdtemp(prefix="lakestrata-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(d)
    return d


def confirm_scratch(spark: SparkSession, path: str) -> None:
    """After a write below the scratch folder: executors that came meanwhile, on
    further hosts, must share it too, or their rows are not in ``path``."""
    if getattr(spark, "_jsc", None) is None or spark.sparkContext.master.startswith("local") or not _is_local_folder(spark, path):
        return
    if not path.startswith(f"{ensure_checkpoint_dir(spark).rstrip('/')}/"):
        raise RuntimeError(f"{path} is not shared by all executors: point spark.checkpoint.dir at shared storage (HDFS, object store)")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder for written tables in the shared checkpoint folder (not
    below one that another user may have made); it is deleted when the driver's
    JVM ends."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/lakestrata-layers-{label}-{uuid.uuid4().hex}"
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)
    return path


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "lakestrata") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    for k, v in ENGINE_CONF.items():
        spark.conf.set(k, v)
    return apply_engine_conf(spark)
