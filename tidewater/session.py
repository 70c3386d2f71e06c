"""Session helper and shared-folder helpers.

Settings are the ones every job here relies on: UTC wall clock, ANSI casts,
AQE with skew-join splitting and partition coalescing.  Nothing is forced on a
session that already exists except what correctness needs (time zone, ANSI).
"""

from __future__ import annotations

import json
import tempfile
import uuid

from pyspark.sql import SparkSession

CORE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a skewed shuffle partition (one hot key) is split once it is 4x the median
    # and above 256 MB; AQE then replicates the other side for that slice only
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # the state of streams lies on the executors' disks, not in their heap
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(master: str | None = None, app: str = "tidewater",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(CORE_CONF)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    apply_core_conf(spark)
    return spark


def apply_core_conf(spark: SparkSession) -> None:
    """Pin the settings the results depend on (idempotent, runtime-settable)."""
    for k in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled",
              "spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled",
              "spark.sql.sources.partitionOverwriteMode"):
        spark.conf.set(k, CORE_CONF[k])


_LOCAL_DIRS: dict = {}


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder named by ``spark.checkpoint.dir``; without it a cluster is refused.

    On a cluster this is set by the operator to a shared file system and is
    used as is.  Only where it is unset (local tests) a fresh folder is made;
    it becomes the context's checkpoint folder (the conf itself cannot be
    changed at run time) and is reused for the rest of the application.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        d = _LOCAL_DIRS.get(sc.applicationId)
        if d is None:
            d = tempfile.mkdtemp(prefix="tidewater-ckpt-")
            _LOCAL_DIRS[sc.applicationId] = d
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder below the shared folder for one run."""
    base = shared_dir(spark)
    path = f"{base}/tidewater-runs/{name}-{uuid.uuid4().hex[:12]}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)
    return path


def remove_folder(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def free_shuffles(spark: SparkSession) -> None:
    """Has Spark delete the shuffle files of the steps that are done.

    Spark deletes them when the driver's garbage collector finds that no plan
    can read them any more.  A driver with memory to spare collects late, and
    until then the files of every step of a run lie on the executors' disks.
    The scheduler holds the last job until another comes, so a small one goes first.
    """
    spark.range(1).collect()
    spark.sparkContext._jvm.java.lang.System.gc()


def write_note(spark: SparkSession, path: str, value) -> None:
    """A small JSON file that appears whole."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    p = fs_path(f"{path}.tmp")
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    out = fs.create(p, True)
    out.write(bytearray(json.dumps(value).encode()))
    out.close()
    fs.rename(p, fs_path(path))


def read_note(spark: SparkSession, path: str):
    """What ``write_note`` put there, or None."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        return None
    return json.loads(spark.read.text(path, wholetext=True).first().value)
