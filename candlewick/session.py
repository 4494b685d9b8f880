"""Session construction and the shared folder for materialised tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on. AQE re-plans joins from measured stage sizes
# (a join side is only broadcast when its materialised size is below the
# threshold) and splits skewed shuffle partitions.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_spark(
    master: str | None = None,
    app: str = "candlewick",
    shuffle_partitions: int | None = None,
    driver_memory: str | None = None,
    extra: dict | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if driver_memory:
        conf["spark.driver.memory"] = driver_memory
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder shared by the cluster, taken from ``spark.checkpoint.dir``.

    Only a session on a local master may do without: it gets a fresh folder
    under the system temp directory, registered as checkpoint dir. On any
    other master a temp folder would be a different one on each machine.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(root)
        return root.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        # the context adds a per-application sub folder; tables go next to it
        return current.rstrip("/").rsplit("/", 1)[0]
    if not (sc.master == "local" or sc.master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that the whole cluster shares")
    root = tempfile.mkdtemp(prefix="candlewick-ckpt-")
    sc.setCheckpointDir(root)
    return root


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A folder of its own for one call: results that read it stay valid
    when the same query runs again, also in another session."""
    return f"{shared_dir(spark)}/candlewick-work/{name}-{uuid.uuid4().hex}"


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) on whatever file system the path names."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists, on whatever file system the path
    (or the default file system, for one without scheme) names."""
    fs, p = hadoop_path(spark, path)
    return fs.exists(p)


def path_state(spark: SparkSession, path: str) -> str:
    """Qualified path, size and newest modification of a file or of the
    files of a folder; empty when there is none."""
    fs, p = hadoop_path(spark, path)
    if not fs.exists(p):
        return ""
    found = [s for s in fs.listStatus(p)] if fs.getFileStatus(p).isDirectory() else [fs.getFileStatus(p)]
    return f"{fs.makeQualified(p)}:{sum(s.getLen() for s in found)}:{max((s.getModificationTime() for s in found), default=0)}"


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder that the caller's own job wrote; none is fine."""
    fs, p = hadoop_path(spark, path)
    fs.delete(p, True)
