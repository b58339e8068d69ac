"""Session helper and shared scratch locations.

No master is hard-coded: the cluster manager decides. Scratch output
(round trips, run directories) always goes below the shared folder the
cluster names in ``spark.checkpoint.dir``; only a local master (a laptop or
a test) gets a local folder when that is unset.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(app_name: str = "terrapipe", master: str | None = None,
                conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    Only a local master, whose tasks all run on this machine, gets a folder of
    its own when none is named; on a cluster that is an error, since executors
    would each write to a disk that the others do not see.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="terrapipe-ckpt-"))
        current = sc.getCheckpointDir()
    return current.rstrip("/")


def run_dir(spark: SparkSession, name: str) -> str:
    """A fresh, never reused directory below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/terrapipe/{name}/run={uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file, a folder or (for a pattern) any match exists, asked of the path's own file system."""
    file_system, target = _file_system(spark, path)
    found = file_system.globStatus(target)
    return found is not None and len(found) > 0


def delete_path(spark: SparkSession, path: str) -> None:
    file_system, target = _file_system(spark, path)
    file_system.delete(target, True)


def count_files(spark: SparkSession, path: str) -> int:
    """Files below ``path``; 0 when it does not exist."""
    file_system, target = _file_system(spark, path)
    if not file_system.exists(target):
        return 0
    files, n = file_system.listFiles(target, True), 0
    while files.hasNext():
        files.next()
        n += 1
    return n


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """The folders right below ``path``; none when it does not exist."""
    file_system, target = _file_system(spark, path)
    if not file_system.exists(target):
        return []
    return sorted(str(entry.getPath()) for entry in file_system.listStatus(target) if entry.isDirectory())
