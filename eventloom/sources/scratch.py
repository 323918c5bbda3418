"""Where intermediate tables go: the shared folder the cluster names."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
_local: dict[str, str] = {}
_made: dict[str, list[str]] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder from ``spark.checkpoint.dir``; a temporary one only in local mode."""
    configured = spark.conf.get(SETTING, None) or spark.sparkContext.getConf().get(SETTING)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {SETTING} to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local:
        _local[app] = tempfile.mkdtemp(prefix="eventloom-")
    return _local[app]


def new_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the shared folder; nothing is created yet."""
    path = f"{shared_dir(spark)}/{purpose}-{uuid.uuid4().hex[:12]}"
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def delete_dir(spark: SparkSession, path: str) -> None:
    """Delete one of the folders above, once nothing reads it any more."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    fs.delete(hadoop_path, True)


def delete_scratch(table: DataFrame) -> None:
    """Delete the folders above that ``table`` is read from; other folders are left alone."""
    spark = table.sparkSession
    made = _made.get(spark.sparkContext.applicationId, [])
    read = {file.rsplit("/", 2)[-2] for file in table.inputFiles()}
    for path in [p for p in made if p.rsplit("/", 1)[1] in read]:
        made.remove(path)
        delete_dir(spark, path)


def scratch_paths(spark: SparkSession) -> list[str]:
    """Folders made by this application and not deleted yet, oldest first."""
    return list(_made.get(spark.sparkContext.applicationId, []))


def release(spark: SparkSession, paths: list[str] = (), keep: DataFrame | None = None) -> None:
    """Delete the ``paths`` that ``keep`` is not read from, and shuffle files nothing needs.

    Spark deletes the shuffle files of a plan when the driver's JVM collects the plan. Call
    this after a large step whose result is stored.
    """
    read = set() if keep is None else {f.rsplit("/", 2)[-2] for f in keep.inputFiles()}
    made = _made.get(spark.sparkContext.applicationId, [])
    for path in [p for p in paths if p in made and p.rsplit("/", 1)[1] not in read]:
        made.remove(path)
        delete_dir(spark, path)
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def clear_scratch(spark: SparkSession) -> None:
    """Delete all folders this application made; call it when its results are stored."""
    for path in _made.pop(spark.sparkContext.applicationId, []):
        delete_dir(spark, path)
