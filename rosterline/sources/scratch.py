"""A folder for tables that a job writes for itself."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import SparkSession

_roots: dict[str, str] = {}


def work_folder(spark: SparkSession) -> str:
    """A folder that the driver and all executors share, one for each application; it is removed at exit.

    It lies in spark.checkpoint.dir. Where that is unset, a temporary folder is used if the master is local, as in tests;
    on a cluster that is an error, since executors would not see each other's files.
    """
    key = spark.sparkContext.applicationId
    if key not in _roots:
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            base = "file://" + tempfile.mkdtemp(prefix="spark-stage-")
        _roots[key] = f"{base.rstrip('/')}/stage-{uuid.uuid4().hex}"
        atexit.register(remove, spark, _roots[key])
    return _roots[key]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{work_folder(spark)}/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Best effort: at exit the session may be gone."""
    try:
        jvm = spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:
        pass
