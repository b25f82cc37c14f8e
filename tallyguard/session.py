"""Session construction and the shared scratch area."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.streaming.metricsEnabled": "true",
}


def build_session(app_name: str = "tallyguard", master: str | None = None,
                  conf: dict[str, str] | None = None) -> SparkSession:
    """A session with the settings the operators are written for; the deployer adds the rest."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with its file system: Spark takes the default one where it names none."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(found).toString()


_ROOTS: dict[str, str] = {}


def _root(spark: SparkSession) -> str:
    """The session's folder for intermediate tables; it is removed when the session's JVM ends."""
    app = spark.sparkContext.applicationId
    if app not in _ROOTS:
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            master = spark.sparkContext.master
            if master != "local" and not master.startswith("local["):
                raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
            base = tempfile.mkdtemp(prefix="tallyguard-")
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/tallyguard-{app}-{uuid.uuid4().hex[:8]}")
        files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)
        _ROOTS[app] = path.toString()
    return _ROOTS[app]


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh directory under the cluster's shared ``spark.checkpoint.dir``.

    Only a local master, whose tasks all run in one process, may fall back to a folder
    of this machine: elsewhere such a folder is gone with the executor that wrote it.
    """
    return f"{_root(spark)}/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back: several passes over it cost one of its sources."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
