"""Where intermediate results live: the shared folder named by the cluster."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_written: dict[str, list[str]] = {}     # paths of each application
_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session. Only a local session, whose driver is its only
    executor, may do without and gets a temporary folder; on a cluster that is an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.match(r"local($|\[)", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="tenderloom-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def materialize(df: DataFrame, name: str = "step") -> DataFrame:
    """Writes the rows once, as Parquet, and reads them back: lineage ends there, they survive the
    loss of executors, and later steps read only the columns they need. Nothing reads the shuffle
    files of the write after it, so Spark is asked to free them when it ends."""
    spark = df.sparkSession
    path = new_path(spark, name)
    before = spark.conf.get(_FREE_SHUFFLES, None)
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_FREE_SHUFFLES)
        else:
            spark.conf.set(_FREE_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


def remove_materialized(spark: SparkSession) -> int:
    """Deletes what this application has materialized; for the end of a job, when its result is
    published. Returns the number of folders."""
    paths = _written.pop(spark.sparkContext.applicationId, [])
    configuration = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(configuration).delete(place, True)
    return len(paths)
