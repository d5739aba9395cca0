"""Tables staged in the folder that driver and executors share: they cut lineages and survive lost executors."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_made: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Where it is unset, a local master gets a temporary folder, as driver and executors are one process; a cluster
    is an error, as a folder of one machine would lose what others wrote.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="lexspark-checkpoint-")
        spark.conf.set("spark.checkpoint.dir", found)
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    _made.append(f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}")
    return _made[-1]


def staged(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """df as a written table in the shared folder."""
    path = new_folder(df.sparkSession, name)
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, folder: str) -> bool:
    """Deletes a folder with all that is in it, and says whether there was one."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def remove_staged(spark: SparkSession) -> int:
    """Deletes all folders that this process has staged, and says how many; no DataFrame that reads them may be in use."""
    gone = 0
    while _made:
        gone += remove(spark, _made.pop())
    return gone
