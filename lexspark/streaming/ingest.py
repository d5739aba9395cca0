"""Incremental ingestion: new XML files as a stream, and the best candidate of each urn kept up to date."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from lexspark.operators.canonical import rank
from lexspark.sources import akn
from lexspark.staging import remove


def member_stream(spark: SparkSession, folder: str, collection: str, source_format: str = "V") -> DataFrame:
    schema = "path string, modificationTime timestamp, length long, content binary"
    files = spark.readStream.format("binaryFile").schema(schema).option("pathGlobFilter", "*.xml").load(folder)
    return files.select(F.lit(collection).alias("collection"), F.lit(source_format).alias("source_format"), F.col("path").alias("source"), F.col("content").alias("raw"))


def keep_best(spark: SparkSession, stream: DataFrame, table: str, checkpoint: str) -> DataStreamWriter:
    """Each batch is folded into the table's next version: table/v=<batch>, the newest being the result.

    A batch that is run again overwrites its own version and reads the one before, so results do not change; older
    versions are deleted, as no batch reads them again.
    """

    def fold(batch: DataFrame, number: int) -> None:
        new = akn.candidates(akn.parse_members(batch))
        rows = new if number == 0 else new.unionByName(spark.read.parquet(f"{table}/v={number - 1}"))
        ranked = rows.withColumn("rank", rank())
        best = ranked.groupBy("urn").agg(F.min_by(F.struct(*rows.columns), "rank").alias("best")).select("best.*")
        best.write.mode("overwrite").parquet(f"{table}/v={number}")
        if number > 1:
            remove(spark, f"{table}/v={number - 2}")

    return stream.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint).trigger(availableNow=True)
