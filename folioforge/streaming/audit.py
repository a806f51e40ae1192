"""The audit log as a stream: failures a stage and window, with a watermark for late records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.schemas import AUDIT


#: How records say that something went wrong: stages end with 'failure', pages are 'failed'.
FAILED = ("failure", "failed")


def audit_stream(spark: SparkSession, folder: str) -> DataFrame:
    return spark.readStream.schema(AUDIT).json(folder).withColumn("ts", F.to_timestamp("timestamp"))


def failures(log: DataFrame, window: str = "10 minutes", late: str = "30 minutes") -> DataFrame:
    g = log.withWatermark("ts", late).groupBy(F.window("ts", window).alias("w"), "stage")
    g = g.agg(F.count(F.lit(1)).alias("records"), F.count_if(F.col("status").isin(*FAILED)).alias("failed"))
    return g.select(F.col("w.start").alias("started"), "stage", "records", "failed")
