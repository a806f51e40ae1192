"""Job bookkeeping: page metrics, job summary, manifest, audit log."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# The folders of a job.
SUBDIRS = ("detection", "dewarping", "lines", "results")


def job_summary(pages: DataFrame, *keys: str) -> DataFrame:
    """Page metrics (status, total_duration_ms, lines_detected) -> totals of the job; failed pages count as pages, not as successes."""
    g = pages.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_pages"),
        F.count_if(F.col("status") != "failed").alias("successful_pages"),
        F.coalesce(F.sum("total_duration_ms"), F.lit(0.0)).alias("total_duration_ms"),
        F.coalesce(F.sum("lines_detected"), F.lit(0)).cast("long").alias("total_lines_detected"),
    )
    return g.withColumn("avg_duration_per_page_ms", F.coalesce(F.try_divide("total_duration_ms", "total_pages"), F.lit(0.0)))


def stage_durations(log: DataFrame, job: str = "job_id", stage: str = "stage", ts: str = "ts", kind: str = "kind") -> DataFrame:
    """Pairs each 'start' with the next record of its stage if that is an 'end' -> (job, stage, started, ended, duration_s)."""
    w = Window.partitionBy(job, stage).orderBy(ts)
    d = log.withColumns({"__k": F.lead(kind).over(w), "ended": F.lead(ts).over(w)})
    d = d.filter((F.col(kind) == "start") & (F.col("__k") == "end")).withColumnRenamed(ts, "started")
    return d.select(job, stage, "started", "ended", F.timestamp_diff("SECOND", "started", "ended").alias("duration_s"))


def manifest(artifacts: DataFrame) -> DataFrame:
    """(job_id, name, type, path, timestamp) -> a job's manifest as JSON, each artifact once, at its latest time."""
    one = artifacts.groupBy("job_id", "name", "type", "path").agg(F.max("timestamp").alias("timestamp"))
    g = one.groupBy("job_id").agg(F.min("timestamp").alias("created"), F.array_sort(F.collect_list(F.struct("timestamp", "name", "type", "path"))).alias("a"))
    entry = F.transform("a", lambda x: F.struct(x["name"].alias("name"), x["type"].alias("type"), x["path"].alias("path"), x["timestamp"].alias("timestamp")))
    return g.select("job_id", F.to_json(F.struct("job_id", "created", entry.alias("artifacts"))).alias("manifest"))


def artifact_path(root: str, job: str, subdir: str, page: str | None = None) -> str:
    if subdir not in SUBDIRS:
        raise ValueError(f"unknown folder {subdir}")
    return "/".join([root.rstrip("/"), job, *([page] if page else []), subdir])


def audit_lines(log: DataFrame) -> DataFrame:
    """Audit records as JSON lines; absent fields are left out."""
    names = [c for c in ("timestamp", "level", "message", "job_id", "stage", "operation", "status", "metadata", "exception") if c in log.columns]
    return log.select(F.to_json(F.struct(*names)).alias("value"))
