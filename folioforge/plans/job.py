"""A job: pages through the pipeline, and what it leaves in a folder.

job/pages         Parquet, rows of plans.ocr.run() (one read of each image, whatever is exported after)
job/lines         Parquet, recognised lines (schemas.OCR_LINES, and where they stand)
job/detections    Parquet, contours and boxes of each page (schemas.LINE_DETECTION)
job/results/text, xml, json   one text row a page, in folders by page
job/metrics       JSON: a row a page, and job/summary
job/audit         JSON lines: start and end of each page's stages, errors
job/manifest      JSON: what there is
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.operators import jobs
from folioforge.plans import ocr
from folioforge.sinks import export

KINDS = ("text", "xml", "json")


def stamp_now() -> str:
    return datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%S")


def audit(read: DataFrame, job_id: str, stamp: str) -> DataFrame:
    """A start and an end of the pipeline for each page, and an error where it failed."""
    record = lambda level, message, status, error=None: F.struct(F.lit(stamp).alias("timestamp"), F.lit(level).alias("level"), message.alias("message"), F.lit(job_id).alias("job_id"), F.lit("ocr_pipeline").alias("stage"), F.lit(None).cast("string").alias("operation"), status.alias("status"), F.create_map(F.lit("image_name"), F.col("page_id").cast("string")).alias("metadata"), (F.lit(None).cast("string") if error is None else error).alias("exception"))
    ok, none = F.col("status") == "success", F.lit(None).cast("string")
    started = record("INFO", F.lit("Stage started: ocr_pipeline"), none)
    ended = record("INFO", F.lit("Stage completed: ocr_pipeline"), F.when(ok, "success").otherwise("failure"))
    failed = record("ERROR", F.col("error"), F.lit("failure"), F.col("error"))
    return read.select(F.explode(F.array_compact(F.array(started, F.when(~ok, failed), ended))).alias("r")).select("r.*")


def run_job(pages: DataFrame, detector: ocr.Detector, recogniser: ocr.Recogniser | None, folder: str, job_id: str, settings: ocr.Settings = ocr.Settings(), exports: tuple[str, ...] = ("text", "xml"), stamp: str | None = None, config: dict[str, str] | None = None) -> DataFrame:
    """Runs the pages, writes the job's tables under folder/job_id, and returns the job's summary. A folder that is there is an error."""
    if unknown := set(exports) - set(KINDS):
        raise ValueError(f"unknown exports: {sorted(unknown)}")
    spark, root, stamp = pages.sparkSession, f"{folder.rstrip('/')}/{job_id}", stamp or stamp_now()
    put = lambda df, name, kind="parquet": df.write.option("compression", "zstd" if kind == "parquet" else "none").format(kind).save(f"{root}/{name}")
    put(ocr.run(pages, detector, recogniser, settings), "pages")
    read = spark.read.parquet(f"{root}/pages")
    found = ocr.lines(read)
    put(found.drop("image"), "lines")
    boxes = found.withColumnsRenamed({"page_width": "w_", "page_height": "h_"}).drop("image_width", "image_height").withColumnsRenamed({"w_": "image_width", "h_": "image_height"})
    put(export.line_detections(boxes), "detections")
    written = ["pages", "lines", "detections"]
    for kind in exports:
        table = export.page_text(boxes) if kind == "text" else export.page_json(boxes, angle="applied_angle", optimise=True) if kind == "json" else export.page_xml(boxes, stamp, angle="applied_angle", optimise=True)
        name = next(c for c in table.columns if c != "page_id")
        safe = table.select(F.regexp_replace(F.col("page_id").cast("string"), "[/\\\\]", "_").alias("page"), F.regexp_replace(F.col(name), "\n$", "").alias("value"))
        safe.write.partitionBy("page").option("lineSep", "\n").text(f"{root}/results/{kind}")
        written.append(f"results/{kind}")
    metrics = ocr.page_metrics(read)
    put(metrics, "metrics", "json")
    summary = jobs.job_summary(metrics)
    put(summary, "summary", "json")
    put(audit(read, job_id, stamp), "audit", "json")
    written += ["metrics", "summary", "audit"]
    artifacts = [(job_id, name, "configuration" if name == "config" else "json" if name in ("metrics", "summary", "audit") else "table", f"{root}/{name}", stamp) for name in written]
    if config is not None:
        put(spark.createDataFrame([config], ", ".join(f"`{k}` string" for k in config)), "config", "json")
        artifacts.append((job_id, "config", "configuration", f"{root}/config", stamp))
    put(jobs.manifest(spark.createDataFrame(artifacts, "job_id string, name string, type string, path string, timestamp string")).select(F.col("manifest").alias("value")), "manifest", "text")
    return spark.read.json(f"{root}/summary")


def infer_lines(pages: DataFrame, detector: ocr.Detector, folder: str) -> DataFrame:
    """Line detection alone: schemas.LINE_DETECTION under folder, a row for every page of the input."""
    export.write_parquet(ocr.detections(pages, detector), folder)
    return pages.sparkSession.read.parquet(folder)
