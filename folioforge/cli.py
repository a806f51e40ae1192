"""Command line: python -m folioforge.cli ocr|lines|regions ...

ocr:     images -> text (and, with --save-artifacts, all tables of a job)
lines:   images -> Parquet of line contours and boxes
regions: images -> JSON of the boxes of layout classes
Models are folders that hold one model_config.json and the ONNX file that it names.
"""

from __future__ import annotations

import argparse
import os
import sys
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.operators import layout
from folioforge.plans import job, ocr
from folioforge.sinks import export
from folioforge.sources import files


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="folioforge", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    sub = top.add_subparsers(dest="command", required=True)
    p = sub.add_parser("ocr", help="recognise the text of images")
    p.add_argument("--model", required=True, help="folder of the recognition model")
    p.add_argument("--line-model", required=True, help="folder of the line or layout model")
    given = p.add_mutually_exclusive_group(required=True)
    given.add_argument("--image", help="one image file")
    given.add_argument("--folder", help="a folder of images, with its folders")
    p.add_argument("--output", required=True, help="folder for the text")
    p.add_argument("--encoding", choices=["unicode", "wylie"], default="unicode", help="encoding of the model's labels, noted with each line")
    p.add_argument("--k-factor", type=float, default=2.5)
    p.add_argument("--bbox-tolerance", type=float, default=4.0)
    p.add_argument("--merge-lines", action="store_true", help="join the parts of a line")
    p.add_argument("--dewarp", action="store_true", help="straighten curved pages")
    p.add_argument("--line-mode", choices=["line", "layout"], default="line")
    p.add_argument("--save-artifacts", action="store_true")
    p.add_argument("--artifact-output", default="output", help="folder for jobs")
    p.add_argument("--artifact-granularity", choices=["minimal", "standard"], default="standard", help="standard keeps masks and contours too")
    p.add_argument("--job-id")
    p = sub.add_parser("lines", help="detect lines")
    p.add_argument("-i", "--input-dir", required=True)
    p.add_argument("-o", "--output-dir", default="parquet_out")
    p.add_argument("-c", "--model", required=True, help="folder of the line model")
    p.add_argument("-b", "--batch-size", type=int, default=8, help="tiles a call of the model")
    p.add_argument("-t", "--class-threshold", type=float, default=0.85)
    p = sub.add_parser("regions", help="boxes of layout classes")
    p.add_argument("-i", "--input-dir", required=True)
    p.add_argument("-o", "--output-dir", required=True)
    p.add_argument("-c", "--model", required=True, help="folder of the layout model")
    p.add_argument("--classes", nargs="*", default=[])
    p.add_argument("-t", "--class-threshold", type=float, default=0.8)
    return top


def config(spark: SparkSession, folder: str):
    path = os.path.join(folder, "model_config.json")
    if not os.path.isfile(path):
        raise FileNotFoundError(f"no model configuration: {path}")
    return files.single_config(files.model_configs(spark, path)).first()


def found_images(spark: SparkSession, path: str) -> DataFrame:
    """Pages of an image or a folder, unreadable ones failed; leaves the program if there are none."""
    pages = files.images(spark, path, drop_invalid=False)
    if not pages.limit(1).count():
        sys.exit(f"no images in {path}")
    return pages


def main(args: list[str] | None = None, spark: SparkSession | None = None, detector: ocr.Detector | None = None, recogniser: ocr.Recogniser | None = None) -> int:
    """detector and recogniser replace the models of the folders named."""
    a = parser().parse_args(args)
    spark = spark or SparkSession.builder.appName("folioforge").getOrCreate()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")  # pages are large rows
    if a.command == "lines":
        d = detector or ocr.detector_of(config(spark, a.model), threshold=a.class_threshold, batch=a.batch_size)
        n = job.infer_lines(found_images(spark, a.input_dir), d, a.output_dir).count()
        print(f"{n} images with lines: {a.output_dir}")
        return 0
    if a.command == "regions":
        d = detector or ocr.detector_of(config(spark, a.model), threshold=a.class_threshold)
        layout.class_boxes(ocr.layout_boxes(found_images(spark, a.input_dir), d, a.classes)).write.json(a.output_dir)
        print(f"regions: {a.output_dir}")
        return 0
    d = detector or ocr.detector_of(config(spark, a.line_model))
    if detector is None and (a.line_mode == "layout") != bool(d.classes):
        raise ValueError(f"--line-mode {a.line_mode}, but the model in {a.line_model} is of the other kind")
    r = recogniser or ocr.recogniser_of(config(spark, a.model))
    s = ocr.Settings(merge_lines=a.merge_lines, k_factor=a.k_factor, bbox_tolerance=a.bbox_tolerance, dewarp=a.dewarp, encoding=a.encoding, artifacts=a.save_artifacts and a.artifact_granularity == "standard")
    pages = found_images(spark, a.image or a.folder)
    job_id = a.job_id or f"{datetime.now(timezone.utc):%Y%m%d_%H%M%S}_{uuid.uuid4().hex[:6]}"
    root = a.artifact_output if a.save_artifacts else os.path.join(a.output, "_jobs")
    given = {k: str(v) for k, v in vars(a).items() if v is not None}
    summary = job.run_job(pages, d, r, root, job_id, s, ("text", "xml") if a.save_artifacts else ("text",), config=given).first()
    read = spark.read.parquet(f"{root}/{job_id}/pages")
    export.page_text(ocr.lines(read)).select(F.col("page_id"), "text").write.mode("overwrite").parquet(os.path.join(a.output, "text"))
    for row in read.filter("status = 'failed'").select("page_id", "error").limit(100).collect():
        print(f"failed: {row.page_id}: {row.error}")
    print(f"{summary.successful_pages} of {summary.total_pages} pages, {summary.total_lines_detected} lines: {root}/{job_id}")
    return 0 if summary.successful_pages else 1


if __name__ == "__main__":
    sys.exit(main())
