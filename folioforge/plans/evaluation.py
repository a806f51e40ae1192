"""Models compared on line images and their labels: read, score, sum up, write."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.operators import evaluate
from folioforge.plans import ocr


def evaluate_model(images: DataFrame, labels: DataFrame, recogniser: ocr.Recogniser, architecture: str, s: ocr.Settings = ocr.Settings(drop_spaces=True)) -> DataFrame:
    """Line images (distribution, name, height, width, channels, data) and labels (distribution, name, label) -> (distribution, architecture, image_name, label_name,
    text, label, cer). Paired by natural order within a distribution; without a partner, left out. An image that can't be read has the error rate of an empty text."""
    pairs = evaluate.pair_by_position(images.select("distribution", "name"), labels.select("distribution", "name"))
    line = images.withColumn("line_id", F.struct("distribution", "name"))
    read = ocr.read_lines(line, recogniser, s, black_and_white=True).select(F.col("line_id.distribution").alias("distribution"), F.col("line_id.name").alias("image_name"), "text")
    named = labels.select("distribution", F.col("name").alias("label_name"), "label")
    both = pairs.join(read, ["distribution", "image_name"]).join(named, ["distribution", "label_name"]).withColumn("text", F.coalesce("text", F.lit("")))
    scored = evaluate.score_pairs(both, "text", "label", evaluate.whole_distance)
    return scored.select("distribution", F.lit(architecture).alias("architecture"), "image_name", "label_name", "text", "label", "cer")


def one_of(pairs: DataFrame, seed: int) -> DataFrame:
    """One pair at random, the same for the same seed and rows."""
    return pairs.orderBy(F.xxhash64(F.lit(seed), *[c for c in pairs.columns if not pairs.schema[c].dataType.simpleString().startswith(("map", "binary"))])).limit(1)


def write_scores(scores: DataFrame, path: str, mode: str = "error") -> None:
    """Scores by distribution and architecture; two architectures of one name don't overwrite each other, as both are rows."""
    scores.select("distribution", "architecture", "image_name", "cer").write.mode(mode).option("compression", "zstd").partitionBy("distribution", "architecture").parquet(path)
