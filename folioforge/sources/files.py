"""Scans: page images, volumes, label files, model configurations, language-model unigrams."""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.functions.scalars import file_name, file_stem, natural_key
from folioforge.functions.text import clean_label, finish_wylie_label, first_line

IMAGES = "*.{jpg,jpeg,png,tif,tiff,JPG,JPEG,PNG,TIF,TIFF}"


def page_of(path: Column) -> Column:
    """A page's identity: its whole path, less the scheme. File names alone repeat from volume to volume."""
    return F.regexp_replace(path, r"^[A-Za-z][A-Za-z0-9+.-]*:/{0,2}(?=/)", "")


def volume_of(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+)/[^/]*$", 1)


def image_files(spark: SparkSession, root: str, pattern: str = IMAGES) -> DataFrame:
    """Raw image files: path, page_id, image_name, volume (the folder), content."""
    df = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(root)
    p = F.col("path")
    return df.select("path", page_of(p).alias("page_id"), file_stem(p).alias("image_name"), volume_of(p).alias("volume"), "content")


def images(spark: SparkSession, root: str, drop_invalid: bool = True, pattern: str = IMAGES) -> DataFrame:
    """Decoded pages (BGR): page_id (unique: the path), image_name, volume, height, width, channels, data; unreadable files are dropped, or kept
    with status failed."""
    df = spark.read.format("image").option("dropInvalid", drop_invalid).option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root).select("image.*")
    bad, p = F.col("height") <= 0, F.col("origin")
    return df.select(page_of(p).alias("page_id"), file_stem(p).alias("image_name"), volume_of(p).alias("volume"), "height", "width", F.col("nChannels").alias("channels"), "data", F.when(bad, "failed").otherwise("success").alias("status"), F.when(bad, "unreadable image").alias("error"))


def in_natural_order(df: DataFrame, column: str = "path") -> DataFrame:
    return df.orderBy(natural_key(file_name(F.col(column))), column)


def not_yet_done(volumes: DataFrame, done: DataFrame, key: str = "volume") -> DataFrame:
    """Volumes without output; the output folder itself is no volume."""
    return volumes.filter(F.col(key) != "Output").join(done.select(key).distinct(), key, "left_anti")


def labels(spark: SparkSession, root: str, wylie: bool = True) -> DataFrame:
    """Label files: path, name, label (the first line, cleaned)."""
    df = spark.read.text(root, wholetext=True, pathGlobFilter="*.txt", recursiveFileLookup=True).withColumn("path", F.input_file_name())
    text = clean_label(first_line(F.col("value")))
    return df.select("path", file_stem(F.col("path")).alias("name"), (finish_wylie_label(text) if wylie else text).alias("label"))


def arpa_unigrams(spark: SparkSession, path: str) -> DataFrame:
    """Tokens of the \\1-grams: section, in file order. The file is one language model; it is read as one value and split where it is."""
    text = spark.read.text(path, wholetext=True)
    section = F.regexp_extract("value", r"(?s)(?:^|\n)\\1-grams:[ \t\r]*\n(.*?)(?:\n\\|$)", 1)
    rows = text.select(F.posexplode(F.split(section, "\n")).alias("ord", "line"))
    token = F.get(F.split(F.trim(F.translate("line", "\t\r", "  ")), " +"), 1)
    return rows.filter(~F.trim("line").startswith("#")).select("ord", token.alias("token")).filter("token is not null")


def language_model(spark: SparkSession, model: str, arpa: str) -> DataFrame:
    """One row (model, arpa, unigrams): where a language model lies and what words it knows; unigrams is null where it names none."""
    words = arpa_unigrams(spark, arpa).agg(F.array_sort(F.collect_list(F.struct("ord", "token")))["token"].alias("words"))
    return words.select(F.lit(model).alias("model"), F.lit(arpa).alias("arpa"), F.when(F.size("words") > 0, F.col("words")).alias("unigrams"))


def only_file(spark: SparkSession, folder: str, suffix: str) -> str:
    """The one file in a folder whose name ends so; an error if there is none, or several."""
    fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = fs_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = sorted(f.getPath().toString() for f in fs.listStatus(fs_path) if f.isFile() and f.getPath().getName().endswith(suffix)) if fs.exists(fs_path) else []
    if not found:
        raise FileNotFoundError(f"no {suffix} file in {folder}")
    if len(found) > 1:
        raise ValueError(f"several {suffix} files in {folder}: {found}")
    return found[0]


def model_in(spark: SparkSession, folder: str) -> DataFrame:
    """The configuration of a model's folder, which holds exactly one."""
    return model_configs(spark, only_file(spark, folder, ".json"))


def language_model_in(spark: SparkSession, folder: str) -> DataFrame:
    """The language model of a folder, which holds exactly one .binary and one .arpa file."""
    return language_model(spark, only_file(spark, folder, ".binary"), only_file(spark, folder, ".arpa"))


def theme(spark: SparkSession, path: str) -> dict | None:
    """A JSON file's content, or None if there is no such file."""
    try:
        return json.loads(spark.read.text(path, wholetext=True).first()[0])
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def model_configs(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Line, layout and recognition model configurations as one table; 'yes' flags become booleans, a missing layout architecture deeplabv3.
    Files are named relative to the configuration's folder."""
    names = {"checkpoint": "string", "onnx-model": "string", "architecture": "string", "patch_size": "int", "classes": "array<string>", "version": "string", "input_width": "int", "input_height": "int", "input_layer": "string", "output_layer": "string", "encoder": "string", "squeeze_channel_dim": "string", "swap_hw": "string", "charset": "string", "add_blank": "string"}
    df = spark.read.schema(", ".join(f"`{k}` {v}" for k, v in names.items())).json(paths, multiLine=True).withColumn("config_path", F.input_file_name())
    folder = F.regexp_extract("config_path", r"^(.*/)", 1)
    for c in ("squeeze_channel_dim", "swap_hw", "add_blank"):
        df = df.withColumn(c, F.lower(c) == "yes")
    df = df.withColumn("onnx_file", F.concat(folder, F.col("onnx-model"))).withColumn("checkpoint", F.concat(folder, F.col("checkpoint"))).drop("onnx-model")
    return df.withColumn("architecture", F.when(F.col("classes").isNotNull(), F.coalesce("architecture", F.lit("deeplabv3"))).otherwise(F.col("architecture")))


def single_config(configs: DataFrame) -> DataFrame:
    """Exactly one configuration, or an error."""
    n = configs.limit(2).count()
    if n != 1:
        raise ValueError("expected one model configuration, found " + ("none" if not n else "several"))
    return configs
