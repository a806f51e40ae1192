import json
import struct
import zlib

from pyspark.sql import functions as F

from folioforge.sinks import export
from folioforge.sources import files
from folioforge.streaming import audit


def test_labels_and_unigrams(spark, tmp_path):
    (tmp_path / "v1").mkdir()
    (tmp_path / "v1" / "a.txt").write_text("ka (kha)\nsecond", encoding="utf-8")
    got = files.labels(spark, str(tmp_path / "v1")).first()
    assert (got.name, got.label) == ("a", "ka§kha")
    (tmp_path / "lm.arpa").write_text("\\data\\\nngram 1=2\n\n\\1-grams:\n-1.0\tka\t-0.5\n# no\n-2.0 kha\n\n\\2-grams:\n-1 x y\n", encoding="utf-8")
    assert [r.token for r in files.arpa_unigrams(spark, str(tmp_path / "lm.arpa")).orderBy("ord").collect()] == ["ka", "kha"]


def test_model_config(spark, tmp_path):
    (tmp_path / "model_config.json").write_text(json.dumps({"onnx-model": "m.onnx", "classes": ["line"], "add_blank": "yes", "patch_size": 512}), encoding="utf-8")
    r = files.single_config(files.model_configs(spark, str(tmp_path))).first()
    assert r.onnx_file.endswith("/m.onnx") and r.add_blank and r.architecture == "deeplabv3" and r.swap_hw is None


def test_image_files_and_skip(spark, tmp_path):
    for v in ("v1", "v2", "Output"):
        (tmp_path / v).mkdir()
        (tmp_path / v / "p10.JPG").write_bytes(b"x")
        (tmp_path / v / "p9.jpg").write_bytes(b"y")
        (tmp_path / v / "note.md").write_bytes(b"z")
    df = files.image_files(spark, str(tmp_path))
    assert df.count() == 6
    left = files.not_yet_done(df, spark.createDataFrame([("v1",)], "volume string"))
    assert [r.image_name for r in files.in_natural_order(left).collect()] == ["p9", "p10"]


def png(pixels):
    """A grey PNG from rows of bytes."""
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    head = struct.pack(">IIBBBBB", len(pixels[0]), len(pixels), 8, 0, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(b"".join(b"\0" + bytes(r) for r in pixels))) + chunk(b"IEND", b"")


def test_pages_of_two_volumes_stay_apart(spark, tmp_path):
    for v, tone in (("v1", 10), ("v2", 200)):
        (tmp_path / v).mkdir()
        (tmp_path / v / "p1.png").write_bytes(png([[tone] * 6] * 4))
    (tmp_path / "v2" / "bad.png").write_bytes(b"no image")
    (tmp_path / "v2" / "note.txt").write_bytes(b"no image either")
    got = sorted(files.images(spark, str(tmp_path), drop_invalid=False).collect(), key=lambda r: r.page_id)
    assert [(r.image_name, r.volume, r.status) for r in got] == [("p1", "v1", "success"), ("bad", "v2", "failed"), ("p1", "v2", "success")]
    assert len({r.page_id for r in got}) == 3 and got[0].page_id == f"{tmp_path}/v1/p1.png"
    assert {r.page_id for r in files.image_files(spark, str(tmp_path), "*.png").collect()} == {r.page_id for r in got}
    from folioforge.operators import pixels

    cut = pixels.tiles(files.images(spark, str(tmp_path)), 4)
    assert pixels.stitched(cut.withColumn("channels", F.lit(1)).withColumn("data", F.lit(bytearray(16)))).count() == 2


def test_ocr_lines_allow_missing_scores(spark):
    r = export.ocr_lines(spark.range(1).select(F.lit("g").alias("guid"), F.lit("ab").alias("text"), F.lit(-4.0).alias("logit_score"))).first()
    assert r.norm_logp == -2.0 and r.ctc_conf is None and r.logits is None


def test_round_trip_parquet(spark, tmp_path):
    df = spark.range(3).select(F.col("id").alias("page_id"), F.lit("t").alias("text"), F.lit(0).alias("ord"))
    export.write_parquet(df, str(tmp_path / "o"), "page_id")
    assert spark.read.parquet(str(tmp_path / "o")).count() == 3
    export.write_text(export.page_text(df), str(tmp_path / "t"), "text")
    assert spark.read.text(str(tmp_path / "t")).filter("value <> ''").count() == 3


def test_audit_stream(spark, tmp_path):
    log = tmp_path / "log"
    log.mkdir()
    lines = [{"timestamp": f"2024-01-01T00:0{i}:00", "level": "INFO", "message": "m", "stage": "s", "status": "failure" if i == 2 else "success"} for i in range(4)]
    (log / "a.json").write_text("\n".join(map(json.dumps, lines)))
    q = audit.failures(audit.audit_stream(spark, str(log))).writeStream.format("memory").queryName("fails").outputMode("complete").option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.stop()
    assert [(r.records, r.failed) for r in spark.table("fails").collect()] == [(4, 1)]
