"""The page pipeline from images to text, with stub models; its job, exports and command line."""

import json
import xml.etree.ElementTree as etree

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_sources import png

from folioforge import cli
from folioforge.operators import pixels as P
from folioforge.plans import evaluation, job, ocr
from folioforge.plans.catalogue import dark
from folioforge.sinks import export

CHARSET = tuple("abcdefghij§ ")


def page(*bars, shape=(192, 256)):
    img = np.full((*shape, 3), 255, np.uint8)
    for x, y, w, h in bars:
        img[y : y + h, x : x + w] = 0
    return img


def table(spark, pages):
    rows = [(name, *a.shape, bytearray(a.tobytes())) if a is not None else (name, None, None, None, None) for name, a in pages.items()]
    return spark.createDataFrame(rows, "page_id string, height int, width int, channels int, data binary")


def by_ink(lines):
    """Stands for a recogniser: how much of a line is dark, in tenths, as a letter, a blank and that letter again: 'd§d'."""
    out = np.full((len(lines), 7, len(CHARSET) + 1), -20.0, np.float32)
    for row, line in zip(out, lines):
        lit = line[0][:, (line[0] > 0).any(axis=0)]  # without the black sides
        letter = 1 + min(9, int(10 * (lit < 0).mean()))
        for t, s in enumerate((letter, letter, 0, 11, 0, letter, 12)):
            row[t, s] = 20.0
    return out


DETECT = ocr.Detector(dark, patch=64)
READ = ocr.Recogniser(by_ink, 200, 40, CHARSET)
PAGES = {
    "two": page((20, 40, 180, 12), (30, 104, 60, 12), (120, 106, 80, 12)),
    "empty": page(),
    "specks": page((10, 10, 2, 2), (100, 40, 30, 5)),
    "none": None,
}


def test_text_of_each_line(spark):
    got = {r.page_id: r for r in ocr.run(table(spark, PAGES), DETECT, READ, ocr.Settings(k_factor=0.8)).collect()}
    assert {k: (r.status, r.error) for k, r in got.items()} == {"two": ("success", None), "empty": ("failed", "No lines detected"), "specks": ("failed", "No valid lines after filtering"), "none": ("failed", "no image")}
    lines = got["two"].lines
    assert [(r.ord, r.x, r.y, r.w, r.h, r.n_chunks) for r in lines] == [(0, 20, 40, 180, 12, 1), (1, 30, 104, 170, 14, 2)]
    assert all(len(r.text) == 3 and r.text[1] == " " and r.text[0] == r.text[2] for r in lines)
    assert all(r.n_beams > 1 and len(r.logits) == r.n_beams and 0 < r.ctc_conf <= 1 for r in lines) and lines[0].norm_logp == pytest.approx(lines[0].logits[0] / 3)
    apart = ocr.run(table(spark, PAGES), DETECT, READ, ocr.Settings(k_factor=0.8, merge_lines=False, drop_spaces=True)).filter("page_id = 'two'").first().lines
    assert [(r.x, r.y) for r in apart] == [(20, 40), (30, 104), (120, 106)]
    assert ocr.run(table(spark, PAGES).limit(0), DETECT, READ).count() == 0


def test_order_is_by_centres(spark):
    """A wide bar that starts left of a narrow one but has its centre right of it comes second."""
    img = page((10, 40, 40, 12), (60, 44, 30, 12), (4, 100, 200, 12))
    got = ocr.run(table(spark, {"p": img}), DETECT, None, ocr.Settings(merge_lines=False, calculate_threshold=False)).first().lines
    assert [r.x for r in got] == [10, 60, 4]
    assert ocr.reading_order([(100, 10), (60, 12), (5, 90)], 20) == [[2], [1, 0]]


def test_a_model_that_fails_fails_its_page_only(spark):
    def moody(tiles):
        if tiles.mean() < 0.9:
            raise RuntimeError("too dark")
        return dark(tiles)

    got = {r.page_id: r for r in ocr.run(table(spark, {"a": page((20, 40, 180, 12)), "b": np.zeros((64, 64, 3), np.uint8)}), ocr.Detector(moody, patch=64, black_and_white=False), None).collect()}
    assert got["a"].status == "success" and got["b"].error == "Line detection failed: too dark" and got["b"].lines == []


def test_tilted_pages_are_turned(spark):
    straight = page(*[(60, y, 200, 14) for y in (60, 110, 160)], shape=(256, 320))
    tilted = 255 - P.rotate(255 - straight, -2.0)
    got = {r.page_id: r for r in ocr.run(table(spark, {"p": tilted, "q": 255 - P.rotate(255 - straight, 2.0)}), DETECT, None, ocr.Settings(artifacts=True)).collect()}
    assert got["p"].angle == pytest.approx(2, abs=0.3) and got["p"].applied_angle == got["p"].angle
    assert [r.h < 20 for r in got["p"].lines] == [True] * 3
    assert got["q"].angle < -1.5 and got["q"].applied_angle == 0 and all(r.h >= 20 for r in got["q"].lines)
    mask = np.frombuffer(got["p"].line_mask, np.uint8).reshape(256, 320)
    turned = np.frombuffer(got["p"].rotated_mask, np.uint8).reshape(256, 320)
    assert set(np.unique(mask)) == {0, 255} and (mask != turned).any() and len(got["p"].contours_filtered) == 3


def test_curved_pages_are_straightened(spark):
    img = page(shape=(192, 576))
    for base in (24, 80, 128):
        for x in range(30, 540):
            y = base + int(26 * ((x - 285) / 255) ** 2)
            img[y : y + 12, x] = 0
    flat = page(*[(30, y, 500, 12) for y in (24, 80, 128)], shape=(192, 576))
    got = {r.page_id: r for r in ocr.run(table(spark, {"bent": img, "flat": flat}), ocr.Detector(dark, patch=192, black_and_white=False), None, ocr.Settings(dewarp=True)).collect()}
    assert (got["flat"].dewarped, got["flat"].tps_ratio) == (False, 0.0)
    assert got["bent"].dewarped and got["bent"].tps_ratio == 1.0
    assert [r.h < 30 for r in got["bent"].lines if r.w > 300] == [True] * 3


def test_layout_models(spark):
    """Two classes: dark above the middle is a header, below it lines."""
    def classes(tiles):
        d = dark(tiles)
        top = np.arange(tiles.shape[2])[None, :, None] < tiles.shape[2] // 2
        return np.stack([-d, np.where(top, d, -50), np.where(top, -50, d)], axis=1)

    d = ocr.Detector(classes, patch=256, classes=("background", "header", "line"), black_and_white=False)
    img = page((20, 20, 100, 14), (20, 160, 180, 14), (20, 220, 180, 14), shape=(256, 256))
    assert [(r.x, r.y) for r in ocr.run(table(spark, {"p": img}), d, None).first().lines] == [(20, 160), (20, 220)]
    boxes = {(r["class"]): (r.x, r.y, r.w, r.h) for r in ocr.layout_boxes(table(spark, {"p": img}), d, ["header", "line"]).collect()}
    assert boxes == {"header": (20, 20, 100, 14), "line": (20, 160, 180, 74)}
    with pytest.raises(ValueError):
        ocr.layout_boxes(table(spark, {"p": img}), d, ["footer"])


def test_model_flags():
    """swap_hw and squeeze_channel change what the model is given; logits may come with symbols first."""
    seen = []

    def model(x):
        seen.append(x.shape)
        return by_ink(x.reshape(len(x), 1, 40, 200) if x.shape[-1] == 200 else x.reshape(len(x), 200, 40).transpose(0, 2, 1)[:, None]).transpose(0, 2, 1)

    line = page((0, 0, 100, 20), shape=(20, 200))
    texts = set()
    for swap in (False, True):
        for squeeze in (False, True):
            r = ocr.Recogniser(model, 200, 40, CHARSET, True, swap, squeeze)
            texts.add(next(r.read([line], ocr.Settings()))[0])
    assert seen == [(1, 1, 40, 200), (1, 40, 200), (1, 1, 200, 40), (1, 200, 40)] and len(texts) == 1
    no_blank = ocr.Recogniser(lambda x: by_ink(x), 200, 40, ("<blk>", *CHARSET), add_blank=False)
    assert next(no_blank.read([line], ocr.Settings()))[0] in texts


def test_batch_detection_gives_every_page(spark):
    pages = PAGES | {"low": page((4, 4, 40, 8), shape=(32, 100))}  # lower than a tile, so inferred at twice its size
    got = {r.image_name: r for r in ocr.detections(table(spark, pages), ocr.Detector(dark, patch=64, black_and_white=False)).collect()}
    assert {k: r.num_contours for k, r in got.items()} == {"two": 3, "empty": 0, "specks": 2, "none": 0, "low": 1}
    assert {tuple(b.asDict().values()) for b in got["two"].bboxes} == {(20, 40, 180, 12), (30, 104, 60, 12), (120, 106, 80, 12)}
    assert got["low"].image_height == 32 and abs(got["low"].bboxes[0].x - 4) <= 1


def exported(spark, angle=0.0):
    c = [(0, 0), (5, 0), (10, 0), (10, 4), (0, 4)]
    rows = [("p<1>", 1, c, "b & c", 0, 8, 10, 4, 100, 50, angle), ("p<1>", 0, c, None, 0, 0, 10, 4, 100, 50, angle)]
    return spark.createDataFrame(rows, "page_id string, ord int, contour array<struct<x:int,y:int>>, text string, x int, y int, w int, h int, image_width int, image_height int, angle double")


def test_exports(spark):
    lines = exported(spark)
    ns = {"p": export.PAGE_NS}
    root = etree.fromstring(export.page_xml(lines, "2024-01-01T00:00:00").first().xml)
    at = root.find("p:Page", ns)
    assert at.attrib == {"imageFilename": "p<1>", "imageWidth": "100", "imageHeight": "50"} and root.find("p:Metadata/p:Creator", ns).text == "Transkribus"
    found = at.findall("p:TextRegion/p:TextLine", ns)
    assert [(x.get("id"), x.get("custom"), x.find("p:TextEquiv/p:Unicode", ns).text) for x in found] == [("line_9874_0", "readingOrder {index: 0;}", None), ("line_9874_1", "readingOrder {index: 1;}", "b & c")]
    assert at.find("p:ReadingOrder/p:OrderedGroup/p:RegionRefIndexed", ns).get("regionRef") == at.find("p:TextRegion", ns).get("id")
    plain = json.loads(export.page_json(lines).first().json)
    assert plain["textbox"] == "0,0 10,0 10,12 0,12" and plain["lines"][0] == "0,0 5,0 10,0 10,4 0,4 " and plain["text"] == ["", "b & c"]
    assert json.loads(export.page_json(lines, optimise=True).first().json)["lines"][0] == "0,0 10,0 10,4 0,4 "
    assert json.loads(export.page_json(lines, bbox=True).first().json)["lines"] == ["0,0 10,0 10,4 0,4", "0,8 10,8 10,12 0,12"]
    turned = json.loads(export.page_json(exported(spark, 180.0), angle="angle", optimise=True).first().json)["lines"][0].split()
    assert {tuple(map(int, p.split(","))) for p in turned} <= {(x, y) for x in range(89, 101) for y in range(45, 51)}
    assert json.loads(export.page_json(exported(spark), angle="angle").first().json) == plain


def test_job(spark, tmp_path):
    summary = job.run_job(table(spark, PAGES), DETECT, READ, str(tmp_path), "j1", ocr.Settings(k_factor=0.8), ("text", "xml", "json"), "2024-01-01T00:00:00", {"k_factor": "0.8"}).first()
    assert (summary.total_pages, summary.successful_pages, summary.total_lines_detected) == (4, 1, 2)
    root = tmp_path / "j1"
    assert len((root / "results/text/page=two").glob("*.txt").__next__().read_text().splitlines()) == 2
    etree.fromstring(next((root / "results/xml/page=two").glob("*.txt")).read_text())
    log = spark.read.json(str(root / "audit"))
    assert log.filter("level = 'ERROR'").count() == 3 and log.filter("status = 'failure' and level = 'INFO'").count() == 3 and log.count() == 11
    kept = json.loads(next((root / "manifest").glob("*.txt")).read_text())
    assert kept["job_id"] == "j1" and {a["name"] for a in kept["artifacts"]} == {"pages", "lines", "detections", "results/text", "results/xml", "results/json", "metrics", "summary", "audit", "config"}
    assert spark.read.parquet(str(root / "lines")).filter("text is not null").count() == 2
    with pytest.raises(ValueError):
        job.run_job(table(spark, PAGES), DETECT, READ, str(tmp_path), "j2", exports=("pdf",))
    with pytest.raises(Exception, match="(?i)exists"):
        job.run_job(table(spark, PAGES), DETECT, READ, str(tmp_path), "j1")


def test_command_line(spark, tmp_path, capsys):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    for v in ("v1", "v2"):
        (tmp_path / "in" / v).mkdir(parents=True)
        (tmp_path / "in" / v / "p1.png").write_bytes(png(PAGES["two"][:, :, 0].tolist()))
    (tmp_path / "in" / "v2" / "broken.png").write_bytes(b"no image")
    try:
        base = ["--model", "m", "--line-model", "l", "--k-factor", "0.8", "--output", str(tmp_path / "out")]
        assert cli.main(["ocr", *base, "--folder", str(tmp_path / "in"), "--merge-lines", "--save-artifacts", "--artifact-output", str(tmp_path / "jobs"), "--job-id", "j"], spark, DETECT, READ) == 0
        assert "2 of 3 pages, 4 lines" in capsys.readouterr().out
        assert spark.read.parquet(str(tmp_path / "out" / "text")).count() == 2
        assert spark.read.parquet(str(tmp_path / "jobs" / "j" / "pages")).filter("line_mask is not null").count() == 2
        assert cli.main(["lines", "-i", str(tmp_path / "in"), "-o", str(tmp_path / "lines"), "-c", "l"], spark, DETECT) == 0
        assert spark.read.parquet(str(tmp_path / "lines")).agg(F.sum("num_contours")).first()[0] == 6
        with pytest.raises(SystemExit):
            cli.main(["ocr", *base], spark, DETECT, READ)
        with pytest.raises(FileNotFoundError):
            cli.main(["lines", "-i", str(tmp_path / "in"), "-c", str(tmp_path)], spark)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_models_are_compared(spark, tmp_path):
    """Three line images in natural order against their labels; one can't be read."""
    line = lambda w: page((0, 0, w, 20), shape=(20, 200))
    read = {w: next(READ.read([P.binarise(line(w))], ocr.Settings()))[0] for w in (60, 150)}
    rows = [("d", "p10", line(150)), ("d", "p9", line(60)), ("d", "p11", None), ("e", "x", line(60))]
    images = spark.createDataFrame([(d, n, *(a.shape if a is not None else (None,) * 3), bytearray(a.tobytes()) if a is not None else None) for d, n, a in rows], "distribution string, name string, height int, width int, channels int, data binary")
    labels = spark.createDataFrame([("d", "l1", read[60]), ("d", "l2", read[150] + "z"), ("d", "l3", "ab")], "distribution string, name string, label string")
    got = evaluation.evaluate_model(images, labels, READ, "m", ocr.Settings())
    assert {(r.image_name, r.label_name): round(r.cer, 4) for r in got.collect()} == {("p9", "l1"): 0.0, ("p10", "l2"): 0.25, ("p11", "l3"): 1.0}
    evaluation.write_scores(got, str(tmp_path / "scores"))
    assert spark.read.parquet(str(tmp_path / "scores")).filter("distribution = 'd' and architecture = 'm'").count() == 3
    assert evaluation.one_of(got, 1).collect() == evaluation.one_of(got.repartition(3), 1).collect()
