"""Text areas, previews, local dewarping, model folders, and a real model file."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioforge.operators import areas as A
from folioforge.operators import pixels as P
from folioforge.operators import recognise
from folioforge.plans import ocr
from folioforge.plans.catalogue import dark
from folioforge.sources import files


def bars(shape, *boxes, value=255):
    out = np.zeros(shape, np.uint8)
    for x, y, w, h in boxes:
        out[y : y + h, x : x + w] = value
    return out


def test_text_area_is_the_largest_region():
    mask = bars((300, 400), (40, 100, 200, 10), (40, 130, 200, 10), (380, 5, 4, 4))
    full, area, contour = A.text_area(mask, 400, 300)
    assert (full == mask).all() and P.box_of(contour) == (40, 50, 210, 150)  # 50 up, 60 down, 10 to the right
    assert A.text_area(np.zeros((40, 40), np.uint8), 80, 80) is None
    assert [P.box_of(c)[:2] for c in A.lines_inside(mask, contour)] == [(40, 100), (40, 130)]
    assert area[50:201, 40:251].all() and area.sum() == 151 * 211 * 255


@pytest.mark.parametrize("degrees", [-2.0, 0.0, 3.0])
def test_straightened(degrees):
    mask = P.rotate(bars((300, 400), *[(60, 60 + 40 * i, 280, 12) for i in range(5)]), degrees)
    mask = np.where(mask > 127, 255, 0).astype(np.uint8)
    page, turned, contour, angle = A.straightened(np.repeat(mask[:, :, None], 3, axis=2), mask)
    assert angle == pytest.approx(-degrees, abs=0.3) and page.shape == (300, 400, 3) and len(contour) > 3
    left = [c for c in P.contours(np.where(turned > 127, 255, 0)) if P.contour_area(c) > 1000]
    assert max(P.box_of(c)[3] for c in left) <= 16
    assert A.straightened(np.zeros((40, 40, 3), np.uint8), np.zeros((20, 20), np.uint8)) is None


def test_turned_equals_the_column(spark):
    from folioforge.functions import geometry as G

    p = np.array([(0, 0), (50, 3), (61, 47), (-9, 20)])
    rows = spark.createDataFrame([([(int(x), int(y)) for x, y in p],)], "c array<struct<x:int,y:int>>")
    want = rows.select(G.rotated(F.col("c"), F.lit(20), F.lit(15), F.lit(33.5)).alias("c")).first().c
    assert A.turned(p, (20, 15), 33.5).tolist() == [[q.x, q.y] for q in want]
    assert A.centroid(np.array([(0, 0), (10, 0), (10, 20), (0, 20)])) == (5, 10) and A.centroid(np.array([(3, 4), (7, 4)])) == (5, 4)


def test_drawing():
    img = np.full((20, 30, 3), 200, np.uint8)
    box = A.box_outlined(img, (5, 5, 10, 8), (1, 2, 3), 1)
    assert (box[5, 5:16] == (1, 2, 3)).all() and (box[6:13, 6:15] == 200).all() and (img == 200).all()
    assert (A.filled((20, 30), [np.array([(2, 2), (6, 2), (6, 6), (2, 6)])]) > 0).sum() == 25
    line = np.array([(0, 0), (9, 0), (9, 9), (0, 9)])
    got = A.preview(img, {"image": [line], "line": [line[:, ::-1] + 5, np.zeros((0, 2), int)]})
    assert got[0, 0].tolist() == [138, 222, 120] and got[14, 14].tolist() == [120, 160, 222] and got[7, 7].tolist() == got[14, 14].tolist() and got[19, 29].tolist() == [120] * 3
    with pytest.raises(KeyError):
        A.preview(img, {"nothing": [line]})


def test_previews_can_be_read(spark, tmp_path):
    img = np.arange(6 * 8 * 3, dtype=np.uint8).reshape(6, 8, 3)
    square = [(1, 1), (3, 1), (3, 3), (1, 3)]
    rows = [("a", 6, 8, 3, bytearray(img.tobytes()), [("line", square), ("text", [])]), ("b", 6, 8, 3, bytearray(img.tobytes()), None), ("c", None, None, None, None, [("line", square)])]
    pages = spark.createDataFrame(rows, "page_id string, height int, width int, channels int, data binary, regions array<struct<class:string,contour:array<struct<x:int,y:int>>>>")
    got = {r.page_id: r.png for r in A.page_previews(pages, alpha=0.5).collect()}
    assert got["c"] is None
    for name in "ab":
        (tmp_path / f"{name}.png").write_bytes(got[name])
    read = {r.image_name: np.frombuffer(r.data, np.uint8).reshape(r.height, r.width, r.channels) for r in files.images(spark, str(tmp_path)).collect()}
    half = np.rint(img * 0.5).astype(np.uint8)
    assert (read["b"] == half).all()
    lit = np.zeros((6, 8, 3))
    lit[1:4, 1:4] = A.COLOURS["line"][::-1]
    assert (read["a"] == np.rint(lit * 0.5 + img * 0.5)).all()
    assert A.page_previews(pages.limit(0)).count() == 0


def test_scaled(spark):
    rows = [(1, 4, 8, 1, bytearray(range(32))), (2, None, None, None, None)]
    got = P.scaled(spark.createDataFrame(rows, "page_id long, height int, width int, channels int, data binary"), 16).orderBy("page_id").collect()
    assert (got[0].height, got[0].width, got[0].channels, len(got[0].data)) == (8, 16, 3, 384) and got[1].data is None and got[0].guid != got[1].guid


def arched(width=500, height=300):
    img, mask = np.full((height, width, 3), 255, np.uint8), np.zeros((height, width), np.uint8)
    for x in range(40, width - 40):
        y = int(height // 3 + 40 * np.sin((x - 40) / (width - 80) * np.pi))
        img[y : y + 12, x], mask[y : y + 12, x] = 0, 255
    return img, mask


def test_a_window_of_a_warp_is_a_part_of_it():
    img, mask = arched()
    contour = max(P.contours(mask), key=P.contour_area)
    curved, centres, level, spread = P.line_curve(mask.shape, contour)
    assert curved and spread > 0
    part, line = P.unbent_line(img, contour, centres, level, 12, 20)
    x, y, w, h = P.box_of(contour)
    where = slice(y - 20, y + h + 20), slice(x - 12, x + w + 12)
    assert (part == P.unbend(img, centres, level)[where]).all() and (line == P.unbend(mask, centres, level)[where]).all()


def test_curved_lines_by_themselves(spark):
    img, mask = arched()
    whole, alone = (P.extract_lines(img, [max(P.contours(mask), key=P.contour_area)], 1.2, 20.0, local)[0][0] for local in (False, True))
    assert alone.shape[0] < whole.shape[0] and alone.shape[1] > 300
    straight = P.extract_lines(img, [np.array([(50, 200), (400, 200), (400, 215), (50, 215)])], 1.2, 2.0, True)
    assert (straight[0][0] == P.extract_lines(img, [np.array([(50, 200), (400, 200), (400, 215), (50, 215)])], 1.2, 2.0)[0][0]).all()
    page = spark.createDataFrame([("p", *img.shape, bytearray(img.tobytes()))], "page_id string, height int, width int, channels int, data binary")
    read = ocr.run(page, ocr.Detector(dark, patch=64), None, ocr.Settings(dewarp=True, tps_mode="local", k_factor=1.2, bbox_tolerance=20.0), images=True).first()
    assert read.status == "success" and read.dewarped and len(read.lines) == 1 and read.lines[0].image_height < whole.shape[0]


def test_largest(spark):
    def square(n):
        return [(0, 0), (n, 0), (n, n), (0, n)]

    rows = [("p", 0, square(3)), ("p", 1, square(5)), ("p", 2, square(5)), ("q", 0, []), (None, 4, square(1)), ("r", 7, None)]
    df = spark.createDataFrame(rows, "page string, ord int, contour array<struct<x:int,y:int>>")
    assert {(r.page, r.ord, r.area) for r in A.largest(df, "page").collect()} == {("p", 1, 25.0), ("q", 0, 0.0), (None, 4, 1.0), ("r", 7, 0.0)}
    assert A.largest(df.limit(0), "page").count() == 0


def test_model_folders(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        files.model_in(spark, str(tmp_path / "none"))
    (tmp_path / "model.json").write_text(json.dumps({"onnx-model": "m.onnx", "charset": "ab", "add_blank": "yes"}))
    assert files.model_in(spark, str(tmp_path)).first().add_blank is True
    (tmp_path / "other.json").write_text("{}")
    with pytest.raises(ValueError):
        files.model_in(spark, str(tmp_path))
    (tmp_path / "lm.binary").write_bytes(b"x")
    (tmp_path / "lm.arpa").write_text("\\data\\\n\n\\1-grams:\n-1.0\tka\n# no\n-2.0\tkha\t-0.5\n\n\\end\\\n")
    row = files.language_model_in(spark, str(tmp_path)).first()
    assert row.unigrams == ["ka", "kha"] and row.model.endswith("lm.binary")
    (tmp_path / "empty.txt").write_text("\\data\\\n")
    assert files.language_model(spark, "m", str(tmp_path / "empty.txt")).first().unigrams is None
    assert files.theme(spark, str(tmp_path / "other.json")) == {} and files.theme(spark, str(tmp_path / "no.json")) is None


def identity_model(name: str = "x", rank: int = 4) -> bytes:
    """An ONNX file of one Identity node on floats, written out by hand."""

    def field(number: int, value: bytes | int) -> bytes:
        if isinstance(value, int):
            return bytes([number << 3, value])
        assert len(value) < 16384
        size = bytes([len(value)]) if len(value) < 128 else bytes([len(value) & 127 | 128, len(value) >> 7])
        return bytes([number << 3 | 2]) + size + value

    def tensor(n: str) -> bytes:
        shape = b"".join(field(1, field(2, f"d{i}".encode())) for i in range(rank))
        return field(1, n.encode()) + field(2, field(1, field(1, 1) + field(2, shape)))

    node = field(1, name.encode()) + field(2, b"y") + field(4, b"Identity")
    graph = field(1, node) + field(2, b"g") + field(11, tensor(name)) + field(12, tensor("y"))
    return field(1, 8) + field(7, graph) + field(8, field(1, b"") + field(2, 13))


def test_a_model_file(spark, tmp_path):
    pytest.importorskip("onnxruntime")
    path = str(tmp_path / "same.onnx")
    (tmp_path / "same.onnx").write_bytes(identity_model())
    assert "CPUExecutionProvider" in recognise.providers()
    assert recognise.describe(path) == {"inputs": [("x", "tensor(float)", ("d0", "d1", "d2", "d3"))], "outputs": [("y", "tensor(float)", ("d0", "d1", "d2", "d3"))]}
    # As a line model it takes each channel for the logits of a class.
    runner = recognise.onnx_runner(path, "x", "y")
    tiles = np.random.default_rng(0).random((2, 3, 8, 8), np.float32)
    assert (runner(tiles) == tiles).all()
    img = np.zeros((64, 64, 3), np.uint8)
    img[20:40, 10:50, 1] = 255
    page = spark.createDataFrame([("p", *img.shape, bytearray(img.tobytes()))], "page_id string, height int, width int, channels int, data binary")
    layout = ocr.Detector(recognise.onnx_runner(path, "x", "y"), patch=64, classes=("a", "b", "c"), threshold=0.5, black_and_white=False)
    assert {(r["class"], r.x, r.y, r.w, r.h) for r in ocr.layout_boxes(page, layout).collect()} == {("b", 10, 20, 40, 20)}
