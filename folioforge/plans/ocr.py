"""The page pipeline: masks, lines, dewarping, line images, recognised text.

A page is the unit of work: run() takes each through all stages in one pass under Arrow, so nothing is shuffled and no tile, mask or line image
leaves the task that made it, unless it is asked for. Page rows are large; keep `spark.sql.execution.arrow.maxRecordsPerBatch` at a few pages.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.functions.scalars import line_guid
from folioforge.functions.text import vocabulary
from folioforge.operators import pixels as P
from folioforge.operators.decode import oriented, prefix_beams
from folioforge.operators.recognise import onnx_runner, sigmoid_mask, softmax_mask

Model = Callable[[np.ndarray], np.ndarray]


@dataclass(frozen=True)
class Settings:
    merge_lines: bool = True
    k_factor: float = 2.5
    bbox_tolerance: float = 4.0
    dewarp: bool = False
    dewarp_threshold: float = 0.25
    #: global: the page by its most typical curved line; local: each curved line by itself.
    tps_mode: str = "global"
    #: Distance of lines: from the mask, or else this.
    calculate_threshold: bool = True
    group_threshold: float = 20
    #: Only pages turned by more are turned back; pages that lean the other way have a negative angle and stay as they are.
    least_angle: float = 0.5
    prepad: bool = False
    beams: int = 10
    #: Blanks that were read as such don't count, as in evaluation.
    drop_spaces: bool = False
    encoding: str = "unicode"
    #: Keep masks and contours of each page.
    artifacts: bool = False


@dataclass(frozen=True)
class Detector:
    """model: tiles (n, 3, patch, patch) of 0 or 1 -> logits (n, [1,] patch, patch), or (n, classes, patch, patch) with classes."""

    model: Model
    patch: int = 512
    classes: tuple[str, ...] = ()
    line_class: str = "line"
    threshold: float | None = None  # 0.9 for lines alone, 0.8 for a class
    batch: int = 8
    black_and_white: bool = True  # tiles are made so first

    def mask(self, img: np.ndarray) -> np.ndarray:
        """Page -> 0 or 255 for each of its pixels."""
        big, px, py = P.preprocess(img, self.patch)
        return P.crop_prediction(self.whole(big), px, py, img.shape[1], img.shape[0]) * 255

    def whole(self, big: np.ndarray) -> np.ndarray:
        """A page of whole tiles -> 0 or 1 for each pixel."""
        rows = P.tile(big, self.patch)
        cut = [P.normalise(P.binarise(t) if self.black_and_white else t).transpose(2, 0, 1) for row in rows for t in row]
        found = []
        for s in range(0, len(cut), self.batch):
            y = self.model(np.stack(cut[s : s + self.batch]))
            if self.classes:
                m = softmax_mask(y, self.classes.index(self.line_class), 0.8 if self.threshold is None else self.threshold)
            else:
                m = sigmoid_mask(y, 0.9 if self.threshold is None else self.threshold)
            found += list(m.reshape(-1, self.patch, self.patch))
        n = len(rows[0])
        return P.stitch([found[i * n : i * n + n] for i in range(len(rows))])

    def detections(self, img: np.ndarray) -> list[np.ndarray]:
        """All contours of a page, taken at the size at which it is inferred and scaled back, half to even."""
        h, w = img.shape[:2]
        scale = 4096 / w if w > h and w > 4096 else 2048 / h if h > w and h > 2048 else self.patch / h if h < self.patch else 1.0
        nw, nh = round(w * scale), round(h * scale)
        big = P.pad(P.resize(img, nw, nh), -nw % self.patch, -nh % self.patch)
        return [np.stack([[round(x / (nw / w)) for x in c[:, 0].tolist()], [round(y / (nh / h)) for y in c[:, 1].tolist()]], axis=1) for c in P.contours(self.whole(big)[:nh, :nw])]


@dataclass(frozen=True)
class Recogniser:
    """model: lines (n, 1, height, width) in -1..1 -> logits (n, time, symbols), or symbols and time the other way. With swap_hw it takes width before
    height, with squeeze_channel no channel axis."""

    model: Model
    width: int
    height: int
    charset: tuple[str, ...]
    add_blank: bool = True
    swap_hw: bool = False
    squeeze_channel: bool = False
    batch: int = 16

    def logits(self, lines: list[np.ndarray], prepad: bool) -> Iterator[np.ndarray]:
        """(time, symbols) of each line."""
        n = len(vocabulary(self.charset, self.add_blank)[0])
        for s in range(0, len(lines), self.batch):
            x = np.stack([P.prepare_line(line, self.width, self.height, prepad) for line in lines[s : s + self.batch]])
            x = x.transpose(0, 1, 3, 2) if self.swap_hw else x
            for y in self.model(x[:, 0] if self.squeeze_channel else x):
                yield oriented(y, n)

    def read(self, lines: list[np.ndarray], s: Settings) -> Iterator[tuple[str, list[float]]]:
        """(text, log scores of the beams, best first) of each line."""
        symbols, blank = vocabulary(self.charset, self.add_blank)
        for y in self.logits(lines, s.prepad):
            beams = prefix_beams(y, s.beams, blank)
            text = "".join(symbols[i] for i in beams[0][0]) if beams else ""
            text = text.strip().replace(" ", "") if s.drop_spaces else text.strip()
            yield text.replace("§", " "), [score for _, score in beams]


def detector_of(config, **more) -> Detector:
    """From a row of sources.files.model_configs(): a line model, or a layout model if it names more classes than one."""
    classes = tuple(config.classes or ())
    return Detector(onnx_runner(config.onnx_file.removeprefix("file:"), "input", "output"), config.patch_size or 512, classes if len(classes) > 1 else (), **more)


def recogniser_of(config, **more) -> Recogniser:
    run = onnx_runner(config.onnx_file.removeprefix("file:"), config.input_layer, config.output_layer)
    return Recogniser(run, config.input_width, config.input_height, tuple(config.charset), bool(config.add_blank), bool(config.swap_hw), bool(config.squeeze_channel_dim), **more)


@dataclass
class Page:
    """What the stages have found so far."""

    img: np.ndarray
    mask: np.ndarray
    angle: float = 0.0
    applied_angle: float = 0.0
    raw: list[np.ndarray] = field(default_factory=list)
    contours: list[np.ndarray] = field(default_factory=list)
    tps_ratio: float | None = None
    dewarped: bool = False
    local: bool = False
    threshold: float = 0.0
    lines: list[dict] = field(default_factory=list)


class Failed(ValueError):
    """A page that a stage can do nothing with."""


def build_lines(img: np.ndarray, mask: np.ndarray, s: Settings) -> Page:
    """Turned by the lines' angle, if that is over least_angle; contours that can be lines: wider than 1 % of the page and higher than 10 pixels."""
    angle = P.page_angle(mask)
    applied = angle if angle > s.least_angle else 0.0
    if applied:
        img, mask = P.rotate(img, angle), P.rotate(mask, angle)
    page = Page(img, mask, angle, applied, P.line_contours(mask))
    boxes = [P.box_of(c) for c in page.raw]
    page.contours = [c for c, (_, _, w, h) in zip(page.raw, boxes, strict=True) if w > img.shape[1] * 0.01 and h > 10]
    return page


def dewarp(page: Page, s: Settings) -> Page:
    """Warped by the most typical curved line if more than dewarp_threshold of the lines are curved; lines are then built anew. With tps_mode local the
    page stays, and extract_lines straightens each curved line."""
    curves = [P.line_curve(page.mask.shape, c) for c in page.contours]
    ratio = sum(c[0] for c in curves) / len(curves)
    if ratio <= s.dewarp_threshold:
        return replace(page, tps_ratio=ratio)
    if s.tps_mode == "local":
        return replace(page, tps_ratio=ratio, dewarped=True, local=True)
    _, centres, level, _ = curves[P.global_curve(curves)]
    new = build_lines(P.unbend(page.img, centres, level), P.unbend(page.mask, centres, level), s)
    return replace(new, tps_ratio=ratio, dewarped=True)


def reading_order(centres: list[tuple[int, int]], threshold: float) -> list[list[int]]:
    """Groups of lines, in reading order: see operators.layout.group_lines."""
    groups: list[list[int]] = []
    for i, (_, y) in enumerate(centres):
        if groups and abs(np.mean([centres[j][1] for j in groups[-1]]) - y) <= threshold:
            groups[-1].append(i)
        else:
            groups.append([i])
    return [sorted(g, key=lambda i: centres[i][0]) for g in reversed(groups)]


def centre(box: tuple[int, int, int, int]) -> tuple[int, int]:
    return box[0] + box[2] // 2, box[1] + box[3] // 2


def extract_lines(page: Page, first_mask: np.ndarray, s: Settings) -> Page:
    """Lines in reading order with their images. The distance of lines is taken from the mask as it was before dewarping."""
    simple = [P.simplify(c) for c in page.contours]
    page.threshold = P.line_threshold(first_mask) if s.calculate_threshold else s.group_threshold
    groups = reading_order([centre(P.box_of(c)) for c in simple], page.threshold)
    if s.merge_lines:
        merged = [(P.convex_hull(np.concatenate([simple[i] for i in g])) if len(g) > 1 else simple[g[0]], len(g)) for g in groups]
    else:
        merged = [(simple[i], 1) for g in groups for i in g]
    for (c, n), (image, k) in zip(merged, P.extract_lines(page.img, [c for c, _ in merged], s.k_factor, s.bbox_tolerance, page.local), strict=True):
        (x, y, w, h), (cx, cy) = P.box_of(c), centre(P.box_of(c))
        points = [{"x": int(a), "y": int(b)} for a, b in c]
        page.lines.append({"ord": len(page.lines), "contour": points, "x": x, "y": y, "w": w, "h": h, "cx": cx, "cy": cy, "n_chunks": n, "k": k, "image": image})
    return page


def recognise(page: Page, recogniser: Recogniser, s: Settings) -> Page:
    """Adds text and scores; a line whose image is empty has none."""
    lines = [line for line in page.lines if line["image"].size]
    for line, (text, scores) in zip(lines, recogniser.read([line["image"] for line in lines], s), strict=True):
        norm = scores[0] / max(len(text), 1) if scores else None
        conf = float(np.exp(norm)) if scores else None
        line |= {"text": text, "encoding": s.encoding, "ctc_conf": conf, "norm_logp": norm, "n_beams": len(scores), "logits": scores}
    return page


STAGES = {"detect": "Line detection failed", "build": "Line data building failed", "dewarp": "Line processing failed", "extract": "Line extraction failed", "recognise": "OCR processing failed"}


def read_page(img: np.ndarray, detector: Detector, recogniser: Recogniser | None, s: Settings) -> tuple[Page | None, np.ndarray | None, str | None]:
    """All stages -> (page, its mask as detected, error)."""
    mask, page, at = None, None, "detect"
    try:
        mask = detector.mask(img)
        at = "build"
        page = build_lines(img, mask, s)
        if not page.contours:
            return page, mask, "No valid lines after filtering" if page.raw else "No lines detected"
        first, at = page.mask, "dewarp"
        page = dewarp(page, s) if s.dewarp else page
        at = "extract"
        page = extract_lines(page, first, s)
        if not page.lines:
            return page, mask, "No valid line images extracted"
        at = "recognise"
        if recogniser is not None:
            page = recognise(page, recogniser, s)
    except Exception as e:  # whatever a page or a model does: the page has failed, the others go on
        return page, mask, f"{STAGES[at]}: {e}"
    return page, mask, None


POINTS = pa.list_(pa.struct([("x", pa.int32()), ("y", pa.int32())]))
NUMBER, FLOAT, TEXT = pa.int32(), pa.float64(), pa.string()
LINE = pa.struct([("ord", NUMBER), ("contour", POINTS), *[(c, NUMBER) for c in ("x", "y", "w", "h", "cx", "cy", "n_chunks")], ("k", FLOAT), ("image_height", NUMBER), ("image_width", NUMBER), ("image_channels", NUMBER), ("image", pa.binary()),
                  ("text", TEXT), ("encoding", TEXT), ("ctc_conf", FLOAT), ("norm_logp", FLOAT), ("n_beams", pa.int16()), ("logits", pa.list_(FLOAT))])
LINE_SQL = "struct<ord:int,contour:array<struct<x:int,y:int>>,x:int,y:int,w:int,h:int,cx:int,cy:int,n_chunks:int,k:double,image_height:int,image_width:int,image_channels:int,image:binary,text:string,encoding:string,ctc_conf:double,norm_logp:double,n_beams:smallint,logits:array<double>>"
PAGE_SQL = f"status string, error string, width int, height int, angle double, applied_angle double, tps_ratio double, dewarped boolean, threshold double, duration_ms double, lines array<{LINE_SQL}>, line_mask binary, rotated_mask binary, contours_raw array<array<struct<x:int,y:int>>>, contours_filtered array<array<struct<x:int,y:int>>>"


def _points(contours: list[np.ndarray]) -> list:
    return [[{"x": int(x), "y": int(y)} for x, y in c] for c in contours]


def _row(img: np.ndarray, page: Page | None, mask: np.ndarray | None, error: str | None, ms: float, s: Settings, images: bool) -> dict:
    lines = []
    for line in page.lines if page else []:
        a = line["image"]
        lines.append(line | {"image": a.tobytes() if images else None, "image_height": a.shape[0], "image_width": a.shape[1], "image_channels": a.shape[2]})
    out = {"status": "failed" if error else "success", "error": error, "width": img.shape[1], "height": img.shape[0], "duration_ms": ms, "lines": lines, "dewarped": bool(page and page.dewarped)}
    if page:
        out |= {"angle": page.angle, "applied_angle": page.applied_angle, "tps_ratio": page.tps_ratio, "threshold": page.threshold}
    if s.artifacts and mask is not None:
        out["line_mask"] = mask.tobytes()
        if page:
            out |= {"rotated_mask": page.mask.astype(np.uint8).tobytes(), "contours_raw": _points(page.raw), "contours_filtered": _points(page.contours)}
    return out


def run(pages: DataFrame, detector: Detector, recogniser: Recogniser | None = None, s: Settings = Settings(), images: bool = False) -> DataFrame:
    """pages (page_id, height, width, channels, data) -> a row a page: page_id, status, error, what was measured, and its lines in reading order.

    Without a recogniser lines have no text; with images they carry their pixels. A page that fails says at which stage and why, and has no lines;
    a null page, or one whose bytes don't fit its size, has failed too. Repeated pages give repeated rows, an empty table none.
    """
    kind = pages.schema["page_id"].dataType.simpleString()
    fields = [("status", TEXT), ("error", TEXT), ("width", NUMBER), ("height", NUMBER), ("angle", FLOAT), ("applied_angle", FLOAT), ("tps_ratio", FLOAT), ("dewarped", pa.bool_()), ("threshold", FLOAT), ("duration_ms", FLOAT), ("lines", pa.list_(LINE)),
              ("line_mask", pa.binary()), ("rotated_mask", pa.binary()), ("contours_raw", pa.list_(POINTS)), ("contours_filtered", pa.list_(POINTS))]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            schema = pa.schema([b.schema.field(0), *fields])
            for i in range(b.num_rows):
                img, start = P.image_of(b, i), time.perf_counter()
                row = {"status": "failed", "error": "no image", "width": b.column(2)[i].as_py(), "height": b.column(1)[i].as_py(), "dewarped": False, "lines": []}
                if img is not None:
                    row = _row(img, *read_page(img, detector, recogniser, s), (time.perf_counter() - start) * 1000, s, images)
                cols = [b.column(0).slice(i, 1), *[pa.array([row.get(name)], t) for name, t in fields]]
                yield pa.RecordBatch.from_arrays(cols, schema=schema)

    return pages.select("page_id", "height", "width", "channels", "data").mapInArrow(work, f"page_id {kind}, {PAGE_SQL}")


def lines(read: DataFrame) -> DataFrame:
    """Rows of run() -> a row a line, with its page's angle and size, and a guid from page and place."""
    one = read.select("page_id", F.col("width").alias("page_width"), F.col("height").alias("page_height"), "applied_angle", F.explode("lines").alias("l"))
    return one.select("page_id", "page_width", "page_height", "applied_angle", line_guid(F.col("page_id"), F.col("l.ord")).alias("guid"), "l.*")


def read_lines(images: DataFrame, recogniser: Recogniser, s: Settings = Settings(), key: str = "line_id", black_and_white: bool = False) -> DataFrame:
    """Line images (key, height, width, channels, data) -> (key, text, ctc_conf, norm_logp, n_beams). Those that are null or empty, or whose bytes don't fit
    their size, have null text. black_and_white: they are made so first, as when models are compared."""
    kind = images.schema[key].dataType.simpleString()
    types = [("text", TEXT), ("ctc_conf", FLOAT), ("norm_logp", FLOAT), ("n_beams", pa.int16())]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [P.image_of(b, i) for i in range(b.num_rows)]
            some = [P.binarise(x) if black_and_white else x for x in found if x is not None]
            read = iter(list(recogniser.read(some, s)))
            rows = []
            for x in found:
                text, scores = next(read) if x is not None else (None, [])
                norm = scores[0] / max(len(text), 1) if scores else None
                rows.append((text, float(np.exp(norm)) if scores else None, norm, len(scores)))
            cols = zip(*rows) if rows else [()] * 4
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, t) for c, (_, t) in zip(cols, types, strict=True)]], [key, *[n for n, _ in types]])

    return images.select(key, "height", "width", "channels", "data").mapInArrow(work, f"{key} {kind}, text string, ctc_conf double, norm_logp double, n_beams smallint")


def page_metrics(read: DataFrame) -> DataFrame:
    """A row a page, as schemas.PAGE_METRICS."""
    n = F.size("lines").cast("long")
    done = F.size(F.filter("lines", lambda x: x["text"].isNotNull())).cast("long")
    return read.select(F.col("page_id").cast("string").alias("image_name"), F.coalesce("duration_ms", F.lit(0.0)).alias("total_duration_ms"), n.alias("lines_detected"), done.alias("lines_processed"), F.col("dewarped").alias("dewarping_applied"), F.col("angle").alias("rotation_angle"), "status")


def detections(pages: DataFrame, detector: Detector) -> DataFrame:
    """pages -> schemas.LINE_DETECTION, a row a page: every contour that the line model gives, in the order of their first pixels. A page without any, or without an image,
    has none."""
    names = ["image_name", "image_width", "image_height", "num_contours", "contours", "bboxes"]
    box = pa.list_(pa.struct([(c, NUMBER) for c in "xywh"]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                img = P.image_of(b, i)
                found = [] if img is None else detector.detections(img)
                boxes = [dict(zip("xywh", P.box_of(c), strict=True)) for c in found]
                row = (b.column(0)[i].as_py(), b.column(2)[i].as_py(), b.column(1)[i].as_py(), len(found), _points(found), boxes)
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, (TEXT, NUMBER, NUMBER, NUMBER, pa.list_(POINTS), box), strict=True)], names)

    kind = "image_name string, image_width int, image_height int, num_contours int, contours array<array<struct<x:int,y:int>>>, bboxes array<struct<x:int,y:int,w:int,h:int>>"
    return pages.select(F.col("page_id").cast("string"), "height", "width", "channels", "data").mapInArrow(work, kind)


def layout_boxes(pages: DataFrame, detector: Detector, wanted: list[str] | None = None) -> DataFrame:
    """pages -> (page_id, class, x, y, w, h): for each class (or wanted one) that a layout model finds, the box around all it finds."""
    if unknown := sorted(set(wanted or ()) - set(detector.classes)):
        raise ValueError(f"unknown classes: {unknown}")
    kind = pages.schema["page_id"].dataType.simpleString()
    names = ["page_id", "class", "x", "y", "w", "h"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                img, found = P.image_of(b, i), []
                if img is not None:
                    for name in detector.classes:
                        if not wanted or name in wanted:
                            on = np.argwhere(replace(detector, line_class=name).mask(img))
                            if len(on):
                                (y, x), (y2, x2) = on.min(axis=0).tolist(), on.max(axis=0).tolist()
                                found.append((name, x, y, x2 - x + 1, y2 - y + 1))
                cols = list(zip(*found)) or [()] * 5
                yield pa.RecordBatch.from_arrays([pa.array([b.column(0)[i].as_py()] * len(found), b.schema.field(0).type), *[pa.array(v, t) for v, t in zip(cols, [TEXT] + [NUMBER] * 4, strict=True)]], names)

    return pages.select("page_id", "height", "width", "channels", "data").mapInArrow(work, f"page_id {kind}, class string, x int, y int, w int, h int")
