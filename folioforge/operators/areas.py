"""Where a page's text is, and pictures of what was found on it: kernels on NumPy arrays, and their use on tables of pages through Arrow."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.functions import geometry as G
from folioforge.operators import pixels as P

# Colours of region classes, red, green, blue.
COLOURS = {
    "background": (0, 0, 0),
    "image": (45, 255, 0),
    "text": (255, 243, 0),
    "margin": (0, 0, 255),
    "caption": (255, 100, 243),
    "table": (0, 255, 0),
    "pagenr": (0, 100, 15),
    "header": (255, 0, 0),
    "footer": (255, 255, 100),
    "line": (0, 100, 255),
}


def largest(contours: DataFrame, *keys: str, contour: str = "contour", ord: str = "ord") -> DataFrame:
    """(keys, ord, contour) -> the contour of greatest area for each key, the first of equals; one shuffle, combined before it."""
    a = F.when(F.size(contour) > 0, G.area(F.col(contour))).otherwise(0.0)
    best = F.max_by(F.struct(F.col(ord).alias("ord"), F.col(contour).alias("contour"), "area"), F.struct("area", -F.col(ord)))
    return contours.withColumn("area", a).groupBy(*keys).agg(best.alias("best")).select(*keys, "best.*")


def text_area(mask: np.ndarray, width: int, height: int) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """(mask at the page's size, mask of the box around all text, its contour): lines are dilated by 12 x 2 pixels ten times, so that they run
    together, and the largest region is the text. None if there is none."""
    found = P.contours(P.resize(P.dilate(mask, 2, 12, 10), width, height))
    if not found:
        return None
    contour = max(found, key=P.contour_area)
    x, y, w, h = P.box_of(contour)
    area = np.zeros((height, width), np.uint8)
    area[y : y + h + 1, x : x + w + 1] = 255
    return P.resize(mask, width, height), area, contour


def lines_inside(mask: np.ndarray, contour: np.ndarray) -> list[np.ndarray]:
    """Contours of a mask whose least rectangle's centre lies in the box around another contour, its border included."""
    x, y, w, h = P.box_of(contour)
    centres = [(c, P.least_rectangle(c)[:2]) for c in P.contours(mask)]
    return [c for c, (cx, cy) in centres if x <= cx <= x + w and y <= cy <= y + h]


def centroid(p: np.ndarray) -> tuple[int, int]:
    """Of a polygon's area, cut to whole pixels; the mean of the points if it has none."""
    x, y = p[:, 0].astype(float), p[:, 1].astype(float)
    cross = x * np.roll(y, -1) - np.roll(x, -1) * y
    if not cross.sum():
        return int(x.mean()), int(y.mean())
    return tuple(int(((v + np.roll(v, -1)) * cross).sum() / (3 * cross.sum())) for v in (x, y))


def turned(p: np.ndarray, centre: tuple[int, int], degrees: float) -> np.ndarray:
    """Points turned about a centre, offsets cut to whole pixels: as geometry.rotated."""
    d = (p - centre).astype(float)
    t = np.radians((np.degrees(np.arctan2(d[:, 1], d[:, 0])) + degrees) % 360)
    r = np.hypot(d[:, 0], d[:, 1])
    return np.stack([r * np.cos(t), r * np.sin(t)], axis=1).astype(int) + centre


def straightened(img: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float] | None:
    """(page, mask, contour of its text, angle): all turned by the angle of the lines within the text's box. None for a mask without text."""
    got = text_area(mask, img.shape[1], img.shape[0])
    if got is None:
        return None
    mask, area, contour = got
    inside = P.mask_and_crop(mask, area)[:, :, 0]
    angle = P.page_angle(inside) if inside.size else 0.0
    return P.rotate(img, angle), P.rotate(mask, angle), turned(contour, centroid(contour), angle), angle


def filled(shape: tuple[int, int], contours: list[np.ndarray], colour: tuple[int, ...] = (255,)) -> np.ndarray:
    """Contours in one colour on black; (height, width) if the colour is one number."""
    out = np.zeros((*shape, len(colour)), np.uint8)
    for c in contours:
        if len(c):
            out[P.fill(shape, c) > 0] = colour
    return out[:, :, 0] if len(colour) == 1 else out


def outlined(img: np.ndarray, p: np.ndarray, colour: tuple[int, ...] = (0, 255, 0), thickness: int = 2) -> np.ndarray:
    """A closed polygon's border on a copy of an image."""
    out, h, w = img.copy(), *img.shape[:2]
    lo = (thickness - 1) // 2
    for (x1, y1), (x2, y2) in zip(p.tolist(), np.roll(p, -1, axis=0).tolist(), strict=True):
        n = max(abs(x2 - x1), abs(y2 - y1), 1)
        t = np.arange(n + 1) / n
        at = np.stack([np.floor(x1 + (x2 - x1) * t + 0.5), np.floor(y1 + (y2 - y1) * t + 0.5)], axis=1).astype(int)
        for dy in range(-lo, thickness - lo):
            for dx in range(-lo, thickness - lo):
                q = at + (dx, dy)
                q = q[(q[:, 0] >= 0) & (q[:, 0] < w) & (q[:, 1] >= 0) & (q[:, 1] < h)]
                out[q[:, 1], q[:, 0]] = colour
    return out


def box_outlined(img: np.ndarray, box: tuple[int, int, int, int], colour: tuple[int, ...] = (0, 255, 0), thickness: int = 2) -> np.ndarray:
    x, y, w, h = box
    return outlined(img, np.array([(x, y), (x + w, y), (x + w, y + h), (x, y + h)]), colour, thickness)


def overlaid(img: np.ndarray, layer: np.ndarray, alpha: float = 0.4) -> np.ndarray:
    """alpha of a layer over the rest of an image, rounded half to even."""
    if layer.ndim < img.ndim:
        layer = layer[:, :, None]
    return np.clip(np.rint(layer * alpha + img * (1 - alpha)), 0, 255).astype(np.uint8)


def preview(img: np.ndarray, regions: dict[str, list[np.ndarray]], alpha: float = 0.4) -> np.ndarray:
    """A page under its regions, filled in their classes' colours, later classes over earlier ones. Channels are taken as red, green, blue."""
    layer = np.zeros(img.shape, np.uint8)
    for name, contours in regions.items():
        for c in contours:
            if len(c):
                layer[P.fill(img.shape[:2], c) > 0] = COLOURS[name]
    return overlaid(img, layer, alpha)


def png(img: np.ndarray) -> bytes:
    """An image of one channel, or of red, green, blue, as a PNG file."""
    a = img[:, :, None] if img.ndim == 2 else img
    h, w, c = a.shape
    kind = {1: 0, 3: 2, 4: 6}[c]

    def chunk(name: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + name + data + struct.pack(">I", zlib.crc32(name + data))

    rows = np.concatenate([np.zeros((h, 1), np.uint8), np.ascontiguousarray(a, np.uint8).reshape(h, w * c)], axis=1)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, kind, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(rows.tobytes())) + chunk(b"IEND", b"")


POINTS = "array<struct<x:int,y:int>>"


def page_previews(pages: DataFrame, alpha: float = 0.4, order: tuple[str, ...] = ("image", "line", "caption", "margin")) -> DataFrame:
    """pages (page_id, height, width, channels, data, regions array<struct<class, contour>>) -> (page_id, height, width, png). Classes of `order`
    are drawn in it, others before them by name; an unknown class is an error. Pages are taken as blue, green, red, as they are read. A page without an image
    has a null picture, one without regions is darkened only."""
    kind = pages.schema["page_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                img, found, out = P.image_of(b, i), {}, None
                if img is not None:
                    for r in b.column(5)[i].as_py() or []:
                        if r and r["contour"]:
                            found.setdefault(r["class"], []).append(np.array([(p["x"], p["y"]) for p in r["contour"]]))
                    names = sorted(found, key=lambda n: (order.index(n) if n in order else -1, n))
                    out = png(preview(img[:, :, ::-1], {n: found[n] for n in names}, alpha))
                yield pa.RecordBatch.from_arrays([*[b.column(j).slice(i, 1) for j in range(3)], pa.array([out], pa.binary())], ["page_id", "height", "width", "png"])

    rows = pages.select("page_id", F.col("height").cast("int"), F.col("width").cast("int"), F.col("channels").cast("int"), "data", F.col("regions").cast(f"array<struct<class:string,contour:{POINTS}>>"))
    return rows.mapInArrow(run, f"page_id {kind}, height int, width int, png binary")


def text_boxes(pages: DataFrame) -> DataFrame:
    """Masks (page_id, height, width, channels, data) with page_height and page_width -> (page_id, x, y, w, h, n_lines): the box around each page's text
    and the number of lines inside. Pages without text have no row."""
    kind = pages.schema["page_id"].dataType.simpleString()
    names = ["x", "y", "w", "h", "n_lines"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found, rows = [], []
            for i in range(b.num_rows):
                img = P.image_of(b, i)
                got = None if img is None else text_area(img[:, :, 0], b.column(6)[i].as_py(), b.column(5)[i].as_py())
                if got is not None:
                    mask, _, contour = got
                    found.append(i)
                    rows.append((*P.box_of(contour), len(lines_inside(mask, contour))))
            if found:
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(found)), *[pa.array(v, pa.int32()) for v in zip(*rows, strict=True)]], ["page_id", *names])

    rows = pages.select("page_id", "height", "width", "channels", "data", F.col("page_height").cast("int"), F.col("page_width").cast("int"))
    return rows.mapInArrow(run, f"page_id {kind}, " + ", ".join(f"{n} int" for n in names))
