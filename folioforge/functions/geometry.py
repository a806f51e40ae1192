"""Sizes, boxes and contours as column expressions. Contours are arrays of (x, y) structs, boxes (x, y, w, h) structs."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_even(x: Column) -> Column:
    return F.bround(x).cast("int")


def to_width(w: Column, h: Column, width: int) -> tuple[Column, Column]:
    return F.lit(width), (h * F.lit(width) / w).cast("int")


def to_height(w: Column, h: Column, height: int) -> tuple[Column, Column]:
    return (w * F.lit(height) / h).cast("int"), F.lit(height)


def clamped(w: Column, h: Column, patch: int = 512, max_width: int = 4096, max_height: int = 2048) -> tuple[Column, Column]:
    """Size before tiling: wide pages over max_width and tall pages over max_height shrink, pages lower than a patch grow; a square
    page is never shrunk."""
    a, b, c = (w > h) & (w > max_width), (h > w) & (h > max_height), h < patch
    (wa, ha), (wb, hb), (wc, hc) = to_width(w, h, max_width), to_height(w, h, max_height), to_height(w, h, patch)
    return F.when(a, wa).when(b, wb).when(c, wc).otherwise(w).cast("int"), F.when(a, ha).when(b, hb).when(c, hc).otherwise(h).cast("int")


def batch_clamped(w: Column, h: Column, patch: int = 512, max_width: int = 4096, max_height: int = 2048) -> tuple[Column, Column, Column, Column]:
    """As clamped(), the other side rounded half to even; with the scales of both sides."""
    a, b, c = (w > h) & (w > max_width), (h > w) & (h > max_height), h < patch
    nw = F.when(a, F.lit(max_width)).when(b, half_even(w * F.lit(max_height) / h)).when(c, half_even(w * F.lit(patch) / h)).otherwise(w)
    nh = F.when(a, half_even(h * F.lit(max_width) / w)).when(b, F.lit(max_height)).when(c, F.lit(patch)).otherwise(h)
    return nw.cast("int"), nh.cast("int"), nw / w, nh / h


def steps(size: Column, patch: int) -> Column:
    return F.ceil(size / patch).cast("int")


def padding(size: Column, patch: int) -> Column:
    """What is missing to a multiple of patch."""
    return F.pmod(F.lit(patch) - F.pmod(size, F.lit(patch)), F.lit(patch)).cast("int")


def to_polar(x: Column, y: Column) -> tuple[Column, Column]:
    return F.atan2(y, x), F.hypot(x, y)


def from_polar(theta: Column, rho: Column) -> tuple[Column, Column]:
    return rho * F.cos(theta), rho * F.sin(theta)


def rotated(contour: Column, cx: Column, cy: Column, degrees: Column) -> Column:
    """Each point turned about (cx, cy); the offset from the centre is cut to whole pixels, toward zero."""

    def turn(p: Column) -> Column:
        theta, rho = to_polar((p["x"] - cx).cast("double"), (p["y"] - cy).cast("double"))
        turned = F.radians(F.pmod(F.degrees(theta) + degrees, F.lit(360.0)))
        x, y = from_polar(turned, rho)
        return F.struct((x.cast("int") + cx).cast("int").alias("x"), (y.cast("int") + cy).cast("int").alias("y"))

    return F.transform(contour, turn)


def inside(px: Column, py: Column, box: Column) -> Column:
    return px.between(box["x"], box["x"] + box["w"]) & py.between(box["y"], box["y"] + box["h"])


def to_original(v: Column, scale: Column) -> Column:
    return half_even(v / scale)


def contour_to_original(contour: Column, sx: Column, sy: Column) -> Column:
    return F.transform(contour, lambda p: F.struct(to_original(p["x"], sx).alias("x"), to_original(p["y"], sy).alias("y")))


def bbox_to_original(box: Column, sx: Column, sy: Column) -> Column:
    return F.struct(to_original(box["x"], sx).alias("x"), to_original(box["y"], sy).alias("y"), to_original(box["w"], sx).alias("w"), to_original(box["h"], sy).alias("h"))


def bbox_of(contour: Column) -> Column:
    """Bounding box in pixels: a single point is 1 x 1."""
    xs, ys = F.transform(contour, lambda p: p["x"]), F.transform(contour, lambda p: p["y"])
    x, y = F.array_min(xs), F.array_min(ys)
    return F.struct(x.alias("x"), y.alias("y"), (F.array_max(xs) - x + 1).alias("w"), (F.array_max(ys) - y + 1).alias("h"))


def centre_of(box: Column) -> Column:
    return F.struct((box["x"] + F.floor(box["w"] / 2)).cast("int").alias("x"), (box["y"] + F.floor(box["h"] / 2)).cast("int").alias("y"))


def area(contour: Column) -> Column:
    """Of the polygon, by the shoelace formula."""
    n = F.size(contour)
    cross = F.transform(contour, lambda p, i: p["x"].cast("long") * F.get(contour, F.pmod(i + 1, n))["y"] - F.get(contour, F.pmod(i + 1, n))["x"].cast("long") * p["y"])
    return F.abs(F.aggregate(cross, F.lit(0).cast("long"), lambda a, b: a + b)) / 2.0


def contour_string(contour: Column) -> Column:
    """'x,y x,y ' with a blank after each point; nothing for no points."""
    points = F.array_join(F.transform(contour, lambda p: F.concat_ws(",", p["x"], p["y"])), " ")
    return F.when(F.size(contour) > 0, F.concat(points, F.lit(" "))).otherwise("")


def bbox_string(box: Column) -> Column:
    """Corners clockwise from the top left."""
    x2, y2 = box["x"] + box["w"], box["y"] + box["h"]
    return F.format_string("%d,%d %d,%d %d,%d %d,%d", box["x"], box["y"], x2, box["y"], x2, y2, box["x"], y2)


def tile_grid(pages, patch: int = 512):
    """pages (page_id, width, height) -> a row a tile, row-major: page_id, ty, tx, x, y, x_steps, y_steps, pad_x, pad_y."""
    w, h = F.col("width"), F.col("height")
    d = pages.withColumns({"x_steps": steps(w, patch), "y_steps": steps(h, patch), "pad_x": padding(w, patch), "pad_y": padding(h, patch)})
    d = d.filter("x_steps > 0 and y_steps > 0").withColumn("i", F.explode(F.sequence(F.lit(0), F.col("x_steps") * F.col("y_steps") - 1)))
    ty, tx = F.floor(F.col("i") / F.col("x_steps")).cast("int"), F.pmod("i", "x_steps").cast("int")
    return d.select("page_id", ty.alias("ty"), tx.alias("tx"), (tx * patch).alias("x"), (ty * patch).alias("y"), "x_steps", "y_steps", "pad_x", "pad_y")


def degrees_of(radians: float) -> float:
    return math.degrees(radians)
