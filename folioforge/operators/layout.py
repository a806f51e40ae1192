"""From detected regions to ordered lines: filters, page angle, boxes, grouping into reading order, dewarping decisions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioforge.functions import geometry as G
from folioforge.operators.pixels import convex_hull
from folioforge.schemas import CONTOUR_TYPE

LINE_THRESHOLDS = {"line": 0.9, "layout": 0.8, "batch": 0.9, "cli": 0.85, "book": 0.8}


def usable_line(box: Column, image_width: Column) -> Column:
    """Wider than 1 % of the page and higher than 10 pixels."""
    return (box["w"] > image_width * 0.01) & (box["h"] > 10)


def sizeable(contour: Column, least: float = 10.0) -> Column:
    return G.area(contour) > least


def sizeable_in(contour: Column, mask_width: Column, mask_height: Column) -> Column:
    """Over a thousandth of the mask."""
    return G.area(contour) > mask_width * mask_height * 0.001


def known_classes(df: DataFrame, wanted: list[str], known: list[str], column: str = "class") -> DataFrame:
    if unknown := sorted(set(wanted) - set(known)):
        raise ValueError(f"unknown classes: {unknown}")
    return df.filter(F.col(column).isin(*wanted)) if wanted else df


def page_angle(rects: DataFrame, page: str = "page_id", angle: str = "angle") -> DataFrame:
    """Angles of the lines' least rectangles, in degrees -> (page_id, angle, applied_angle).

    Low: not 0 and under 5; high: over 85, but 90 off. More low than high: mean of the low; else, if any is high, mean of the high less 90; else 0.
    Only a page over half a degree is turned.
    """
    a = F.col(angle)
    low, high = (a != 0) & (a < 5), (F.abs(a) != 90) & (a > 85)
    g = rects.groupBy(page).agg(F.count_if(low).alias("n_low"), F.count_if(high).alias("n_high"), F.avg(F.when(low, a)).alias("low"), F.avg(F.when(high, a)).alias("high"))
    turn = F.when((F.col("n_low") > F.col("n_high")) & (F.col("n_low") > 0), F.col("low")).when(F.col("n_high") > 0, -(90 - F.col("high"))).otherwise(0.0)
    return g.select(page, turn.alias("angle"), F.when(turn > 0.5, turn).otherwise(0.0).alias("applied_angle"))


def union_bbox(boxes: DataFrame, *keys: str) -> DataFrame:
    """(keys, x, y, w, h) -> least box around all of them."""
    g = boxes.groupBy(*keys).agg(F.min("x").alias("x"), F.min("y").alias("y"), F.max(F.col("x") + F.col("w")).alias("x2"), F.max(F.col("y") + F.col("h")).alias("y2"))
    return g.select(*keys, "x", "y", (F.col("x2") - F.col("x")).alias("w"), (F.col("y2") - F.col("y")).alias("h"))


def text_bbox(lines: DataFrame, page: str = "page_id") -> DataFrame:
    """A text box whose width is the widest line's and whose height the last line's lower edge, beside the true extent (extent_w, extent_h)."""
    g = lines.groupBy(page).agg(F.min("x").alias("x"), F.min("y").alias("y"), F.max("w").alias("w"), F.max_by(F.col("y") + F.col("h"), "ord").alias("h"), F.max(F.col("x") + F.col("w")).alias("x2"), F.max(F.col("y") + F.col("h")).alias("y2"))
    return g.select(page, "x", "y", "w", "h", (F.col("x2") - F.col("x")).alias("extent_w"), (F.col("y2") - F.col("y")).alias("extent_h"))


def group_lines(lines: DataFrame, threshold: float = 20, page: str = "page_id") -> DataFrame:
    """lines (page_id, ord, x, y, ...) -> with grp and place, both from 0 in reading order; all rows and columns stay.

    In the order of ord, a line opens a new group if its y is more than threshold off the mean y of the open group. Groups are read last
    first, the lines of one by x, then ord. The running mean restarts with each group, so this is a fold: it runs over rows sorted by page, whole batches
    of pages at once, and holds a batch and the page that it ends in. Lines are numbered in a window by page, which shuffles once, or not at all where they
    lie by page already. Lines of equal ord go by y, then x; a null ord is first, a null page a page like any; a line without y stays in the open group.
    """

    def fold(t: pa.Table) -> list[pa.RecordBatch]:
        """Of whole pages."""
        first = t.column(number).to_numpy() == 1
        groups, group, total, n = [], -1, 0.0, 0
        for v, new in zip(t.column("y").to_pylist(), first.tolist(), strict=True):
            if new or (v is not None and n and abs(total / n - v) > threshold):
                group, total, n = group + 1, 0.0, 0
            groups.append(group)
            if v is not None:
                total, n = total + v, n + 1
        group, row = np.array(groups), np.arange(len(groups))
        start = np.flatnonzero(first)
        end = np.append(start[1:], len(row))
        at = np.cumsum(first) - 1
        grp = group[end - 1][at] - group  # groups are numbered on from page to page
        x = t.column("x")
        key = x.cast(pa.float64()).fill_null(-np.inf).to_numpy()
        place = np.empty(len(row), np.int32)
        place[np.lexsort((row, key, grp, at))] = row - start[at]
        t = t.drop_columns([number]).append_column("grp", pa.array(grp.astype(np.int32))).append_column("place", pa.array(place))
        return t.combine_chunks().to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for b in batches:
            starts = np.flatnonzero(b.column(b.num_columns - 1).to_numpy() == 1)
            if len(starts):
                last = int(starts[-1])
                held.append(b.slice(0, last))
                if whole := [h for h in held if h.num_rows]:
                    yield from fold(pa.Table.from_batches(whole))
                held = []
                b = b.slice(last)
            held.append(b)
        if whole := [h for h in held if h.num_rows]:
            yield from fold(pa.Table.from_batches(whole))

    rows = lines.drop("grp", "place")
    number = "__n"
    while number in [c.lower() for c in rows.columns]:
        number += "_"
    schema = T.StructType([*rows.schema.fields, T.StructField("grp", T.IntegerType()), T.StructField("place", T.IntegerType())])
    numbered = rows.withColumn(number, F.row_number().over(Window.partitionBy(page).orderBy("ord", "y", "x")))
    return numbered.mapInArrow(run, schema)


@F.arrow_udf(CONTOUR_TYPE)
def hull(contours: pa.Array) -> pa.Array:
    rows = [None if c is None else [{"x": int(x), "y": int(y)} for x, y in convex_hull(np.array([(p["x"], p["y"]) for p in c]))] if c else [] for c in contours.to_pylist()]
    return pa.array(rows, pa.list_(pa.struct([("x", pa.int32()), ("y", pa.int32())])))


def merge_groups(grouped: DataFrame, page: str = "page_id") -> DataFrame:
    """Lines of one group as one: union box, centre and, if lines have contours, these end to end in reading order and their hull; a line alone
    in its group keeps its contour as hull."""
    more = []
    if "contour" in grouped.columns:
        more = [F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("place", "contour"))), lambda x: x["contour"])).alias("contour")]
    g = grouped.groupBy(page, "grp").agg(F.min("x").alias("x"), F.min("y").alias("y"), F.max(F.col("x") + F.col("w")).alias("x2"), F.max(F.col("y") + F.col("h")).alias("y2"), F.count(F.lit(1)).alias("n_lines"), *more)
    w, h = F.col("x2") - F.col("x"), F.col("y2") - F.col("y")
    out = [page, "grp", "x", "y", w.alias("w"), h.alias("h"), "n_lines", (F.col("x") + F.floor(w / 2)).cast("int").alias("cx"), (F.col("y") + F.floor(h / 2)).cast("int").alias("cy")]
    if more:
        out += ["contour", F.when(F.col("n_lines") > 1, hull("contour")).otherwise(F.col("contour")).alias("hull")]
    return g.select(*out)


def line_threshold(slices: DataFrame, page: str = "page_id") -> DataFrame:
    """Slices of a page (step, n contours, ys of their centres) -> threshold: of the slice with most contours, the first of equals,
    median centre over their number."""
    best = slices.groupBy(page).agg(F.max_by(F.struct("n", "ys"), F.struct("n", -F.col("step"))).alias("b"))
    ys = F.array_sort("b.ys")
    n = F.size(ys)
    mid = (F.get(ys, F.floor((n - 1) / 2).cast("int")) + F.get(ys, F.floor(n / 2).cast("int"))) / 2
    return best.select(page, F.when(n > 0, F.floor(mid / F.greatest(F.col("b.n"), F.lit(1)))).otherwise(0).cast("int").alias("threshold"))


def curvature(slices: DataFrame, *keys: str) -> DataFrame:
    """Slices of a line (y of the centre, h) -> curved (spread of centres over the mean height), target (mean centre, half to even)."""
    g = slices.groupBy(*keys).agg((F.max("y") - F.min("y")).alias("spread"), F.avg("h").alias("height"), F.avg("y").alias("mean"))
    return g.select(*keys, (F.col("spread") > F.col("height")).alias("curved"), F.when(F.col("spread") > F.col("height"), F.col("spread")).otherwise(0).alias("yd"), G.half_even(F.col("mean")).alias("target"))


def curved_ratio(lines: DataFrame, page: str = "page_id") -> DataFrame:
    return lines.groupBy(page).agg(F.try_divide(F.count_if("curved"), F.count(F.lit(1))).alias("ratio"))


def needs_dewarp(ratio: Column, threshold: float = 0.25) -> Column:
    return ratio > threshold


def global_curve(lines: DataFrame, page: str = "page_id") -> DataFrame:
    """Of the lines with yd > 0 the one nearest to the page's mean yd (zeros included), the first of equals."""
    mean = F.avg("yd").over(Window.partitionBy(page))
    near = lines.withColumn("__m", mean).filter("yd > 0").withColumn("__d", F.abs(F.col("yd") - F.col("__m")))
    return near.groupBy(page).agg(F.min_by("ord", F.struct("__d", "ord")).alias("ord"))


def class_boxes(boxes: DataFrame, page: str = "page_id") -> DataFrame:
    """(page_id, class, x, y, w, h) -> layout JSON {class: {bbox: {x, y, w, h}}} a page; classes without a region are left out."""
    one = union_bbox(boxes, page, "class").withColumn("v", F.struct(F.struct("x", "y", "w", "h").alias("bbox")))
    return one.groupBy(page).agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("class", "v"))))).alias("layout"))
