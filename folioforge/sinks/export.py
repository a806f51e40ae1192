"""Exports: text, JSON lines, PageXML, Parquet; as column expressions over a page's ordered lines, and as writers."""

from __future__ import annotations

from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.functions.geometry import bbox_string, contour_string, rotated
from folioforge.functions.text import xml_escape
from folioforge.operators.pixels import simplify
from folioforge.schemas import CONTOUR_TYPE

# The PAGE schema's namespace and place, and the names that its readers expect.
PAGE_NS = "http://schema.primaresearch.org/PAGE/gts/pagecontent/2013-07-15"
XSI = "http://www.w3.org/2001/XMLSchema-instance"
CREATOR, REGION, ORDER, CAPTION, LINE = "Transkribus", "region_main", "1234_0", "Regions reading order", "line_9874_"


class Exporter(Protocol):
    """Lines in reading order -> a row a page."""

    def __call__(self, lines: DataFrame, page: str = "page_id") -> DataFrame: ...


@F.arrow_udf(CONTOUR_TYPE)
def simplified(contours: pa.Array) -> pa.Array:
    """Contours with a tolerance of a thousandth of their length."""
    rows = [c and [{"x": int(x), "y": int(y)} for x, y in simplify(np.array([(p["x"], p["y"]) for p in c]))] for c in contours.to_pylist()]
    return pa.array(rows, pa.list_(pa.struct([("x", pa.int32()), ("y", pa.int32())])))


def with_points(lines: DataFrame, angle: str | None = None, optimise: bool = False, bbox: bool = False) -> DataFrame:
    """Adds points, each line's outline as text: its contour, turned about the page's centre by column `angle` (0: as it is) and simplified if asked
    for, or the corners of its box. What it is made from stays as it was, so exports don't change each other's."""
    if bbox:
        return lines.withColumn("points", bbox_string(F.struct("x", "y", "w", "h")))
    c = F.col("contour")
    if angle is not None:
        turned = rotated(c, F.floor(F.col("image_width") / 2).cast("int"), F.floor(F.col("image_height") / 2).cast("int"), F.col(angle))
        c = F.when(F.coalesce(F.col(angle), F.lit(0.0)) != 0, turned).otherwise(c)
    return lines.withColumn("points", contour_string(simplified(c) if optimise else c))


def _pages(lines: DataFrame, page: str, *more: Column) -> DataFrame:
    """A row a page: its lines (l: ord, points, text) in reading order and the box around them."""
    one = F.struct("ord", "points", F.coalesce("text", F.lit("")).alias("text"))
    g = lines.groupBy(page).agg(F.array_sort(F.collect_list(one)).alias("l"), F.min("x").alias("x"), F.min("y").alias("y"), F.max(F.col("x") + F.col("w")).alias("x2"), F.max(F.col("y") + F.col("h")).alias("y2"), *more)
    return g.withColumn("box", bbox_string(F.struct("x", "y", (F.col("x2") - F.col("x")).alias("w"), (F.col("y2") - F.col("y")).alias("h"))))


def page_text(lines: DataFrame, page: str = "page_id") -> DataFrame:
    """(page_id, ord, text) -> a page's lines in reading order, each ended by a newline."""
    g = lines.groupBy(page).agg(F.array_sort(F.collect_list(F.struct("ord", F.coalesce("text", F.lit("")).alias("text")))).alias("l"))
    return g.select(page, F.concat(F.array_join(F.transform("l", lambda x: x["text"]), "\n"), F.lit("\n")).alias("text"))


def page_json(lines: DataFrame, page: str = "page_id", angle: str | None = None, optimise: bool = False, bbox: bool = False) -> DataFrame:
    """(page_id, ord, contour, text, x, y, w, h[, image_width, image_height]) -> one JSON object a page: image, textbox (its corners), lines (points), text."""
    g = _pages(with_points(lines, angle, optimise, bbox), page)
    return g.select(page, F.to_json(F.struct(F.col(page).cast("string").alias("image"), F.col("box").alias("textbox"), F.transform("l", lambda x: x["points"]).alias("lines"), F.transform("l", lambda x: x["text"]).alias("text"))).alias("json"))


def text_line(i: Column, points: Column, text: Column) -> Column:
    return F.concat(F.lit(f'<TextLine id="{LINE}'), i.cast("string"), F.lit('" custom="readingOrder {index: '), i.cast("string"), F.lit(';}"><Coords points="'), F.trim(points), F.lit('"/><TextEquiv><Unicode>'), xml_escape(text), F.lit("</Unicode></TextEquiv></TextLine>"))


def page_xml(lines: DataFrame, created: str, creator: str = CREATOR, page: str = "page_id", angle: str | None = None, optimise: bool = False, bbox: bool = False) -> DataFrame:
    """(page_id, ord, contour, text, x, y, w, h, image_width, image_height) -> a PageXML document a page. Lines without text keep an empty one;
    the region's reference stands inside the reading order's group."""
    g = _pages(with_points(lines, angle, optimise, bbox), page, F.max("image_width").alias("iw"), F.max("image_height").alias("ih"))
    body = F.array_join(F.transform("l", lambda x, i: text_line(i, x["points"], x["text"])), "")
    head = f'<?xml version="1.0" encoding="UTF-8"?><PcGts xmlns="{PAGE_NS}" xmlns:xsi="{XSI}" xsi:schemaLocation="{PAGE_NS} {PAGE_NS}/pagecontent.xsd"><Metadata><Creator>{creator}</Creator><Created>{created}</Created></Metadata><Page imageFilename="'
    order = f'"><ReadingOrder><OrderedGroup id="{ORDER}" caption="{CAPTION}"><RegionRefIndexed index="0" regionRef="{REGION}"/></OrderedGroup></ReadingOrder><TextRegion id="{REGION}" custom="readingOrder {{index:0;}}"><Coords points="'
    return g.select(page, F.concat(
        F.lit(head), xml_escape(F.col(page).cast("string")), F.lit('" imageWidth="'), F.col("iw").cast("string"), F.lit('" imageHeight="'), F.col("ih").cast("string"),
        F.lit(order), F.col("box"), F.lit('"/>'), body, F.lit("</TextRegion></Page></PcGts>")).alias("xml"))


EXPORTERS: dict[str, Exporter] = {"text": page_text, "json": page_json, "xml": page_xml}


def ocr_lines(lines: DataFrame) -> DataFrame:
    """The recognised lines' schema; what is missing is null, norm_logp is the score a character."""
    have = set(lines.columns)
    col = lambda c, t: (F.col(c) if c in have else F.lit(None)).cast(t).alias(c)
    norm = F.col("norm_logp").cast("float") if "norm_logp" in have else (F.col("logit_score") / F.greatest(F.length("text"), F.lit(1))).cast("float") if "logit_score" in have else F.lit(None).cast("float")
    beams = (F.col("n_beams") if "n_beams" in have else F.size("logits") if "logits" in have else F.lit(None)).cast("smallint")
    return lines.select(col("guid", "string"), col("text", "string"), col("encoding", "string"), col("ctc_conf", "float"), norm.alias("norm_logp"), beams.alias("n_beams"), col("logits", "array<float>"), col("lm_scores", "array<float>"))


def line_detections(regions: DataFrame, page: str = "page_id") -> DataFrame:
    """A row a page: contours and boxes of its regions in order."""
    one = F.struct("ord", "contour", F.struct("x", "y", "w", "h").alias("bbox"))
    g = regions.groupBy(page).agg(F.array_sort(F.collect_list(one)).alias("l"), F.max("image_width").alias("image_width"), F.max("image_height").alias("image_height"))
    return g.select(F.col(page).cast("string").alias("image_name"), "image_width", "image_height", F.size("l").alias("num_contours"), F.transform("l", lambda x: x["contour"]).alias("contours"), F.transform("l", lambda x: x["bbox"]).alias("bboxes"))


def write_parquet(df: DataFrame, path: str, *partition_by: str, mode: str = "error") -> None:
    df.write.mode(mode).option("compression", "zstd").partitionBy(*partition_by).parquet(path)


def write_text(pages: DataFrame, path: str, column: str, *partition_by: str, mode: str = "error") -> None:
    pages.select(column, *partition_by).write.mode(mode).partitionBy(*partition_by).text(path)
