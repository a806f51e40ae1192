"""Registered queries of the document operators, and the SQL that says what each must return.

The driver's tables hold no page images, so pages are drawn from parts and suppliers; boxes come from lineitem (an order is a page), logits from
embeddings, reading order and text from conversations and documents, audit records from events. The SQL is written out by hand: it holds
none of the library's tables.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioforge.functions import geometry as G
from folioforge.functions import scalars as S
from folioforge.functions import text as T
from folioforge.operators import areas, charset, decode, evaluate, jobs, layout, pixels
from folioforge.plans import ocr
from folioforge.sinks import export
from folioforge.sources import files

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
CHARSET = list("abcdefghijklmnopqrstuvwxyz .,")


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


ORDER = "l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity"
BOXES = f"""b AS (SELECT l_orderkey AS page_id, (row_number() OVER (PARTITION BY l_orderkey ORDER BY {ORDER}) - 1)::INTEGER AS ord,
 (l_partkey % 1500)::INTEGER AS x, (l_suppkey % 90 * 12)::INTEGER AS y, (l_quantity * 8)::INTEGER AS w, (l_quantity % 40)::INTEGER AS h FROM lineitem)"""


def boxes(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("page_id").orderBy(*ORDER.split(", "))
    li = table(spark, d, "lineitem").withColumnRenamed("l_orderkey", "page_id")  # first, so that what follows by page finds lines by page
    return li.select("page_id", (F.row_number().over(w) - 1).alias("ord"), (F.col("l_partkey") % 1500).cast("int").alias("x"), (F.col("l_suppkey") % 90 * 12).cast("int").alias("y"), (F.col("l_quantity") * 8).cast("int").alias("w"), (F.col("l_quantity") % 40).cast("int").alias("h"))


def contour_of_box() -> F.Column:
    x, y, x2, y2 = F.col("x"), F.col("y"), F.col("x") + F.col("w"), F.col("y") + F.col("h")
    return F.array(*[F.struct(a.alias("x"), b.alias("y")) for a, b in ((x, y), (x2, y), (x2, y2), (x, y2))])


#: What labels hold and these documents don't: appended to them, as characters and as code points.
MARKS = "a\uf8f0b\uf038c\u00a0d\u0010e\tf\u200dg\uf037h\u0f0ci\u0f0bj"
MARK_CODES = "'a' || chr(63728) || 'b' || chr(61496) || 'c' || chr(160) || 'd' || chr(16) || 'e' || chr(9) || 'f' || chr(8205) || 'g' || chr(61495) || 'h' || chr(3852) || 'i' || chr(3851) || 'j'"


@query(f"""WITH t AS (SELECT doc_id, text || {MARK_CODES} AS t FROM documents),
d AS (SELECT doc_id, replace(replace(replace(replace(replace(replace(t, chr(63728), ' '), chr(61496), ''), chr(160), ''), chr(16), ''), chr(9), ''), chr(8205), '') AS t FROM t)
SELECT doc_id, replace(replace(replace(replace(t, chr(61495), ''), chr(3852), chr(3851)), '(', ''), ')', '') AS label FROM d""")
def text_clean(spark, d):
    return table(spark, d, "documents").select("doc_id", T.clean_label(F.concat("text", F.lit(MARKS))).alias("label"))


@query(r"""WITH a AS (SELECT doc_id, text || '\u0f85k\u0f09k\u0f13k\u0f12k\u0fd3k\u0fd4k\u0f00k\u0f7fk' || chr(65312) || 'k' || chr(2404) || 'k*k  k   k_[k]' AS t FROM documents),
b AS (SELECT doc_id, replace(replace(replace(replace(t, '\u0f85', '&'), '\u0f09', chr(228)), '\u0f13', chr(246)), '\u0f12', chr(252)) AS t FROM a),
c AS (SELECT doc_id, replace(replace(replace(replace(t, '\u0fd3', '@'), '\u0fd4', '#'), '\u0f00', 'oM'), '\u0f7f', '}') AS t FROM b),
d AS (SELECT doc_id, replace(replace(replace(t, chr(65312), '@'), chr(2404), '|'), '*', ' ') AS t FROM c)
SELECT doc_id, replace(replace(replace(replace(replace(t, '  ', ' '), '_', ''), '[', ''), ']', ''), ' ', chr(167)) AS label FROM d""")
def wylie_post(spark, d):
    marks = r"\u0f85k\u0f09k\u0f13k\u0f12k\u0fd3k\u0fd4k\u0f00k\u0f7fk" + "\uff20k\u0964k*k  k   k_[k]"
    return table(spark, d, "documents").select("doc_id", T.finish_wylie_label(F.concat("text", F.lit(marks))).alias("label"))


@query(f"SELECT doc_id, array_to_string(list_transform(list_filter(string_split(lower(text), ''), lambda c: c <> ''), lambda c: CASE WHEN strpos('{''.join(CHARSET)}', c) > 0 THEN strpos('{''.join(CHARSET)}', c) ELSE -1 END::INTEGER), ',') AS ids FROM documents")
def label_encode(spark, d):
    return table(spark, d, "documents").select("doc_id", F.array_join(T.encode_label(F.lower("text"), CHARSET), ",").alias("ids"))


@query("SELECT doc_id, regexp_replace(lower(text), '[^a-z .,]', '', 'g') AS label FROM documents")
def label_decode(spark, d):
    ids = T.encode_label(F.lower("text"), CHARSET)
    return table(spark, d, "documents").select("doc_id", T.decode_label(ids, CHARSET).alias("label"))


@query("SELECT symbol, count(*) AS n, count(DISTINCT doc_id) AS n_docs FROM (SELECT doc_id, unnest(string_split(text, '')) AS symbol FROM documents) WHERE symbol <> '' GROUP BY symbol")
def charset_stats(spark, d):
    return charset.symbol_counts(table(spark, d, "documents"))


@query("SELECT doc_id, (i - 1)::INTEGER AS ord, l[i] AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS l, unnest(generate_series(1, len(string_split(text, chr(10))))) AS i FROM documents)")
def text_lines(spark, d):
    return table(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("ord", "line"))


@query("SELECT doc_id, string_split(text, chr(10))[1] AS label FROM documents")
def first_line(spark, d):
    return table(spark, d, "documents").select("doc_id", T.first_line(F.col("text")).alias("label"))


@query("""SELECT vec_id, array_to_string(list_transform(list_filter(generate_series(1, 8), lambda i: p[i] <> 0 AND (i = 1 OR p[i] <> p[greatest(i - 1, 1)])), lambda i: substr('abcdefg', p[i], 1)), '') AS text
FROM (SELECT vec_id, list_transform(generate_series(0, 7), lambda t: (list_position(embedding[t * 8 + 1:t * 8 + 8], list_max(embedding[t * 8 + 1:t * 8 + 8])) - 1)::INTEGER) AS p FROM embeddings)""")
def ctc_greedy(spark, d):
    return table(spark, d, "embeddings").select("vec_id", decode.greedy_text(F.col("embedding"), 8, list("abcdefg")).alias("text"))


@query()
def ctc_beam(spark, d):
    e = table(spark, d, "embeddings").select("vec_id", F.transform("embedding", lambda x: x * 4).cast("array<float>").alias("embedding"))
    return decode.beam_decode(e, 8, list("abcdefg"), 10, "vec_id", "embedding")


@query("""SELECT vec_id, (i - 1)::INTEGER AS symbol, round(exp(e[i] - list_max(e)) / list_sum(list_transform(e, lambda y: exp(y - list_max(e)))), 6) AS p
FROM (SELECT vec_id, embedding::DOUBLE[] AS e, unnest(generate_series(1, len(embedding))) AS i FROM embeddings)""")
def softmax(spark, d):
    e = table(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("e"))
    return e.select("vec_id", F.posexplode(S.softmax(F.col("e"))).alias("symbol", "p")).withColumn("p", F.round("p", 6))


@query("SELECT vec_id, array_to_string(list_transform(embedding, lambda x: (1 / (1 + exp(-(x::DOUBLE))) > 0.55)::INTEGER), '') AS mask FROM embeddings")
def sigmoid_mask(spark, d):
    mask = S.above(F.transform("embedding", lambda x: S.sigmoid(x.cast("double"))), 0.55)
    return table(spark, d, "embeddings").select("vec_id", F.array_join(mask, "").alias("mask"))


@query("""WITH s AS (SELECT p_partkey AS page_id, (p_size * 37 + 60)::INTEGER AS width, (p_size * 53 % 900 + 100)::INTEGER AS height FROM part),
g AS (SELECT *, ceil(width / 256)::INTEGER AS x_steps, ceil(height / 256)::INTEGER AS y_steps FROM s),
t AS (SELECT *, unnest(generate_series(0, x_steps * y_steps - 1)) AS i FROM g)
SELECT page_id, (i // x_steps)::INTEGER AS ty, (i % x_steps)::INTEGER AS tx, (i % x_steps * 256)::INTEGER AS x, (i // x_steps * 256)::INTEGER AS y, x_steps, y_steps,
 (x_steps * 256 - width)::INTEGER AS pad_x, (y_steps * 256 - height)::INTEGER AS pad_y FROM t""")
def tile_grid(spark, d):
    size = F.col("p_size")
    return G.tile_grid(table(spark, d, "part").select(F.col("p_partkey").alias("page_id"), (size * 37 + 60).cast("int").alias("width"), (size * 53 % 900 + 100).cast("int").alias("height")), 256)


@query("""WITH s AS (SELECT p_partkey AS page_id, (p_size * 150 + 60)::INTEGER AS w, (p_size * 953 % 4000 + 100)::INTEGER AS h FROM part)
SELECT page_id, CASE WHEN w > h AND w > 4096 THEN 4096 WHEN h > w AND h > 2048 THEN trunc(w * 2048 / h) WHEN h < 512 THEN trunc(w * 512 / h) ELSE w END::INTEGER AS cw,
 CASE WHEN w > h AND w > 4096 THEN trunc(h * 4096 / w) WHEN h > w AND h > 2048 THEN 2048 WHEN h < 512 THEN 512 ELSE h END::INTEGER AS ch,
 CASE WHEN w > h AND w > 4096 THEN 4096 WHEN h > w AND h > 2048 THEN round_even(w * 2048 / h, 0) WHEN h < 512 THEN round_even(w * 512 / h, 0) ELSE w END::INTEGER AS bw,
 CASE WHEN w > h AND w > 4096 THEN round_even(h * 4096 / w, 0) WHEN h > w AND h > 2048 THEN 2048 WHEN h < 512 THEN 512 ELSE h END::INTEGER AS bh FROM s""")
def page_sizes(spark, d):
    w, h = (F.col("p_size") * 150 + 60).cast("int"), (F.col("p_size") * 953 % 4000 + 100).cast("int")
    (cw, ch), (bw, bh, _, _) = G.clamped(w, h), G.batch_clamped(w, h)
    return table(spark, d, "part").select(F.col("p_partkey").alias("page_id"), cw.alias("cw"), ch.alias("ch"), bw.alias("bw"), bh.alias("bh"))


@query("SELECT vec_id, (i - 1)::INTEGER AS i, (embedding[i] > 0)::INTEGER * 255 AS v FROM (SELECT vec_id, embedding, unnest(generate_series(1, len(embedding))) AS i FROM embeddings)")
def stitch_tiles(spark, d):
    """Masks of 8 x 8 pixels cut into 3 x 3 tiles, padded, and put together again: an identity but for the scale."""
    data = F.unhex(F.array_join(F.transform("embedding", lambda x: F.when(x > 0, "01").otherwise("00")), ""))
    pages = table(spark, d, "embeddings").select(F.col("vec_id").alias("page_id"), F.lit(8).alias("height"), F.lit(8).alias("width"), F.lit(1).alias("channels"), data.alias("data"))
    back = pixels.stitched(pixels.tiles(pages, 3))
    pixel = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.conv(F.substring(F.hex("mask"), i * 2 + 1, F.lit(2)), 16, 10).cast("int"))
    return back.select(F.col("page_id").alias("vec_id"), F.posexplode(pixel).alias("i", "v"))


@query("""SELECT vec_id, (i - 1)::INTEGER AS symbol, row_number() OVER (PARTITION BY vec_id ORDER BY embedding[i] DESC, i)::INTEGER AS rank,
 round(exp(embedding[i]::DOUBLE / greatest(i - 1, 1)), 6) AS confidence FROM (SELECT vec_id, embedding, unnest(generate_series(1, len(embedding))) AS i FROM embeddings)
QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY embedding[i] DESC, i) <= 10""")
def beam_topk(spark, d):
    e = table(spark, d, "embeddings").select("vec_id", F.posexplode("embedding").alias("symbol", "score"))
    top = decode.top_beams(e, "vec_id", "score", "symbol", 10)
    return top.select("vec_id", "symbol", "rank", F.round(F.exp(F.col("score").cast("double") / F.greatest("symbol", F.lit(1))), 6).alias("confidence"))


@query(f"WITH {BOXES} SELECT page_id, min(x) AS x, min(y) AS y, (max(x + w) - min(x))::INTEGER AS w, (max(y + h) - min(y))::INTEGER AS h FROM b GROUP BY page_id")
def union_bbox(spark, d):
    return layout.union_bbox(boxes(spark, d), "page_id")


@query(f"WITH {BOXES} SELECT page_id, min(x) AS x, min(y) AS y, max(w) AS w, arg_max(y + h, ord) AS h, max(x + w) - min(x) AS extent_w, max(y + h) - min(y) AS extent_h FROM b GROUP BY page_id")
def text_bbox(spark, d):
    return layout.text_bbox(boxes(spark, d))


@query(f"""WITH {BOXES}, a AS (SELECT page_id, (x % 181) / 2 AS a FROM b), g AS (SELECT page_id, count(*) FILTER (a <> 0 AND a < 5) AS nl, count(*) FILTER (a <> 90 AND a > 85) AS nh,
 avg(a) FILTER (a <> 0 AND a < 5) AS l, avg(a) FILTER (a <> 90 AND a > 85) AS h FROM a GROUP BY page_id), t AS (SELECT page_id, CASE WHEN nl > nh AND nl > 0 THEN l WHEN nh > 0 THEN -(90 - h) ELSE 0 END AS t FROM g)
SELECT page_id, round(t, 6) AS angle, round(CASE WHEN t > 0.5 THEN t ELSE 0 END, 6) AS applied_angle FROM t""")
def page_angle(spark, d):
    a = layout.page_angle(boxes(spark, d).select("page_id", ((F.col("x") % 181) / 2).alias("angle")))
    return a.select("page_id", F.round("angle", 6).alias("angle"), F.round("applied_angle", 6).alias("applied_angle"))


@query(f"WITH {BOXES} SELECT page_id, ord, x, y, w, h, (w * h)::DOUBLE AS area FROM b WHERE w > 1500 * 0.01 AND h > 10 AND w * h > 1500 * 1080 * 0.001")
def line_filter(spark, d):
    b = boxes(spark, d).withColumn("contour", contour_of_box())
    keep = layout.usable_line(F.struct("x", "y", "w", "h"), F.lit(1500)) & layout.sizeable(F.col("contour")) & layout.sizeable_in(F.col("contour"), F.lit(1500), F.lit(1080))
    return b.filter(keep).select("page_id", "ord", "x", "y", "w", "h", G.area(F.col("contour")).alias("area"))


GROUPS = f"""{BOXES}, f AS (SELECT page_id, ord, x, y, w, h, 0 AS g, y::DOUBLE AS s, 1 AS n FROM b WHERE ord = 0
 UNION ALL SELECT b.page_id, b.ord, b.x, b.y, b.w, b.h, f.g + (abs(f.s / f.n - b.y) > 20)::INTEGER, CASE WHEN abs(f.s / f.n - b.y) > 20 THEN b.y ELSE f.s + b.y END,
 CASE WHEN abs(f.s / f.n - b.y) > 20 THEN 1 ELSE f.n + 1 END FROM f JOIN b ON b.page_id = f.page_id AND b.ord = f.ord + 1),
r AS (SELECT *, (max(g) OVER (PARTITION BY page_id) - g)::INTEGER AS grp FROM f)"""


@query(f"WITH RECURSIVE {GROUPS} SELECT page_id, ord, grp, (row_number() OVER (PARTITION BY page_id ORDER BY grp, x, ord) - 1)::INTEGER AS place FROM r")
def reading_order(spark, d):
    return layout.group_lines(boxes(spark, d)).select("page_id", "ord", "grp", "place")


@query(f"""WITH RECURSIVE {GROUPS}, m AS (SELECT page_id, grp, min(x) AS x, min(y) AS y, max(x + w) AS x2, max(y + h) AS y2, count(*) AS n_lines FROM r GROUP BY page_id, grp)
SELECT page_id, grp, x, y, (x2 - x)::INTEGER AS w, (y2 - y)::INTEGER AS h, n_lines, (x + (x2 - x) // 2)::INTEGER AS cx, (y + (y2 - y) // 2)::INTEGER AS cy FROM m""")
def line_merge(spark, d):
    return layout.merge_groups(layout.group_lines(boxes(spark, d)))


@query(f"""WITH {BOXES}, s AS (SELECT page_id, x // 300 AS step, count(*) AS n, list(y ORDER BY y) AS ys FROM b GROUP BY ALL),
m AS (SELECT page_id, n, ys FROM s QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY n DESC, step) = 1)
SELECT page_id, floor((ys[(n - 1) // 2 + 1] + ys[n // 2 + 1]) / 2 / n)::INTEGER AS threshold FROM m""")
def line_threshold(spark, d):
    s = boxes(spark, d).groupBy("page_id", F.floor(F.col("x") / 300).alias("step")).agg(F.count(F.lit(1)).alias("n"), F.collect_list("y").alias("ys"))
    return layout.line_threshold(s)


PAGE_W, PAGE_H, K, TOLERANCE = 300, 130, 2.5, 1.5


@query(f"""WITH RECURSIVE l AS (SELECT p_partkey AS page_id, i::INTEGER AS ord, (10 + p_size % 20)::INTEGER AS x, (15 + 35 * i + (p_partkey + i) % 5)::INTEGER AS y,
 (60 + (p_size * 7 + i * 31) % 200)::INTEGER AS w, (4 + p_partkey * (i + 3) % 12)::INTEGER AS h FROM part, generate_series(0, 2) t(i)),
f AS (SELECT page_id, 0 AS ord, 0 AS tries, {K}::DOUBLE AS k, NULL::INTEGER AS done, NULL::INTEGER AS width, NULL::INTEGER AS height FROM l WHERE ord = 0
 UNION ALL SELECT page_id, CASE WHEN more THEN ord ELSE ord + 1 END, CASE WHEN more THEN tries + 1 ELSE 0 END, CASE WHEN more THEN k - 0.1::DOUBLE ELSE k END,
 CASE WHEN more THEN NULL ELSE ord END, CASE WHEN more THEN NULL ELSE width END, CASE WHEN more THEN NULL ELSE height END FROM (
  SELECT *, height > h * {TOLERANCE} AND tries < 10 AND k - 0.1::DOUBLE > 0.1 AS more FROM (
   SELECT *, (least({PAGE_W}, x + w + kw // 2) - greatest(0, x - (kw - 1 - kw // 2)))::INTEGER AS width, (least({PAGE_H}, y + h + kh // 2) - greatest(0, y - (kh - 1 - kh // 2)))::INTEGER AS height FROM (
    SELECT f.page_id, f.ord, f.tries, f.k, l.x, l.y, l.w, l.h, trunc(l.h * f.k)::INTEGER AS kw, trunc(trunc(l.h * f.k) * f.k)::INTEGER AS kh FROM f JOIN l ON l.page_id = f.page_id AND l.ord = f.ord))))
SELECT page_id, done AS ord, round(k, 6) AS k, width, height, width * height * 255 AS ink FROM f WHERE done IS NOT NULL""")
def line_images(spark, d):
    """White pages with three lines each: how large their images are, and what k each line leaves to the next."""
    size, key = F.col("p_size"), F.col("p_partkey")
    box = [F.struct((10 + size % 20).alias("x"), (15 + 35 * i + (key + i) % 5).cast("int").alias("y"), (60 + (size * 7 + i * 31) % 200).alias("w"), (4 + key * (i + 3) % 12).cast("int").alias("h")) for i in range(3)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        page = np.full((PAGE_H, PAGE_W), 255, np.uint8)
        for b in batches:
            rows = []
            x, y, w, h = (b.column(1).flatten().field(i).to_numpy() for i in range(4))
            corners = np.stack([x, y, x + w - 1, y, x + w - 1, y + h - 1, x, y + h - 1], axis=1).reshape(-1, 3, 4, 2)
            for page_id, lines in zip(b.column(0).to_pylist(), corners, strict=True):
                for i, (image, k) in enumerate(pixels.extract_lines(page, list(lines), K, TOLERANCE)):
                    rows.append((page_id, i, round(k, 6), image.shape[1], image.shape[0], int(image.sum())))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 6, (pa.int64(), pa.int32(), pa.float64(), pa.int32(), pa.int32(), pa.int32()), strict=True)], ["page_id", "ord", "k", "width", "height", "ink"])

    return table(spark, d, "part").select(key.alias("page_id"), F.array(*box).alias("boxes")).repartition(tasks(spark), "page_id").mapInArrow(run, "page_id long, ord int, k double, width int, height int, ink int")


def tasks(spark: SparkSession) -> int:
    """Rows that stand for pages are few bytes and much work: they are dealt out by number, which adaptive execution leaves as it is."""
    return 2 * spark.sparkContext.defaultParallelism


def few(batches: Iterator[pa.RecordBatch], rows: int = 64) -> Iterator[pa.RecordBatch]:
    """Slices of batches: a batch of Spark's is up to 10,000 rows, which drawn would be gigabytes at once."""
    for b in batches:
        for start in range(0, b.num_rows, rows):
            yield b.slice(start, rows)


def drawn_pages(spark, d) -> DataFrame:
    """A page of 256 x 192 pixels for each supplier: five rows, each of one black bar or two."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in few(batches):
            data = []
            for s in b.column(0).to_pylist():
                page = np.full((192, 256, 3), 255, np.uint8)
                for r in range(5):
                    y = 8 + 32 * r + s * r % 4
                    page[y : y + 12, 8 + s % 20 : 68 + s % 20 + s % 40] = 0
                    if (s + r) % 3:
                        page[y : y + 12, 150 : 200 + (s + r) % 50] = 0
                data.append(page.tobytes())
            n = len(data)
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array([v] * n, pa.int32()) for v in (192, 256, 3)], pa.array(data, pa.binary())], ["page_id", "height", "width", "channels", "data"])

    return table(spark, d, "supplier").select(F.col("s_suppkey").alias("page_id")).repartition(tasks(spark), "page_id").mapInArrow(run, "page_id long, height int, width int, channels int, data binary")


def dark(tiles: np.ndarray) -> np.ndarray:
    """Stands for a line model: dark is text."""
    return (0.5 - tiles.mean(axis=1)) * 100


@query("""WITH r AS (SELECT s_suppkey AS s, r FROM supplier, generate_series(0, 4) t(r)),
b AS (SELECT s, r, 8 + s % 20 AS x, 8 + 32 * r + s * r % 4 AS y, CASE WHEN (s + r) % 3 <> 0 THEN 200 + (s + r) % 50 ELSE 68 + s % 20 + s % 40 END AS x2, CASE WHEN (s + r) % 3 <> 0 THEN 2 ELSE 1 END AS n FROM r)
SELECT s AS page_id, r::INTEGER AS ord, sha256(s || '/' || r) AS guid, x::INTEGER AS x, y::INTEGER AS y, (x2 - x)::INTEGER AS w, 12 AS h, (x + (x2 - x) // 2)::INTEGER AS cx, (y + 6)::INTEGER AS cy, n::INTEGER AS n_chunks FROM b""")
def page_lines(spark, d):
    """Drawn pages through all stages up to ordered, merged lines."""
    read = ocr.run(drawn_pages(spark, d), ocr.Detector(dark, patch=64), None, ocr.Settings(calculate_threshold=False, group_threshold=20))
    return ocr.lines(read).select("page_id", "ord", "guid", "x", "y", "w", "h", "cx", "cy", "n_chunks")


@query(f"""WITH {BOXES} SELECT page_id, ord, (w * h)::DOUBLE AS area, x, y FROM b QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY w * h DESC, ord) = 1""")
def largest_contour(spark, d):
    best = areas.largest(boxes(spark, d).withColumn("contour", contour_of_box()), "page_id")
    return best.select("page_id", "ord", "area", F.col("contour")[0]["x"].alias("x"), F.col("contour")[0]["y"].alias("y"))


@query("""WITH s AS (SELECT p_partkey AS page_id, 8 + p_size % 20 AS x, 60 + p_size % 40 AS w, 55 + p_partkey % 7 AS y, 1 + p_partkey % 5 AS n FROM part)
SELECT page_id, (2 * x - 1)::INTEGER AS x, (2 * (y - 50) - 1)::INTEGER AS y, (2 * (w + 10) + 2)::INTEGER AS w,
 (least(2 * (y + 20 * (n - 1) + 12 + 60) + 1, 384) - (2 * (y - 50) - 1))::INTEGER AS h, n::INTEGER AS n_lines FROM s""")
def text_area(spark, d):
    """Masks of one to five bars, half as large as their pages: the box in which they run together, and the bars inside."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in few(batches):
            data = []
            for key, size in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                mask = np.zeros((192, 256), np.uint8)
                for i in range(1 + key % 5):
                    y = 55 + key % 7 + 20 * i
                    mask[y : y + 12, 8 + size % 20 : 68 + size % 20 + size % 40] = 255
                data.append(mask.tobytes())
            sizes = [pa.array([v] * b.num_rows, pa.int32()) for v in (192, 256, 1, 384, 512)]
            yield pa.RecordBatch.from_arrays([b.column(0), *sizes, pa.array(data, pa.binary())], ["page_id", "height", "width", "channels", "page_height", "page_width", "data"])

    keys = table(spark, d, "part").select(F.col("p_partkey").alias("page_id"), "p_size").repartition(tasks(spark), "page_id")
    return areas.text_boxes(keys.mapInArrow(run, "page_id long, height int, width int, channels int, page_height int, page_width int, data binary"))


@query()
def page_previews(spark, d):
    """Drawn pages under their lines, as PNG files."""
    pages = drawn_pages(spark, d)
    line = F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in ((8, 8), (247, 8), (247, 20), (8, 20))])
    return areas.page_previews(pages.withColumn("regions", F.array(F.struct(F.lit("line").alias("class"), line.alias("contour")))))


CURVES = f"""{BOXES}, c AS (SELECT page_id, ord // 2 AS ord, max(y % 50) - min(y % 50) AS spread, avg(h) AS height, avg(y % 50) AS mean FROM b GROUP BY ALL),
l AS (SELECT page_id, ord, spread > height AS curved, CASE WHEN spread > height THEN spread ELSE 0 END AS yd, round_even(mean, 0)::INTEGER AS target FROM c)"""


def curves(spark, d) -> DataFrame:
    s = boxes(spark, d).select("page_id", F.floor(F.col("ord") / 2).alias("ord"), (F.col("y") % 50).alias("y"), "h")
    return layout.curvature(s, "page_id", "ord")


@query(f"WITH {CURVES} SELECT page_id, ord::BIGINT AS ord, curved, yd, target FROM l")
def line_curvature(spark, d):
    return curves(spark, d)


@query(f"WITH {CURVES} SELECT page_id, count(*) FILTER (curved) / count(*) AS ratio, count(*) FILTER (curved) / count(*) > 0.25 AS dewarp FROM l GROUP BY page_id")
def tps_ratio(spark, d):
    return layout.curved_ratio(curves(spark, d)).withColumn("dewarp", layout.needs_dewarp(F.col("ratio")))


@query(f"""WITH {CURVES}, m AS (SELECT *, avg(yd) OVER (PARTITION BY page_id) AS m FROM l) SELECT page_id, ord::BIGINT AS ord FROM m WHERE yd > 0
QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY abs(yd - m), ord) = 1""")
def tps_line(spark, d):
    return layout.global_curve(curves(spark, d))


@query(f"""WITH {BOXES}, p AS (SELECT page_id, ord, x - 700 AS dx, y - 500 AS dy, radians((degrees(atan2(y - 500, x - 700)) + 33.5 + 360) % 360) AS t FROM b)
SELECT page_id, ord, (trunc(sqrt(dx * dx + dy * dy) * cos(t)) + 700)::INTEGER AS x, (trunc(sqrt(dx * dx + dy * dy) * sin(t)) + 500)::INTEGER AS y FROM p""")
def rotate_points(spark, d):
    p = G.rotated(F.array(F.struct("x", "y")), F.lit(700), F.lit(500), F.lit(33.5))
    return boxes(spark, d).select("page_id", "ord", p[0]["x"].alias("x"), p[0]["y"].alias("y"))


@query(f"WITH {BOXES} SELECT page_id, ord, round_even(x / 0.4::DOUBLE, 0)::INTEGER AS x, round_even(y / 0.8::DOUBLE, 0)::INTEGER AS y, round_even(w / 0.4::DOUBLE, 0)::INTEGER AS w, round_even(h / 0.8::DOUBLE, 0)::INTEGER AS h FROM b")
def rescale_boxes(spark, d):
    o = G.bbox_to_original(F.struct("x", "y", "w", "h"), F.lit(0.4), F.lit(0.8))
    return boxes(spark, d).select("page_id", "ord", o["x"].alias("x"), o["y"].alias("y"), o["w"].alias("w"), o["h"].alias("h"))


@query(f"WITH {BOXES} SELECT page_id, ord, x + (w + 1) // 2 AS cx, y + (h + 1) // 2 AS cy, x || ',' || y || ' ' || (x + w) || ',' || y || ' ' || (x + w) || ',' || (y + h) || ' ' || x || ',' || (y + h) AS corners FROM b")
def line_data(spark, d):
    box = G.bbox_of(contour_of_box())
    c = G.centre_of(box)
    return boxes(spark, d).select("page_id", "ord", c["x"].alias("cx"), c["y"].alias("cy"), G.bbox_string(F.struct("x", "y", "w", "h")).alias("corners"))


def whole_pairs(spark, d) -> DataFrame:
    docs = table(spark, d, "documents")
    a = docs.select("doc_id", "lang", F.col("text").alias("prediction"))
    both = a.join(docs.select((F.col("doc_id") - 1).alias("doc_id"), F.col("text").alias("label")), "doc_id").repartition("doc_id")  # else the few tasks of a small scan score all
    return evaluate.score_pairs(both, distance=evaluate.whole_distance)


@query()
def cer_pairs(spark, d):
    """Whole texts in code points. No SQL: DuckDB's distance counts bytes, and takes too long on whole texts."""
    return whole_pairs(spark, d).select("doc_id", F.round("cer", 6).alias("cer"))


@query()
def cer_summary(spark, d):
    s = evaluate.summary(whole_pairs(spark, d), "lang")
    return s.select("lang", "pairs", *[F.round(c, 6).alias(c) for c in ("mean_cer", "median_cer", "max_cer")])


@query("SELECT conv_id AS page_id, string_agg(text, chr(10) ORDER BY turn) || chr(10) AS text FROM conversations GROUP BY conv_id")
def export_text(spark, d):
    c = table(spark, d, "conversations")
    return export.page_text(c.select(F.col("conv_id").alias("page_id"), F.col("turn").alias("ord"), "text"))


def text_boxes(spark, d) -> DataFrame:
    c = table(spark, d, "conversations").select(F.col("conv_id").alias("page_id"), F.col("turn").cast("int").alias("ord"), F.regexp_replace("text", r"[\x00-\x1f\x7f]", " ").alias("text"), (F.col("turn") * 7).cast("int").alias("x"), (F.col("turn") * 30).cast("int").alias("y"), F.length("text").cast("int").alias("w"), F.lit(20).alias("h"), F.lit(1500).alias("image_width"), F.lit(900).alias("image_height"))
    return c.withColumn("contour", contour_of_box())


TURNS = r"""c AS (SELECT conv_id AS page_id, turn AS ord, regexp_replace(text, '[\x00-\x1f\x7f]', ' ', 'g') AS text, turn * 7 AS x, turn * 30 AS y, length(text) AS w, 20 AS h FROM conversations),
t AS (SELECT *, x || ',' || y || ' ' || (x + w) || ',' || y || ' ' || (x + w) || ',' || (y + h) || ' ' || x || ',' || (y + h) AS pts FROM c),
g AS (SELECT page_id, min(x) AS x, min(y) AS y, max(x + w) AS x2, max(y + h) AS y2, list(pts ORDER BY ord) AS pts, list(text ORDER BY ord) AS texts FROM t GROUP BY page_id)"""


@query(rf"""WITH {TURNS} SELECT page_id, '{{"image":"' || page_id || '","textbox":"' || x || ',' || y || ' ' || x2 || ',' || y || ' ' || x2 || ',' || y2 || ' ' || x || ',' || y2 || '","lines":["' ||
 array_to_string(list_transform(pts, lambda p: p || ' '), '","') || '"],"text":["' || array_to_string(list_transform(texts, lambda v: replace(replace(v, chr(92), chr(92) || chr(92)), '"', chr(92) || '"')), '","') || '"]}}' AS json FROM g""")
def export_json(spark, d):
    return export.page_json(text_boxes(spark, d))


@query(rf"""WITH {TURNS}, l AS (SELECT *, list_transform(generate_series(1, len(pts)), lambda i: '<TextLine id="line_9874_' || (i - 1) || '" custom="readingOrder {{index: ' || (i - 1) || ';}}"><Coords points="' || pts[i] || '"/><TextEquiv><Unicode>' ||
 replace(replace(replace(replace(texts[i], '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;') || '</Unicode></TextEquiv></TextLine>') AS ls FROM g)
SELECT page_id, '<?xml version="1.0" encoding="UTF-8"?><PcGts xmlns="http://schema.primaresearch.org/PAGE/gts/pagecontent/2013-07-15" xmlns:xsi="http://www.w3.org/2001/XMLSchema-instance" xsi:schemaLocation="http://schema.primaresearch.org/PAGE/gts/pagecontent/2013-07-15 http://schema.primaresearch.org/PAGE/gts/pagecontent/2013-07-15/pagecontent.xsd"><Metadata><Creator>Transkribus</Creator><Created>2024-01-01T00:00:00</Created></Metadata><Page imageFilename="' || page_id ||
 '" imageWidth="1500" imageHeight="900"><ReadingOrder><OrderedGroup id="1234_0" caption="Regions reading order"><RegionRefIndexed index="0" regionRef="region_main"/></OrderedGroup></ReadingOrder><TextRegion id="region_main" custom="readingOrder {{index:0;}}"><Coords points="' ||
 x || ',' || y || ' ' || x2 || ',' || y || ' ' || x2 || ',' || y2 || ' ' || x || ',' || y2 || '"/>' || array_to_string(ls, '') || '</TextRegion></Page></PcGts>' AS xml FROM l""")
def export_pagexml(spark, d):
    return export.page_xml(text_boxes(spark, d), "2024-01-01T00:00:00")


@query(f"""WITH {BOXES} SELECT page_id::VARCHAR AS image_name, 1500 AS image_width, 1080 AS image_height, count(*)::INTEGER AS num_contours,
 array_to_string(list(x || ' ' || y || ' ' || w || ' ' || h ORDER BY ord), ';') AS boxes FROM b GROUP BY page_id""")
def line_detections(spark, d):
    b = boxes(spark, d).withColumns({"contour": contour_of_box(), "image_width": F.lit(1500), "image_height": F.lit(1080)})
    text = F.array_join(F.transform("bboxes", lambda p: F.concat_ws(" ", p["x"], p["y"], p["w"], p["h"])), ";")
    return export.line_detections(b).select("image_name", "image_width", "image_height", "num_contours", text.alias("boxes"))


@query("SELECT sha256(conv_id || '/' || turn) AS guid, text, 'unicode' AS encoding, NULL::FLOAT AS ctc_conf, (-(length(text)::DOUBLE) / 4 / greatest(length(text), 1))::FLOAT AS norm_logp, NULL::SMALLINT AS n_beams FROM conversations")
def ocr_lines(spark, d):
    c = table(spark, d, "conversations").select(S.line_guid(F.col("conv_id"), F.col("turn")).alias("guid"), "text", F.lit("unicode").alias("encoding"), (-F.length("text") / 4).alias("logit_score"))
    return export.ocr_lines(c).drop("logits", "lm_scores")


@query(f"""WITH {BOXES}, k AS (SELECT b.*, CASE x % 3 WHEN 0 THEN 'footer' WHEN 1 THEN 'header' ELSE 'text' END AS class FROM b),
u AS (SELECT page_id, class, min(x) AS x, min(y) AS y, max(x + w) - min(x) AS w, max(y + h) - min(y) AS h FROM k WHERE class IN ('header', 'footer') GROUP BY ALL)
SELECT page_id, '{{' || string_agg('"' || class || '":{{"bbox":{{"x":' || x || ',"y":' || y || ',"w":' || w || ',"h":' || h || '}}}}', ',' ORDER BY class) || '}}' AS layout FROM u GROUP BY page_id""")
def class_bboxes(spark, d):
    name = F.when(F.col("x") % 3 == 0, "footer").when(F.col("x") % 3 == 1, "header").otherwise("text")
    b = layout.known_classes(boxes(spark, d).withColumn("class", name), ["header", "footer"], ["header", "footer", "text", "background"])
    return layout.class_boxes(b)


@query("""SELECT user_id AS job, count(*) AS total_pages, count(*) FILTER (event_type <> 'error') AS successful_pages, round(sum(value), 4) AS total_duration_ms,
 sum(event_id % 40)::BIGINT AS total_lines_detected, round(sum(value) / count(*), 4) AS avg_duration_per_page_ms FROM events GROUP BY user_id""")
def job_metrics(spark, d):
    e = table(spark, d, "events").select(F.col("user_id").alias("job"), F.when(F.col("event_type") == "error", "failed").otherwise("success").alias("status"), F.col("value").alias("total_duration_ms"), (F.col("event_id") % 40).alias("lines_detected"))
    s = jobs.job_summary(e, "job")
    return s.withColumns({c: F.round(c, 4) for c in ("total_duration_ms", "avg_duration_per_page_ms")})


@query("""WITH e AS (SELECT user_id AS job_id, 'stage' || event_id % 3 AS stage, ts, CASE event_type WHEN 'view' THEN 'start' WHEN 'click' THEN 'end' ELSE 'op' END AS kind FROM events WHERE event_type IN ('view', 'click', 'error')),
n AS (SELECT *, lead(kind) OVER w AS k, lead(ts) OVER w AS ended FROM e WINDOW w AS (PARTITION BY job_id, stage ORDER BY ts))
SELECT job_id, stage, ts AS started, ended, date_sub('second', ts, ended) AS duration_s FROM n WHERE kind = 'start' AND k = 'end'""")
def stage_durations(spark, d):
    e = table(spark, d, "events").filter(F.col("event_type").isin("view", "click", "error"))
    kind = F.when(F.col("event_type") == "view", "start").when(F.col("event_type") == "click", "end").otherwise("op")
    return jobs.stage_durations(e.select(F.col("user_id").alias("job_id"), F.concat(F.lit("stage"), (F.col("event_id") % 3).cast("string")).alias("stage"), "ts", kind.alias("kind")))


@query("""WITH a AS (SELECT user_id AS job_id, 'page' || event_id % 50 AS name, event_type AS type, 'out/' || event_type AS path, max(strftime(ts, '%Y-%m-%dT%H:%M:%S')) AS ts FROM events GROUP BY ALL)
SELECT job_id, '{"job_id":' || job_id || ',"created":"' || min(ts) || '","artifacts":[' || string_agg('{"name":"' || name || '","type":"' || type || '","path":"' || path || '","timestamp":"' || ts || '"}', ',' ORDER BY ts, name, type, path) || ']}' AS manifest FROM a GROUP BY job_id""")
def manifest(spark, d):
    e = table(spark, d, "events")
    return jobs.manifest(e.select(F.col("user_id").alias("job_id"), F.concat(F.lit("page"), (F.col("event_id") % 50).cast("string")).alias("name"), F.col("event_type").alias("type"), F.concat(F.lit("out/"), "event_type").alias("path"), S.utc_stamp(F.col("ts")).alias("timestamp")))


@query("""SELECT event_id, '{"timestamp":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S') || '","level":"' || CASE event_type WHEN 'error' THEN 'ERROR' ELSE 'INFO' END || '","message":"' || event_type || '","job_id":"' || user_id || '"' ||
 CASE event_type WHEN 'error' THEN ',"status":"failed"' ELSE '' END || '}' AS line FROM events""")
def audit_log(spark, d):
    bad = F.col("event_type") == "error"
    e = table(spark, d, "events").select("event_id", F.struct(S.utc_stamp(F.col("ts")).alias("timestamp"), F.when(bad, "ERROR").otherwise("INFO").alias("level"), F.col("event_type").alias("message"), F.col("user_id").cast("string").alias("job_id"), F.when(bad, "failed").alias("status")).alias("r"))
    return e.select("event_id", F.to_json("r").alias("line"))


@query("""SELECT page_id, f AS name, CASE WHEN strpos(f, '.') = 0 THEN '' ELSE rtrim(regexp_replace(f, '\\.[^.]*$', ''), '.') END AS stem FROM (SELECT page_id, regexp_extract(url, '([^/]*)$', 1) AS f FROM pages)""".replace("\\\\", "\\"))
def file_stem(spark, d):
    return table(spark, d, "pages").select("page_id", S.file_name(F.col("url")).alias("name"), S.file_stem(F.col("url")).alias("stem"))


@query(r"""SELECT s_suppkey, s_name, array_to_string(list_transform(regexp_extract_all(s_name, '(\d+|\D+)'), lambda x: CASE WHEN regexp_matches(x, '^\d') THEN lpad(length(CASE WHEN ltrim(x, '0') = '' THEN '0' ELSE ltrim(x, '0') END)::VARCHAR, 10, '0') || CASE WHEN ltrim(x, '0') = '' THEN '0' ELSE ltrim(x, '0') END ELSE x END), '|') AS key FROM supplier""")
def natural_sort(spark, d):
    s = table(spark, d, "supplier").select("s_suppkey", "s_name", F.array_join(S.natural_key(F.col("s_name")), "|").alias("key"))
    return s.orderBy("key", "s_suppkey")


@query("SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def skip_existing(spark, d):
    docs = table(spark, d, "documents").withColumn("volume", F.col("doc_id").cast("string"))
    return files.not_yet_done(docs, table(spark, d, "labels").withColumn("volume", F.col("doc_id").cast("string"))).select("doc_id", "source")


@query("""WITH a AS (SELECT lang AS distribution, doc_id, row_number() OVER (PARTITION BY lang ORDER BY lpad(doc_id::VARCHAR, 20, '0')) AS pos FROM documents),
b AS (SELECT distribution, a.doc_id AS label_doc, row_number() OVER (PARTITION BY distribution ORDER BY lpad(a.doc_id::VARCHAR, 20, '0')) AS pos FROM a JOIN labels l ON a.doc_id = l.doc_id)
SELECT distribution, pos::INTEGER AS pos, a.doc_id AS image_doc, label_doc FROM a JOIN b USING (distribution, pos)""")
def pair_by_position(spark, d):
    docs = table(spark, d, "documents").select(F.col("lang").alias("distribution"), F.col("doc_id").cast("string").alias("name"))
    lab = docs.join(table(spark, d, "labels").select(F.col("doc_id").cast("string").alias("name")), "name")
    p = evaluate.pair_by_position(docs, lab.select("distribution", "name"))
    return p.select("distribution", "pos", F.col("image_name").cast("long").alias("image_doc"), F.col("label_name").cast("long").alias("label_doc"))


@query("""SELECT lang, count(*) AS n_volumes, sum(n)::BIGINT AS n_pages FROM (SELECT lang, source, count(*) AS n FROM documents GROUP BY ALL) GROUP BY lang""")
def volume_counts(spark, d):
    v = table(spark, d, "documents").groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))
    return v.groupBy("lang").agg(F.count(F.lit(1)).alias("n_volumes"), F.sum("n").alias("n_pages"))


@query("""SELECT m.model, d.doc_id FROM documents d, (VALUES ('a'), ('b'), ('c')) m(model)""")
def evaluation_plan(spark, d):
    models = spark.createDataFrame([("a",), ("b",), ("c",)], "model string")
    return evaluate.evaluation_plan(models, table(spark, d, "documents").select("doc_id")).select("model", "doc_id")


@query("""SELECT doc_id, replace(trim(replace(replace(text, ' ', ''), chr(10), '§')), '§', ' ') AS text FROM documents""")
def recognised_text(spark, d):
    t = F.replace(F.col("text"), F.lit("\n"), F.lit("§"))
    return table(spark, d, "documents").select("doc_id", T.finish_text(t, drop_spaces=True).alias("text"))
