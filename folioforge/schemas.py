"""Table schemas and closed value sets."""

from __future__ import annotations

from pyspark.sql import types as T

POINT = "struct<x:int,y:int>"
BBOX = "struct<x:int,y:int,w:int,h:int>"
ROTATED_BBOX = f"struct<cx:double,cy:double,width:double,height:double,angle:double,points:array<{POINT}>>"
CONTOUR = f"array<{POINT}>"
CONTOUR_TYPE = T.ArrayType(T.StructType([T.StructField("x", T.IntegerType()), T.StructField("y", T.IntegerType())]))

LINE_DETECTION = f"image_name string, image_width int, image_height int, num_contours int, contours array<{CONTOUR}>, bboxes array<{BBOX}>"
OCR_LINES = "guid string, text string, encoding string, ctc_conf float, norm_logp float, n_beams smallint, logits array<float>, lm_scores array<float>"
LINES = f"page_id string, ord int, guid string, contour {CONTOUR}, bbox {BBOX}, center {POINT}"
TILES = "page_id string, ty int, tx int, height int, width int, data binary"
PAGES = "page_id string, height int, width int, channels int, data binary, status string, error string"
AUDIT = "timestamp string, level string, message string, job_id string, stage string, operation string, status string, metadata map<string,string>, exception string"
MANIFEST = "job_id string, name string, type string, path string, timestamp string"
PAGE_METRICS = "image_name string, total_duration_ms double, lines_detected long, lines_processed long, dewarping_applied boolean, rotation_angle double, status string"

# The closed sets that string columns are checked against.
DOMAINS = {
    "status": ("success", "failed"),
    "encoding": ("unicode", "wylie"),
    "encoder": ("stack", "wylie"),
    "export": ("text", "xml", "json"),
    "line_mode": ("line", "layout"),
    "line_merge": ("merge", "stack"),
    "line_sorting": ("threshold", "peaks"),
    "tps_mode": ("global", "local"),
}


def in_domain(column: str, name: str):
    from pyspark.sql import functions as F

    return F.col(column).isin(*DOMAINS[name])
