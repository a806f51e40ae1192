import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioforge.functions import geometry as G
from folioforge.functions import scalars as S
from folioforge.functions import text as T
from folioforge.operators import decode, evaluate, jobs, layout


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


def test_clean_label(spark):
    r = one(spark, T.clean_label(F.lit("ab(c) ༌d[e]‍")).alias("a"), T.clean_label(F.lit("a(b)c[d]e"), True).alias("b"))
    assert r.a == "a bc་d[e]" and r.b == "ace"


def test_wylie(spark):
    assert one(spark, T.finish_wylie_label(F.lit("ka_[kha]  *ga")).alias("a")).a == "kakha§§ga"


def test_wylie_replacements(spark):
    """Literal backslash-u text, one by one, as the toolkit maps it; stacked in one label, in that order."""
    want = {r"\u0f85": "&", r"\u0f09": "ä", r"\u0f13": "ö", r"\u0f12": "ü", r"\u0fd3": "@", r"\u0fd4": "#", r"\u0f00": "oM", r"\u0f7f": "}", "＠": "@", "।": "|", "*": "§", "a  b": "a§b", "a   b": "a§§b", "_": "", "[x]": "x", r"\u0f0b": r"\u0f0b", r"\u0f38": r"\u0f38", "\u0f85": "\u0f85"}
    r = one(spark, *[T.finish_wylie_label(F.lit(k)).alias(f"c{i}") for i, k in enumerate(want)])
    assert list(r) == list(want.values())


def test_encode_symbols_of_several_characters(spark):
    r = one(spark, T.encode_label(F.lit("ba"), ["ka", "b", "a"]).alias("a"), T.encode_label(F.lit("é😀x"), ["x", "é", "😀"]).alias("b"))
    assert r.a == [2, 3] and r.b == [2, 3, 1]


def test_vocabulary():
    assert T.vocabulary("ab", True) == (["<blk>", "a", "b"], 0)
    assert T.vocabulary(["a", " ", "b"], False) == (["a", " ", "b"], 1) and T.vocabulary(["a", "<blk>"], False)[1] == 1


def test_utc_stamp_in_any_session(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York", "Asia/Kathmandu"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            r = one(spark, S.utc_stamp(F.timestamp_seconds(F.lit(1704110400))).alias("a"), S.utc_stamp(F.timestamp_seconds(F.lit(-1))).alias("b"), S.utc_stamp(F.lit("2024-03-10 02:30:00").cast("timestamp_ntz")).alias("c"), S.utc_stamp(F.lit(None).cast("timestamp")).alias("d"))
            assert tuple(r) == ("2024-01-01T12:00:00", "1969-12-31T23:59:59", "2024-03-10T02:30:00", None)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_natural_key_of_long_numbers(spark):
    names = ["p" + "9" * 25, "p1" + "0" * 25, "p007", "p7a", "p08"]
    got = [r.n for r in spark.createDataFrame([(n,) for n in names], "n string").orderBy(S.natural_key(F.col("n")), "n").collect()]
    assert got == ["p007", "p7a", "p08", "p" + "9" * 25, "p1" + "0" * 25]


def test_softmax_and_greedy_of_long_lines(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 5)).astype(np.float32)
    x[3] = x[4] = x[5]
    df = spark.createDataFrame([([float(v) for v in x.ravel()],), (None,)], "e array<float>")
    got = df.select(decode.greedy_path(F.col("e"), 300, 5).alias("p"), S.softmax(F.slice("e", 1, 5)).alias("s")).collect()
    best = x.argmax(axis=1)
    assert got[0].p == [int(s) for i, s in enumerate(best) if s and (i == 0 or s != best[i - 1])]
    assert np.allclose(got[0].s, np.exp(x[0]) / np.exp(x[0]).sum(), atol=1e-6) and got[1].p is None and got[1].s is None


def test_encode_decode(spark):
    r = one(spark, T.encode_label(F.lit("abx"), ["a", "b"]).alias("e"), T.decode_label(F.array(F.lit(2), F.lit(0), F.lit(-1), F.lit(1)), ["a", "b"]).alias("d"), T.encode_label(F.lit(""), ["a"]).alias("z"))
    assert r.e == [1, 2, -1] and r.d == "ba" and r.z == []


def test_names(spark):
    r = one(spark, *[S.file_stem(F.lit(x)).alias(k) for k, x in {"a": "/x/p.1.jpg", "b": "name", "c": "x..tif"}.items()])
    assert (r.a, r.b, r.c) == ("p.1", "", "x")
    names = [("p10",), ("p9",), ("p1a",)]
    got = [r.n for r in spark.createDataFrame(names, "n string").orderBy(S.natural_key(F.col("n"))).collect()]
    assert got == ["p1a", "p9", "p10"]


def test_geometry(spark):
    sq = F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in ((0, 0), (4, 0), (4, 3), (0, 3))])
    r = one(spark, G.area(sq).alias("a"), G.bbox_of(sq).alias("b"), G.contour_string(sq).alias("s"), G.contour_string(F.slice(sq, 1, 0)).alias("e"), G.rotated(sq, F.lit(0), F.lit(0), F.lit(90.0)).alias("r"), G.half_even(F.lit(2.5)).alias("h"))
    assert r.a == 12 and tuple(r.b) == (0, 0, 5, 4) and r.s == "0,0 4,0 4,3 0,3 " and r.e == "" and r.h == 2
    assert [tuple(p) for p in r.r][0] == (0, 0) and r.r[1].y in (3, 4)


def test_beam_search_sums_paths():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(4, 3))
    p, total = decode.log_softmax(x), {}
    for path in itertools.product(range(3), repeat=4):
        out = tuple(s for i, s in enumerate(path) if s and (i == 0 or path[i - 1] != s))
        total[out] = total.get(out, 0) + math.exp(sum(p[t, s] for t, s in enumerate(path)))
    got = decode.prefix_beams(x, width=1000)
    assert len(got) == len(total)
    for seq, score in got:
        assert math.isclose(math.exp(score), total[seq], rel_tol=1e-9)
    assert [s for _, s in got] == sorted((s for _, s in got), reverse=True)


def test_oriented():
    x = np.zeros((3, 7))
    assert decode.oriented(x, 3).shape == (7, 3) and decode.oriented(x, 7).shape == (3, 7)


def test_cer(spark):
    r = one(spark, *[evaluate.cer(F.lit(a), F.lit(b)).alias(k) for k, a, b in (("x", "abc", "abd"), ("y", "", ""), ("z", "q", ""), ("w", "same", "same"))])
    assert abs(r.x - 1 / 3) < 1e-9 and (r.y, r.z, r.w) == (0, 1, 0)


def test_group_lines_runs_on_the_mean(spark):
    rows = [("p", 0, 50, 100), ("p", 1, 10, 115), ("p", 2, 5, 130), ("p", 3, 0, 60)]
    got = layout.group_lines(spark.createDataFrame(rows, "page_id string, ord int, x int, y int")).orderBy("place").collect()
    # 130 is 22.5 off the mean of 100 and 115, though only 15 off its neighbour
    assert [(r.ord, r.grp) for r in got] == [(3, 0), (2, 1), (1, 2), (0, 2)]


def test_group_lines_keeps_all_rows_and_columns(spark):
    rows = [("p", 0, 5, 10, "a"), ("p", 0, 1, 10, "b"), (None, 0, 1, 1, "c"), (None, 1, 0, 90, "d"), ("q", None, 3, 4, "e"), ("q", 1, 2, None, "f"), ("q", 2, None, 50, "g")]
    got = layout.group_lines(spark.createDataFrame(rows, "page_id string, ord int, x int, y int, grp string"))
    assert got.columns == ["page_id", "ord", "x", "y", "grp", "place"]
    got = {(r.page_id, r.place): (r.ord, r.x, r.grp) for r in got.collect()}
    assert got == {("p", 0): (0, 1, 0), ("p", 1): (0, 5, 0), (None, 0): (1, 0, 0), (None, 1): (0, 1, 1), ("q", 0): (2, None, 0), ("q", 1): (1, 2, 1), ("q", 2): (None, 3, 1)}
    plan = layout.group_lines(spark.createDataFrame(rows, "page_id string, ord int, x int, y int, grp string"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_group_lines_over_batches(spark):
    """Pages that run over Arrow batches, against the fold written out."""
    import random

    from folioforge.plans.ocr import reading_order

    rng = random.Random(2)
    rows = [(p, i, rng.randint(0, 50), rng.randint(0, 120)) for p in range(30) for i in range(rng.randint(1, 40))]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = layout.group_lines(spark.createDataFrame(rows, "page_id int, ord int, x int, y int")).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    for p in range(30):
        own = [r for r in rows if r[0] == p]
        want = [i for g in reading_order([(r[2], r[3]) for r in own], 20) for i in g]
        assert [r.ord for r in sorted((r for r in got if r.page_id == p), key=lambda r: r.place)] == want


def test_ties_and_empty_groups(spark):
    lines = spark.createDataFrame([("p", 0, 4), ("p", 1, 6), ("p", 2, 5), ("q", 0, 0), ("r", 0, 4), ("r", 1, 6)], "page_id string, ord int, yd int")
    # the mean is 5 on both pages: p has a line of just that, r has two that are equally near
    assert {r.page_id: r.ord for r in layout.global_curve(lines).collect()} == {"p": 2, "r": 0}
    assert layout.group_lines(spark.createDataFrame([], "page_id string, ord int, x int, y int")).count() == 0


def test_unknown_class(spark):
    with pytest.raises(ValueError):
        layout.known_classes(spark.range(1).withColumn("class", F.lit("a")), ["b"], ["a"])


def test_job_summary_counts_failures(spark):
    df = spark.createDataFrame([("a", "failed", 5.0, 1), ("a", "success", 7.0, 2)], "job string, status string, total_duration_ms double, lines_detected long")
    r = jobs.job_summary(df, "job").first()
    assert (r.total_pages, r.successful_pages, r.total_duration_ms, r.avg_duration_per_page_ms) == (2, 1, 12.0, 6.0)
    assert jobs.job_summary(df.limit(0)).first().avg_duration_per_page_ms == 0
    with pytest.raises(ValueError):
        jobs.artifact_path("r", "j", "elsewhere")


def test_symbol_counts(spark, monkeypatch):
    from collections import Counter

    from folioforge.operators import charset

    texts = ["abca", None, "", "é😀é", "a" * 50, "\n a"]
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(2)
    n, docs = Counter("".join(filter(None, texts))), Counter(c for t in texts for c in set(t or ""))
    for piece in (4, 4_000_000):
        monkeypatch.setattr(charset, "PIECE", piece)
        assert {r.symbol: (r.n, r.n_docs) for r in charset.symbol_counts(df).collect()} == {c: (n[c], docs[c]) for c in n}
    assert charset.symbol_counts(df.limit(0)).count() == 0
