from folioforge.operators import layout


def test_merged_lines_keep_contours_and_hull(spark):
    box = lambda x, y, w, h: [(x, y), (x + w, y), (x + w, y + h), (x, y + h)]
    dent = [(0, 100), (40, 100), (20, 104), (40, 110), (0, 110)]  # not convex
    rows = [("p", 0, 0, 100, 40, 10, dent), ("p", 1, 60, 4, 20, 10, box(60, 4, 20, 10)), ("p", 2, 0, 0, 30, 10, box(0, 0, 30, 10))]
    lines = spark.createDataFrame(rows, "page_id string, ord int, x int, y int, w int, h int, contour array<struct<x:int,y:int>>")
    got = {r.n_lines: r for r in layout.merge_groups(layout.group_lines(lines)).collect()}
    points = lambda c: [(p.x, p.y) for p in c]
    assert points(got[2].contour) == box(0, 0, 30, 10) + box(60, 4, 20, 10)
    assert set(points(got[2].hull)) == {(0, 0), (30, 0), (80, 4), (80, 14), (60, 14), (0, 10)}
    assert points(got[1].contour) == points(got[1].hull) == dent


def test_lines_by_page_already_are_not_shuffled_again(spark):
    from folioforge.plans import catalogue

    plan = layout.group_lines(catalogue.boxes(spark, "/root/testdata/sf0.001"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_groups_do_not_depend_on_batches(spark):
    import random

    rng = random.Random(3)
    some = lambda v: None if rng.random() < 0.1 else v
    rows = [(some(f"p{rng.randint(0, 40)}"), some(rng.randint(0, 9)), some(rng.randint(0, 50)), some(rng.randint(0, 200)), i) for i in range(800)]
    lines = spark.createDataFrame(rows, "page_id string, ord int, x int, y int, id int")
    pages, low = {}, lambda v: (v is not None, v)
    for page, o, x, y, i in rows:
        pages.setdefault(page, []).append((low(o), low(y), low(x), x, y, i))
    want = {}
    for found in pages.values():
        group, total, n, grp = -1, 0, 0, []
        found.sort(key=lambda r: r[:3])
        for _, _, _, x, y, i in found:
            if group < 0 or (y is not None and n and abs(total / n - y) > 20):
                group, total, n = group + 1, 0, 0
            total, n = (total, n) if y is None else (total + y, n + 1)
            grp.append((group, x))
        order = sorted(range(len(grp)), key=lambda j: (-grp[j][0], low(grp[j][1]), j))
        for place, j in enumerate(order):
            want.setdefault((rows[found[j][5]][:4]), []).append((group - grp[j][0], place))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    for size in ("3", "100"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        got = {}
        for r in layout.group_lines(lines).collect():
            got.setdefault((r.page_id, r.ord, r.x, r.y), []).append((r.grp, r.place))
        assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
