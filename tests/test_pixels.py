import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from folioforge.operators import pixels as P


def test_tiles_and_stitch_are_inverse():
    img = np.arange(6 * 9, dtype=np.uint8).reshape(6, 9)
    padded = P.pad(img, 3, 2)
    assert padded.shape == (8, 12) and padded[7, 11] == 255
    assert (P.stitch(P.tile(padded, 4)) == padded).all()


def test_resize_identity_and_mean():
    img = np.array([[0, 100], [100, 200]], np.uint8)
    assert (P.resize(img, 2, 2) == img).all()
    assert P.resize(img, 1, 1)[0, 0] == 100


def test_crop_keeps_only_full_pixels():
    m = np.zeros((4, 4), np.uint8)
    m[:2, :2] = 1
    assert P.crop_prediction(m, 0, 0, 8, 8).sum() < 16
    assert (P.crop_prediction(m, 2, 2, 2, 2) == 1).all()


def test_preprocess_square_is_never_shrunk():
    assert P.preprocess(np.zeros((5000, 5000), np.uint8), 512)[0].shape == (5120, 5120)
    assert P.preprocess(np.zeros((100, 5000), np.uint8), 512)[0].shape[1] == 4096


def test_contours_of_a_ring():
    m = np.zeros((7, 7), np.uint8)
    m[1:6, 1:6] = 1
    m[3, 3] = 0
    got = P.contours(m)
    assert len(got) == 2
    assert sorted(map(tuple, got[0].tolist())) == [(1, 1), (1, 5), (5, 1), (5, 5)]
    assert {tuple(p) for p in got[1].tolist()} == {(3, 2), (2, 3), (3, 4), (4, 3)}
    assert P.contour_area(got[0]) == 16


def test_single_pixel_and_two_regions():
    m = np.zeros((5, 9), np.uint8)
    m[2, 1] = 1
    m[1:3, 4:8] = 1
    got = P.contours(m)
    assert sorted(len(c) for c in got) == [1, 4]


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 2**25 - 1))
def test_contours_cover_each_region_once(bits):
    m = np.array([bits >> i & 1 for i in range(25)], np.uint8).reshape(5, 5)
    on = {tuple(p) for p in np.argwhere(m)}
    left, regions = set(on), 0
    while left:
        regions += 1
        todo = [left.pop()]
        while todo:
            y, x = todo.pop()
            for q in [(y + a, x + b) for a in (-1, 0, 1) for b in (-1, 0, 1)]:
                if q in left:
                    left.remove(q)
                    todo.append(q)
    found = P.contours(m)
    assert len(found) >= regions and (regions > 0) == (len(found) > 0)
    assert all((y, x) in on for c in found for x, y in c.tolist())


def test_hull_and_least_rectangle():
    p = np.array([(0, 0), (4, 0), (4, 2), (0, 2), (2, 1)])
    assert len(P.convex_hull(p)) == 4
    cx, cy, w, h, a = P.least_rectangle(p)
    assert (cx, cy) == (2, 1) and sorted((round(w), round(h))) == [2, 4] and a == 90
    d = np.array([(0, 0), (3, 3), (2, 4), (-1, 1)])
    assert abs(P.least_rectangle(d)[4] - 45) < 1e-6


def test_simplify_drops_points_on_a_line():
    p = np.array([(0, 0), (5, 0), (10, 0), (10, 10), (0, 10)])
    assert len(P.simplify(p)) == 4


def test_binarise_and_rotate():
    img = np.full((60, 60), 200, np.uint8)
    img[30, 20:40] = 0
    b = P.binarise(img)
    assert b.shape == (60, 60, 3) and b[30, 30, 0] == 0 and b[5, 5, 0] == 255
    assert (P.rotate(img, 0) == img).all()


def test_extract_lines_carry_k():
    img = np.full((60, 60), 9, np.uint8)
    line = np.array([(10, 20), (50, 20), (50, 24), (10, 24)])
    got = P.extract_lines(img, [line, line], k=1.7, tolerance=2.0)
    assert got[0][1] < 1.7 and got[1][1] == got[0][1]
    assert 0 < got[0][0].shape[0] <= 10


def test_a_line_that_gives_nothing_leaves_k():
    img = np.full((20, 20), 9, np.uint8)
    thin, usual = np.array([(2, 2), (9, 2)]), np.array([(2, 6), (12, 6), (12, 9), (2, 9)])
    got = P.extract_lines(img, [thin, usual], k=0.9, tolerance=9)  # int(1 * 0.9) is no kernel
    assert got[0][0].shape == (1, 2, 1) and not got[0][0].any() and [k for _, k in got] == [0.9, 0.9]


def test_extracted_line_equals_masking_the_whole_page():
    rng = np.random.default_rng(3)
    img = rng.integers(0, 3, (50, 70, 3), np.uint8)
    p = np.array([(5, 20), (30, 16), (64, 22), (60, 28), (8, 27)])
    for k in (0.5, 1.1, 1.6):
        kw = int(P.box_of(p)[3] * k)
        want = P.mask_and_crop(img, P.dilate(P.fill(img.shape[:2], p), kw, int(kw * k)))
        assert np.array_equal(P.extract_line(img, p, P.box_of(p)[3], k), want)


def test_dilate_by_definition():
    rng = np.random.default_rng(4)
    m = (rng.random((9, 11)) < 0.1).astype(np.uint8)
    for kw, kh in ((1, 1), (2, 3), (4, 2), (5, 5)):
        want = np.zeros_like(m)
        for y in range(9):
            for x in range(11):
                rows, cols = range(y - kh // 2, y - kh // 2 + kh), range(x - kw // 2, x - kw // 2 + kw)
                want[y, x] = max((m[a, b] for a in rows for b in cols if 0 <= a < 9 and 0 <= b < 11), default=0)
        assert np.array_equal(P.dilate(m, kw, kh), want)


def test_mask_and_crop_is_black_and_goes_by_what_is_left():
    img = np.full((4, 5, 3), 200, np.uint8)
    img[2, 1] = 0  # black on the page: its row goes though the mask has it
    img[3, 4, 1] = 0  # a channel of the row's only pixel is black: the row goes too
    m = np.zeros((4, 5), np.uint8)
    m[0, 0] = m[1, 3] = m[2, 1] = m[3, 4] = 1
    got = P.mask_and_crop(img, m)
    assert got[:, :, 0].tolist() == [[200, 0], [0, 200]] and got.shape == (2, 2, 3)


def test_pad_line_is_black():
    got = P.pad_line(np.full((4, 8), 9, np.uint8), 8, 8)
    assert got[:2].max() == 0 and (got[2:6] == 9).all() and got[6:].max() == 0
    assert P.pad_to_height(np.full((4, 4), 9, np.uint8), 12, 4, 255)[0].tolist() == [255] * 4 + [9] * 4 + [255] * 4


def test_line_threshold_by_hand():
    m = np.zeros((120, 400), np.uint8)
    for y in (10, 50, 90):
        m[y : y + 8, 20:380] = 255
    # slices of three lines with centres 3 + 1, 43 + 1, 83 + 1 below the box's top: the median, 44, over 3
    assert P.line_threshold(m) == 14.0
    assert P.line_threshold(np.zeros((5, 5), np.uint8)) == 0.0


def arc(bend, shape=(160, 520)):
    """Three bars; the outer quarters of each lie `bend` lower than its middle."""
    m = np.zeros(shape, np.uint8)
    for base in (20, 60, 100):
        for x in range(20, 500):
            y = base + int(bend * ((x - 260) / 240) ** 2)
            m[y : y + 8, x] = 255
    return m


def test_curved_lines_are_found_and_straightened():
    flat, bent = arc(0), arc(24)
    assert not any(P.line_curve(flat.shape, c)[0] for c in P.line_contours(flat))
    curves = [P.line_curve(bent.shape, c) for c in P.line_contours(bent)]
    assert all(c[0] for c in curves) and all(c[3] >= 18 for c in curves)
    _, centres, level, _ = curves[P.global_curve(curves)]
    again = [P.line_curve(bent.shape, c) for c in P.line_contours(P.unbend(bent, centres, level)) if P.box_of(c)[2] > 200]
    assert len(again) == 3 and not any(c[0] for c in again)


def test_global_curve_takes_the_first_nearest():
    c = lambda y: (y > 0, None, None, float(y))
    assert P.global_curve([c(0), c(4), c(8)]) == 1 and P.global_curve([c(9), c(3), c(0), c(5), c(3)]) == 1


def test_page_angle_turns_back():
    m = np.zeros((200, 400), np.uint8)
    for y in (50, 100, 150):
        m[y : y + 10, 60:340] = 255
    tilted = P.rotate(m, -2.0)
    assert abs(P.page_angle(tilted) - 2.0) < 0.2 and P.page_angle(m) == 0
    assert abs(P.page_angle(P.rotate(tilted, P.page_angle(tilted)))) < 0.3
    assert P.page_angle(P.rotate(m, 2.0)) < -1.5


def test_thin_plate_identity():
    img = np.arange(100, dtype=np.uint8).reshape(10, 10)
    p = np.array([(0, 0), (9, 0), (0, 9), (9, 9), (4, 5)], float)
    assert (P.thin_plate_warp(img, p, p)[2:8, 2:8] == img[2:8, 2:8]).all()


def test_a_line_is_filled_once_and_a_box_never(monkeypatch):
    calls, filled = [], P._filled
    monkeypatch.setattr(P, "_filled", lambda *a: calls.append(a) or filled(*a))
    img = np.full((130, 300), 255, np.uint8)
    box, other = np.array([(20, 50), (99, 50), (99, 57), (20, 57)]), np.array([(20, 50), (99, 52), (99, 59), (20, 57)])
    assert P.extract_lines(img, [box], 2.5, 1.5)[0][1] < 2.0 and not calls
    assert P.extract_lines(img, [other], 2.5, 1.5)[0][1] < 2.0 and len(calls) == 1


def test_cut_boxes_equal_masking_the_whole_page():
    rng = np.random.default_rng(5)
    for i in range(60):
        img = rng.integers(i % 2, 4, (40, 50, 3) if i % 3 else (40, 50)).astype(np.uint8)
        x, y, w, h = rng.integers(-6, 45), rng.integers(-6, 36), rng.integers(1, 30), rng.integers(1, 9)
        p = np.array([(x, y), (x + w - 1, y), (x + w - 1, y + h - 1), (x, y + h - 1)])
        for k in (0.6, 1.4, 2.0):
            kw = int(h * k)
            want = P.mask_and_crop(img, P.dilate(P.fill(img.shape[:2], p), kw, int(kw * k))) if kw and int(kw * k) else None
            got = P.extract_line(img, p, h, k)
            assert (got is None or not got.size) if want is None or not want.size else np.array_equal(got, want)


def plain_walk(on: np.ndarray, start: tuple[int, int], side: int, seen: set) -> list[tuple[int, int]]:
    """Walks around, keeping the empty side at hand; notes every (pixel, empty left or right neighbour) that it passes."""
    path, at, back, first = [], start, side, None
    while True:
        for i in range(1, 9):
            d = (back + i) % 8
            if on[at[0] + P.AROUND[d][0], at[1] + P.AROUND[d][1]]:
                break
            if d in (0, 4):
                seen.add((at[0], at[1], d))
        else:
            seen.add((at[0], at[1], side))
            return [start]
        seen.add((at[0], at[1], back)) if back in (0, 4) and not on[at[0] + P.AROUND[back][0], at[1] + P.AROUND[back][1]] else None
        if first == (at, d):
            return path
        first = first or (at, d)
        path.append(at)
        at, back = (at[0] + P.AROUND[d][0], at[1] + P.AROUND[d][1]), (d + 4) % 8


def plain_ends(p: np.ndarray) -> np.ndarray:
    if len(p) < 3:
        return p
    before, after = p - np.roll(p, 1, axis=0), np.roll(p, -1, axis=0) - p
    return p[(before != after).any(axis=1)]


def plain_contours(mask):
    """Pixel by pixel."""
    on = np.pad(mask > 0, 1)
    seen, out = set(), []
    for y, x in np.argwhere(on).tolist():
        for side, dx in ((4, -1), (0, 1)):
            if not on[y, x + dx] and (y, x, side) not in seen:
                out.append(plain_ends(np.array([(b - 1, a - 1) for a, b in plain_walk(on, (y, x), side, seen)])))
    return out


def test_contours_equal_the_plain_walk():
    rng = np.random.default_rng(6)
    for i in range(400):
        if i % 2:
            m = (rng.random(rng.integers(1, 14, 2)) < rng.choice([0.05, 0.3, 0.6, 0.9])).astype(np.uint8)
        else:
            m = np.zeros((40, 50), np.uint8)
            for _ in range(5):
                y, x = rng.integers(0, 35), rng.integers(0, 45)
                m[y : y + rng.integers(1, 20), x : x + rng.integers(1, 30)] = rng.random() < 0.7
        assert [c.tolist() for c in P.contours(m)] == [c.tolist() for c in plain_contours(m)]


def test_a_straight_border_is_passed_in_one_go(monkeypatch):
    calls, alike = [], P._alike
    monkeypatch.setattr(P, "_alike", lambda *a: calls.append(a) or alike(*a))
    m = np.zeros((500, 900), np.uint8)
    m[20:480, 30:870] = 255
    assert len(P.contours(m)[0]) == 4 and len(calls) <= 8


def test_dilated_many_times_over_is_once_by_more():
    m = (np.random.default_rng(7).random((30, 40)) < 0.01).astype(np.uint8)
    for kw, kh, n in ((2, 12, 10), (1, 3, 4), (4, 2, 3)):
        want = m
        for _ in range(n):
            want = P.dilate(want, kw, kh)
        assert np.array_equal(P.dilate(m, kw, kh, n), want)


def test_resized_by_definition():
    rng = np.random.default_rng(8)
    for h, w, height, width in ((5, 7, 10, 14), (9, 4, 3, 11), (6, 6, 13, 5)):
        img = np.repeat(rng.integers(0, 256, (h, w), np.uint8), 2, axis=0)
        want = np.empty((height, width), np.uint8)
        for i in range(height):
            for j in range(width):
                y, x = (min(max((k + 0.5) * n / m - 0.5, 0), n - 1) for k, n, m in ((i, 2 * h, height), (j, w, width)))
                a, b, c, d = int(y), min(int(y) + 1, 2 * h - 1), int(x), min(int(x) + 1, w - 1)
                f = img.astype(float)
                want[i, j] = np.floor((f[a, c] * (1 - (x - c)) + f[a, d] * (x - c)) * (1 - (y - a)) + (f[b, c] * (1 - (x - c)) + f[b, d] * (x - c)) * (y - a) + 0.5)
        assert np.array_equal(P.resize(img, width, height), want)
