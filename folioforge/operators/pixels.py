"""Pixel kernels on NumPy arrays, and their use on tables of pages and tiles through Arrow. Images are (height, width[, channels]) uint8."""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.functions.scalars import line_guid


@functools.lru_cache(64)
def _places(before: int, after: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int, np.ndarray]:
    """For each pixel after resizing: the two that it lies between, the second one's share, how many shares there are and which it has."""
    at = np.clip((np.arange(after) + 0.5) * before / after - 0.5, 0, before - 1)
    first = np.floor(at).astype(int)
    shares, share = np.unique(at - first, return_inverse=True)
    return first, np.minimum(first + 1, before - 1), at - first, len(shares), share


def resize(img: np.ndarray, width: int, height: int) -> np.ndarray:
    """Bilinear, by pixel centres, edges repeated."""
    h, w = img.shape[:2]
    if (h, w) == (height, width):
        return img
    (y0, y1, fy, shares, share), (x0, x1, fx, *_) = _places(h, height), _places(w, width)
    shape = (1,) * (img.ndim - 2)
    fy, fx = fy.reshape(-1, 1, *shape), fx.reshape(1, -1, *shape)
    same = np.concatenate([[0], np.cumsum((img[1:] != img[:-1]).any(axis=tuple(range(1, img.ndim))))])  # rows that repeat, as in masks, are computed once
    rows = img[np.flatnonzero(np.diff(same, prepend=-1))].astype(np.float64)
    rows = rows[:, x0] * (1 - fx) + rows[:, x1] * fx
    _, new, back = np.unique((same[y0] * len(rows) + same[y1]) * shares + share, return_index=True, return_inverse=True)
    out = rows[same[y0[new]]] * (1 - fy[new]) + rows[same[y1[new]]] * fy[new]
    out = np.floor(out + 0.5).astype(img.dtype) if img.dtype.kind in "ui" else out.astype(img.dtype)
    return out[back]


def resize_to_width(img: np.ndarray, width: int) -> tuple[np.ndarray, float]:
    ratio = width / img.shape[1]
    return resize(img, width, max(1, int(img.shape[0] * ratio))), ratio


def resize_to_height(img: np.ndarray, height: int) -> tuple[np.ndarray, float]:
    ratio = height / img.shape[0]
    return resize(img, max(1, int(img.shape[1] * ratio)), height), ratio


def pad(img: np.ndarray, pad_x: int, pad_y: int, value: int = 255) -> np.ndarray:
    """Right and bottom only."""
    return np.pad(img, [(0, pad_y), (0, pad_x)] + [(0, 0)] * (img.ndim - 2), constant_values=value)


def preprocess(img: np.ndarray, patch: int = 512, max_width: int = 4096, max_height: int = 2048) -> tuple[np.ndarray, int, int]:
    h, w = img.shape[:2]
    if w > h and w > max_width:
        img, _ = resize_to_width(img, max_width)
    elif h > w and h > max_height:
        img, _ = resize_to_height(img, max_height)
    elif h < patch:
        img, _ = resize_to_height(img, patch)
    px, py = -img.shape[1] % patch, -img.shape[0] % patch
    return pad(img, px, py), px, py


def tile(img: np.ndarray, patch: int) -> list[list[np.ndarray]]:
    return [[img[y : y + patch, x : x + patch] for x in range(0, img.shape[1], patch)] for y in range(0, img.shape[0], patch)]


def stitch(tiles: list[list[np.ndarray]]) -> np.ndarray:
    return np.concatenate([np.concatenate(row, axis=1) for row in tiles], axis=0)


def normalise(img: np.ndarray) -> np.ndarray:
    return img.astype(np.float32) / 255


def grey(img: np.ndarray) -> np.ndarray:
    """From BGR, with the usual luma weights."""
    return img if img.ndim == 2 else np.floor(img @ np.array([0.114, 0.587, 0.299]) + 0.5).astype(np.uint8)


def gaussian(size: int) -> np.ndarray:
    sigma = 0.3 * ((size - 1) * 0.5 - 1) + 0.8
    k = np.exp(-((np.arange(size) - (size - 1) / 2) ** 2) / (2 * sigma**2))
    return k / k.sum()


def blur(g: np.ndarray, block: int) -> np.ndarray:
    """Gaussian mean over block x block pixels, edges repeated; one tap at a time, over whole rows and columns."""
    k, r = gaussian(block), block // 2
    p = np.pad(g, r, mode="edge")
    p = sum(k[j] * p[j : j + g.shape[0]] for j in range(block))
    return sum(k[j] * p[:, j : j + g.shape[1]] for j in range(block))


def binarise(img: np.ndarray, adaptive: bool = True, block: int = 51, c: float = 13) -> np.ndarray:
    """Black and white in three channels: against the local gaussian mean less c, or against 120."""
    g = grey(img).astype(np.float64)
    limit = np.floor(blur(g, block) + 0.5) - c if adaptive else 120
    return np.repeat(np.where(g > limit, 255, 0).astype(np.uint8)[..., None], 3, axis=2)


def pad_to_width(img: np.ndarray, width: int, height: int, value: int = 0) -> np.ndarray:
    """Resized to the width, then centred in the height; an error if it is higher than that."""
    img, _ = resize_to_width(img, width)
    return _centred(img, width, height, value)


def pad_to_height(img: np.ndarray, width: int, height: int, value: int = 0) -> np.ndarray:
    img, _ = resize_to_height(img, height)
    return _centred(img, width, height, value)


def _centred(img: np.ndarray, width: int, height: int, value: int) -> np.ndarray:
    if img.shape[0] > height or img.shape[1] > width:
        raise ValueError(f"{img.shape[1]} x {img.shape[0]} pixels don't fit {width} x {height}")
    top, left = (height - img.shape[0]) // 2, (width - img.shape[1]) // 2
    out = np.full((height, width, *img.shape[2:]), value, img.dtype)
    out[top : top + img.shape[0], left : left + img.shape[1]] = img
    return out


def pad_line(img: np.ndarray, width: int, height: int, value: int = 0) -> np.ndarray:
    """To the side that is relatively shorter of room, then centred on black, or on `value`."""
    to = pad_to_width if width / img.shape[1] <= height / img.shape[0] else pad_to_height
    return to(img, width, height, value)


def prepare_line(img: np.ndarray, width: int, height: int, prepad: bool = False) -> np.ndarray:
    """Recognition input (1, height, width) in -1..1: padded, black and white; with prepad, white squares at both ends first."""
    if prepad:
        side = np.full((img.shape[0], img.shape[0], *img.shape[2:]), 255, img.dtype)
        img = np.concatenate([side, img, side], axis=1)
    img = binarise(pad_line(img, width, height))
    return (img[..., 0].astype(np.float32) / 127.5 - 1)[None]


def crop_prediction(mask: np.ndarray, pad_x: int, pad_y: int, width: int, height: int) -> np.ndarray:
    """Paddings off, then to the page's size; a 0/1 mask keeps what interpolates to a full 1."""
    m = mask[: mask.shape[0] - pad_y or None, : mask.shape[1] - pad_x or None].astype(np.float64)
    return np.floor(resize(m, width, height) + 1e-9).astype(np.uint8)


def rotate(img: np.ndarray, degrees: float) -> np.ndarray:
    """About the centre, counter-clockwise, same canvas, black outside; bilinear."""
    h, w = img.shape[:2]
    t = np.radians(degrees)
    y, x = np.mgrid[:h, :w].astype(np.float64)
    dx, dy = x - w / 2, y - h / 2
    return sample(img, w / 2 + dx * np.cos(t) - dy * np.sin(t), h / 2 + dx * np.sin(t) + dy * np.cos(t))


def sample(img: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    h, w = img.shape[:2]
    x0, y0 = np.floor(x).astype(int), np.floor(y).astype(int)
    out = np.zeros((*x.shape, *img.shape[2:]))
    for dy in (0, 1):
        for dx in (0, 1):
            xi, yi = x0 + dx, y0 + dy
            weight = (1 - np.abs(x - xi)) * (1 - np.abs(y - yi)) * ((xi >= 0) & (xi < w) & (yi >= 0) & (yi < h))
            out += img[np.clip(yi, 0, h - 1), np.clip(xi, 0, w - 1)] * weight.reshape(*x.shape, *(1,) * (img.ndim - 2))
    return np.floor(out + 0.5).astype(img.dtype)


def mask_and_crop(img: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """(height, width, channels): black outside the mask; then rows, and after them columns, go in which a channel is black throughout, inner ones too."""
    img = img if img.ndim == 3 else img[:, :, None]
    return _trimmed(np.where((mask > 0)[:, :, None], img, 0).astype(img.dtype))


def _trimmed(img: np.ndarray) -> np.ndarray:
    img = img[img.any(axis=1).all(axis=1)]
    return img[:, img.any(axis=0).all(axis=1)]


def dilate(mask: np.ndarray, kw: int, kh: int, times: int = 1) -> np.ndarray:
    """By a rectangle kw wide and kh high, anchored at its middle: each pixel takes the greatest of those from k // 2 before it on. So many times over,
    which is once by a larger rectangle."""
    rows = np.flatnonzero(mask.any(axis=1))
    if not len(rows):
        return mask.copy()
    columns = np.flatnonzero(mask.any(axis=0))
    up, left = ((k - 1 - k // 2) * times for k in (kh, kw))  # what is dilated reaches this far before the mask's box, and k // 2 behind it
    window = slice(max(0, rows[0] - up), rows[-1] + 1 + kh // 2 * times), slice(max(0, columns[0] - left), columns[-1] + 1 + kw // 2 * times)
    out, whole = mask[window], np.zeros_like(mask)
    for axis, k in ((1, kw), (0, kh)):
        a, n, k = k // 2 * times, out.shape[axis], (k - 1) * times + 1
        p = np.pad(out, [(a, k - 1 - a) if axis == 0 else (0, 0), (a, k - 1 - a) if axis == 1 else (0, 0)])
        done = 1
        while done < k:  # maxima of 1, 2, 4, ... pixels
            step = min(done, k - done)
            low, high = [slice(None)] * 2, [slice(None)] * 2
            low[axis], high[axis] = slice(0, p.shape[axis] - step), slice(step, None)
            p = np.maximum(p[tuple(low)], p[tuple(high)])
            done += step
        out = p[:n] if axis == 0 else p[:, :n]
    whole[window] = out
    return whole


AROUND = ((0, 1), (1, 1), (1, 0), (1, -1), (0, -1), (-1, -1), (-1, 0), (-1, 1))


def _steps() -> tuple[bytes, bytes]:
    """For each set of neighbours (a bit for each place in AROUND) and each place to come from: where to go on, and which empty sides were passed (1: left, 2: right)."""
    go, passed = bytearray(2048), bytearray(2048)
    for code in range(256):
        for back in range(8):
            empty = [d for d in range(8) if not code >> d & 1]
            turn = [(back + i) % 8 for i in range(1, 9)]
            n = next((i for i, d in enumerate(turn) if code >> d & 1), 8)
            looked = {d for d in [*turn[:n], back] if d in empty}
            go[code * 8 + back] = turn[n] if n < 8 else 8
            passed[code * 8 + back] = (4 in looked) + 2 * (0 in looked)
    return bytes(go), bytes(passed)


GO, PASSED = _steps()


def contours(mask: np.ndarray) -> list[np.ndarray]:
    """Borders of 8-connected regions and of their holes, as (n, 2) arrays of x, y, straight runs reduced to their ends. In the order of their first
    pixels, row by row. Only pixels at the end of a run in their row can start one."""
    on = mask > 0
    rows = np.flatnonzero(on.any(axis=1))
    if not len(rows):
        return []
    top, bottom = int(rows[0]), int(rows[-1]) + 1
    columns = np.flatnonzero(on[top:bottom].any(axis=0))
    left, right = int(columns[0]), int(columns[-1]) + 1
    on = np.pad(on[top:bottom, left:right], 1)
    w = on.shape[1]
    bits = on.view(np.uint8).ravel()
    code, end = np.zeros_like(bits), len(bits) - w - 1
    inner = code[w + 1 : end]
    for dy, dx in reversed(AROUND):
        step = dy * w + dx
        inner += inner
        inner |= bits[w + 1 + step : end + step]
    outer, hole = np.zeros_like(bits), np.zeros_like(bits)  # an outer border starts right of a gap, a hole's border left of one
    outer[1:], hole[:-1] = bits[1:] > bits[:-1], bits[:-1] > bits[1:]
    starts, flat, out = (bytearray(outer.data), bytearray(hole.data)), code.tobytes(), []
    a, b = starts[0].find(1), starts[1].find(1)
    while a >= 0 or b >= 0:
        first = b < 0 or 0 <= a <= b
        path = np.array(_follow(flat, w, a if first else b, 4 if first else 0, starts))
        out.append(np.stack([path % w + (left - 1), path // w + (top - 1)], axis=1))
        a, b = (starts[i].find(1, p) if p >= 0 else p for i, p in enumerate((a, b)))
    return out


def _follow(code: bytes, w: int, start: int, side: int, starts: tuple[bytearray, bytearray]) -> list[int]:
    """Walks around, keeping the empty side at hand, and takes every (pixel, empty left or right neighbour) that it passes out of starts. Returns the pixels where it
    turns; straight runs between pixels alike are passed in one go."""
    offset = [dy * w + dx for dy, dx in AROUND]
    lefts, rights = starts
    path, at, back, first, last, n = [], start, side, -1, -1, 0
    while True:
        c = code[at]
        d, marks = GO[c * 8 + back], PASSED[c * 8 + back]
        if d == 8:
            lefts[at] = rights[at] = 0
            return [start]
        if marks & 1:
            lefts[at] = 0
        if marks & 2:
            rights[at] = 0
        if n and at == start and d == first:
            break
        if not n:
            first = d
        if d != last:
            path.append(at)
        last, step = d, offset[d]
        at, back, n = at + step, d ^ 4, n + 1
        if not d & 1 and code[at] == c and GO[c * 8 + back] == d:
            run = _alike(code, w, at, d)
            if 0 < (start - at) * (1 if step > 0 else -1) < run * abs(step) and (start - at) % step == 0:
                run = (start - at) // step
            if at == start:
                continue
            marks, end = PASSED[c * 8 + back], at + run * step
            for bit, side_starts in ((1, lefts), (2, rights)):
                if marks & bit:
                    side_starts[at:end:step] = bytes(run)
            at, n = end, n + run
    if n > 2 and path[0] == start and last == first:
        path = path[1:]
    return path if n > 2 else _short(start, path, n, offset, first)


def _alike(code: bytes, w: int, at: int, d: int) -> int:
    """Number of pixels from at on, in direction d (0, 2, 4, 6), with the same neighbours."""
    row = at - at % w
    line = code[at : row + w] if d == 0 else code[at::w] if d == 2 else code[at : row - 1 if row else None : -1] if d == 4 else code[at::-w]
    return len(line) - len(line.lstrip(code[at : at + 1]))


def _short(start: int, path: list[int], n: int, offset: list[int], first: int) -> list[int]:
    """A border of one or two steps keeps all its pixels."""
    return [start, start + offset[first]][:n]


def contour_area(p: np.ndarray) -> float:
    x, y = p[:, 0].astype(np.int64), p[:, 1].astype(np.int64)
    return abs(int((x * np.roll(y, -1) - np.roll(x, -1) * y).sum())) / 2


def simplify(p: np.ndarray, share: float = 0.001) -> np.ndarray:
    """Douglas-Peucker on a closed contour; tolerance: share of the perimeter."""
    if len(p) < 4:
        return p
    eps = share * np.hypot(*(p - np.roll(p, 1, axis=0)).T).sum()
    far = int(np.hypot(*(p - p[0]).T).argmax())
    keep = {0, far}
    closed = np.concatenate([p, p[:1]]).astype(np.float64)
    todo = [(0, far), (far, len(p))]
    while todo:
        a, b = todo.pop()
        if b - a < 2:
            continue
        v, q = closed[b] - closed[a], closed[a + 1 : b] - closed[a]
        n = np.hypot(*v)
        d = np.abs(q[:, 0] * v[1] - q[:, 1] * v[0]) / n if n else np.hypot(*q.T)
        i = int(d.argmax())
        if d[i] > eps:
            keep.add(a + 1 + i)
            todo += [(a, a + 1 + i), (a + 1 + i, b)]
    return p[sorted(i for i in keep if i < len(p))]


def convex_hull(p: np.ndarray) -> np.ndarray:
    pts = sorted(set(map(tuple, p.tolist())))
    if len(pts) < 3:
        return np.array(pts)

    def chain(points):
        out: list[tuple[int, int]] = []
        for q in points:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (q[1] - out[-2][1]) - (out[-1][1] - out[-2][1]) * (q[0] - out[-2][0]) <= 0:
                out.pop()
            out.append(q)
        return out[:-1]

    return np.array(chain(pts) + chain(reversed(pts)))


def least_rectangle(p: np.ndarray) -> tuple[float, float, float, float, float]:
    """(cx, cy, width, height, angle) of the least rotated rectangle around the points; angle in (0, 90]."""
    if is_box(p):
        (x, y), (x2, y2) = p.min(axis=0).tolist(), p.max(axis=0).tolist()
        if x2 > x and y2 > y:
            return ((x + x2) / 2, (y + y2) / 2, float(y2 - y), float(x2 - x), 90.0)
    hull = convex_hull(p).astype(np.float64)
    if len(hull) == 1:
        return (*hull[0], 0.0, 0.0, 90.0)
    best = None
    for v in np.roll(hull, -1, axis=0) - hull:
        a = np.arctan2(v[1], v[0]) % (np.pi / 2)
        a = a if a > 1e-12 else np.pi / 2
        u, w = np.array([np.cos(a), np.sin(a)]), np.array([-np.sin(a), np.cos(a)])
        s, t = hull @ u, hull @ w
        size = (s.max() - s.min()) * (t.max() - t.min())
        if best is None or size < best[0] - 1e-9:
            c = u * (s.max() + s.min()) / 2 + w * (t.max() + t.min()) / 2
            best = (size, (float(c[0]), float(c[1]), float(s.max() - s.min()), float(t.max() - t.min()), float(np.degrees(a))))
    return best[1]


def fill(shape: tuple[int, int], p: np.ndarray) -> np.ndarray:
    """Mask of a polygon, its border included."""
    out = np.zeros(shape, np.uint8)
    (x0, y0), (x1, y1) = np.maximum(p.min(axis=0), 0).tolist(), np.minimum(p.max(axis=0) + 1, (shape[1], shape[0])).tolist()
    if x1 > x0 and y1 > y0:
        out[y0:y1, x0:x1] = _filled((y1 - y0, x1 - x0), p - (x0, y0))
    return out


def _filled(shape: tuple[int, int], p: np.ndarray) -> np.ndarray:
    y, x = np.mgrid[: shape[0], : shape[1]]
    inside, edge = np.zeros(shape, bool), np.zeros(shape, bool)
    for (x1, y1), (x2, y2) in zip(p.tolist(), np.roll(p, -1, axis=0).tolist(), strict=True):
        if y1 != y2:
            inside ^= ((y1 > y) != (y2 > y)) & (x < (x2 - x1) * (y - y1) / (y2 - y1) + x1)
        n = max(abs(x2 - x1), abs(y2 - y1), 1)
        i = np.arange(n + 1)
        ex, ey = x1 + np.floor((x2 - x1) * i / n + 0.5).astype(int), y1 + np.floor((y2 - y1) * i / n + 0.5).astype(int)
        ok = (ex >= 0) & (ex < shape[1]) & (ey >= 0) & (ey < shape[0])
        edge[ey[ok], ex[ok]] = True
    return ((inside | edge) * 255).astype(np.uint8)


def box_of(p: np.ndarray) -> tuple[int, int, int, int]:
    """x, y, w, h of the pixels' bounding box."""
    (x, y), (x2, y2) = p.min(axis=0).tolist(), p.max(axis=0).tolist()
    return x, y, x2 - x + 1, y2 - y + 1


def is_box(p: np.ndarray) -> bool:
    """Four points that are an upright box's corners, one after the other."""
    if len(p) != 4:
        return False
    (ax, ay), (bx, by), (cx, cy), (dx, dy) = p.tolist()
    return (ay == by and bx == cx and cy == dy and dx == ax) or (ax == bx and by == cy and cx == dx and dy == ay)


def extract_line(img: np.ndarray, p: np.ndarray, height: int, k: float) -> np.ndarray | None:
    """What a page shows under a line's polygon, dilated by a rectangle int(height * k) wide and as much times k high; None if that is nothing."""
    return line_cutter(img, p, height)(k)


def line_cutter(img: np.ndarray, p: np.ndarray, height: int) -> Callable[[float], np.ndarray | None]:
    """extract_line by k, for one line: its polygon is filled once. Upright boxes stay boxes when dilated, so they are cut out; while nothing in such a
    cut is black, it is a view of the page."""
    img = img if img.ndim == 3 else img[:, :, None]
    x, y, w, h = box_of(p)
    left, top, right, bottom = max(0, x), max(0, y), min(img.shape[1], x + w), min(img.shape[0], y + h)
    line = None if is_box(p) and right > left and bottom > top else fill(img.shape[:2], p)[top:bottom, left:right] if right > left and bottom > top else np.zeros((0, 0), np.uint8)
    clear: tuple[int, int, int, int] | None = None

    def cut(k: float) -> np.ndarray | None:
        nonlocal clear
        kw = int(height * k)
        kh = int(kw * k)
        if kw < 1 or kh < 1:
            return None
        x0, y0, x1, y1 = max(0, x - kw), max(0, y - kh), min(img.shape[1], x + w + kw), min(img.shape[0], y + h + kh)
        if x1 <= x0 or y1 <= y0:
            return None
        if line is not None:  # the dilated line lies within this much of its box
            mask = np.zeros((y1 - y0, x1 - x0), np.uint8)
            if line.size:
                mask[top - y0 : bottom - y0, left - x0 : right - x0] = line
            return mask_and_crop(img[y0:y1, x0:x1], dilate(mask, kw, kh))
        x0, y0, x1, y1 = max(0, left - (kw - 1 - kw // 2)), max(0, top - (kh - 1 - kh // 2)), min(img.shape[1], right + kw // 2), min(img.shape[0], bottom + kh // 2)
        part = img[y0:y1, x0:x1]
        if clear and clear[0] <= x0 and clear[1] <= y0 and clear[2] >= x1 and clear[3] >= y1:
            return part
        if part.min() == 0:
            return _trimmed(part)
        clear = x0, y0, x1, y1
        return part

    return cut


def extract_lines(img: np.ndarray, lines: list[np.ndarray], k: float = 2.5, tolerance: float = 4.0, local: bool = False) -> list[tuple[np.ndarray, float]]:
    """(line image, k) in reading order: k shrinks by tenths, ten times at most, while a line comes out higher than tolerance times its box, and the
    next line starts with it. A line that gives nothing is black, and leaves k as it was. With local, a curved line is straightened by itself, and only
    such lines hand their k on."""
    out = []
    for p in lines:
        height, now = box_of(p)[3], k
        curved, centres, level, spread = line_curve(img.shape[:2], p) if local else (False, None, None, 0.0)
        if curved:
            room = max(1, int(height * k))
            part, mask = unbent_line(img, p, centres, level, room, max(1, int(room * k)) + 2 * int(spread) + height)

        def take_curved(now: float) -> np.ndarray | None:
            kw = int(height * now)
            kh = int(kw * now)
            return mask_and_crop(part, dilate(mask, kw, kh)) if kw > 0 and kh > 0 else None

        take = take_curved if curved else line_cutter(img, p, height)
        line = take(now)
        for _ in range(10):
            if line is None or line.shape[0] <= height * tolerance:
                break
            now -= 0.1
            if now <= 0.1:
                break
            line = take(now)
        if line is None:
            line = np.zeros((height, 2 * height, 1 if img.ndim == 2 else img.shape[2]), np.uint8)
        elif curved or not local:
            k = now
        out.append((line.copy(), now if local else k))
    return out


def unbent_line(img: np.ndarray, p: np.ndarray, centres: np.ndarray, level: np.ndarray, side: int, above: int) -> tuple[np.ndarray, np.ndarray]:
    """Page and mask of one line, both warped so that it lies on one level; only what lies within side and above of its box is computed."""
    x, y, w, h = box_of(p)
    window = max(0, x - side), max(0, y - above), min(img.shape[1], x + w + side), min(img.shape[0], y + h + above)
    return unbend(img, centres, level, window=window), unbend(fill(img.shape[:2], p), centres, level, window=window)


def line_threshold(mask: np.ndarray, width: int = 20) -> float:
    """How far apart lines are: of slices across the mask's box, as many as half its width in slices and as many pixels apart, the one with most contours, the
    first of equals; the median of their centres, over their number, cut to a whole number. 0 without any."""
    on = np.argwhere(mask > 0)
    if not len(on):
        return 0.0
    (y, x), (y2, x2) = on.min(axis=0).tolist(), on.max(axis=0).tolist()
    steps, best = (x2 - x + 1) // width // 2, []
    for step in range(1, steps + 1):
        start = x + steps * step
        found = contours(mask[y : y2 + 1, start : start + width])
        best = found if len(found) > len(best) else best
    centres = [b[1] + b[3] // 2 for b in map(box_of, best)]
    return float(np.median(centres) // len(centres)) if centres else 0.0


def slice_centre(mask: np.ndarray, x: int, y: int) -> tuple[int, int, int]:
    """(x, y, height) of the largest contour in a slice that lies at x, y: centre of its least rectangle, height of its box; of the slice if it is empty."""
    found = contours(mask)
    if not found:
        return x + mask.shape[1] // 2, y + mask.shape[0] // 2, mask.shape[0]
    c = max(found, key=contour_area)
    cx, cy = least_rectangle(c)[:2]
    return x + int(cx), y + int(cy), box_of(c)[3]


def line_curve(shape: tuple[int, int], p: np.ndarray, width: int = 40) -> tuple[bool, np.ndarray, np.ndarray, float]:
    """(curved, centres of five slices (n, 2: x, y), the same on one height, spread of the centres): a line is curved if its centres are
    further apart than its slices are high on average."""
    x, y, w, h = box_of(p)
    mask = fill(shape, p)
    starts = (x, x + w // 4 - width, x + w // 2, x + w // 2 + w // 4, x + w - width)
    got = [slice_centre(mask[y : y + h, max(0, s) : max(0, s + width)], s, y) for s in starts]
    centres, spread = np.array([g[:2] for g in got], float), float(max(g[1] for g in got) - min(g[1] for g in got))
    if spread <= np.mean([g[2] for g in got]):
        return False, centres, centres, 0.0
    target = round(float(centres[:, 1].mean()))  # half to even
    return True, centres, np.stack([centres[:, 0], np.full(5, target)], axis=1), spread


def global_curve(curves: list[tuple[bool, np.ndarray, np.ndarray, float]]) -> int:
    """Of the curved lines the one whose spread is nearest to the mean of all (straight ones count 0), the first of equals."""
    spread = np.array([c[3] for c in curves])
    away = np.where(spread > 0, np.abs(spread - spread.mean()), np.inf)
    return int(away.argmin())


def unbend(img: np.ndarray, centres: np.ndarray, level: np.ndarray, alpha: float = 0.5, window: tuple[int, int, int, int] | None = None) -> np.ndarray:
    """A page, or its mask, warped so that the centres come to lie on one level; the page's corners stay. With a window, only what shows there."""
    h, w = img.shape[:2]
    corners = np.array([(0, 0), (w, 0), (0, h), (w, h)], float)
    return thin_plate_warp(img, np.concatenate([centres, corners]), np.concatenate([level, corners]), alpha, window)


def line_contours(mask: np.ndarray) -> list[np.ndarray]:
    """Contours of more than 10 pixels, from the bottom up, then by x."""
    found = [c for c in contours(mask) if contour_area(c) > 10]
    return sorted(found, key=lambda c: (-int(c[:, 1].min() + c[:, 1].max()), int(c[:, 0].min())))


def page_angle(mask: np.ndarray, most: float = 5.0) -> float:
    """Degrees by which the lines of a mask are turned: see layout.page_angle."""
    angles = [least_rectangle(c)[4] for c in contours(mask) if contour_area(c) > mask.size * 0.001]
    low, high = [a for a in angles if a != 0 and a < most], [a for a in angles if abs(a) != 90 and a > 90 - most]
    if len(low) > len(high):
        return float(np.mean(low))
    return -(90 - float(np.mean(high))) if high else 0.0


def thin_plate_warp(img: np.ndarray, src: np.ndarray, dst: np.ndarray, alpha: float = 0.5, window: tuple[int, int, int, int] | None = None) -> np.ndarray:
    """Moves points src to dst (n, 2: x, y) by a regularised thin-plate spline, everything else smoothly with them. window: x, y and their ends, of
    the part that is wanted."""

    def kernel(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        r2 = ((a[:, None] - b[None]) ** 2).sum(axis=2)
        return np.where(r2 > 0, r2 * np.log(np.maximum(r2, 1e-12)) / 2, 0)

    n, scale = len(dst), float(max(img.shape[:2]))
    d, s = dst / scale, src / scale
    p = np.concatenate([np.ones((n, 1)), d], axis=1)
    m = np.block([[kernel(d, d) + alpha * 1e-6 * np.eye(n), p], [p.T, np.zeros((3, 3))]])
    coef = np.linalg.lstsq(m, np.concatenate([s, np.zeros((3, 2))]), rcond=None)[0]
    x0, y0, x1, y1 = window or (0, 0, img.shape[1], img.shape[0])
    y, x = np.mgrid[y0:y1, x0:x1]
    q = np.stack([x.ravel(), y.ravel()], axis=1) / scale
    at = (kernel(q, d) @ coef[:n] + np.concatenate([np.ones((len(q), 1)), q], axis=1) @ coef[n:]) * scale
    return sample(img, at[:, 0].reshape(x.shape), at[:, 1].reshape(x.shape))


def image_of(b: pa.RecordBatch, i: int) -> np.ndarray | None:
    """Row i of (page_id, height, width, channels, data), in three channels; None if it holds no image of that size."""
    h, w, c, data = (b.column(j)[i].as_py() for j in range(1, 5))
    if not (data and h and w and c and len(data) == h * w * c):
        return None
    img = np.frombuffer(data, np.uint8).reshape(h, w, c)
    return img[:, :, :3] if c >= 3 else np.broadcast_to(img[:, :, :1], (h, w, 3))


def array_of(row) -> np.ndarray:
    a = np.frombuffer(row.data, np.uint8)
    return a.reshape(row.height, row.width, row.channels) if row.channels > 1 else a.reshape(row.height, row.width)


def tiles(pages: DataFrame, patch: int = 512, transform: Callable[[np.ndarray], np.ndarray] | None = None) -> DataFrame:
    """pages (page_id, height, width, channels, data) -> tiles (page_id, ty, tx, height, width, channels, data), paddings and page size with each."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for row in b.itertuples():
                img, px, py = preprocess(array_of(row), patch)
                rows = [(row.page_id, ty, tx, patch, patch, row.channels, (transform(t) if transform else t).tobytes(), px, py, row.width, row.height) for ty, line in enumerate(tile(img, patch)) for tx, t in enumerate(line)]
                yield pd.DataFrame(rows, columns=["page_id", "ty", "tx", "height", "width", "channels", "data", "pad_x", "pad_y", "page_width", "page_height"])

    return pages.select("page_id", "height", "width", "channels", "data").mapInPandas(run, f"page_id {pages.schema['page_id'].dataType.simpleString()}, ty int, tx int, height int, width int, channels int, data binary, pad_x int, pad_y int, page_width int, page_height int")


def scaled(pages: DataFrame, width: int = 2048) -> DataFrame:
    """pages -> (page_id, guid, height, width, channels, data): every page at one width, its height in proportion. A page without an image has null sizes and data."""
    kind = pages.schema["page_id"].dataType.simpleString()
    types = (pa.int32(), pa.int32(), pa.int32(), pa.binary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                img, row = image_of(b, i), (None,) * 4
                if img is not None:
                    img = resize_to_width(img, width)[0]
                    row = (*img.shape, img.tobytes())
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, 1), *[pa.array([v], t) for v, t in zip(row, types, strict=True)]], ["page_id", "height", "width", "channels", "data"])

    out = pages.select("page_id", "height", "width", "channels", "data").mapInArrow(run, f"page_id {kind}, height int, width int, channels int, data binary")
    return out.select("page_id", line_guid(F.col("page_id"), F.lit("page")).alias("guid"), "height", "width", "channels", "data")


def stitched(masks: DataFrame) -> DataFrame:
    """Masks of tiles (as tiles(), one byte a pixel, 0 or 1) -> pages of masks at page size. One shuffle, by page; a group is one page's tiles."""

    def one(b: pd.DataFrame) -> pd.DataFrame:
        b = b.sort_values(["ty", "tx"])
        rows = [[np.frombuffer(r.data, np.uint8).reshape(r.height, r.width) for r in line.itertuples()] for _, line in b.groupby("ty")]
        r = b.iloc[0]
        m = crop_prediction(stitch(rows), int(r.pad_x), int(r.pad_y), int(r.page_width), int(r.page_height))
        return pd.DataFrame([(r.page_id, m.shape[0], m.shape[1], (m * 255).tobytes())], columns=["page_id", "height", "width", "mask"])

    return masks.groupBy("page_id").applyInPandas(one, f"page_id {masks.schema['page_id'].dataType.simpleString()}, height int, width int, mask binary")
