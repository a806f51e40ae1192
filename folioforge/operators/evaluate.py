"""Character error rate over pairs of prediction and label."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from folioforge.functions.scalars import natural_key


def edit_distance(a: str, b: str) -> int:
    """Levenshtein distance in code points. Myers' bit vectors in Hyyro's form: the longer text is one long integer, so each character of
    the shorter one takes a dozen operations on it."""
    if len(a) < len(b):
        a, b = b, a
    start, end, n = 0, len(a), len(b)
    while n and a[end - 1] == b[n - 1]:
        end, n = end - 1, n - 1
    while start < n and a[start] == b[start]:
        start += 1
    a, b = a[start:end], b[start:n]
    if not b:
        return len(a)
    places: dict[str, list[int]] = {}
    for i, c in enumerate(a):
        places.setdefault(c, []).append(i)
    match, size = {}, len(a) // 8 + 1
    for c in set(b) & places.keys():
        bits = bytearray(size)
        for i in places[c]:
            bits[i >> 3] |= 1 << (i & 7)
        match[c] = int.from_bytes(bits, "little")
    full, top = (1 << len(a)) - 1, len(a) - 1
    up, down, d = full, 0, len(a)
    for c in b:
        m = match.get(c, 0)
        zero = ((((m & up) + up) & full) ^ up) | m | down
        more, less = down | (full ^ (zero | up)), zero & up
        d += (more >> top) - (less >> top)
        more, less = ((more << 1) | 1) & full, (less << 1) & full
        up, down = less | (full ^ (zero | more)), more & zero
    return d


def edit_distances(pairs: list[tuple[str, str]], words: int = 4096, room: int = 1 << 22) -> list[int]:
    """edit_distance of many pairs at once, pairs of like length together, about `words` 64-bit words of their longer texts in each step."""
    out, todo = [0] * len(pairs), []
    for i, (a, b) in enumerate(pairs):
        if a != b and a and b:
            a, b = (b, a) if len(a) < len(b) else (a, b)
            todo.append((len(b) + len(a) // 64, i, a, b))
        else:
            out[i] = 0 if a == b else max(len(a), len(b))
    todo.sort(key=lambda t: t[:2])
    while todo:
        group, n = [], 0
        while todo and (not group or n + len(todo[-1][2]) // 64 + 1 <= words and todo[-1][0] * 5 >= group[0][0] * 4):
            n += len(todo[-1][2]) // 64 + 1
            group.append(todo.pop())
        found = _abreast([(a, b) for _, _, a, b in group], room) if n > 256 else None
        for j, (_, i, a, b) in enumerate(group):
            out[i] = edit_distance(a, b) if found is None else found[j]
    return out


def _abreast(pairs: list[tuple[str, str]], room: int) -> list[int] | None:
    """Distances of pairs (longer, shorter). The bit vectors of edit_distance, cut into words: each word is one column behind the word before it, whose last
    row's change it takes over, so that all words of all pairs take a step at once. None if match vectors would take more than `room` words."""
    code = lambda t: np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32)
    rows, columns = [code(a) for a, _ in pairs], [code(b) for _, b in pairs]
    symbols = np.unique(np.concatenate(columns))
    m, n = np.array([len(a) for a in rows]), np.array([len(b) for b in columns])
    wide = (m + 63) // 64
    first = np.cumsum(wide) - wide
    last, size = first + wide - 1, int(wide.sum())
    if (len(symbols) + 1) * size > room:
        return None
    match = np.zeros((len(symbols) + 1) * size, np.uint64)  # the last symbol is none
    for a, start in zip(rows, first.tolist(), strict=True):
        c, at = np.minimum(np.searchsorted(symbols, a), len(symbols) - 1), np.arange(len(a))
        ok = symbols[c] == a
        np.add.at(match, c[ok] * size + start + at[ok] // 64, np.uint64(1) << (at[ok] % 64).astype(np.uint64))
    steps = int((n + wide).max())
    feed = np.full((steps, len(pairs)), len(symbols), np.int64)
    for j, b in enumerate(columns):
        feed[: len(b), j] = np.searchsorted(symbols, b)
    feed = feed * size + first
    one, end = np.uint64(1), np.uint64(63)
    up, down = np.full(size, ~np.uint64(0)), np.zeros(size, np.uint64)
    equal, zero, x, more, less = (np.empty(size, np.uint64) for _ in range(5))
    at, at_next = np.full(size, len(symbols) * size) + np.arange(size), np.empty(size, np.int64)
    more_in, more_next, less_in, less_next = (np.zeros(size, np.uint64) for _ in range(4))
    top, distance = ((m - 1) % 64).astype(np.uint64), m.astype(np.int64)
    for t in range(steps):
        np.add(at[:-1], 1, out=at_next[1:])
        at_next[first] = feed[t]
        at, at_next = at_next, at
        more_in[first], less_in[first] = 1, 0
        match.take(at, out=equal, mode="clip")
        np.bitwise_or(equal, down, out=x)
        equal |= less_in
        np.bitwise_and(equal, up, out=zero)
        zero += up
        zero ^= up
        zero |= equal
        np.bitwise_or(zero, up, out=more)
        np.invert(more, out=more)
        more |= down
        np.bitwise_and(up, zero, out=less)
        seen = t - wide + 1
        change = (more[last] >> top & one).astype(np.int64) - (less[last] >> top & one).astype(np.int64)
        distance += np.where((seen >= 0) & (seen < n), change, 0)
        np.right_shift(more[:-1], end, out=more_next[1:])
        np.right_shift(less[:-1], end, out=less_next[1:])
        more += more
        more |= more_in
        less += less
        less |= less_in
        np.bitwise_or(x, more, out=up)
        np.invert(up, out=up)
        up |= less
        np.bitwise_and(more, x, out=down)
        more_in, more_next, less_in, less_next = more_next, more_in, less_next, less_in
    return distance.tolist()


@F.arrow_udf(IntegerType())
def whole_distance(a: pa.Array, b: pa.Array) -> pa.Array:
    pairs = list(zip(a.to_pylist(), b.to_pylist(), strict=True))
    found = iter(edit_distances([p for p in pairs if None not in p]))
    return pa.array([None if None in p else next(found) for p in pairs], pa.int32())


def cer(prediction: Column, label: Column, distance: Callable[[Column, Column], Column] = F.levenshtein) -> Column:
    """Edit distance over label length; an empty label: 0 if the prediction is empty too, else 1. whole_distance is the faster one on long texts."""
    d = distance(prediction, label)
    return F.when(F.length(label) > 0, d / F.length(label)).otherwise((F.length(prediction) > 0).cast("double"))


def pair_by_position(images: DataFrame, labels: DataFrame, group: str = "distribution", name: str = "name") -> DataFrame:
    """n-th image with n-th label of a group, both in natural order; what has no partner is left out."""
    w = Window.partitionBy(group).orderBy(natural_key(F.col(name)), name)
    a = images.withColumn("pos", F.row_number().over(w)).withColumnRenamed(name, "image_name")
    b = labels.withColumn("pos", F.row_number().over(w)).withColumnRenamed(name, "label_name")
    return a.join(b, [group, "pos"])


def score_pairs(pairs: DataFrame, prediction: str = "prediction", label: str = "label", distance: Callable[[Column, Column], Column] = F.levenshtein) -> DataFrame:
    return pairs.withColumn("cer", cer(F.col(prediction), F.col(label), distance))


def summary(scores: DataFrame, *keys: str) -> DataFrame:
    """Per group: pairs, mean, median and greatest CER."""
    return scores.groupBy(*keys).agg(F.count(F.lit(1)).alias("pairs"), F.avg("cer").alias("mean_cer"), F.median("cer").alias("median_cer"), F.max("cer").alias("max_cer"))


def evaluation_plan(models: DataFrame, pairs: DataFrame) -> DataFrame:
    """Every model against every pair; models are a handful of configurations."""
    if models.limit(1001).count() > 1000:
        raise ValueError("more than 1000 models")
    return pairs.join(F.broadcast(models), how="cross")
