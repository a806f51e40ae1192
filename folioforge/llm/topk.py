"""Exact top-k search by inner product, with multi-resolution segment statistics.

For vectors q and x cut into segments of n components with means m and deviations s, the squared distance is at least
sum n * ((m_q - m_x)^2 + (s_q - s_x)^2), so at most q.x <= sum n * (m_q * m_x + s_q * s_x). The bound is taken with few segments, then with more
on what is left, and exact products are computed for survivors only. A pair is dropped only if its bound lies under the k-th best
score that the query is known to have: at first on a bounded sample of vectors, then on what the task has met.

Vectors are dealt out to parts of a bounded size. A task holds one part at a time and lets all queries, of which each part has a copy, stream
past it in blocks; it gives k rows a query and part at most. Neither the driver nor a task ever holds all queries or all vectors. Scores
are exact integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioforge.llm.common import Scratch, even_keys

BLOCK = 2048  # vectors, and queries, that are compared at once
PART = (4096, 131_072)  # vectors of a part: two parts a core, but not below or above this
SAMPLE = 1024  # vectors from which the first k-th best scores are taken
LEVELS = (4, 16)  # segments, coarse to fine
LONG = (1 << 63) - 1


def quantise(v: list, scale: int) -> np.ndarray | None:
    """floor(scale * x) as int64, as Python integers if one is large; None if a component is null or not finite."""
    if v is None or any(x is None for x in v):
        return None
    x = np.array(v, np.float64)
    if not np.isfinite(x).all():
        return None
    y = np.floor(x * scale)
    return y.astype(np.int64) if np.abs(y).max(initial=0) < 2**24 else np.array([int(t) for t in y.tolist()], object)


class Side:
    """Vectors of one length, with segment statistics: `bounds[l]` has len * mean and len * deviation (queries: as they are, so that
    a product of rows is the bound)."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, query: bool):
        self.ids, self.x, self.bounds = ids, x, []
        f = x.astype(np.float64)
        self.top = float(np.abs(f).max(initial=0))
        for n in LEVELS:
            cuts = np.array_split(np.arange(x.shape[1]), min(n, max(1, x.shape[1])))
            parts = [f[:, c] for c in cuts]
            mean = np.stack([p.mean(axis=1) if p.shape[1] else np.zeros(len(f)) for p in parts], axis=1)
            dev = np.stack([p.std(axis=1) if p.shape[1] else np.zeros(len(f)) for p in parts], axis=1)
            size = np.array([len(c) for c in cuts])
            self.bounds.append(np.concatenate([mean * size, dev * size] if query else [mean, dev], axis=1))


def sides(ids: list, vectors: list, scale: int, query: bool) -> dict[tuple[int, bool], Side]:
    """By length, and with large components apart."""
    groups: dict[tuple[int, bool], tuple[list, list]] = {}
    for i, v in zip(ids, vectors, strict=True):
        q = quantise(v, scale)
        if q is not None and i is not None:
            a, b = groups.setdefault((len(q), q.dtype == object), ([], []))
            a.append(i)
            b.append(q)
    return {k: Side(np.array(a, np.int64), np.array(b).reshape(len(a), k[0]), query) for k, (a, b) in groups.items()}


def arrow_sides(ids: pa.Array, v: pa.Array, scale: int) -> dict[tuple[int, bool], Side]:
    """sides() of vectors under Arrow; without a detour over Python objects where all are of one length, complete and of usual size."""
    flat, n = v.flatten(), len(v)
    if n and not ids.null_count and not v.null_count and not flat.null_count and len(set(np.diff(v.offsets.to_numpy()).tolist())) == 1:
        y = np.floor(flat.to_numpy().astype(np.float64).reshape(n, -1) * float(scale))
        if np.isfinite(y).all() and np.abs(y).max(initial=0) < 2**24:
            return {(y.shape[1], False): Side(ids.to_numpy(), y.astype(np.int64), False)}
    return sides(ids.to_pylist(), v.to_pylist(), scale, False)


def products(q: Side, c: Side, qi: np.ndarray, ci: np.ndarray) -> np.ndarray:
    """Exact inner products of pairs, held to the range of a long."""
    if q.x.dtype == object or c.x.dtype == object:
        return np.array([max(-LONG - 1, min(LONG, sum(int(a) * int(b) for a, b in zip(q.x[i], c.x[j], strict=True)))) for i, j in zip(qi, ci, strict=True)], np.int64)
    out = np.empty(len(qi), np.int64)
    for s in range(0, len(qi), 100_000):
        out[s : s + 100_000] = np.einsum("ij,ij->i", q.x[qi[s : s + 100_000]], c.x[ci[s : s + 100_000]])
    return out


class Search:
    """The k best of each query, over the candidates met so far."""

    def __init__(self, q: Side, k: int, floor: np.ndarray | None = None):
        self.q, self.k = q, k
        self.floor = np.full(len(q.ids), -LONG - 1, np.int64) if floor is None else floor.copy()
        self.qi, self.ids, self.scores = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def meet(self, c: Side) -> None:
        q, slack = self.q, 1e-9 * (1 + self.q.top * c.top * max(1, self.q.x.shape[1])) + 1e-6
        line = self.floor.astype(np.float64) * (1 - np.sign(self.floor) * 1e-15) - slack
        near = q.bounds[0] @ c.bounds[0].T >= line[:, None]
        qi, ci = np.nonzero(near)
        if len(qi) and len(q.bounds) > 1:
            if len(qi) > near.size // 16:  # too many for pair by pair
                qi, ci = np.nonzero(near & (q.bounds[1] @ c.bounds[1].T >= line[:, None]))
            else:
                ok = np.einsum("ij,ij->i", q.bounds[1][qi], c.bounds[1][ci]) >= line[qi]
                qi, ci = qi[ok], ci[ok]
        other = q.ids[qi] != c.ids[ci]
        qi, ci = qi[other], ci[other]
        score = products(q, c, qi, ci)
        ok = score >= self.floor[qi]
        self.qi = np.concatenate([self.qi, qi[ok]])
        self.ids = np.concatenate([self.ids, c.ids[ci[ok]]])
        self.scores = np.concatenate([self.scores, score[ok]])
        self.settle()

    def settle(self) -> None:
        order = np.lexsort((self.ids, ~self.scores, self.qi))
        self.qi, self.ids, self.scores = self.qi[order], self.ids[order], self.scores[order]
        first = np.searchsorted(self.qi, np.arange(len(self.q.ids)))
        rank = np.arange(len(self.qi)) - first[self.qi]
        keep = rank < self.k
        self.qi, self.ids, self.scores, rank = self.qi[keep], self.ids[keep], self.scores[keep], rank[keep]
        last = rank == self.k - 1
        self.floor[self.qi[last]] = np.maximum(self.floor[self.qi[last]], self.scores[last])


def search(vectors: DataFrame, queries: DataFrame, k: int = 10, scale: int = 1024) -> DataFrame:
    """vectors, queries (vec_id, embedding) -> (query_id, rank, vec_id, score): each query's k best, ties to the smaller vec_id.

    Score: inner product of floor(scale * x), beyond a long's range held at its end. Vectors that are null, hold null or non-finite
    components, or lack a vec_id take no part; nor do vectors of another length than the query's, for that query, or of its own
    vec_id. A vec_id among the queries counts once, with its least vector; a repeated row of `vectors` is a candidate each time.
    Fewer than k candidates: all of them. Empty tables give an empty result; other columns are ignored.
    """
    spark, scratch = vectors.sparkSession, Scratch(vectors.sparkSession, "topk")
    kinds = {d.schema["embedding"].dataType.simpleString() for d in (vectors, queries)}
    kind = kinds.pop() if len(kinds) == 1 and kinds <= {"array<float>", "array<double>"} else "array<double>"
    known = "vec_id is not null and embedding is not null"
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(kind).alias("embedding")).filter(known)
    q = queries.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(kind).alias("embedding")).filter(known)
    some = v.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).collect()
    q = q.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    q = scratch.write(q.mapInArrow(_floors([r.vec_id for r in some], [r.embedding for r in some], k, scale), f"vec_id long, embedding {kind}, floor long"), "queries")
    n = v.count()
    parts = -(-n // min(PART[1], max(PART[0], n // (2 * spark.sparkContext.defaultParallelism) + 1))) or 1
    names = F.array(*map(F.lit, even_keys(spark, parts)))
    # copies of a row go to one part, so that a vec_id is dealt out by itself, not by its number of rows
    mine = F.element_at(names, F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(parts)).cast("int") + 1)
    rows = v.select(mine.alias("part"), F.lit(False).alias("asks"), "vec_id", "embedding", F.lit(None).cast("long").alias("floor"))
    asked = q.select(F.explode(names).alias("part"), F.lit(True).alias("asks"), "vec_id", "embedding", "floor")
    dealt = rows.unionByName(asked).repartition(parts, "part").sortWithinPartitions("part", "asks")
    found = dealt.mapInArrow(_part(k, scale), "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _floors(ids: list, vectors: list, k: int, scale: int):
    """Adds to each query the k-th best score that it has on the sample, if it has so many. Copies of one vec_id in the sample are one each in the
    table as well, so that is a bound."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sides(ids, vectors, scale, False)
        for b in batches:
            floor = np.full(b.num_rows, -LONG - 1, np.int64)
            place = {x: i for i, x in enumerate(b.column(0).to_pylist())}
            for (size, _), q in sides(b.column(0).to_pylist(), b.column(1).to_pylist(), scale, True).items():
                first = Search(q, k)
                for (other, _), c in known.items():
                    if other == size:
                        first.meet(c)
                floor[[place[x] for x in q.ids.tolist()]] = first.floor
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(floor)], ["vec_id", "embedding", "floor"])

    return run


def _part(k: int, scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = None, []
        for batch in batches:
            keys = np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False).astype(np.int32)])
            cuts = [0, *(np.flatnonzero((np.diff(keys) != 0).any(axis=0)) + 1).tolist(), batch.num_rows]
            for a, z in zip(cuts, cuts[1:]):
                if a == z:
                    continue
                if keys[0, a] != part:
                    part, held = keys[0, a], []
                for s in range(a, z, BLOCK):
                    some = batch.slice(s, min(BLOCK, z - s))
                    ids, vectors = some.column(2), some.column(3)
                    if not keys[1, a]:
                        held += arrow_sides(ids, vectors, scale).items()
                        continue
                    floors = dict(zip(ids.to_pylist(), some.column(4).to_pylist(), strict=True))
                    for (size, _), q in sides(ids.to_pylist(), vectors.to_pylist(), scale, True).items():
                        f = Search(q, k, np.array([floors[x] for x in q.ids.tolist()], np.int64))
                        for (other, _), c in held:
                            if other == size:
                                f.meet(c)
                        yield pa.RecordBatch.from_arrays([pa.array(f.q.ids[f.qi]), pa.array(f.ids), pa.array(f.scores)], ["query_id", "vec_id", "score"])

    return run
