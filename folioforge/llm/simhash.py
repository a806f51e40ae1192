"""SimHash near-duplicates: fingerprints, and their links by the generalised pigeonhole principle.

Bits that correlate are put into the same partition. Each partition gets a threshold of its own, and a fingerprint is filed under
every value within that threshold of the partition's bits; members of a bucket are then verified on the fingerprint. Thresholds are
allocated by dynamic programming over candidate counts estimated on a bounded sample, for the least cost, in one of two ways:

* Exact, for links of t bits or less: with sum(t_i) = t - m + 1 over m partitions (-1: unused) two such fingerprints are within t_i
  bits on at least one of them. Both sides file all values within ceil(t_i / 2), so none is lost.
* By likelihood, for sets of a similarity s or more, whose fingerprints differ in too many bits for that: a threshold is a number of
  flips, of the bits of a fingerprint that are least certain, filed beside its own value. The chance that two sets of similarity s meet
  in a partition follows from its size and flips; thresholds are chosen so that they meet somewhere with the chance asked for.

Where a similarity is asked for, the components of these links are only where to look: inside each, all pairs are
compared by the exact Jaccard similarity of their sets of shingles, and only those that have it are linked.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.llm.common import Scratch, WordHashes, column, free_name, mix64
from folioforge.llm.graph import connected_components

SAMPLE = 2000  # fingerprints from which bit correlations and candidate counts are estimated
HOT = 20_000  # members of a bucket beyond which it is dealt out anew
FLIPS = (0, 1, 2, 3, 4, 6, 8)  # thresholds of the likelihood kind
PARTS = (4, 6, 8, 9, 10, 11, 12, 13, 14, 16, 18, 20, 24, 28, 32)  # numbers of partitions that are tried
PAIR_COST = 1 / 20  # of comparing two members of a bucket, where filing a row costs 1
CARRIED = 2  # 64-bit words of a long fingerprint that a filed row carries to be verified on
AT_ONCE = 200_000  # shingles, or more where one text has more, whose fingerprints are taken at once


def shingles(words: list[bytes], k: int) -> list[bytes]:
    if not words:
        return []
    if len(words) < k:
        return [b" ".join(words)]
    return list(map(b" ".join, zip(*(words[i:] for i in range(k)))))


def shingle_hashes(text: str | None, k: int) -> np.ndarray:
    """XXH64 (seed 42) of each k-word shingle, repeats included; bytes.lower() changes A-Z only."""
    sh = shingles([] if text is None else text.encode("utf-8", "surrogatepass").lower().split(), k)
    return np.fromiter((xxhash.xxh64_intdigest(s, 42) for s in sh), np.uint64, len(sh))


class ShingleSets:
    """Sets of k-word shingles as rising 64-bit hashes. A shingle's hash is a sum of its words' hashes, each times a number of its place:
    a fraction of the cost of hashing its bytes, and two shingles agree by chance once in 2 ** 64."""

    def __init__(self, k: int):
        self.k, self.words = k, WordHashes(41)
        self.place = np.random.Generator(np.random.PCG64(97)).integers(0, 1 << 63, k, np.uint64) * np.uint64(2) + np.uint64(1)

    def of(self, text: str | None) -> np.ndarray:
        h = self.words.of([] if text is None else text.encode("utf-8", "surrogatepass").lower().split())
        if not len(h):
            return h
        n = max(1, len(h) - self.k + 1)
        x = np.full(n, min(len(h), self.k), np.uint64)
        for j in range(min(self.k, len(h))):
            x += h[j : j + n] * self.place[j]
        return np.unique(mix64(x))


def set_id(hashes: np.ndarray) -> int:
    """One signed 64-bit number for a set of shingles, given as rising hashes."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(hashes.tobytes(), 7)).astype(np.int64))


#: A byte -> its bits, most significant first, one in each byte of a 64-bit word: 255 of them can be added up without a carry.
SPREAD = np.array([sum((b >> (7 - t) & 1) << (8 * t) for t in range(8)) for b in range(256)], "<u8")


def margins(hashes: np.ndarray, sizes: np.ndarray, bits: int = 64) -> np.ndarray:
    """Texts' hashes end to end -> for each text and bit (most significant first): 2 * (hashes that have it) - (all hashes)."""
    out = np.zeros((len(sizes), bits), np.int64)
    runs = -(-sizes // 255)
    owner = np.repeat(np.arange(len(sizes)), runs)
    start = np.repeat(np.cumsum(sizes) - sizes, runs) + 255 * (np.arange(runs.sum()) - np.repeat(np.cumsum(runs) - runs, runs))
    for s in range(0, len(start), 256):
        own, at = owner[s : s + 256], start[s : s + 256]
        part = hashes[at[0] : start[s + 256] if s + 256 < len(start) else len(hashes)]
        for j in range(bits // 64):
            x = part if j == 0 else mix64(part + np.uint64((0x9E3779B97F4A7C15 * j) % 2**64))
            lanes = SPREAD[x.astype(">u8").view(np.uint8).reshape(-1, 8)]
            counts = np.add.reduceat(lanes, at - at[0], axis=0).view(np.uint8).reshape(len(at), 64)
            np.add.at(out[:, 64 * j : 64 * j + 64], own, counts)
    return 2 * out - sizes[:, None]


def fingerprints(docs: DataFrame, k: int = 3, bits: int = 64, sets: bool = False) -> DataFrame:
    """(doc_id, fp binary(bits / 8)) of all shingles, repeats included; or of the set of distinct ones, with weak binary (the quarter of the bits
    of least margin, in rising order, as 16-bit numbers) and node, the id of that set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = ShingleSets(k).of if sets else lambda text: shingle_hashes(text, k)
        for b in batches:
            fps, low, ids, held, n = [], [], [], [], 0
            for i, text in enumerate(b.column(1)):
                held.append(of(text.as_py()))
                n += len(held[-1])
                if n < AT_ONCE and i < b.num_rows - 1:
                    continue
                m = margins(np.concatenate(held), np.array(list(map(len, held))), bits)
                fps += [x.tobytes() for x in np.packbits(m > 0, axis=1)]
                if sets:
                    low += [x.tobytes() for x in np.argsort(np.abs(m), axis=1, kind="stable")[:, : bits // 4].astype("<u2")]
                    ids += map(set_id, held)
                held, n = [], 0
            cols = [b.column(0).cast(pa.int64()), pa.array(fps, pa.binary())] + ([pa.array(low, pa.binary()), pa.array(ids, pa.int64())] if sets else [])
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "fp", "weak", "node"][: len(cols)])

    kind = "doc_id long, fp binary" + ", weak binary, node long" * sets
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, kind)


def bit_groups(sample: np.ndarray, m: int) -> list[list[int]]:
    """m partitions of nearly equal size; each is grown from its seed by the bits that correlate with it most."""
    bits = sample.shape[1]
    x = sample.astype(np.float64) - sample.mean(axis=0)
    norm = np.sqrt((x * x).sum(axis=0))
    c = np.abs(x.T @ x) / np.maximum(np.outer(norm, norm), 1e-9)
    left, out = np.ones(bits, bool), []
    for i in range(m):
        pull, grown = c[:, left].sum(axis=1), []
        for _ in range(bits // m + (i < bits % m)):
            grown.append(int(np.argmax(np.where(left, pull, -1.0))))
            left[grown[-1]] = False
            pull = c[:, grown[-1]] + (pull if len(grown) > 1 else 0)
        out.append(sorted(grown))
    return out


def ball(bits: int, radius: int) -> int:
    return sum(math.comb(bits, r) for r in range(radius + 1))


def apart(sample: np.ndarray) -> np.ndarray:
    s = sample.astype(np.float32)
    own = s.sum(axis=1)
    return np.rint(own[:, None] + own[None] - 2 * s @ s.T).astype(np.int16)[np.triu_indices(len(s), 1)]


def plan(sample: np.ndarray, n: int, t: int, parts: int | None = None) -> list[tuple[list[int], int]]:
    """[(bits, threshold)] of the exact kind: for each m the thresholds of least cost by dynamic programming, and of these the best m.

    Cost: rows filed, plus PAIR_COST for each pair that is expected to meet in a bucket, as estimated on the
    sample or, where that saw none, for independent bits.
    """
    bits, best = sample.shape[1], None
    for m in [parts] if parts else range(1, min(t + 1, 16) + 1):
        groups, cost = bit_groups(sample, m), []
        for g in groups:
            d = apart(sample[:, g])
            row = {-1: 0.0}
            for e in range(0, min(t, 6) + 1):
                share = max((d <= e).mean() if len(d) else 0, ball(len(g), e) / 2.0 ** len(g))
                row[e] = n * float(ball(len(g), -(-e // 2))) + share * n * n / 2 * PAIR_COST
            cost.append(row)
        need = t - m + 1
        states: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
        for row in cost:  # states: sum of (threshold + 1) so far -> least cost
            nxt: dict[int, tuple[float, list[int]]] = {}
            for have, (c, chosen) in states.items():
                for e, add in row.items():
                    if have + e + 1 <= need + m and (have + e + 1 not in nxt or c + add < nxt[have + e + 1][0]):
                        nxt[have + e + 1] = (c + add, [*chosen, e])
            states = nxt
        if need + m in states and (best is None or states[need + m][0] < best[0]):
            best = (states[need + m][0], [(g, e) for g, e in zip(groups, states[need + m][1], strict=True) if e >= 0])
    if best is None:
        raise ValueError("no thresholds add up; give more parts")
    return best[1]


def differing(similarity: float) -> float:
    """The share of bits in which fingerprints of two sets of this Jaccard similarity and of one size differ, on average."""
    return math.acos(2 * similarity / (1 + similarity)) / math.pi


@cache
def meeting(bits: int, flips: int, similarity: float, trials: int = 4000) -> float:
    """The chance that two sets of this similarity meet in a partition of so many bits, with so many flips filed on both sides. Margins of a
    bit are jointly normal, with the cosine of the sets for correlation; the trials are the same each time."""
    rho, rng = 2 * similarity / (1 + similarity), np.random.Generator(np.random.PCG64([bits, flips]))
    a = rng.normal(size=(trials, bits))
    b = rho * a + math.sqrt(1 - rho * rho) * rng.normal(size=(trials, bits))
    differ = (a > 0) != (b > 0)
    mine, theirs = (np.argsort(np.argsort(np.abs(x), axis=1), axis=1) < flips for x in (a, b))
    n = differ.sum(axis=1)
    either, both = (differ & (mine | theirs)).sum(axis=1), (differ & mine & theirs).sum(axis=1)
    left, right = (differ & mine).sum(axis=1), (differ & theirs).sum(axis=1)
    two = (either == 2) & (left > 0) & (right > 0) & ~((left == 1) & (right == 1) & (both == 1))
    return float(((n == 0) | ((n == 1) & (either == 1)) | ((n == 2) & two)).mean())


def likely_plan(sample: np.ndarray, n: int, similarity: float, recall: float) -> list[tuple[list[int], int]]:
    """[(bits, flips)] of the likelihood kind: of all numbers of partitions and flips for each (or none of it) those of least cost, among those
    that let two sets of this similarity meet with the chance `recall`. Sampled pairs that are similar themselves count as no chance meeting."""
    bits, best, need, units = sample.shape[1], None, -math.log(1 - recall), 120
    strange = apart(sample) > bits * (differing(similarity) + 0.5) / 2
    pairs = max(1, int(strange.sum()))
    for m in PARTS:
        if not 8 <= bits // m <= 60:
            continue
        groups = bit_groups(sample, m)
        states: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
        for g in groups:
            d = np.bincount(apart(sample[:, g])[strange], minlength=3)[:3] / pairs
            options = [(0, 0.0, -1)]
            for f in FLIPS:
                one, two = 1 - (1 - f / len(g)) ** 2, 2 * (f / len(g)) ** 2
                share = max(d[0] + d[1] * one + d[2] * two, (1 + f) ** 2 / 2.0 ** len(g))
                gain = -math.log(max(1e-9, 1 - meeting(len(g), f, similarity)))
                options.append((int(gain / need * units), n * (1.0 + f) + share * n * n / 2 * PAIR_COST, f))
            nxt: dict[int, tuple[float, list[int]]] = {}
            for have, (c, chosen) in states.items():
                for gain, add, f in options:
                    to = min(units, have + gain)
                    if to not in nxt or c + add < nxt[to][0]:
                        nxt[to] = (c + add, [*chosen, f])
            states = nxt
        if units in states and (best is None or states[units][0] < best[0]):
            best = (states[units][0], [(g, f) for g, f in zip(groups, states[units][1], strict=True) if f >= 0])
    if best is None:
        raise ValueError(f"fingerprints of {bits} bits can't give a recall of {recall}")
    return best[1]


def _probe(scheme: list[tuple[list[int], int]], words: int, likely: bool):
    """(fp, rep[, weak]) -> a row for each value that a fingerprint is filed under: key, its first words, rep."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            fp = np.frombuffer(b"".join(b.column(0).to_pylist()), np.uint8).reshape(b.num_rows, -1)
            bit, every = np.unpackbits(fp, axis=1), np.arange(b.num_rows)
            weak = np.frombuffer(b"".join(b.column(2).to_pylist()), "<u2").reshape(b.num_rows, -1) if likely else None
            keys, owner = [], []
            for at, (g, e) in enumerate(scheme):
                value = (bit[:, g].astype(np.uint64) << np.arange(len(g), dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
                flips = [(value, every)]
                if likely and e:
                    place = np.full(bit.shape[1], -1, np.int64)
                    place[g] = np.arange(len(g))
                    inside = place[weak]
                    first = np.argsort(inside < 0, axis=1, kind="stable")[:, :e]
                    for x in np.take_along_axis(inside, first, axis=1).T:
                        ok = np.flatnonzero(x >= 0)
                        flips.append((value[ok] ^ (np.uint64(1) << x[ok].astype(np.uint64)), ok))
                elif not likely:
                    for r in range(1, -(-e // 2) + 1):
                        for some in itertools.combinations(range(len(g)), r):
                            flips.append((value ^ np.uint64(sum(1 << x for x in some)), every))
                for v, own in flips:
                    keys.append(mix64(v + np.uint64(((at + 1) * 0xD1342543DE82EF95) % 2**64)))
                    owner.append(own)
            k, o = np.concatenate(keys).view(np.int64), np.concatenate(owner)
            carried = fp[:, : 8 * words].copy().view(np.int64)
            rep = b.column(1).to_numpy()
            for s in range(0, len(k), 50_000):
                own = o[s : s + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array(k[s : s + 50_000]), *[pa.array(carried[own, j]) for j in range(words)], pa.array(rep[own])], ["key", *[f"w{j}" for j in range(words)], "rep"])

    return run


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits of fingerprints as 64-bit words, on the last axis."""
    return np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int32)


def group_links(fp: np.ndarray, rep: np.ndarray, t: int) -> tuple[list[int], list[int]]:
    """A star (smallest rep, other) for each component of one bucket's links; rep is rising. Who joins a component is
    not looked at again, so a bucket that is one dense cluster costs a few passes; one without links n * n / 2 comparisons."""
    left, us, vs = np.arange(len(rep)), [], []
    while len(left):
        seed, left = left[0], left[1:]
        todo = [seed]
        while todo and len(left):
            near = distance(fp[left], fp[todo.pop()]) <= t
            got = left[near]
            us += [int(rep[seed])] * len(got)
            vs += rep[got].tolist()
            todo += got.tolist()
            left = left[~near]
    return us, vs


def small_links(fp: np.ndarray, rep: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
    """The same for many buckets of one small size at once: fp (buckets, size, words), rep (buckets, size) rising."""
    near = distance(fp[:, :, None], fp[:, None]) <= t
    some = np.flatnonzero(near.sum(axis=(1, 2)) > rep.shape[1])
    near, rep = near[some], rep[some]
    label = np.broadcast_to(np.arange(rep.shape[1]), rep.shape)
    while len(rep):
        least = np.where(near, label[:, None], rep.shape[1]).min(axis=2)
        if (least == label).all():
            break
        label = least
    u = np.take_along_axis(rep, label, axis=1)
    return u[u != rep], rep[u != rep]


def thinned(stars: DataFrame) -> DataFrame:
    """(u, v), u < v -> fewer edges of the same components, each once.

    A node that hangs on several centres keeps the smallest; the others are tied to that one instead. It has a centre
    for each bucket it was filed in at most (of a hot bucket: for each block), which bounds the set gathered here.
    """
    of = stars.groupBy("v").agg(F.sort_array(F.collect_set("u")).alias("us"))
    return of.select(F.col("us")[0].alias("u"), F.explode(F.concat(F.array("v"), F.slice("us", 2, F.size("us")))).alias("v")).distinct()


def _verify(t: int, words: int):
    def links(key: np.ndarray, fp: np.ndarray, rep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        edge = np.flatnonzero(np.diff(key)) + 1
        start, end = np.r_[0, edge], np.r_[edge, len(key)]
        size = end - start
        us, vs = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for n in range(2, 33):  # buckets of one size at a time
            own = start[size == n]
            for s in range(0, len(own), (1 << 20) // (n * n)):
                at = own[s : s + (1 << 20) // (n * n)][:, None] + np.arange(n)
                u, v = small_links(fp[at], rep[at], t)
                us.append(u)
                vs.append(v)
        for s, e in zip(start[size > 32], end[size > 32], strict=True):
            _, one = np.unique(rep[s:e], return_index=True)
            u, v = group_links(fp[s:e][one], rep[s:e][one], t)
            us.append(np.array(u, np.int64))
            vs.append(np.array(v, np.int64))
        return np.concatenate(us), np.concatenate(vs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def out(parts):
            u, v = links(*(np.concatenate(x) for x in zip(*parts)))
            if len(u):
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

        for b in batches:
            if not b.num_rows:
                continue
            key, rep = b.column(0).to_numpy(), b.column(words + 1).to_numpy()
            fp = np.stack([b.column(j + 1).to_numpy() for j in range(words)], axis=1).view(np.uint64)
            last = np.searchsorted(key, key[-1])
            if last == 0 and held and held[-1][0][-1] == key[0]:
                held.append((key, fp, rep))
                continue
            held.append((key[:last], fp[:last], rep[:last]))
            if any(len(h[0]) for h in held):
                yield from out([h for h in held if len(h[0])])
            held = [(key[last:], fp[last:], rep[last:])]
        if held:
            yield from out(held)

    return run


def _spread(hot: DataFrame, filed: DataFrame, t: int) -> DataFrame:
    """Buckets over HOT members by the pigeonhole principle once more: of t + 1 parts of the fingerprint two within t bits agree on one, so
    that each row goes to t + 1 smaller buckets."""
    masks = [sum(1 << i for i in range(64 * j // (t + 1), 64 * (j + 1) // (t + 1))) for j in range(t + 1)]
    parts = [F.xxhash64("key", F.lit(j), F.col("w0").bitwiseAND(F.lit(m - (m >> 63 << 64)))) for j, m in enumerate(masks)]
    return filed.join(hot.select("key"), "key").select(F.explode(F.array(*parts)).alias("key"), "w0", "rep")


def _blocks(hot: DataFrame, filed: DataFrame, words: int) -> DataFrame:
    """Buckets over HOT members, dealt out: each row goes to every pair of blocks that holds its block."""
    k, carried = hot.withColumn("blocks", F.ceil(F.col("n") / (HOT // 2)).cast("int")), [f"w{j}" for j in range(words)]
    rows = filed.join(k, "key").withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    other = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return other.select(F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("key"), *carried, "rep")


def _split(filed: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame | None]:
    """filed -> its rows of buckets up to HOT members, and the keys of the others, if any."""
    hot = scratch.write(filed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > HOT), "hot")
    if not hot.limit(1).count():
        return filed, None
    return filed.join(hot, "key", "left_anti"), hot


def _met(filed: DataFrame, t: int, words: int, scratch: Scratch, exact: bool) -> DataFrame:
    """Filed rows -> (u, v): edges of the components of what meets in a bucket and is within t bits on the words carried."""
    cold, hot = _split(filed, scratch)
    if hot is not None and exact and t < 8:
        spread = scratch.write(_spread(hot, filed, t), "spread")
        more, hot = _split(spread, scratch)
        cold, filed = cold.unionByName(more), spread
    if hot is not None:
        cold = cold.unionByName(_blocks(hot, filed, words))
    found = cold.repartition("key").sortWithinPartitions("key", "rep").mapInArrow(_verify(t, words), "u long, v long")
    return scratch.write(thinned(found), "links")


def _sampled(fps: DataFrame) -> np.ndarray:
    some = fps.orderBy(F.xxhash64("fp")).limit(SAMPLE).select("fp").collect()
    return np.unpackbits(np.frombuffer(b"".join(bytes(r.fp) for r in some), np.uint8).reshape(len(some), -1), axis=1)


def _filed(fps: DataFrame, scheme: list[tuple[list[int], int]], words: int, likely: bool, scratch: Scratch) -> DataFrame:
    kind = "key long, " + ", ".join(f"w{j} long" for j in range(words)) + ", rep long"
    return scratch.write(fps.select("fp", "rep", *["weak"] * likely).repartition("fp").mapInArrow(_probe(scheme, words, likely), kind), "filed")


def link_fingerprints(fps: DataFrame, scratch: Scratch, max_distance: int, parts: int | None = None) -> DataFrame:
    """Distinct (fp of one to CARRIED words, rep) -> (u, v): edges whose components are those of all links at max_distance bits or less."""
    n = fps.count()
    if n < 2:
        return fps.sparkSession.createDataFrame([], "u long, v long")
    sample = _sampled(fps)
    words = sample.shape[1] // 64
    filed = _filed(fps, plan(sample, n, max_distance, parts), words, False, scratch)
    edges = _met(filed, max_distance, words, scratch, words == 1)
    scratch.drop(filed)
    return edges


def link_sets(sets: DataFrame, scratch: Scratch, similarity: float, recall: float) -> DataFrame:
    """Distinct (fp, weak, rep) -> (u, v): edges of components in which sets of this similarity are together with the chance `recall` or more
    (and one in a hundred of them is lost when verified). Others may be too: components are where to look."""
    n = sets.count()
    if n < 2:
        return sets.sparkSession.createDataFrame([], "u long, v long")
    sample = _sampled(sets)[: SAMPLE // 2]
    words = min(CARRIED, sample.shape[1] // 64)
    p, seen = differing(similarity), 64 * words
    filed = _filed(sets, likely_plan(sample, n, similarity, recall), words, True, scratch)
    edges = _met(filed, math.ceil(p * seen + 2.33 * math.sqrt(seen * p * (1 - p))), words, scratch, False)
    scratch.drop(filed)
    return edges


def exact_links(nodes: np.ndarray, flat: np.ndarray, size: np.ndarray, least: float) -> tuple[list[int], list[int]]:
    """Stars (smallest node, other) of the components that pairs of Jaccard similarity `least` or more make. nodes is rising;
    flat has the sets' members end to end. Who joins a component is not looked at again; all other pairs are compared."""
    end = np.cumsum(size)
    _, member = np.unique(flat, return_inverse=True)
    mark = np.zeros(len(flat) + 1, bool)
    left, us, vs = np.arange(len(nodes)), [], []
    while len(left) > 1:
        seed, left = left[0], left[1:]
        todo = [seed]
        while todo and len(left):
            one = todo.pop()
            own = member[end[one] - size[one] : end[one]]
            mark[own] = True
            upto = np.r_[0, np.cumsum(mark[member])]
            mark[own] = False
            both = upto[end[left]] - upto[end[left] - size[left]]
            union = size[one] + size[left] - both
            near = np.where(union > 0, both / np.maximum(union, 1), 1.0) >= least
            got = left[near]
            us += [int(nodes[seed])] * len(got)
            vs += nodes[got].tolist()
            todo += got.tolist()
            left = left[~near]
    return us, vs


def similar(docs: DataFrame, own: DataFrame, labels: DataFrame, scratch: Scratch, k: int, least: float) -> DataFrame:
    """Nodes with their loose components -> (u, v): edges whose components are those of all pairs in one loose component
    that are similar enough. Texts are read again for these nodes only. A large loose component is dealt out as pairs of
    blocks of 64 nodes, or a sixty-fourth of it, but no more than 4,096."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = ShingleSets(k).of
        for b in batches:
            for s in range(0, b.num_rows, 256):
                all_of = [of(t) for t in b.column(0).slice(s, 256).to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array([set_id(h) for h in all_of], pa.int64()), pa.array([h.view(np.int64) for h in all_of], pa.list_(pa.int64()))], ["of", "hashes"])

    def links(t: pa.Table) -> pa.Table:
        node = t.column("node").to_numpy()
        nodes, first = np.unique(node, return_index=True)  # rows of one text and doc_id may repeat
        hashes = t.column("hashes").take(pa.array(first)).combine_chunks()
        size = np.diff(hashes.offsets.to_numpy()).astype(np.int64)
        u, v = exact_links(nodes, hashes.flatten().to_numpy(), size, least)
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    n = scratch.write(labels.groupBy("component").agg(F.count(F.lit(1)).alias("n")), "sizes")
    blocks = F.greatest(F.ceil(F.col("n") / 4096), F.least(F.lit(64), F.ceil(F.col("n") / 64))).cast("int")
    inside = scratch.write(labels.join(n, "component").join(own.select("node", "rep"), "node").select("node", "rep", "component", blocks.alias("blocks")), "inside")
    texts = docs.select(F.col("doc_id").cast("long").alias("__id"), F.col("text").cast("string").alias("text")).join(inside.select("rep").distinct(), F.col("__id") == F.col("rep"), "left_semi")
    have = inside.join(texts.select("text").mapInArrow(sets, "of long, hashes array<long>"), F.col("node") == F.col("of"))
    mine = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = have.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).filter("blocks = 1 or mine <> other")
    pairs = dealt.select("component", F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high"), "node", "hashes")
    found = pairs.groupBy("component", "low", "high").applyInArrow(links, "u long, v long")
    edges = scratch.write(thinned(found), "similar")
    scratch.drop(n, inside)
    return edges


def near_duplicates(docs: DataFrame, k: int = 3, bits: int = 64, max_distance: int = 2) -> DataFrame:
    """documents -> (doc_id, fp binary, component_id long: the smallest doc_id reachable over links of max_distance bits or less).

    A null, empty or blank text has no shingle: its fingerprint is zero and links like any other. Fewer words than
    k: the whole sequence is the one shingle. A bit is set if over half of the hashes have it, so a tie clears it.
    Repeated rows and copies share a fingerprint and so a component. A null doc_id never names a component, but its
    row gets the component of its fingerprint, null if no row has an id. An empty table gives an empty result.
    Other columns are ignored, whatever their names. bits: 64 or 128.
    """
    scratch = Scratch(docs.sparkSession, "simhash")
    each = scratch.write(fingerprints(docs, k, bits), "fingerprints")
    own = scratch.write(each.groupBy("fp").agg(F.min("doc_id").alias("rep")).filter("rep is not null"), "distinct")
    labels = connected_components(link_fingerprints(own, scratch, max_distance), scratch)
    of = scratch.write(own.join(labels, own.rep == labels.node, "left").select("fp", F.coalesce("component", "rep").alias("component_id")), "components")
    scratch.drop(own)
    return each.select("doc_id", "fp").join(of, "fp", "left").select("doc_id", "fp", "component_id")


def similar_documents(docs: DataFrame, k: int = 5, similarity: float = 0.8, recall: float = 0.97, bits: int | None = None) -> DataFrame:
    """documents -> (doc_id, fp binary, component_id long: the smallest doc_id reachable over links), links being pairs of the Jaccard similarity
    of sets of k-word shingles (A-Z lower-cased, compared as 64-bit hashes) or more.

    recall: the chance with which two sets of just that similarity are compared; more similar ones have a greater one. bits: by default 256, and
    twice as many for every 64 times of 2 ** 26 rows, so that partitions can grow with the table. Nulls, short texts, repeated rows, missing ids and
    empty tables as with near_duplicates(); texts of one set of shingles share a component.
    """
    scratch = Scratch(docs.sparkSession, "similar")
    if bits is None:
        bits = 256 << max(0, math.ceil(math.log2(max(1, docs.count()) / 2**26) / 6))
    each = scratch.write(fingerprints(docs, k, bits, sets=True), "fingerprints")
    own = scratch.write(each.groupBy("node").agg(F.min("fp").alias("fp"), F.min("weak").alias("weak"), F.min("doc_id").alias("rep")).filter("rep is not null"), "distinct")
    loose = connected_components(link_sets(own.drop("rep").withColumnRenamed("node", "rep"), scratch, similarity, recall), scratch)
    labels = connected_components(similar(docs, own, loose, scratch, k, similarity), scratch)
    joined = scratch.write(own.select(F.col("node").alias("own"), "rep").join(labels, F.col("own") == labels.node).select("own", "rep", "component"), "joined")
    names = scratch.write(joined.groupBy("component").agg(F.min("rep").alias("least")), "names")
    named = scratch.write(joined.join(names, "component").select("own", "least"), "named")
    of = scratch.write(own.select("node", "rep").join(named, own.node == named.own, "left").select("node", F.coalesce("least", "rep").alias("component_id")), "components")
    scratch.drop(own, joined, names, named)
    return each.select("doc_id", "fp", "node").join(of, "node", "left").select("doc_id", "fp", "component_id")


def first_of_each(docs: DataFrame, **how) -> DataFrame:
    """docs, with all their columns, less those that are similar_documents() of one with a smaller doc_id; of rows without doc_id none goes, and
    rows that repeat a doc_id go or stay together."""
    gone = similar_documents(docs, **how).filter("doc_id <> component_id").select(F.col("doc_id").alias("gone")).distinct()
    name = free_name(docs, "gone")
    return docs.join(gone.withColumnRenamed("gone", name), column("doc_id").cast("long") == column(name), "left_anti")
