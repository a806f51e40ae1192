"""Mixing sources to target weights by entropy balancing, with DataFrame functions only.

Among all document rates r_i in (0, cap], the mix takes those closest to the base rate 1 in relative entropy,
sum_i r_i log r_i - r_i, whose words meet the target of every source: sum_i r_i size_i = T_s. Their dual is convex, with
one multiplier a source, and gives r_i = min(cap, exp(lambda_s * x_i)), x_i = size_i / (largest size of the source): rates are
exponentially tilted by what a document adds to its source's words. Each Newton step is one aggregation over all
documents, gathered by (source, size), for the dual's gradient and curvature, guarded by a bracket. Rates become copies: floor(r_i) and one more where a
hash of doc_id, less the fraction of r_i, lies under a threshold of the source, set on two levels of histograms.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioforge.llm.common import WORD, Scratch, column, join_bounded

WEIGHTS = (3, 1, 2)
BINS = 4096


def targets(sizes: dict[str | None, int], weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, cap: float = 2.0) -> dict[str | None, float]:
    """Sources by code point, null last, weigh `weights` in turn and share `share` of all sizes; a target stops at cap times
    its source's size, and the excess is dealt again by weight until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode("utf-8", "surrogatepass")))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, full, open_ = share * sum(sizes.values()), {}, set(order)
    while open_:
        rest, heavy = total - sum(full.values()), sum(w[s] for s in open_)
        given = {s: rest * w[s] / heavy for s in open_}
        over = {s for s in open_ if given[s] > cap * sizes[s]}
        if not over:
            return full | given
        full |= {s: cap * sizes[s] for s in over}
        open_ -= over
    return full


def target_table(sizes: DataFrame, scratch: Scratch, weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """(source, source_size, ...) -> with weight and target. No step sees all sources in one task: they are ranked within ranges and the ranges
    counted, and the level up to which they fill, target per weight, is found from a few sums."""
    ranged = sizes.withColumn("none", F.col("source").isNull()).repartitionByRange(F.col("none"), F.col("source")).withColumn("range", F.spark_partition_id())
    ranged = scratch.write(ranged, "ranged")
    counts = ranged.groupBy("range").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.select(F.col("range").alias("of"), F.coalesce(F.sum("n").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    rank = F.col("before") + F.row_number().over(Window.partitionBy("range").orderBy("none", "source")) - 1
    by_turn = F.create_map(*[x for i, v in enumerate(weights) for x in (F.lit(i), F.lit(float(v)))])
    t = ranged.join(F.broadcast(counts), F.col("range") == F.col("of")).withColumn("weight", F.element_at(by_turn, (rank % len(weights)).cast("int"))).drop("none", "range", "of", "before")
    t = scratch.write(t, "weighted")
    # A source is full once the level reaches cap * size / weight; what full ones leave is dealt to the others by weight, which
    # lifts the level, until no more are full.
    level, most = -1.0, F.col("source_size") * cap
    while True:
        full = most < F.lit(level) * F.col("weight")
        s = t.agg(F.sum("source_size").alias("all"), F.coalesce(F.sum(F.when(full, most)), F.lit(0.0)).alias("full"), F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)).alias("open")).first()
        new = max(level, ((s["all"] or 0) * share - s["full"]) / s["open"]) if s["open"] > 0 else math.inf
        if new == level:
            return t.withColumn("target", F.least(most, F.lit(level) * F.col("weight")))
        level = new
        if level == math.inf:
            return t.withColumn("target", most)


def measured(docs: DataFrame, *more: str) -> DataFrame:
    words = F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), words.alias("size"), *more)


def fit(sized: DataFrame, scratch: Scratch, weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, cap: float = 2.0, steps: int = 200, tolerance: float = 1e-6) -> DataFrame:
    """(doc_id, source, size) -> a row for each source: source_size, longest, target, multiplier lam, threshold line. A Newton step that leaves the
    bracket is replaced by its middle, so the fit is found; if it is not within `steps`, that is an error."""
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.max("size").alias("longest"))
    state = target_table(sums, scratch, weights, share, cap).withColumns({"lam": F.lit(0.0), "low": F.lit(float("-inf")), "high": F.lit(float("inf")), "done": F.col("source_size") == 0})
    state = scratch.write(state, "state")
    n = state.count()
    x, bent = _tilt()
    # Documents of one source and size have one rate: each step sums over these groups.
    alike = scratch.write(sized.filter("size > 0").groupBy("source", "size").agg(F.count(F.lit(1)).alias("docs")), "alike")
    for _ in range(steps):
        seen = join_bounded(alike, state.filter("not done").select("source", "longest", "lam"), "source", "inner", n)
        w = F.col("size") * F.col("docs")
        sums = seen.groupBy("source").agg(F.sum(w * F.least(F.lit(cap), bent)).alias("words"), F.sum(F.when(bent < cap, w * x * bent)).alias("slope"))
        moved = join_bounded(state, sums, "source", "left", n)
        gap = F.col("words") - F.col("target")
        low, high = F.when(gap < 0, F.col("lam")).otherwise(F.col("low")), F.when(gap > 0, F.col("lam")).otherwise(F.col("high"))
        newton = F.col("lam") - gap / F.col("slope")
        edge = (F.col("target") >= cap * F.col("source_size") * (1 - 1e-12)) | (F.col("target") <= 0)
        middle = F.when(low == float("-inf"), high * 2 - 1).when(high == float("inf"), low * 2 + 1).otherwise((low + high) / 2)
        step = F.when(F.col("slope").isNotNull() & (F.col("slope") > 0) & (newton > low) & (newton < high), newton).otherwise(middle)
        limit = F.when(F.col("target") <= 0, F.lit(float("-inf"))).otherwise(F.lit(float("inf")))
        over = F.col("done") | edge | (F.abs(gap) <= tolerance * F.col("target"))
        new = moved.select("source", "source_size", "longest", "weight", "target", F.when(F.col("done"), F.col("lam")).when(edge, limit).when(F.abs(gap) <= tolerance * F.col("target"), F.col("lam")).otherwise(step).alias("lam"),
                           F.coalesce(low, "low").alias("low"), F.coalesce(high, "high").alias("high"), F.coalesce(over, F.lit(True)).alias("done"))
        new = scratch.write(new, "state")
        scratch.drop(state)
        state = new
        if not state.filter("not done").limit(1).count():
            break
    else:
        raise RuntimeError(f"rates of some sources not found in {steps} steps")

    rated = _rated(sized, state, cap, n)
    small = rated.select("source", "size", "whole", "target", "source_size", "spot")
    base = small.groupBy("source").agg(F.sum(F.col("size") * F.col("whole")).alias("base"), F.first("target").alias("aim"))
    base = scratch.write(base, "base")
    cut = base.select("source", (F.col("aim") - F.col("base")).alias("need"), F.lit(0.0).alias("at"), F.lit(1.0).alias("width"))
    for _ in range(2):  # the bin in which the words taken so far reach the need, then the same within that bin
        hist = join_bounded(small.filter("spot is not null and size > 0"), cut, "source", "inner", n)
        hist = hist.filter((F.col("spot") >= F.col("at")) & (F.col("spot") < F.col("at") + F.col("width")))
        hist = hist.groupBy("source", F.least(F.floor((F.col("spot") - F.col("at")) / F.col("width") * BINS), F.lit(BINS - 1)).alias("bin")).agg(F.sum("size").alias("w"))
        cum = hist.withColumn("before", F.coalesce(F.sum("w").over(Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        under = join_bounded(cum, cut, "source", "inner", n).filter(F.col("before") <= F.col("need"))
        last = under.groupBy("source").agg(F.max_by(F.struct("bin", "before", "w", "need", "at", "width"), "bin").alias("b")).select("source", "b.*")
        cut = scratch.write(last.select("source", (F.col("need") - F.col("before")).alias("need"), (F.col("at") + F.col("bin") * F.col("width") / BINS).alias("at"), (F.col("width") / BINS).alias("width"), (F.col("need") - F.col("before") >= F.col("w") / 2).alias("more")), "cut")
    line = cut.select("source", (F.col("at") + F.when(F.col("more"), F.col("width")).otherwise(0.0)).alias("line"))
    return scratch.write(join_bounded(state.select("source", "source_size", "longest", "target", "lam"), line, "source", "left", n), "fitted")


def apply(sized: DataFrame, fitted: DataFrame, cap: float = 2.0) -> DataFrame:
    """Adds source_size, target, rate, copies and taken to rows with doc_id, source and size; other columns stay. No shuffle up to
    join_bounded's number of sources."""
    copies = (F.col("whole") + F.when(F.col("spot") < F.col("line"), 1).otherwise(0)).cast("long")
    out = _rated(sized, fitted, cap).withColumn("copies", copies).withColumn("taken", F.col("size") * F.col("copies"))
    return out.drop("longest", "lam", "line", "spot", "whole")


def _tilt() -> tuple[Column, Column]:
    x = F.col("size") / F.greatest(F.col("longest"), F.lit(1))
    return x, F.exp(F.least(F.col("lam") * x, F.lit(50.0)))


def _rated(sized: DataFrame, by_source: DataFrame, cap: float, rows: int | None = None) -> DataFrame:
    bent = _tilt()[1]
    rate = F.when(F.col("size") == 0, F.lit(1.0)).when(F.col("lam") == float("inf"), F.lit(cap)).when(F.col("lam") == float("-inf"), F.lit(0.0)).otherwise(F.least(F.lit(cap), bent))
    fraction = F.col("rate") - F.floor("rate")
    draw = F.pmod(F.xxhash64("doc_id", "size"), F.lit(1 << 40)) / float(1 << 40)
    spot = (draw - fraction + 1) / 2  # in (0, 1); a fraction f leaves the next copy to draws under f where the threshold is 1 / 2
    rated = join_bounded(sized, by_source, "source", "left", rows).withColumn("rate", rate)
    return rated.withColumn("spot", F.when(fraction > 0, spot)).withColumn("whole", F.floor("rate").cast("long"))


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """documents -> (doc_id, size, source_size, target, rate, copies, taken); one row per input row.

    size: words of the text, null: 0. A document's copies are a whole number up to ceil(cap) and taken = size * copies.
    Null is a source like any other, ordered last. Documents without words have rate 1, and take nothing. Rows that repeat a
    doc_id are mixed each by itself, all alike. An empty table gives an empty result; other columns are ignored.
    The result depends on the rows alone, not on their order or partitions.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    sized = scratch.write(measured(docs), "sized")
    return apply(sized, fit(sized, scratch, weights, share, cap), cap).select("doc_id", "size", "source_size", "target", "rate", "copies", "taken")


def mixed_rows(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """The mix itself: every row of docs as often as it has copies, with its columns unchanged."""
    scratch = Scratch(docs.sparkSession, "mixing")
    sized = scratch.write(measured(docs), "sized")
    rows = measured(docs.withColumn("__row", F.struct(*[column(c) for c in docs.columns])), "__row")
    out = apply(rows, fit(sized, scratch, weights, share, cap), cap)
    return out.filter("copies > 0").withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("__row.*")
