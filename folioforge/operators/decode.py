"""CTC decoding: best path as column expressions, prefix beam search under Arrow."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioforge.functions.scalars import argmax, length_normalised_confidence, let


def steps_of(logits: Column, steps: int, symbols: int) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(steps - 1)), lambda t: F.slice(logits, t * symbols + 1, symbols))


def greedy_path(logits: Column, steps: int, symbols: int, blank: int = 0) -> Column:
    """Best symbol of each step, repeats merged, blanks out. Linear: the path is made once and laid beside itself, one step on."""
    best = F.transform(steps_of(logits, steps, symbols), argmax)
    kept = lambda s, before: F.when((s != blank) & (s != before), s)
    path = let(best, lambda path: F.array_compact(F.zip_with(path, F.concat(F.array(F.lit(-1)), path), kept)))
    return F.when(logits.isNotNull(), path)


def greedy_text(logits: Column, steps: int, charset: list[str]) -> Column:
    """charset without the blank, which is symbol 0."""
    symbols = F.array(*map(F.lit, charset))
    return F.array_join(F.transform(greedy_path(logits, steps, len(charset) + 1), lambda s: F.element_at(symbols, s)), "")


def oriented(logits: np.ndarray, vocabulary: int) -> np.ndarray:
    """time x vocabulary, whichever way it came; a square array is taken to be so already."""
    return logits.T if logits.shape[0] == vocabulary and logits.shape[1] != vocabulary else logits


def log_softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(axis=-1, keepdims=True)
    return x - np.log(np.exp(x).sum(axis=-1, keepdims=True))


def prefix_beams(logits: np.ndarray, width: int = 10, blank: int = 0) -> list[tuple[tuple[int, ...], float]]:
    """(symbols, log probability), best first; equal scores by symbols. Probabilities of all paths to a prefix are summed.
    Prefixes that no path leads to are left out, so there may be fewer than width."""
    beams = {(): (0.0, -np.inf)}  # prefix -> log probability of ending in blank, in its last symbol
    for row in log_softmax(np.asarray(logits, np.float64)):
        nxt: dict[tuple[int, ...], list[float]] = {}

        def add(prefix: tuple[int, ...], place: int, p: float) -> None:
            if p == -np.inf:
                return
            pair = nxt.setdefault(prefix, [-np.inf, -np.inf])
            pair[place] = np.logaddexp(pair[place], p)

        for prefix, (pb, ps) in beams.items():
            both = np.logaddexp(pb, ps)
            for s, p in enumerate(row):
                if s == blank:
                    add(prefix, 0, both + p)
                elif prefix and prefix[-1] == s:
                    add(prefix, 1, ps + p)
                    add((*prefix, s), 1, pb + p)
                else:
                    add((*prefix, s), 1, both + p)
        top = sorted(nxt.items(), key=lambda x: (-np.logaddexp(*x[1]), x[0]))[:width]
        beams = {k: (v[0], v[1]) for k, v in top}
    return [(k, float(np.logaddexp(*v))) for k, v in beams.items()]


def beam_decode(lines: DataFrame, steps: int, charset: list[str], width: int = 10, key: str = "line_id", logits: str = "logits") -> DataFrame:
    """(key, logits array) -> (key, rank, text, logit_score, confidence): up to width beams a line. Lines without logits have none."""
    n = len(charset) + 1

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(k, r, "".join(charset[s - 1] for s in seq), score) for k, x in zip(b[key], b[logits], strict=True) if x is not None and len(x) == steps * n for r, (seq, score) in enumerate(prefix_beams(np.reshape(x, (steps, n)), width), 1)]
            yield pd.DataFrame(rows, columns=[key, "rank", "text", "logit_score"])

    out = lines.select(key, logits).mapInPandas(run, f"{key} {lines.schema[key].dataType.simpleString()}, rank int, text string, logit_score double")
    return out.withColumn("confidence", length_normalised_confidence(F.col("logit_score"), F.col("text")))


def top_beams(beams: DataFrame, key: str, score: str, tie: str, k: int = 10) -> DataFrame:
    w = Window.partitionBy(key).orderBy(F.col(score).desc(), tie)
    return beams.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
