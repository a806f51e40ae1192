"""Language ID by hyperdimensional profiles.

Every letter has a random vector of +1 and -1 from its code point. A letter trigram is the product of its letters' vectors,
rotated by two, one and no places; a text is the sum of its trigrams' vectors, a language the sum of its texts', each of unit
length. A text's language is that of the nearest prototype by cosine.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DIM = 1024
TRAIN_ROWS = 20_000  # bound of the labelled sample (expected rows) from which prototypes are made
MAX_LANGS = 4096
UNDETERMINED = "und"
ROOM = 32_768  # letters whose vectors a task remembers
PIECE, SLICE = 65_536, 4096  # letters of a text that are counted, and trigrams that are made and added, at once


@cache
def letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


class Profiles:
    def __init__(self, dim: int = DIM):
        self.dim, self.place = dim, {}
        self.turned = np.empty((3, 256, dim), np.int8)  # letters' vectors, rotated by no, one and two places

    def of_letter(self, c: int) -> np.ndarray:
        return np.random.Generator(np.random.PCG64([self.dim, c])).integers(0, 2, self.dim).astype(np.int8) * 2 - 1

    def rows(self, letters: np.ndarray) -> np.ndarray:
        """Rows of `turned` that hold these distinct letters."""
        new = [c for c in letters.tolist() if c not in self.place]
        if len(self.place) + len(new) > ROOM:
            self.place, self.turned, new = {}, self.turned[:, :256], letters.tolist()
        while len(self.place) + len(new) > self.turned.shape[1]:
            self.turned = np.concatenate([self.turned, np.empty_like(self.turned)], axis=1)
        for c in new:
            at = self.place[c] = len(self.place)
            v = self.of_letter(c)
            for turn in range(3):
                self.turned[turn, at] = np.roll(v, turn)
        return np.fromiter(map(self.place.__getitem__, letters.tolist()), np.int64, len(letters))

    def vectors(self, grams: np.ndarray) -> np.ndarray:
        """(grams, dim): the product of each trigram's three letters, rotated by two, one and no places."""
        parts = np.stack([grams >> np.uint64(42), grams >> np.uint64(21) & np.uint64(0x1FFFFF), grams & np.uint64(0x1FFFFF)])
        letters, which = np.unique(parts, return_inverse=True)
        at = self.rows(letters)[which.reshape(parts.shape)]
        return (self.turned[2, at[0]] * self.turned[1, at[1]] * self.turned[0, at[2]]).astype(np.float32)

    @staticmethod
    def grams(text: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Trigrams around a letter, other characters being one blank (0), and their counts; distinct within each PIECE letters."""
        c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        c = np.concatenate([[0], np.where(letters()[c], c, 0), [0]]).astype(np.uint32)
        c = c[np.r_[True, (c[1:] != 0) | (c[:-1] != 0)]]
        for at in range(0, len(c) - 2, PIECE):
            x = c[at : at + PIECE + 2].astype(np.uint64)
            g = x[:-2] << np.uint64(42) | x[1:-1] << np.uint64(21) | x[2:]
            yield np.unique(g[x[1:-1] != 0], return_counts=True)

    def bundle(self, texts: list[str | None]) -> np.ndarray:
        """A row of sums for each text; zeros for a text without letters. Memory is bounded by PIECE, SLICE and ROOM, whatever the
        texts: trigrams are counted by pieces of a text, and their vectors made and added by slices."""
        out = np.zeros((len(texts), self.dim), np.float32)
        held, n = [], 0
        for i, t in enumerate(texts):
            for g, count in self.grams(t) if t else ():
                held.append((i, g, count))
                n += len(g)
                if n >= PIECE or len(held) >= 128:
                    self._add(out, held)
                    held, n = [], 0
        self._add(out, held)
        return out

    def _add(self, out: np.ndarray, held: list[tuple[int, np.ndarray, np.ndarray]]) -> None:
        if not held:
            return
        distinct, place = np.unique(np.concatenate([g for _, g, _ in held]), return_inverse=True)
        owner = np.repeat(np.arange(len(held)), [len(g) for _, g, _ in held])
        count = np.concatenate([c for _, _, c in held])
        order = np.argsort(place, kind="stable")
        owner, count, place = owner[order], count[order], place[order]
        for s in range(0, len(distinct), SLICE):
            part = distinct[s : s + SLICE]
            a, b = np.searchsorted(place, (s, s + len(part)))
            counts = np.zeros((len(held), len(part)), np.float32)
            counts[owner[a:b], place[a:b] - s] = count[a:b]
            np.add.at(out, [i for i, _, _ in held], counts @ self.vectors(part))


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=-1, keepdims=True), 1e-12)


def held_out(doc_id: F.Column) -> F.Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def prototypes(labelled: DataFrame, dim: int = DIM, train_rows: int = TRAIN_ROWS) -> dict[str, np.ndarray]:
    """Unit prototypes from (text, lang, key): about train_rows rows, those of the smallest hash of key, whatever the table's size."""
    n = labelled.count()
    share = min(1.0, train_rows / max(n, 1))
    some = labelled.filter(F.pmod(F.xxhash64("key"), F.lit(1 << 32)) < int(share * (1 << 32)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, sums = Profiles(dim), {}
        for b in batches:
            lang = b.column(1).to_pylist()
            for x, y in zip(unit(p.bundle(b.column(0).to_pylist())), lang, strict=True):
                sums[y] = sums.get(y, 0) + x.astype(np.float64)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array([v for v in sums.values()], pa.list_(pa.float64()))], ["lang", "v"])

    # dealt by key and text, so that copies of one text spread over the tasks
    parts = some.select("text", "lang", F.xxhash64("key", "text").alias("deal")).repartition(16, "deal").mapInArrow(run, "lang string, v array<double>")
    rows = parts.select("lang", F.posexplode("v").alias("i", "x")).groupBy("lang", "i").agg(F.sum("x").alias("x")).groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("i", "x")))["x"].alias("v")).limit(MAX_LANGS + 1).collect()
    if len(rows) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages")
    return {r.lang: unit(np.array(r.v)).round(9) for r in sorted(rows, key=lambda r: r.lang)}


def predict(docs: DataFrame, protos: dict[str, np.ndarray], dim: int = DIM) -> DataFrame:
    """(doc_id, text) -> (doc_id, lang_pred, score): the language of greatest cosine, the smaller name if equal; score is that cosine, at
    least 0. Null texts and texts without a letter: und, 0. Without prototypes all are und."""
    langs = list(protos)
    matrix = np.array([protos[x] for x in langs], np.float32).reshape(len(langs), dim).T

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = Profiles(dim)
        for b in batches:
            x = p.bundle(b.column(1).to_pylist())
            known = np.abs(x).sum(axis=1) > 0
            cos = unit(x) @ matrix if langs else np.zeros((len(x), 1))
            best = cos.argmax(axis=1)
            name = [langs[i] if ok and langs else UNDETERMINED for i, ok in zip(best, known, strict=True)]
            score = np.where(known, np.clip(cos.max(axis=1), 0, 1), 0).astype(np.float64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(name), pa.array(score)], ["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, lang_pred string, score double")


def keep_identified(docs: DataFrame, protos: dict[str, np.ndarray], min_score: float = 0.1, dim: int = DIM) -> DataFrame:
    """docs, with all their columns, less those that no language claims: null texts, texts without a letter, and texts whose best
    cosine is under min_score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, matrix = Profiles(dim), np.array(list(protos.values()), np.float32).reshape(len(protos), dim).T
        for b in batches:
            x = p.bundle(b.column("text").to_pylist())
            known = np.abs(x).sum(axis=1) > 0
            if protos:
                known &= (unit(x) @ matrix).max(axis=1) >= min_score
            yield b.filter(pa.array(known))

    return docs.mapInArrow(run, docs.schema)


def train(docs: DataFrame, dim: int = DIM, train_rows: int = TRAIN_ROWS) -> dict[str, np.ndarray]:
    """Prototypes from documents with a lang that are not held out (crc32 of doc_id as text, mod 4, is 2); none without an id."""
    rows = docs.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    return prototypes(rows.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"), F.col("doc_id").alias("key")), dim, train_rows)


def identify(docs: DataFrame, dim: int = DIM, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """documents -> (doc_id, held_out, lang_pred, score), a row per row; an empty table gives an empty result.

    Repeated rows get equal values; a row without doc_id is predicted but neither trained on nor held out. Other columns than
    doc_id, text and lang are ignored, whatever their names.
    """
    return predict(docs, train(docs, dim, train_rows), dim).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
