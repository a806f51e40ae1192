"""Substring dedup over a log-structured fingerprint index.

A window is W consecutive words. Its fingerprint for the index is the least hash among the k-grams (k = W // 3) inside
it: equal windows have equal fingerprints, and neighbouring windows mostly share theirs, so a document files about
2 / (W - k + 2) of its positions. The index is a folder that outlives the session: a log of sorted, immutable runs (fingerprint, first_doc,
last_doc), the documents of each batch with their fingerprints, and a manifest that names what counts. Each
new batch is merge-joined with every run, becomes a run itself, and runs are compacted into one when they are many.
Fingerprints held by more than one document are then verified on SHA-256 of the words of whole windows (its first 128 bits): stretches of
windows under one fingerprint are compared as a whole first, then single windows where stretches differ. Only documents that hold such
a fingerprint are read again.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.llm.common import Rolling, Scratch, WordHashes, column, delete, file_system, free_name, sliding_min, words_of


class Windows:
    """Fingerprints and hashes of one text's windows; lives as long as a Python task."""

    def __init__(self, size: int):
        self.size, self.k = size, max(1, size // 3)
        self.grams, self.roll = WordHashes(11), Rolling()

    def anchors(self, words: list[bytes]) -> np.ndarray:
        """The index fingerprint of every window, in order of its first word."""
        if len(words) < self.size:
            return np.zeros(0, np.int64)
        at = np.arange(len(words) - self.k + 1)
        s = self.roll.sums(self.grams.of(words))
        return sliding_min(self.roll.stretch(s, at, at + self.k), self.size - self.k + 1).view(np.int64)

    @staticmethod
    def hashes(words: list[bytes], start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """(n, 2): 128 bits of SHA-256 of the words start .. end - 1, joined by a space."""
        joined = b" ".join(words)
        first = np.concatenate([[0], np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)])
        digests = b"".join(hashlib.sha256(joined[a:b]).digest()[:16] for a, b in zip(first[start].tolist(), (first[end] - 1).tolist(), strict=True))
        return np.frombuffer(digests, np.int64).reshape(-1, 2)

    def stretches(self, words: list[bytes], wanted: np.ndarray) -> list[np.ndarray]:
        """Maximal runs of windows under one wanted fingerprint: (fingerprint, first window, windows, hash of all words)."""
        a = self.anchors(words)
        edge = np.flatnonzero(np.diff(a)) + 1
        start, end = np.r_[0, edge], np.r_[edge, len(a)]
        ok = np.isin(a[start], wanted)
        start, end = start[ok], end[ok]
        return [a[start], start, end - start, *self.hashes(words, start, end - 1 + self.size).T]

    def single(self, words: list[bytes], wanted: np.ndarray) -> list[np.ndarray]:
        """Every window under a wanted fingerprint: (fingerprint, window, 1, hash)."""
        a = self.anchors(words)
        at = np.flatnonzero(np.isin(a, wanted))
        return [a[at], at, np.ones(len(at), np.int64), *self.hashes(words, at, at + self.size).T]


class FingerprintIndex:
    """A folder with runs of (fingerprint, first_doc, last_doc), each sorted by fingerprint and never changed once written, and for each batch
    its (doc_id, anchors). The manifest of the highest number counts; one is written when a batch is complete, so a job that dies leaves the
    index as it was. One job at a time may add to a folder."""

    def __init__(self, spark: SparkSession, folder: str, max_runs: int = 4):
        self.spark, self.folder, self.max_runs = spark, folder.rstrip("/"), max_runs
        self.number, self.runs, self.batches = 0, [], {}
        fs, p = file_system(spark, self.folder)
        if fs.exists(p):
            names = [f.getPath().getName() for f in fs.listStatus(p)]
            self.number = max((int(n[9:]) for n in names if n.startswith("manifest-")), default=0)
        if self.number:
            text = spark.read.text(f"{self.folder}/manifest-{self.number:06d}", wholetext=True).first()[0]
            state = json.loads(text)
            self.runs, self.batches = state["runs"], state["batches"]

    def run(self, name: str) -> DataFrame:
        return self.spark.read.schema("fingerprint long, first_doc long, last_doc long").parquet(f"{self.folder}/{name}")

    def documents(self) -> DataFrame | None:
        """(doc_id, anchors) of all batches."""
        if not self.batches:
            return None
        return self.spark.read.schema("doc_id long, anchors array<long>").parquet(*[f"{self.folder}/{b}" for b in self.batches.values()])

    def add(self, name: str, batch: DataFrame, scratch: Scratch) -> DataFrame:
        """batch (doc_id, anchors) -> (hit): fingerprints that it shares with a run, or holds in several documents itself. Counts after commit()."""
        if name in self.batches:
            raise ValueError(f"batch {name} is in the index")
        self.batches[name] = self._write(batch.select("doc_id", "anchors"), "docs")
        rows = batch.select("doc_id", F.explode("anchors").alias("fingerprint")).groupBy("fingerprint").agg(F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc"))
        own = self._write_run(rows)
        run = self.run(own)
        hits = run.filter("first_doc < last_doc").select("fingerprint")
        for old in self.runs:
            o = self.run(old).select(F.col("fingerprint").alias("old"))
            hits = hits.unionByName(run.join(o.hint("merge"), run.fingerprint == o.old).select("fingerprint"))
        hits = scratch.write(hits.distinct().select(F.col("fingerprint").alias("hit")), "hits")
        self.runs.append(own)
        return hits

    def commit(self) -> None:
        """Makes what was added count, and compacts if there are many runs."""
        old = []
        if len(self.runs) > self.max_runs:
            rows = self.run(self.runs[0])
            for r in self.runs[1:]:
                rows = rows.unionByName(self.run(r))
            one = self._write_run(rows.groupBy("fingerprint").agg(F.min("first_doc").alias("first_doc"), F.max("last_doc").alias("last_doc")))
            old, self.runs = self.runs, [one]
        self.number += 1
        fs, path = file_system(self.spark, f"{self.folder}/manifest-{self.number:06d}")
        _, part = file_system(self.spark, f"{self.folder}/_manifest-{uuid.uuid4().hex}")
        out = fs.create(part)
        out.write(bytearray(json.dumps({"runs": self.runs, "batches": self.batches}).encode()))
        out.close()
        if not fs.rename(part, path):
            raise OSError(f"{path} is there: another job has added to the index")
        for r in old:
            delete(self.spark, f"{self.folder}/{r}")

    def _write(self, df: DataFrame, kind: str) -> str:
        name = f"{kind}/{uuid.uuid4().hex}"
        df.write.option("compression", "zstd").parquet(f"{self.folder}/{name}")
        return name

    def _write_run(self, rows: DataFrame) -> str:
        return self._write(rows.repartition("fingerprint").sortWithinPartitions("fingerprint"), "runs")


def _features(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        win = Windows(size)
        for b in batches:
            n, sha, anchors = [], [], []
            for text in b.column(1):
                words = words_of(text.as_py())
                n.append(len(words))
                sha.append(hashlib.sha256(b" ".join(words)).hexdigest())
                anchors.append(np.unique(win.anchors(words)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(sha), pa.array(anchors, pa.list_(pa.int64()))], ["doc_id", "n_words", "sha", "anchors"])

    return run


def _windows(size: int, kind: str):
    """(doc_id, late, text, wanted) -> (doc_id, late, fingerprint, start, n, h1, h2), of stretches or of single windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        win = Windows(size)
        for b in batches:
            for doc, late, text, wanted in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), b.column(3), strict=True):
                got = getattr(win, kind)(words_of(text.as_py()), wanted.values.to_numpy())
                n = len(got[0])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, doc, np.int64)), pa.array(np.full(n, late)), *[pa.array(x.astype(np.int64)) for x in got]], ["doc_id", "late", "fingerprint", "start", "n", "h1", "h2"])

    return run


WINDOWS = "doc_id long, late boolean, fingerprint long, start long, n long, h1 long, h2 long"


def covered(n_words: int, size: int, start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Which words lie in a window of runs start .. start + n - 1."""
    step = np.zeros(n_words + 1, np.int64)
    np.add.at(step, start, 1)
    np.add.at(step, np.minimum(start + n - 1 + size, n_words), -1)
    return np.cumsum(step[:-1]) > 0


def _remove(size: int, texts: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [[], [], [], []]
            for text, spans in zip(b.column(1), b.column(2), strict=True):
                words = words_of(text.as_py())
                gone = 0
                if spans.is_valid and len(spans):
                    v = spans.values
                    off = covered(len(words), size, v.field("start").to_numpy(), v.field("n").to_numpy())
                    gone = int(off.sum())
                    words = [w for w, x in zip(words, off, strict=True) if not x]
                kept = b" ".join(words)
                out[0].append(len(words) + gone)
                out[1].append(gone)
                out[2].append(hashlib.sha256(kept).hexdigest())
                out[3].append((kept if gone else text.as_py().encode("utf-8", "surrogatepass")) if texts and text.is_valid else None)
            arrays = [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2]), pa.array(out[3], pa.binary())]
            yield pa.RecordBatch.from_arrays([b.column(0), *arrays], ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])

    return run


REMOVALS = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept binary"


def _plain(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _owners() -> list[Column]:
    """Of the documents that hold something: the least of an earlier batch, and the least and greatest of this one."""
    early, late = F.when(~F.col("late"), F.col("doc_id")), F.when(F.col("late"), F.col("doc_id"))
    return [F.min(early).alias("early"), F.min(late).alias("least"), F.max(late).alias("most")]


def verified_spans(affected: DataFrame, scratch: Scratch, size: int) -> DataFrame:
    """affected (doc_id, late, text, wanted: fingerprints to look under) -> (doc_id, spans array<start, n>) of late documents: the runs of windows
    whose words also start in an early one, or in a late one of smaller doc_id. An array holds no more runs than its text has words."""
    again = (F.col("early").isNotNull() | (F.col("doc_id") > F.col("least"))) & F.col("late")
    stretch = scratch.write(affected.mapInArrow(_windows(size, "stretches"), WINDOWS), "stretches")
    same = ["fingerprint", "h1", "h2", "n"]
    owners = scratch.write(stretch.groupBy(*same).agg(*_owners()), "owners")
    whole = stretch.join(owners, same).filter(again).select("doc_id", "start", "n")
    # Stretches of one fingerprint that differ, and not all in one document, may still share windows; each kind's first document shows them.
    first, old = F.coalesce("early", "least"), F.count("early")
    unlike = owners.groupBy("fingerprint").agg(F.min(first).alias("a"), F.max(first).alias("b"), old.alias("old"), F.count(F.lit(1)).alias("kinds"))
    unlike = scratch.write(unlike.filter("a < b or (old > 0 and old < kinds)").select("fingerprint"), "unlike")
    show = owners.join(unlike, "fingerprint").groupBy(first.alias("who"), F.col("early").isNull().alias("when")).agg(F.collect_set("fingerprint").alias("look"))
    show = scratch.write(show, "shown")
    looked = affected.join(show, (F.col("doc_id") == F.col("who")) & (F.col("late") == F.col("when"))).select("doc_id", "late", "text", "look")
    single = scratch.write(looked.mapInArrow(_windows(size, "single"), WINDOWS), "windows")
    met = scratch.write(single.groupBy("h1", "h2").agg(*_owners()).filter("(early is not null and least is not null) or least < most"), "met")
    part = single.join(met, ["h1", "h2"]).filter(again).select("doc_id", "start", "n")
    spans = scratch.write(whole.unionByName(part).groupBy("doc_id").agg(F.collect_list(F.struct("start", "n")).alias("spans")), "spans")
    scratch.drop(stretch, owners, unlike, show, single, met)
    return spans


def _affected(docs: DataFrame, filed: DataFrame, hits: DataFrame, late: bool, scratch: Scratch) -> DataFrame:
    """Whole texts of the documents that hold a hit, with those that they hold."""
    held = filed.filter("doc_id is not null").select("doc_id", F.explode("anchors").alias("fingerprint"))
    wanted = held.join(hits, F.col("fingerprint") == F.col("hit")).groupBy("doc_id").agg(F.collect_set("fingerprint").alias("wanted"))
    return _plain(docs).join(scratch.write(wanted, "wanted"), "doc_id").select("doc_id", F.lit(late).alias("late"), "text", "wanted")


def repeated_spans(docs: DataFrame, scratch: Scratch, size: int = 50, batches: int = 3) -> tuple[DataFrame, DataFrame, DataFrame]:
    """-> features (doc_id, n_words, sha, anchors), affected (doc_id, late, text, wanted), spans (doc_id, spans array<start, n>).

    The table goes through an index of its own in `batches` of equal size by doc_id. affected holds the whole text of every document that
    shares an index fingerprint with another; spans the runs of windows that also start in a document of smaller doc_id.
    """
    feats = scratch.write(_plain(docs).mapInArrow(_features(size), "doc_id long, n_words long, sha string, anchors array<long>"), "features")
    cuts = feats.agg(F.percentile_approx("doc_id", [i / batches for i in range(1, batches)], 10_000).alias("cuts")).first().cuts or [] if batches > 1 else []
    index, shared = FingerprintIndex(docs.sparkSession, scratch.path("index"), max_runs=2), None
    bounds = [None, *sorted(set(cuts)), None]
    for i, (low, high) in enumerate(zip(bounds, bounds[1:])):
        part = feats.filter("doc_id is not null")
        part = part if low is None else part.filter(F.col("doc_id") > low)
        part = part if high is None else part.filter(F.col("doc_id") <= high)
        hits = index.add(str(i), part, scratch)
        index.commit()
        shared = hits if shared is None else shared.unionByName(hits)
    affected = scratch.write(_affected(docs, feats, scratch.write(shared.distinct(), "shared"), True, scratch), "affected")
    return feats, affected, verified_spans(affected, scratch, size)


def removals(docs: DataFrame, size: int = 50, batches: int = 3, texts: bool = False) -> DataFrame:
    """documents -> (doc_id, n_words, n_removed, kept_sha256[, kept binary]); one row per input row.

    A word goes if a window of `size` words that covers it also starts in a document with a smaller doc_id; windows are
    judged on the input. Null text: no words. Fewer than `size` words: nothing goes. Rows that repeat a doc_id are one
    document's: they don't remove each other's windows. Rows without doc_id neither lose nor cause a removal. An empty table gives an empty
    result; other columns are ignored, whatever their names. With texts, kept holds the kept words joined by
    one space, or the text as it was where nothing goes.
    """
    scratch = Scratch(docs.sparkSession, "substring")
    feats, affected, spans = repeated_spans(docs, scratch, size, batches)
    if texts:
        return _plain(docs).join(spans, "doc_id", "left").select("doc_id", "text", "spans").mapInArrow(_remove(size, True), REMOVALS)
    cut = affected.join(spans, "doc_id").select("doc_id", "text", "spans").mapInArrow(_remove(size, False), REMOVALS).drop("kept")
    same = feats.join(spans.select("doc_id"), "doc_id", "left_anti").select("doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"), F.col("sha").alias("kept_sha256"))
    return same.unionByName(cut)


def add_batch(index: FingerprintIndex, name: str, batch: DataFrame, earlier: DataFrame | None = None, size: int = 50) -> DataFrame:
    """A batch of documents -> as removals() with texts, and the batch is in the index.

    A word goes if a window that covers it also starts in a document of an earlier batch, or in one of this batch with a smaller doc_id; where
    doc_ids rise from batch to batch, that gives what removals() gives for all at once. earlier: the documents (doc_id, text) of the batches in
    the index, of which only those are read that share a fingerprint with this one. Nulls, repeated rows and empty tables as in removals().
    """
    scratch = Scratch(batch.sparkSession, "substring")
    old = index.documents()
    if old is not None and earlier is None:
        raise ValueError("the index has documents; give their texts")
    feats = scratch.write(_plain(batch).mapInArrow(_features(size), "doc_id long, n_words long, sha string, anchors array<long>").filter("doc_id is not null"), "features")
    hits = index.add(name, feats, scratch)
    affected = _affected(batch, feats, hits, True, scratch)
    if old is not None:
        affected = affected.unionByName(_affected(earlier, old, hits, False, scratch))
    spans = verified_spans(scratch.write(affected, "affected"), scratch, size)
    index.commit()
    return _plain(batch).join(spans, "doc_id", "left").select("doc_id", "text", "spans").mapInArrow(_remove(size, True), REMOVALS)


def deduplicate(docs: DataFrame, size: int = 50, batches: int = 3) -> DataFrame:
    """docs, with all their columns, whatever their names, less the words that removals() takes out; documents left without a word go.

    A changed text is its kept words joined by one space, and n_chars, if there is such a column, its new length; others are as they were.
    Null texts stay; nulls, repeated rows and empty tables otherwise as in removals().
    """
    scratch = Scratch(docs.sparkSession, "substring")
    _, _, spans = repeated_spans(docs, scratch, size, batches)
    of, found = free_name(docs, "of", "found")
    cut = spans.select(F.col("doc_id").alias(of), F.col("spans").alias(found))
    rows = docs.join(cut, column("doc_id").cast("long") == column(of), "left").drop(of)
    names = list(docs.columns)
    text, chars = names.index("text"), names.index("n_chars") if "n_chars" in names else None

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts:
            new, n, keep = [], [], []
            old = b.column(chars).to_pylist() if chars is not None else [None] * b.num_rows
            for t, was, spans in zip(b.column(text), old, b.column(len(names)), strict=True):
                t = t.as_py()
                if spans.is_valid:
                    words, v = words_of(t), spans.values
                    off = covered(len(words), size, v.field("start").to_numpy(), v.field("n").to_numpy())
                    t = b" ".join(w for w, x in zip(words, off, strict=True) if not x).decode("utf-8", "surrogatepass")
                    was = len(t)
                new.append(t)
                n.append(was)
                keep.append(not spans.is_valid or bool(t))
            cols = [b.column(i) for i in range(len(names))]
            cols[text] = pa.array(new, b.schema.field(text).type)
            if chars is not None:
                cols[chars] = pa.array(n, b.schema.field(chars).type)
            yield pa.RecordBatch.from_arrays(cols, schema=pa.schema([b.schema.field(i) for i in range(len(names))])).filter(pa.array(keep))

    return rows.mapInArrow(run, docs.schema)
