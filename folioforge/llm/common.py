"""Shared helpers: scratch tables in the cluster's shared folder, size-checked broadcasts, word tables."""

from __future__ import annotations

import atexit
import contextlib
import os
import tempfile
import threading
import uuid

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: What counts as a word everywhere in this package: runs of anything but these six ASCII blanks.
#: bytes.split() without arguments splits at exactly these.
WORD = r"[^\x20\x09-\x0D]+"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Where that is unset: one of our own if all runs on one machine, else an error."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is unset; on a cluster it must name a folder that all executors share")
        root = os.path.join(tempfile.gettempdir(), "folioforge-scratch")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path as it takes it."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def delete(spark: SparkSession, path: str) -> None:
    fs, p = file_system(spark, path)
    fs.delete(p, True)


class Scratch:
    """Intermediate tables, written as Parquet under the shared folder.

    A written table cuts the lineage, can be read by every executor and outlives the loss of any of them.
    Shuffle files of the job that wrote it are released at its end, so disk holds one job's shuffle at a time.
    Results are read lazily, so tables stay until the block of a released() around them, or else the process, ends.
    """

    lock, writing, before = threading.Lock(), 0, "false"
    open_scopes: list[list["Scratch"]] = []

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self.n = 0
        if Scratch.open_scopes:
            Scratch.open_scopes[-1].append(self)
        atexit.register(self.close)

    def path(self, name: str) -> str:
        self.n += 1
        return f"{self.root}/{self.n:03d}-{name}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path, schema = self.path(name), df.schema
        self._cleanup(True)
        try:
            df.write.option("compression", "zstd").parquet(path)
        finally:
            self._cleanup(False)
        out = self.spark.read.schema(schema).parquet(path)
        out._scratch_path = path
        return out

    def _cleanup(self, on: bool) -> None:
        """The session's setting is on while any thread writes, and as it was after the last."""
        with Scratch.lock:
            if on and not Scratch.writing:
                Scratch.before = self.spark.conf.get(CLEANUP, "false")
                self.spark.conf.set(CLEANUP, "true")
            Scratch.writing += 1 if on else -1
            if not Scratch.writing:
                self.spark.conf.set(CLEANUP, Scratch.before)

    def drop(self, *tables: DataFrame) -> None:
        for t in tables:
            delete(self.spark, t._scratch_path)

    def close(self) -> None:
        atexit.unregister(self.close)
        try:
            if self.spark.sparkContext._jsc is not None:
                delete(self.spark, self.root)
        except Exception:  # the session is gone; the folder is the cluster's to clean
            pass


@contextlib.contextmanager
def released():
    """Scratch tables made in this block go at its end: for callers that have written or collected what they asked for."""
    Scratch.open_scopes.append([])
    try:
        yield
    finally:
        for s in Scratch.open_scopes.pop():
            s.close()


def free_name(df: DataFrame, *wanted: str) -> str | list[str]:
    """Column names like those wanted that df does not have, whatever its names."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out[0] if len(out) == 1 else out


def column(name: str) -> Column:
    """A column by its bare name, with dots or backquotes in it as they are."""
    return F.col("`" + name.replace("`", "``") + "`")


def even_keys(spark: SparkSession, n: int) -> list[int]:
    """n numbers of which repartition(n, number) sends each to a partition of its own."""
    found, width = {}, 16 * n
    while len(found) < n:
        k = F.col("id").cast("int")
        rows = spark.range(width).select(k.alias("k"), F.pmod(F.hash(k), F.lit(n)).alias("p")).groupBy("p").agg(F.min("k").alias("k")).collect()
        found, width = {r.p: r.k for r in rows}, 4 * width
    return [found[p] for p in range(n)]


def join_bounded(df: DataFrame, small: DataFrame, key: str, how: str = "left", rows: int | None = None, max_rows: int = 100_000, salts: int = 32) -> DataFrame:
    """Join with a table that is small as a rule: broadcast up to max_rows rows, else a salted shuffle join.

    The key is compared null-safely. small holds a key once. Beyond max_rows, each row of small is repeated
    for every salt and df's rows are dealt over the salts by row hash, so one hot key spreads over `salts` tasks.
    rows: small's number of rows, or a bound of it, where that is known; else it is counted.
    """
    k = f"__{key}"
    small = small.withColumnRenamed(key, k)
    if (small.limit(max_rows + 1).count() if rows is None else rows) <= max_rows:
        return df.join(F.broadcast(small), F.col(key).eqNullSafe(F.col(k)), how).drop(k)
    many = small.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    dealt = df.withColumn("__deal", F.pmod(F.xxhash64(*[column(c) for c, t in df.dtypes if "map<" not in t and "variant" not in t]), F.lit(salts)).cast("int"))
    on = F.col(key).eqNullSafe(F.col(k)) & (F.col("__deal") == F.col("__salt"))
    return dealt.join(many, on, how).drop(k, "__salt", "__deal")


class WordHashes(dict):
    """word (bytes) -> 64-bit hash, remembered for up to `room` words."""

    def __init__(self, seed: int = 0, room: int = 200_000):
        super().__init__()
        self.seed, self.room = seed, room

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.room:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word, self.seed)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def words_of(text: str | None) -> list[bytes]:
    return [] if text is None else text.encode("utf-8", "surrogatepass").split()


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a bijection on 64-bit words."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Rolling:
    """Polynomial hashes, modulo 2**64, of any stretch of a sequence of mixed 64-bit values."""

    BASE = 0x9E3779B97F4A7C15 | 1

    def __init__(self):
        self.up = np.ones(1, np.uint64)
        self.down = np.ones(1, np.uint64)

    def grow(self, n: int) -> None:
        if len(self.up) <= n:
            size = max(4096, 1 << n.bit_length())
            inverse = pow(self.BASE, -1, 1 << 64)
            for name, base in (("up", self.BASE), ("down", inverse)):
                p = np.full(size, base, np.uint64)
                p[0] = 1
                setattr(self, name, np.multiply.accumulate(p))

    def sums(self, values: np.ndarray) -> np.ndarray:
        self.grow(len(values) + 1)
        out = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self.up[: len(values)], out=out[1:])
        return out

    def stretch(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix64((sums[end] - sums[start]) * self.down[start])


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w consecutive values, by doubling."""
    if len(x) < w:
        return x[:0]
    done, out = 1, x
    while done < w:
        step = min(done, w - done)
        out = np.minimum(out[: len(out) - step], out[step:])
        done += step
    return out
