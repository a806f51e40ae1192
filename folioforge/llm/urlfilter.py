"""URL rules by a sort-merge range join.

A host's labels reversed, each followed by a slash ("www.example.net" -> "net/example/www/"), give a canonical key under which a host
and all its subdomains are one interval: those that start with the rule's key. A host ends at its first slash, so none holds one. URLs and rules are dealt over ranges of
keys and sorted; one sweep over a range keeps the stack of rules whose intervals hold the present key, innermost last. Rules
reach every range that their interval touches. Equal keys are ordered, and so cut, by row hash: one host may fill many ranges.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.llm.common import even_keys

PER_RANGE = 40  # sampled keys a range
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))


def host_and_path(url: F.Column) -> tuple[F.Column, F.Column]:
    """Host: after the first '://' up to '/', '?', '#' or the end, A-Z lower-cased; path: from there up to '?', '#' or the end."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(__url, instr(__url, '://') + 3)")).otherwise("")
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def canonical(host: F.Column) -> F.Column:
    return F.when(host == "", "").otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "/"), F.lit("/")))


def _deal(bounds: list[tuple[bytes, int]], names: list[int]):
    """Adds the range of each url (one), and of each rule (all that its interval touches), by its number in names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, salts, isrule = b.column("key").to_pylist(), b.column("salt").to_pylist(), b.column("verdict").is_valid().to_pylist()
            rows, parts = [], []
            for i, (k, salt, r) in enumerate(zip(keys, salts, isrule, strict=True)):
                k = k.encode()
                if not r:
                    got = [bisect_left(bounds, (k, salt))]
                else:  # from the range of the key itself to the range of the last key that starts with it
                    got = range(bisect_left(bounds, (k, -(1 << 63))), bisect_left(bounds, (k + b"\xff", -(1 << 63))) + 1)
                for p in got:
                    rows.append(i)
                    parts.append(names[p])
            t = pa.Table.from_batches([b]).take(pa.array(rows, pa.int64())).append_column("part", pa.array(parts, pa.int32())).combine_chunks()
            yield from t.to_batches()

    return run


def _sweep(default: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, stack = None, []  # stack: (key, [(length, host length, rule, path, verdict)]), each inside the one before
        for b in batches:
            out = [[], [], [], [], []]
            names = ("part", "key", "verdict", "page_id", "host", "path", "rule", "rule_path")
            for p, key, verdict, page, host, path, rule, rule_path in zip(*(b.column(c).to_pylist() for c in names), strict=True):
                if p != part:
                    part, stack = p, []
                while stack and not key.startswith(stack[-1][0]):
                    stack.pop()
                if verdict is not None:
                    if not stack or stack[-1][0] != key:
                        stack.append((key, []))
                    stack[-1][1].append((len(rule), len(key), rule, rule_path, verdict))
                    continue
                best = max((r for _, rs in stack for r in rs if path.startswith(r[3])), default=None)
                for c, x in zip(out, (page, host, path, best and best[2], best[4] if best else default), strict=True):
                    c.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, (pa.int64(), *[pa.string()] * 4), strict=True)], ["page_id", "host", "path", "rule", "verdict"])

    return run


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """pages (page_id, url), rules (verdict, host, path) -> (page_id, host, path, rule, verdict), a row for each page.

    A rule fits its host and all subdomains if the url's path starts with the rule's path. The longest host + path wins, then the
    longer host; of equal rules the greater verdict by code point. Null url, or no '://': host and path are empty, and no rule fits.
    No rule: rule is null and verdict `default`. Rules without host or verdict, or with a slash in the host, fit nothing; a null path is
    empty; a rule's host is taken with A-Z lower-cased. Repeated pages give repeated rows; empty tables give an empty result, or default verdicts.
    """
    spark = pages.sparkSession
    u = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("__url"))
    host, path = host_and_path(F.col("__url"))
    u = u.select("page_id", host.alias("host"), path.alias("path"), F.xxhash64("page_id", "__url").alias("salt")).withColumn("key", canonical(F.col("host")))
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
    some = u.select("key", "salt").orderBy(F.xxhash64("salt")).limit(parts * PER_RANGE).collect()
    keys = sorted((r.key.encode(), r.salt) for r in some)
    bounds = [keys[i * len(keys) // parts] for i in range(1, parts)] if keys else []
    none = F.lit(None).cast("string")
    r = rules.filter("host is not null and host <> '' and not contains(host, '/') and verdict is not null").select(F.translate("host", UPPER, LOWER).alias("h"), F.coalesce("path", F.lit("")).alias("rule_path"), F.col("verdict").cast("string").alias("verdict"))
    r = r.select(canonical(F.col("h")).alias("key"), F.lit(0).cast("long").alias("salt"), "verdict", F.lit(None).cast("long").alias("page_id"), none.alias("host"), none.alias("path"), F.concat("h", "rule_path").alias("rule"), "rule_path")
    u = u.select("key", "salt", none.alias("verdict"), "page_id", "host", "path", none.alias("rule"), none.alias("rule_path"))
    both = u.unionByName(r)
    dealt = both.mapInArrow(_deal(bounds, even_keys(spark, parts)), "key string, salt long, verdict string, page_id long, host string, path string, rule string, rule_path string, part int")
    ranged = dealt.repartition(parts, "part").sortWithinPartitions("part", "key", F.col("verdict").isNull(), "salt")
    return ranged.mapInArrow(_sweep(default), "page_id long, host string, path string, rule string, verdict string")


def rule_table(spark, rules=RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "verdict string, host string, path string")
