"""Scalar maths, file names and sort keys as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """then(value), with value evaluated once, however often it is named: a lambda over an array of one."""
    return F.transform(F.array(value), then)[0]


def softmax(xs: Column) -> Column:
    """Over an array; shifted by its greatest value. Linear: the greatest value and the sum are taken once."""
    e = let(F.array_max(xs).cast("double"), lambda m: F.transform(xs, lambda x: F.exp(x.cast("double") - m)))
    return let(e, lambda e: let(F.aggregate(e, F.lit(0.0), lambda a, b: a + b), lambda s: F.transform(e, lambda x: x / s)))


def argmax(xs: Column) -> Column:
    """0-based place of the first greatest element."""
    return (F.array_position(xs, F.array_max(xs)) - 1).cast("int")


def above(xs: Column, threshold: float) -> Column:
    """A mask of 0 and 1: strictly above."""
    return F.transform(xs, lambda x: (x > threshold).cast("int"))


def length_normalised_confidence(log_score: Column, text: Column) -> Column:
    return F.exp(log_score / F.greatest(F.length(text), F.lit(1)))


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)


def file_stem(path: Column) -> Column:
    """Name without its last extension; without a dot, nothing; dots at the end go."""
    return F.rtrim(F.regexp_replace(file_name(path), r"\.?[^.]*$", ""), F.lit("."))


def natural_key(name: Column) -> Column:
    """Runs of digits as numbers of any length, the rest as it is: an array that sorts naturally. A number is its count of digits, in ten places, then its
    digits, without leading zeros."""

    def part(x: Column) -> Column:
        bare = F.regexp_replace(x, r"^0+(?=\d)", "")
        return F.when(x.rlike(r"^\d"), F.concat(F.lpad(F.length(bare).cast("string"), 10, "0"), bare)).otherwise(x)

    return F.transform(F.regexp_extract_all(name, F.lit(r"(\d+|\D+)"), F.lit(1)), part)


def line_guid(page: Column, ordinal: Column) -> Column:
    """Deterministic id of a line."""
    return F.sha2(F.concat_ws("/", page.cast("string"), ordinal.cast("string")), 256)


def colour(text: Column) -> Column:
    """'r, g, b' -> array of ints."""
    return F.transform(F.split(text, ","), lambda x: F.trim(x).cast("int"))


def utc_stamp(ts: Column) -> Column:
    """A point in time in UTC, whatever the session's zone; a timestamp without zone is taken to be UTC already."""
    s = F.unix_seconds(ts.cast("timestamp"))
    day, rest = F.floor(s / 86400), F.pmod(s, F.lit(86400))
    clock = F.format_string("%02d:%02d:%02d", F.floor(rest / 3600), F.floor(rest / 60) % 60, rest % 60)
    at = F.concat(F.date_add(F.lit("1970-01-01").cast("date"), day.cast("int")).cast("string"), F.lit("T"), clock)
    return F.when(F.typeof(ts) == "timestamp_ntz", F.replace(F.substring(ts.cast("timestamp_ntz").cast("string"), 1, 19), F.lit(" "), F.lit("T"))).otherwise(at)
