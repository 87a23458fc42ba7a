"""Page ranges: arrays of inclusive (start, end)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_KIND = "array<struct<start:int,end:int>>"


def merged(ranges: Column) -> Column:
    """Sorted disjoint ranges of any given ones; reversed and null ones are left out, neighbours grow together."""
    valid = F.array_sort(F.filter(ranges, lambda r: r["start"].isNotNull() & r["end"].isNotNull() & (r["start"] <= r["end"])))

    def add(done: Column, r: Column) -> Column:
        last = F.element_at(done, -1)
        grown = F.struct(last["start"].alias("start"), F.greatest(last["end"], r["end"]).alias("end"))
        return F.when((F.size(done) > 0) & (r["start"] <= F.get(done, F.size(done) - 1)["end"] + 1), F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(grown))).otherwise(F.concat(done, F.array(F.struct(r["start"].alias("start"), r["end"].alias("end")))))

    return F.aggregate(F.coalesce(valid, F.array().cast(_KIND)), F.array().cast(_KIND), add)


def page_total(ranges: Column) -> Column:
    """How many pages disjoint ranges hold."""
    return F.aggregate(ranges, F.lit(0).cast("bigint"), lambda n, r: n + r["end"] - r["start"] + 1)


def formatted(ranges: Column) -> Column:
    """``1-3,7`` for (1, 3), (7, 7)."""
    return F.array_join(F.transform(ranges, lambda r: F.when(r["start"] == r["end"], r["start"].cast("string")).otherwise(F.concat(r["start"].cast("string"), F.lit("-"), r["end"].cast("string")))), ",")


def parsed(text: Column) -> Column:
    """Ranges of a text like ``1-3, 7``; parts that are none are left out."""
    parts = F.transform(F.split(text, ","), lambda p: F.trim(p))
    good = F.filter(parts, lambda p: p.rlike(r"^\d+(\s*-\s*\d+)?$"))
    return F.transform(good, lambda p: F.struct(F.regexp_extract(p, r"^(\d+)", 1).cast("int").alias("start"), F.regexp_extract(p, r"(\d+)$", 1).cast("int").alias("end")))


def numbers(ranges: Column) -> Column:
    """All page numbers of disjoint ranges."""
    return F.flatten(F.transform(ranges, lambda r: F.sequence(r["start"], r["end"])))
