"""Times and dates, as column builders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clock(seconds: Column) -> Column:
    """seconds as HH:MM:SS, floored, not below zero."""
    s = F.greatest(F.floor(seconds), F.lit(0)).cast("long")
    return F.format_string("%02d:%02d:%02d", F.floor(s / 3600).cast("long"), F.floor(s % 3600 / 60).cast("long"), s % 60)


def seconds(text: Column) -> Column:
    """HH:MM:SS as seconds; null if it isn't that."""
    part = lambda i: F.try_element_at(F.split(text, ":"), F.lit(i)).try_cast("int")
    return F.when(text.rlike("^[0-9]{2,}:[0-9]{2}:[0-9]{2}$"), part(1) * 3600 + part(2) * 60 + part(3))


def midpoint(start: Column, end: Column) -> Column:
    """F38."""
    return (start + end) / 2


def overlap(a1: Column, a2: Column, b1: Column, b2: Column) -> Column:
    """how long two intervals overlap; 0 if they don't."""
    return F.greatest(F.least(a2, b2) - F.greatest(a1, b1), F.lit(0))


def stem_time(stem: Column) -> Column:
    """the time in a recording's file stem, in either of two spellings; null if in neither."""
    a = F.regexp_extract(stem, r"([0-9]{8})[ _-]([0-9]{6})", 0)
    b = F.regexp_extract(stem, r"[0-9]{4}-[0-9]{2}-[0-9]{2}[ _T][0-9]{2}[-:.][0-9]{2}[-:.][0-9]{2}", 0)
    compact = F.try_to_timestamp(F.regexp_replace(a, "[ _-]", ""), F.lit("yyyyMMddHHmmss"))
    spaced = F.try_to_timestamp(F.regexp_replace(b, "[^0-9]", ""), F.lit("yyyyMMddHHmmss"))
    return F.coalesce(F.when(a != "", compact), F.when(b != "", spaced))


def cutoff(now: Column, months: int) -> Column:
    """``months`` times 31 days before."""
    return now - F.expr(f"interval {31 * months} days")


def is_fresh(updated: Column, now: Column, hours: int = 36) -> Column:
    """F35."""
    return F.unix_micros(now) - F.unix_micros(updated) <= hours * 3600 * 1_000_000
