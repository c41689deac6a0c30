"""Dates inside file names, by shape only: nothing is converted to a date.

A name is split into pieces at everything but ASCII letters and digits, after an ISO 'T' between digits has become a separator. A
date takes up to three pieces; the leftmost, and there the longest, is the name's date span.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The shapes of the parts of a date.
YEAR = r"(?:19|20)\d\d"
MONTH = r"(?:0[1-9]|1[0-2])"
DAY = r"(?:0[1-9]|[12]\d|3[01])"
LOOSE_DAY = r"(?:0?[1-9]|[12]\d|3[01])"
MONTH_NAME = (
    r"(?:january|february|march|april|may|june|july|august|september|october|november|december"
    r"|jan|feb|mar|apr|jun|jul|aug|sept|sep|oct|nov|dec)"
)


def _whole(piece: Column, *shapes: str) -> Column:
    return F.coalesce(F.rlike(piece, F.lit("(?i)^(?:" + "|".join(shapes) + ")$")), F.lit(False))


def pieces(stem: Column) -> Column:
    return F.filter(F.split(F.regexp_replace(stem, r"(?<=\d)T(?=\d)", "_"), "[^A-Za-z0-9]+"), lambda p: p != "")


def kind(piece: Column) -> Column:
    """What a piece can be: struct of booleans year, month, day, loose_day, name, short_year, alone. `alone` is a date by itself:
    YYYYMMDD with any digits behind it, eight digits MMDDYYYY or DDMMYYYY, or a fused one like 15Jan2024, Jan2024, 2024Jan15."""
    alone = (
        rf"{YEAR}{MONTH}{DAY}\d*", rf"{MONTH}{DAY}{YEAR}", rf"{DAY}{MONTH}{YEAR}",
        rf"{LOOSE_DAY}{MONTH_NAME}{YEAR}", rf"{MONTH_NAME}{LOOSE_DAY}?{YEAR}", rf"{YEAR}{MONTH_NAME}{LOOSE_DAY}?",
    )
    shapes = {"year": (YEAR,), "month": (MONTH,), "day": (DAY,), "loose_day": (LOOSE_DAY,), "name": (MONTH_NAME,), "short_year": (r"\d\d",), "alone": alone}
    return F.struct(*(_whole(piece, *shape).alias(name) for name, shape in shapes.items()))


def _pair(a: Column, b: Column, x: str, y: str) -> Column:
    return (a[x] & b[y]) | (a[y] & b[x])


def numeric_triple(a: Column, b: Column, c: Column) -> Column:
    """A year first or last, beside a month and a day in either order."""
    return (a["year"] & _pair(b, c, "month", "day")) | (c["year"] & _pair(a, b, "month", "day"))


def named_triple(a: Column, b: Column, c: Column) -> Column:
    """One month name among two numbers, of which one can be the day and the other a year of four or two digits."""
    def rest(x: Column, y: Column) -> Column:
        return (x["loose_day"] & (y["year"] | y["short_year"])) | (y["loose_day"] & (x["year"] | x["short_year"]))

    return (a["name"] & rest(b, c)) | (b["name"] & rest(a, c)) | (c["name"] & rest(a, b))


def date_span(kinds: Column) -> Column:
    """struct(first, length) of the date among pieces of these kinds (from 0), or null: the leftmost, and there the longest."""
    at = lambda i: F.get(kinds, i)

    def length(a: Column, i: Column) -> Column:
        b, c = at(i + 1), at(i + 2)
        return F.when(numeric_triple(a, b, c) | named_triple(a, b, c), F.lit(3)).when(_pair(a, b, "name", "year"), F.lit(2)).when(a["alone"], F.lit(1))

    spans = F.transform(kinds, lambda k, i: F.struct(i.alias("first"), length(k, i).alias("length")))
    return F.get(F.filter(spans, lambda s: s["length"].isNotNull()), F.lit(0))


def group_key_of(parts: Column, span: Column) -> Column:
    """The pieces before the date, joined by '_'; if there are none, those behind it without leading all-digit ones. Null
    without a date or without such pieces."""
    n = F.size(parts)
    before = F.slice(parts, F.lit(1), F.coalesce(span["first"], F.lit(0)))
    rest = F.slice(parts, F.coalesce(span["first"] + span["length"], F.lit(0)) + 1, n)
    first_word = F.get(F.filter(F.transform(rest, lambda p, i: F.when(~F.rlike(p, F.lit(r"^\d+$")), i)), lambda i: i.isNotNull()), F.lit(0))
    after = F.when(first_word.isNotNull(), F.slice(rest, first_word + 1, n))
    key = F.when(F.size(before) > 0, F.array_join(before, "_")).otherwise(F.array_join(after, "_"))
    return F.when(span.isNotNull() & (key != ""), key)


def group_key(stem: Column) -> Column:
    """group_key_of one expression; over many rows compute pieces, kinds and span once instead, as operators/naming.py does."""
    parts = pieces(stem)
    return group_key_of(parts, date_span(F.transform(parts, kind)))
