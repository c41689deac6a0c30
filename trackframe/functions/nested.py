"""Arrays, maps and structs: nested lookups, ragged slices, per-frame heads, overrides."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def nested(value: Column, *keys: str, default=None) -> Column:
    """The entry behind a path of map keys; the default where any of them is missing."""
    found = reduce(lambda v, k: F.try_element_at(v, F.lit(k)), keys, value)
    return found if default is None else F.coalesce(found, F.lit(default))


def ragged_slices(values: Column, counts: Column) -> Column:
    """`values` cut into consecutive parts of the lengths `counts`; parts beyond the end are short or empty."""
    start = lambda i: F.aggregate(F.slice(counts, F.lit(1), i), F.lit(0).cast("long"), lambda s, n: s + n)
    return F.transform(counts, lambda n, i: F.slice(values, (start(i) + 1).cast("int"), n.cast("int")))


def heads_by_frame(**heads: Column) -> Column:
    """Arrays with one entry a frame as an array of structs, one a frame; short ones are padded with nulls."""
    return F.arrays_zip(*(c.alias(n) for n, c in heads.items()))


def overridden(base: Column, *others: Column) -> Column:
    """Maps merged, later ones over earlier ones; null maps count as empty."""
    def merge(a: Column, b: Column) -> Column:
        b = F.coalesce(b, F.map_filter(a, lambda k, v: F.lit(False)))
        return F.map_concat(F.map_filter(a, lambda k, v: ~F.map_contains_key(b, k)), b)

    return reduce(merge, others, base)


def stacked_planes(planes: Column) -> Column:
    """Colour planes side by side, as one row."""
    return F.flatten(planes)


def plane_mean(planes: Column) -> Column:
    """The mean over the colour planes, place by place; planes have one length."""
    n = F.size(planes)
    total = F.aggregate(F.slice(planes, F.lit(2), F.greatest(n - 1, F.lit(0))), F.get(planes, F.lit(0)), lambda s, p: F.zip_with(s, p, lambda a, b: a + b))
    return F.transform(total, lambda v: v / n)
