"""Statistics of arrays of numbers, in array functions; nulls are left out before anything is counted."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def present(a: Column) -> Column:
    return F.filter(a, lambda x: x.isNotNull())


def total(a: Column) -> Column:
    """Sum, 0 of none."""
    return F.aggregate(present(a), F.lit(0.0), lambda s, x: s + x)


def count(a: Column) -> Column:
    return F.size(present(a))


def mean(a: Column) -> Column:
    return F.try_divide(total(a), count(a))


def _squares(a: Column) -> Column:
    m = mean(a)
    return F.aggregate(present(a), F.lit(0.0), lambda s, x: s + (x - m) * (x - m))


def sd_sample(a: Column) -> Column:
    """Sample deviation, null below two values."""
    return F.when(count(a) > 1, F.sqrt(F.try_divide(_squares(a), count(a) - 1)))


def sd_population(a: Column) -> Column:
    return F.sqrt(F.try_divide(_squares(a), count(a)))


def median(a: Column) -> Column:
    s, n = F.sort_array(present(a)), count(a)
    at = lambda i: F.get(s, i.cast("int")).cast("double")
    return (at(F.floor((n - 1) / 2)) + at(F.floor(n / 2))) / 2


def slope(a: Column, least: int = 2) -> Column:
    """Least-squares slope of the values over 1, 2, ... in the order of the array, null below ``least`` values."""
    p, n, m = present(a), count(a), mean(a)
    middle = (n + 1) / 2
    cross = F.aggregate(F.transform(p, lambda y, i: (i + 1 - middle) * (y - m)), F.lit(0.0), lambda s, x: s + x)
    return F.when(n >= least, F.try_divide(cross, n.cast("double") * (n * n - 1) / 12))
