"""Rounding and pair counting that do not depend on binary noise or summation order."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

BIG = "decimal(38,0)"


def round_half_up(col: Column, digits: int = 4) -> Column:
    """Round a bounded double half up on its decimal value.

    The value first becomes a decimal with nine places (it still fits a long),
    so ``0.06585`` computed as ``0.0658499999999999`` rounds up as written.
    """
    return F.round(col.cast("decimal(18,9)"), digits).cast("double")


def to_units(col: Column, digits: int = 4) -> Column:
    """A score in integer units of ``10**-digits``, rounded half up."""
    return F.round(col.cast("decimal(18,9)") * F.lit(10**digits), 0).cast("bigint")


def from_units(col: Column, digits: int = 4) -> Column:
    return col.cast("double") / F.lit(float(10**digits))


def mean_of_units(total: Column, count: Column, digits: int = 4) -> Column:
    """Mean of scores counted in units of ``10**-digits``, rounded half up; 0 if none.

    Integer arithmetic only, hence equal for every order of summation.
    """
    total, count = total.cast(BIG), count.cast(BIG)
    rounded = F.floor((total * 2 + count) / (count * 2))
    return F.when(count > 0, from_units(rounded, digits)).otherwise(F.lit(0.0))


def ratio(num: Column, den: Column, digits: int = 4) -> Column:
    """``num / den`` rounded, 0.0 for an empty denominator."""
    value = round_half_up(num.cast("double") / den.cast("double"), digits)
    return F.when(den > 0, value).otherwise(F.lit(0.0))


def pair_count(n: Column) -> Column:
    """Unordered pairs among ``n`` rows; wide, since a hot group squares past a long."""
    big = n.cast("decimal(19,0)")
    return (big * (big - 1) / 2).cast(BIG)


def pair_product(a: Column, b: Column) -> Column:
    return (a.cast("decimal(19,0)") * b.cast("decimal(19,0)")).cast(BIG)
