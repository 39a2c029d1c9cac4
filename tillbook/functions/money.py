"""Exact money arithmetic as SQL expression text.

Money arrives as DOUBLE.  Summing doubles makes the result depend on row order
(different partitioning gives different last digits) and lets half-cent ties
round either way.  Each value is therefore taken as whole micro-units (1e-6,
HALF_UP) plus what that leaves over, in units of 1e-15, and all parts are summed as
integers; only the per-group results become decimals, for HALF_UP rounding, and are
handed back as DOUBLE.

A value of up to six decimals leaves nothing over: it is the double nearest to its
micro-units, and counts as that decimal.  Of any other value the rest is what the double
holds beyond them, so a thousand rows of 0.0000004 sum to 0.0004.  Below 1e-15 it is
rounded, far under the last place of a double of 10 and more.

Micro-units below 2^53 are split at 2^26 into a high and a low part, each summed
as a LONG like the rest: as fast as a double sum inside whole-stage codegen, unlike a
per-row decimal.  Whatever the ANSI setting, the first two cannot wrap or raise below
6e10 rows in one group and the rest below 1.8e10, even if all have the largest magnitude.
Values that have no exact micro-units (NaN, the infinities, magnitudes from 9e9 on) are
summed as doubles beside them, so that NaN makes its own group NaN and no other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MICRO = 10 ** 6                # micro-units of one
FINE = 10 ** 9                 # units of a sum in one micro-unit
SCALE = MICRO * FINE           # units of a sum in one
SPLIT = 2 ** 26
WILD = "9e9D"


def _tame(e: str, then: str) -> str:
    # NaN compares greater than every number
    return f"CASE WHEN abs({e}) < {WILD} THEN {then} END"


def _micros(e: str) -> str:
    """``x * 1e6 ± 0.5``: truncated toward zero it is HALF_UP away from zero."""
    return f"(({e}) * {MICRO}D + signum({e}) * 0.5D)"


def _high(e: str) -> str:
    return f"CAST({_micros(e)} / {SPLIT}D AS BIGINT)"


def _low(e: str) -> str:
    # the difference is exact: both are multiples of the value's last bit
    return f"CAST({_micros(e)} - {_high(e)} * {SPLIT}D AS BIGINT)"


def _rest(e: str) -> str:
    # zero for a value that is the double nearest to its micro-units
    return f"CAST(rint((({e}) - CAST({_micros(e)} AS BIGINT) / {MICRO}D) * {SCALE}D) AS BIGINT)"


def _sums(e: str, fine: bool = True) -> tuple[str, str, str]:
    """The LONG sums of the high, low and rest parts of the tame values."""
    high, low, rest = (f"SUM({_tame(e, part(e))})" for part in (_high, _low, _rest))
    return high, low, rest if fine else "0L"


def unit_sum_sql(e: str, fine: bool = True) -> str:
    """Exact sum of the tame values in units of 1e-15, DECIMAL(38,0); NULL if there is none."""
    high, low, rest = _sums(e, fine)
    return f"CAST((CAST({high} AS DECIMAL(20,0)) * {SPLIT} + {low}) * {FINE} + {rest} AS DECIMAL(38,0))"


def wild_sum_sql(e: str) -> str:
    """Double sum of the values without micro-units; NULL if there is none."""
    return f"SUM(CASE WHEN abs({e}) >= {WILD} THEN CAST({e} AS DOUBLE) END)"


def _rounded_units(unit_sum: str, digits: int) -> str:
    """``round(sum, digits)`` HALF_UP as DOUBLE, by whole steps of ``10^-digits``."""
    step = SCALE // 10 ** digits
    # up to the half step away from zero, then cut: what is divided is a whole number of steps
    up = f"(abs({unit_sum}) + {step // 2})"
    steps = f"CAST(CAST({up} - {up} % {step} AS DECIMAL(38,0)) / {step} AS DECIMAL(30,0))"
    signed = f"(CASE WHEN {unit_sum} < 0 THEN -{steps} ELSE {steps} END)"
    return f"CAST({signed} * CAST({10.0 ** -digits:.{digits}f} AS DECIMAL({digits + 1},{digits})) AS DOUBLE)"


def _beside(wild: str, exact: str) -> str:
    return f"CASE WHEN {wild} IS NULL THEN {exact} ELSE {wild} + COALESCE({exact}, 0D) END"


def to_double_sql(unit_sum: str, wild: str, digits: int) -> str:
    """``round(sum, digits)`` of a :func:`unit_sum_sql` and the double sum beside it."""
    return _beside(wild, _rounded_units(unit_sum, digits))


def rounded_sum_sql(e: str, digits: int, fine: bool = True) -> str:
    """``round(sum(e), digits)`` summed exactly, as DOUBLE.

    Sums below 2^52 micro-units with nothing left over, which nearly all are, are rounded
    in LONGs; decimals cost several times that for each group.  Not ``fine``: the values
    have at most six decimals, so there is no rest to sum.
    """
    high, low, rest = _sums(e, fine)
    whole = f"({high} * {SPLIT}L + {low})"
    step = MICRO // 10 ** digits
    # div cuts toward zero, so half a step away from it is HALF_UP
    steps = f"({whole} + IF({whole} < 0, -{step // 2}L, {step // 2}L)) div {step}L"
    quick = f"CAST({steps} AS DOUBLE) / {float(10 ** digits)}D"
    small = f"{rest} = 0 AND abs({high}) < {2 ** 25}L AND abs({low}) < {2 ** 51}L"
    exact = f"(CASE WHEN {small} THEN {quick} ELSE {_rounded_units(unit_sum_sql(e, fine), digits)} END)"
    return _beside(wild_sum_sql(e), exact)


def rounded_sum(column: str, digits: int, fine: bool = True) -> Column:
    return F.expr(rounded_sum_sql(f"`{column}`", digits, fine))


# --- exact ratio ---------------------------------------------------------------------
def with_ratio(df: DataFrame, num: str, wild: str, den: str, out: str, digits: int,
               keep: list[str] | None = None) -> DataFrame:
    """Add ``out = round(num / den, digits)`` HALF_UP (away from zero), exactly.

    ``num`` is a :func:`unit_sum_sql`, ``wild`` the double sum beside it, ``den`` an
    integral column; NULL when ``den`` is 0 or NULL, as ``try_divide``.  Spark's
    decimal division keeps only six decimals once operands are wide, and
    rounding that again to ``digits`` could move a value lying just below a
    half-cent tie; so the quotient is ``floor((2a + b) / 2b)`` in integers, with
    the approximate division corrected by its exact remainder.  Runs once per
    group, in its own projections after the aggregation.  ``keep``: columns to
    carry along (default all).
    """
    keep = [f"`{c}`" for c in (keep if keep is not None else df.columns)]
    a = f"abs(CAST(`{num}` AS DECIMAL(38,0))) * {10 ** digits}"
    b = f"abs(CAST(`{den}` AS DECIMAL(38,0))) * {SCALE}"
    t = df.selectExpr(
        *keep, f"`{num}` AS __num", f"`{wild}` AS __wild", f"`{den}` AS __den",
        f"CAST(({a}) * 2 + ({b}) AS DECIMAL(38,0)) AS __n2",
        f"CASE WHEN ({b}) <> 0 THEN CAST(({b}) * 2 AS DECIMAL(38,0)) END AS __d2")
    t = t.selectExpr(*keep, "__num", "__wild", "__den", "__n2", "__d2",
                     "CAST(floor(__n2 / __d2) AS DECIMAL(38,0)) AS __q0")
    # the rounded division can only overshoot by one
    q = "(CASE WHEN __n2 - __q0 * __d2 < 0 THEN __q0 - 1 ELSE __q0 END)"
    exact = (f"CAST(CASE WHEN (__num < 0) <> (__den < 0) THEN -{q} ELSE {q} END AS DOUBLE)"
             f" / {float(10 ** digits)}")
    return t.selectExpr(
        *keep, f"CASE WHEN __wild IS NULL THEN {exact} ELSE try_divide("
        f"__wild + COALESCE(CAST(__num AS DOUBLE), 0D) / {float(SCALE)}, __den) END AS `{out}`")
