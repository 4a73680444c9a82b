"""Numeric expressions: exact decimal rounding, guarded shares, buckets.

Arithmetic stays in DECIMAL so ``round`` is half-away-from-zero on exact values
(never double arithmetic before rounding, never banker's rounding). Divisions
are guarded because ANSI mode raises on x/0.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def rounded(x: Column | str, digits: int) -> Column:
    """Half-away-from-zero rounding of a decimal value."""
    return F.round(_c(x), digits)


def coalesced_sum(cols: Iterable[Column | str]) -> Column:
    """Sum of columns where a missing (NULL) term counts as 0."""
    out = None
    for c in cols:
        term = F.coalesce(_c(c), F.lit(0))
        out = term if out is None else out + term
    return out


#: Decimals of the values whose share is taken (and of the largest integer part, 38 digits in all).
_SCALED = "decimal(38,0)"
_SCALE = 1_000_000


def _percent(part: Column, total: Column, digits: int) -> Column:
    """100 * part / total rounded half away from zero, decided on integers.

    A decimal quotient would be cut to a few digits first and then rounded again
    (12.34999996 -> 12.350000 -> 12.4). Here numerator and denominator are whole
    millionths, and the digit comes from one integer division:
    floor((2 * 100 * 10^digits * |part| + |total|) / (2 * |total|)).
    """
    whole = [(F.abs(x).cast("decimal(28,6)") * F.lit(_SCALE)).cast(_SCALED) for x in (part, total)]
    top = whole[0] * F.lit(2 * 100 * 10**digits).cast("decimal(7,0)") + whole[1]
    below = whole[1] * F.lit(2).cast("decimal(1,0)")
    steps = (top - top % below) / below  # a whole number, so this quotient is exact
    sign = F.when((part < 0) != (total < 0), F.lit(-1)).otherwise(F.lit(1))
    return ((steps.cast("decimal(30,0)") * sign) / F.lit(10**digits).cast("decimal(4,0)")).cast(f"decimal(30,{digits})")


def share_if_positive(part: Column | str, total: Column | str, digits: int = 1) -> Column:
    """100·part/total rounded, only when total > 0 (else NULL) — the hourly guard."""
    part, total = _c(part), _c(total)
    return F.when(total > 0, _percent(part, total, digits))


def share_nonzero(part: Column | str, total: Column | str, digits: int = 1) -> Column:
    """100·part/nullif(total, 0) rounded — the daily/monthly guard (negatives pass)."""
    part, total = _c(part), _c(total)
    return F.when(total != 0, _percent(part, total, digits))


def bucket(x: Column | str, bounds: Iterable[tuple[float, str]], top: str) -> Column:
    """Searched CASE over exclusive upper bounds; values at/above the last bound get ``top``."""
    x = _c(x)
    expr = None
    for upper, label in bounds:
        expr = F.when(x < upper, F.lit(label)) if expr is None else expr.when(x < upper, F.lit(label))
    return expr.otherwise(F.lit(top))
