"""Numeric scalar expressions: rounding, clipping, shift-and-clip."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import SCORE_MAX, SCORE_MIN


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def round_half_even(col, places: int = 2) -> Column:
    """numpy-style ``.round(places)``: scale, round half to even, unscale.

    ``F.round`` rounds half up and ``F.bround`` rounds the exact decimal
    expansion, both of which differ from the binary scale-then-round rule.
    ``+ 0.0`` folds a negative zero into zero.
    """
    scale = float(10 ** places)
    return F.rint(_c(col) * F.lit(scale)) / F.lit(scale) + F.lit(0.0)


def round_python(col, places: int = 2) -> Column:
    """Python's ``round(x, places)``: the exact binary value decides, ties go to even.

    ``x * 10^places`` is split into its rounded product and the rounding error
    (both exact, by splitting x into two halves of its digits), so that 2.675,
    which lies below the tie, gives 2.67 where scale-and-round gives 2.68. Values
    from 2^52 / 10^places on have no such digits and stay as they are.
    """
    x, scale = _c(col), F.lit(float(10 ** places))
    wide = x * F.lit(134217729.0)   # 2^27 + 1
    high = wide - (wide - x)
    low = x - high
    product = x * scale
    error = (high * scale - product) + low * scale
    whole = F.floor(product).cast("double")
    part = product - whole
    up = (part > 0.5) | ((part == 0.5) & ((error > 0) | ((error == 0) & (whole % 2 != 0))))
    rounded = F.when(up, whole + 1.0).otherwise(whole) / scale + F.lit(0.0)
    return F.when(F.abs(product) < F.lit(2.0 ** 52), rounded).otherwise(x)


def clip(col, lo: float | None = None, hi: float | None = None) -> Column:
    """Bound a value; nulls stay null (``greatest``/``least`` would skip them)."""
    c = _c(col)
    out = c
    if hi is not None:
        out = F.least(out, F.lit(float(hi)))
    if lo is not None:
        out = F.greatest(out, F.lit(float(lo)))
    return F.when(c.isNotNull(), out)


def clip_score(col) -> Column:
    return clip(col, SCORE_MIN, SCORE_MAX)


def shift_clip(col, delta: float, lo: float | None = None, hi: float | None = None) -> Column:
    """What-if transform: add ``delta`` then clip to [lo, hi]."""
    return clip(_c(col) + F.lit(float(delta)), lo, hi)
