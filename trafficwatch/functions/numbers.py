"""Number expressions that follow Python's arithmetic."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_LIMB = 1 << 52


def round_half_even(x: Column, places: int) -> Column:
    """A double rounded to ``places`` (0 to 3) decimal digits like Python's ``round``: the exact binary
    value counts, and only an exact tie goes to the even digit. ``F.round`` and ``F.bround`` round
    the shortest decimal text instead (2.675 is a little less than its text).

    The fraction is taken apart into two numbers of 52 bits, exactly; smaller bits can only
    belong to values that round to zero. Where two neighbouring doubles are further apart than
    a digit at the last place asked for (for two places from 2^46 on), the value stays as it is."""
    if not 0 <= places <= 3:
        raise ValueError("places must be 0 to 3")
    scale = 10 ** places
    size = F.abs(x)
    whole = F.floor(size)
    scaled = (size - whole) * F.lit(float(_LIMB))  # exact: a power of two
    high = F.floor(scaled)
    low = F.floor((scaled - high) * F.lit(float(_LIMB)))
    # Fraction * scale = digits + rest / 2^52 + less / 2^104.
    low_scaled = low * F.lit(scale)
    total = high * F.lit(scale) + F.shiftright(low_scaled, 52)
    less = low_scaled.bitwiseAND(F.lit(_LIMB - 1))
    digits = whole * F.lit(scale) + F.shiftright(total, 52)
    rest, half = total.bitwiseAND(F.lit(_LIMB - 1)), F.lit(_LIMB // 2)
    up = (rest > half) | ((rest == half) & ((less > 0) | (F.pmod(digits, F.lit(2)) == 1)))
    rounded = (digits + up.cast("long")).cast("double") / F.lit(float(scale))
    signed = F.when(x < 0, -rounded).otherwise(rounded)
    coarse = 1 << ((1 << 53) // scale).bit_length() - 1
    return F.when((size >= F.lit(float(coarse))) | F.isnan(x), x).otherwise(signed)
