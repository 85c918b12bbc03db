"""Sums that do not depend on the order in which partitions are merged.

Adding doubles gives a different last digit for each task layout, so values are summed
as decimals with a stated number of digits after the point. Nothing is rounded or cut
to size: a value that those digits cannot say (0.004 with two digits, infinity, a
number beyond 10^22) ends the query with an error that names ``digits``. Only the noise
of double arithmetic, up to ``NOISE`` of the value, is taken off: 0.1 * 3 is 0.3. NaN
counts as missing.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Digits after the point unless the caller says otherwise.
DIGITS = 6
NOISE = 1e-12


def exact(col: Column, digits: int = DIGITS) -> Column:
    """``col`` as decimal(28, digits); an error where that is another number."""
    number = F.nanvl(col.cast("double"), F.lit(None).cast("double"))
    told = number.try_cast(f"decimal(28,{digits})")
    refused = F.raise_error(
        F.concat(number.cast("string"), F.lit(f" needs another number of digits than {digits}"))
    ).cast(f"decimal(28,{digits})")
    return F.when(number.isNull(), F.lit(None)).when(F.abs(told.cast("double") - number) <= F.abs(number) * NOISE, told).otherwise(refused)


def exact_sum(col: Column) -> Column:
    """Sum of exact values; one key may hold more than a bigint can."""
    return F.sum(col)


def scaled(col: Column, digits: int = DIGITS) -> Column:
    """``col`` times 10^digits as a bigint; an error where it does not fit."""
    whole = (exact(col, digits) * F.lit(10**digits).cast("decimal(10,0)")).try_cast("bigint")
    number = F.nanvl(col.cast("double"), F.lit(None).cast("double"))
    refused = F.raise_error(
        F.concat(number.cast("string"), F.lit(f" is too large for {digits} digits"))
    ).cast("bigint")
    return F.when(number.isNull(), F.lit(None)).when(whole.isNotNull(), whole).otherwise(refused)


def fixed_point(col: Column, digits: int = 9) -> Column:
    """Double as a scaled bigint; hides last-digit differences of ln and exp."""
    return F.floor(col * F.lit(float(10**digits)) + F.lit(0.5))
