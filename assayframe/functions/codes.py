"""Whole numbers that order as doubles do.

``double_code`` is a long per double with the order that Spark sorts doubles in: NaN
above all, -0.0 equal to 0.0. It is built from exact arithmetic on powers of two, so it
stays inside generated code; ``code_double`` is its inverse. ``packed`` puts a count and
a value into one decimal, whose greatest is the greatest count and then the least value:
a fixed-width aggregate buffer, where a struct would need a sort.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from assayframe.functions._util import as_col

_FRACTION, _BIAS, _TOP = 52, 1023, 2047     # fixed values of the IEEE 754 double format
_LEAST = -1074                              # exponent of the least double above zero


def _two_to(e) -> Column:
    return F.pow(F.lit(2.0), e)


def double_code(v) -> Column:
    v = as_col(v)
    a = F.abs(v)
    guess = F.greatest(F.least(F.floor(F.log2(a)), F.lit(_BIAS)), F.lit(_LEAST)).cast("int")
    # The logarithm may be off by one next to a power of two.
    e = F.when(_two_to(guess) > a, guess - 1).when(_two_to(guess + 1) <= a, guess + 1).otherwise(guess)
    ones = 1 << _FRACTION
    normal = (e + _BIAS).cast("long") * ones + ((a / _two_to(e) - 1.0) * float(ones)).cast("long")
    small = (a * (2.0 ** 537) * (2.0 ** 537)).cast("long")
    bits = (F.when(F.isnan(v), F.lit(_TOP * ones + ones // 2)).when(a == 0.0, F.lit(0).cast("long"))
             .when(a == float("inf"), F.lit(_TOP * ones)).when(a < 2.0 ** (1 - _BIAS), small).otherwise(normal))
    return F.when(v.isNull(), F.lit(None).cast("long")).when(v < 0, -bits).otherwise(bits)


def code_double(code) -> Column:
    code = as_col(code)
    bits, ones = F.abs(code), 1 << _FRACTION
    e = F.shiftright(bits, _FRACTION).cast("int")
    fraction = bits.bitwiseAND(F.lit(ones - 1)).cast("double")
    a = (F.when(e == 0, fraction * (2.0 ** _LEAST))
          .when(e == _TOP, F.when(fraction == 0.0, F.lit(float("inf"))).otherwise(F.lit(float("nan"))))
          .otherwise((fraction / float(ones) + 1.0) * _two_to(e - _BIAS)))
    return F.when(code < 0, -a).otherwise(a)


_SPAN, _HALF = str(1 << 64), str(1 << 63)   # as text: beyond a long


def packed(count, value) -> Column:
    """decimal(38,0), greatest for the greatest count and then the least value. Counts up
    to 10 ** 18."""
    rank = F.lit(0).cast("decimal(20,0)") - double_code(value).cast("decimal(20,0)")
    return (as_col(count).cast("decimal(18,0)") * _span() + rank).cast("decimal(38,0)")


def _span() -> Column:
    return F.lit(_SPAN).cast("decimal(20,0)")


def packed_value(pack) -> Column:
    """The value of a packed pair: the remainder, taken to the nearest multiple."""
    pack = as_col(pack).cast("decimal(38,0)")
    half = F.lit(_HALF).cast("decimal(20,0)")
    rank = F.pmod(pack + half, _span()) - half
    return code_double((F.lit(0).cast("decimal(20,0)") - rank).cast("long"))
