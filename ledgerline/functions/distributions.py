"""Tail probabilities and quantiles as column expressions.

The incomplete beta and gamma functions are continued fractions or series of a
fixed number of terms, evaluated inside the row. Results are good to about 1e-9 for
up to a thousand million degrees of freedom.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

TERMS = 100
HALVINGS = 60
_TINY = 1e-300


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def _solid(value: Column) -> Column:
    """A divisor that is never zero."""
    return _let(value, lambda v: F.when(F.abs(v) < _TINY, F.lit(_TINY)).otherwise(v))


def _state(**fields: Column) -> Column:
    return F.struct(*[v.cast("double").alias(n) for n, v in fields.items()])


def log_gamma(z: Column) -> Column:
    """Logarithm of the gamma function for positive ``z``: Stirling's series eight steps further up."""
    z = z.cast("double")
    y = z + 8
    below = F.lit(0.0)
    for i in range(8):
        below = below + F.log(z + i)
    series = 1 / (12 * y) - 1 / (360 * F.pow(y, 3)) + 1 / (1260 * F.pow(y, 5)) - 1 / (1680 * F.pow(y, 7))
    return (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + series - below


def _lentz(first: Column, term: Callable[[Column], tuple[Column, Column]]) -> Column:
    """The value of first + a1/(b1 + a2/(b2 + ...)) where ``term`` gives (a, b) of each place."""
    start = _solid(first)

    def further(s: Column, n: Column) -> Column:
        a, b = term(n.cast("double"))
        d = _let(b + a * s["d"], lambda v: 1 / _solid(v))
        c = b + a / _solid(s["c"])
        return _let(_state(c=c, d=d), lambda x: _state(c=x["c"], d=x["d"], h=s["h"] * x["c"] * x["d"]))

    zero = _state(c=start, d=F.lit(0.0), h=start)
    return F.aggregate(F.sequence(F.lit(1), F.lit(2 * TERMS)), zero, further)["h"]


def incomplete_beta(a: Column, b: Column, x: Column) -> Column:
    """The regularised incomplete beta function for positive ``a``, ``b`` and ``x`` from 0 to 1."""
    a, b, x = (v.cast("double") for v in (a, b, x))

    def part(p: Column, q: Column, y: Column) -> Column:
        def term(n: Column) -> tuple[Column, Column]:
            m = F.floor(n / 2).cast("double")
            even = m * (q - m) * y / ((p + 2 * m - 1) * (p + 2 * m))
            odd = -(p + m) * (p + q + m) * y / ((p + 2 * m) * (p + 2 * m + 1))
            return F.when(n % 2 == 0, even).otherwise(odd), F.lit(1.0)

        scale = log_gamma(p + q) - log_gamma(p) - log_gamma(q) + p * F.log(y) + q * F.log1p(-y)
        return F.exp(scale) / (p * _lentz(F.lit(1.0), term))

    near = x < (a + 1) / (a + b + 2)
    return (
        F.when(x <= 0, F.lit(0.0)).when(x >= 1, F.lit(1.0)).when(near, part(a, b, x)).otherwise(1 - part(b, a, 1 - x))
    )


def upper_gamma(a: Column, x: Column) -> Column:
    """The regularised upper incomplete gamma function for positive ``a``."""
    a, x = a.cast("double"), x.cast("double")
    scale = F.exp(a * F.log(x) - x - log_gamma(a))

    def further(s: Column, n: Column) -> Column:
        return _let(s["t"] * x / (a + n), lambda t: _state(t=t, h=s["h"] + t))

    first = 1 / a
    series = F.aggregate(F.sequence(F.lit(1), F.lit(2 * TERMS)), _state(t=first, h=first), further)["h"]
    fraction = _lentz(x + 1 - a, lambda n: (n * (a - n), x + 2 * n + 1 - a))
    return F.when(x <= 0, F.lit(1.0)).when(x < a + 1, 1 - scale * series).otherwise(scale / fraction)


def student_p(t: Column, degrees: Column) -> Column:
    """Two-sided p-value of Student's t; null without degrees of freedom."""
    square = (t * t).cast("double")
    known = t.isNotNull() & (degrees > 0)
    return F.when(known, incomplete_beta(degrees / 2, F.lit(0.5), degrees / (degrees + square)))


def normal_p(z: Column) -> Column:
    """Two-sided p-value of a standard normal value."""
    return F.when(z.isNotNull(), upper_gamma(F.lit(0.5), z * z / 2))


def chi_square_p(value: Column, degrees: Column) -> Column:
    """Upper tail of the chi-square distribution; null without degrees of freedom."""
    return F.when(value.isNotNull() & (degrees > 0), upper_gamma(degrees / 2, value / 2))


def student_quantile(level: float, degrees: Column) -> Column:
    """The t that leaves 1 - ``level`` in both tails together, by halving; up to 10,000."""

    def halved(s: Column, _: Column) -> Column:
        return _let(
            (s["lo"] + s["hi"]) / 2,
            lambda mid: F.when(student_p(mid, degrees) > 1 - level, _state(lo=mid, hi=s["hi"])).otherwise(_state(lo=s["lo"], hi=mid)),
        )

    found = F.aggregate(F.sequence(F.lit(1), F.lit(HALVINGS)), _state(lo=F.lit(0.0), hi=F.lit(10_000.0)), halved)
    return F.when(degrees > 0, found["lo"])
