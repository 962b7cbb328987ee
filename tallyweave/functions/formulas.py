"""Scalar formulas written as SQL text.

Spark has no normal, Student or F distribution functions, so the tails are built from its scalars.  Normal tails take and
return SQL text, to be wrapped with ``F.expr``; the others take and return columns.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

# Chebyshev fit of ln(erfc) in t = 1 / (1 + x / 2), fractional error below 1.2e-7 for every x, constant term first.
ERFC = (
    "-1.26551223e0", "1.00002368e0", "0.37409196e0", "0.09678418e0", "-0.18628806e0",
    "0.27886807e0", "-1.13520398e0", "1.48851587e0", "-0.82215223e0", "0.17087277e0",
)


def two_sided_normal(z: str) -> str:
    """P(|Z| >= |z|), to seven digits however far out in the tail."""
    t = f"(1e0 / (1e0 + abs({z}) / sqrt(8e0)))"
    series = ERFC[-1]
    for term in reversed(ERFC[:-1]):
        series = f"({term} + {t} * {series})"
    return f"({t} * exp(-({z}) * ({z}) / 2e0 + {series}))"


def upper_normal(z: str) -> str:
    """P(Z >= z)."""
    half = f"(0.5e0 * {two_sided_normal(z)})"
    return f"(CASE WHEN {z} >= 0 THEN {half} ELSE 1e0 - {half} END)"


def ln_gamma(x: Column) -> Column:
    """ln of the gamma function of positive numbers: Stirling's series eight places further up, and back by the recurrence."""
    y = x + 8
    series = 1 / (12 * y) - 1 / (360 * y * y * y) + 1 / (1260 * y * y * y * y * y) - 1 / (1680 * F.pow(y, F.lit(7.0)))
    down = F.log(x)
    for i in range(1, 8):
        down = down + F.log(x + i)
    return (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + series - down


def incomplete_beta(x: Column, a: Column, b: Column) -> Column:
    """The regularised incomplete beta function, by its continued fraction evaluated from the far end.

    The fraction converges for x below (a + 1) / (a + b + 2), in steps that grow with the square root of the lesser parameter; above, the
    function is taken from the other side.  1 from x = 1 on, 0 up to x = 0."""

    def side(x: Column, rest: Column, a: Column, b: Column) -> Column:
        def term(i: Column) -> Column:
            m = F.floor(i / 2)
            odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
            return F.when(i % 2 == 1, odd).otherwise(m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)))

        steps = (80 + 3 * F.ceil(F.sqrt(F.least(a, b)))).cast("int")
        value = F.aggregate(F.sequence(steps, F.lit(1), F.lit(-1)), F.lit(1.0), lambda v, i: 1 + term(i) / v)
        return F.exp(a * F.log(x) + b * F.log(rest) - F.log(a) - ln_gamma(a) - ln_gamma(b) + ln_gamma(a + b)) / value

    low = x < (a + 1) / (a + b + 2)
    inside = F.when(low, side(x, 1 - x, a, b)).otherwise(1 - side(1 - x, x, b, a))
    return F.when(x >= 1, F.lit(1.0)).when(x <= 0, F.lit(0.0)).otherwise(inside)


def two_sided_student(t: Column, v: Column) -> Column:
    """P(|T| >= |t|) with ``v`` degrees of freedom."""
    return incomplete_beta(v / (v + t * t), v / 2, F.lit(0.5))


def upper_f(f: Column, d1: Column, d2: Column) -> Column:
    """P(F >= f)."""
    return incomplete_beta(d2 / (d2 + d1 * F.greatest(f, F.lit(0.0))), d2 / 2, d1 / 2)


def hash_int(text: Column) -> Column:
    """First 8 hexadecimal digits of the md5 of a string, as an integer."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def hash_order(key: Column, seed: int) -> Column:
    """A reproducible random order: the md5 of ``key|seed``."""
    return F.md5(F.concat(key.cast("string"), F.lit(f"|{seed}")))


def ratio(a: Column, b: Column, otherwise: float | None = None) -> Column:
    """``a / b``; ``otherwise`` where ``b`` is zero."""
    return F.when(b != 0, a / b).otherwise(F.lit(otherwise).cast("double"))


def bind(value: str, name: str, body: str) -> str:
    """Evaluate ``value`` once and use it as ``name`` in ``body``, which would repeat it many times."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"
