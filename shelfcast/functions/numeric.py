"""Numeric expressions: rounding, hashed uniforms, losses and likelihoods."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

# The smoothing constant of the losses, the Tweedie power and the blend weight.
LOSS_EPSILON = 1e-7
TWEEDIE_POWER = 1.5
LOSS_BLEND = 0.5


def clip_zero(x: Column) -> Column:
    return F.greatest(x, F.lit(0.0))


def round_count(x: Column) -> Column:
    """Half-even rounding to a non-negative integer; Spark's ``round`` is half-up."""
    return clip_zero(F.rint(x)).cast("int")


def ratio(a: Column, b: Column) -> Column:
    """Division that gives NULL for a zero denominator instead of raising."""
    return F.try_divide(a, b)


def hashed_uniform(*parts: Column | str, seed: int | Column = 0) -> Column:
    """A reproducible uniform in [0, 1) per row.

    It depends only on the values of the row, so a re-run task, another
    partitioning or another engine draws the same number.
    """
    text = F.concat_ws("|", *[F.col(p) if isinstance(p, str) else p for p in parts],
                       seed if isinstance(seed, Column) else F.lit(seed))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(2.0**32)


def hashed_poisson(u: Column, terms: int = 12) -> Column:
    """Poisson(1) by inverting its distribution function at ``u``.

    The tail beyond ``terms`` is below the resolution of a 32-bit uniform.
    """
    total, weight, count = 0.0, math.exp(-1.0), F.lit(0)
    for k in range(terms):
        total += weight
        count = count + (u >= F.lit(total)).cast("int")
        weight /= k + 1
    return count


# A prime modulus with four full-period multipliers; two factors below it have a product that a long holds.
MODULUS = 2**31 - 1
MULTIPLIERS = (742938285, 950706376, 1226874159, 62089911)


def mixed_draw(a: Column, b: Column, seed: int = 0) -> Column:
    """A reproducible integer in [0, MODULUS) for two whole numbers from 0 on, for draws by the million.

    Products modulo a prime alternate with exclusive ors.  Four of each take a
    tenth of the time of a digest, and every step uses the one before once, so
    the expression stays small.
    """
    m = F.lit(MODULUS).cast("long")
    a, b = a.cast("long"), b.cast("long")
    first, second, third, fourth = (F.lit(k).cast("long") for k in MULTIPLIERS)
    x = (a + (seed + 1)) * first % m
    x = x.bitwiseXOR(b * fourth % m) * second % m
    x = x.bitwiseXOR(a * third % m) * third % m
    return x.bitwiseXOR(b) * fourth % m


def drawn_poisson(draw: Column, terms: int = 12) -> Column:
    """Poisson(1) by inverting its distribution function at ``draw / MODULUS``; small values, which are most, end the search."""
    total, weight, count = 0.0, math.exp(-1.0), None
    for k in range(terms):
        total += weight
        below = draw < F.lit(math.ceil(total * MODULUS)).cast("long")
        count = F.when(below, k) if count is None else count.when(below, k)
        weight /= k + 1
    return count.otherwise(terms)


def poisson_loss(actual: Column, predicted: Column, epsilon: float = LOSS_EPSILON) -> Column:
    p = clip_zero(predicted)
    return p - actual * F.ln(p + F.lit(epsilon))


def tweedie_loss(
    actual: Column, predicted: Column, power: float = TWEEDIE_POWER, epsilon: float = LOSS_EPSILON
) -> Column:
    p = clip_zero(predicted) + F.lit(epsilon)
    a, b = 1.0 - power, 2.0 - power
    return F.pow(actual, F.lit(b)) / (a * b) - actual * F.pow(p, F.lit(a)) / a + F.pow(p, F.lit(b)) / b


def blended_loss(actual: Column, predicted: Column, alpha: float = LOSS_BLEND) -> Column:
    return (1 - alpha) * poisson_loss(actual, predicted) + alpha * tweedie_loss(actual, predicted)


@F.pandas_udf(T.DoubleType())
def lgamma(x: pd.Series) -> pd.Series:
    return x.map(math.lgamma, na_action="ignore")


def log_factorial(count: Column, table_size: int = 171) -> Column:
    """``ln(n!)`` of a whole number: JVM factorials for small counts, Stirling's series above."""
    n = count.cast("double")
    exact = F.element_at(
        F.array(*[F.lit(math.lgamma(k + 1)) for k in range(table_size)]),
        F.least(count.cast("int"), F.lit(table_size - 1)) + 1,
    )
    stirling = (
        (n + 0.5) * F.ln(n + 1) - (n + 1) + F.lit(0.5 * math.log(2 * math.pi))
        + 1 / (12 * (n + 1)) - 1 / (360 * F.pow(n + 1, F.lit(3.0)))
    )
    return F.when(n < table_size, exact).otherwise(stirling)


def poisson_nll(actual: Column, rate: Column) -> Column:
    return rate - actual * F.ln(rate) + log_factorial(actual)


def gaussian_nll(actual: Column, mean: Column, scale: Column) -> Column:
    z = (actual - mean) / scale
    return 0.5 * z * z + F.ln(scale) + F.lit(0.5 * math.log(2 * math.pi))


def gamma_nll(actual: Column, shape: Column, rate: Column) -> Column:
    return lgamma(shape) - shape * F.ln(rate) - (shape - 1) * F.ln(actual) + rate * actual


def negative_density(nll: Column) -> Column:
    """The variant for positive distributions that returns minus the density, not its logarithm."""
    return -F.exp(-nll)
