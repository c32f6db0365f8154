"""Keyed random numbers, densities and safe parsing."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def keyed_uniform(seed: int, *keys: Column) -> Column:
    """Uniform number in [0, 1) fixed by seed and key, whatever the partitioning."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *[k.cast("string") for k in keys]))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(16**13))


def keyed_normal(seed: int, *keys: Column) -> Column:
    """Standard normal number from two keyed uniforms."""
    u = keyed_uniform(seed, *keys, F.lit("u"))
    v = keyed_uniform(seed, *keys, F.lit("v"))
    return F.sqrt(-2 * F.log(1 - u)) * F.cos(2 * F.pi() * v)


def keyed_sample(seed: int, fraction: float, *keys: Column) -> Column:
    """Condition that keeps about ``fraction`` of the keys, the same ones in every run."""
    return keyed_uniform(seed, *keys) < fraction


def normal_pdf(x: Column, mean: Column, std: Column) -> Column:
    z = (x - mean) / std
    return F.exp(-z * z / 2) / (std * F.sqrt(2 * F.pi()))


# Coefficients of Cody's rational approximations of the error function (1969), lowest power last.
_NEAR = (
    (1.85777706184603153e-1, 3.16112374387056560e0, 1.13864154151050156e2, 3.77485237685302021e2, 3.20937758913846947e3),
    (1.0, 2.36012909523441209e1, 2.44024637934444173e2, 1.28261652607737228e3, 2.84423683343917062e3),
)
_MIDDLE = (
    (2.15311535474403846e-8, 5.64188496988670089e-1, 8.88314979438837594e0, 6.61191906371416295e1, 2.98635138197400131e2,
     8.81952221241769090e2, 1.71204761263407058e3, 2.05107837782607147e3, 1.23033935479799725e3),
    (1.0, 1.57449261107098347e1, 1.17693950891312499e2, 5.37181101862009858e2, 1.62138957456669019e3,
     3.29079923573345963e3, 4.36261909014324716e3, 3.43936767414372164e3, 1.23033935480374942e3),
)
_FAR = (
    (1.63153871373020978e-2, 3.05326634961232344e-1, 3.60344899949804439e-1, 1.25781726111229246e-1, 1.60837851487422766e-2, 6.58749161529837803e-4),
    (1.0, 2.56852019228982242e0, 1.87295284992346725e0, 5.27905102951428412e-1, 6.05183413124413191e-2, 2.33520497626869185e-3),
)


def _ratio(x: Column, parts: tuple[tuple[float, ...], tuple[float, ...]]) -> Column:
    def polynomial(coefficients: tuple[float, ...]) -> Column:
        value = F.lit(coefficients[0])
        for c in coefficients[1:]:
            value = value * x + c
        return value

    return polynomial(parts[0]) / polynomial(parts[1])


def erf(z: Column) -> Column:
    """Error function as a column expression, to about 1e-15."""
    a = F.abs(z)
    square = a * a
    inverse = 1 / F.greatest(square, F.lit(1e-300))
    far = F.exp(-square) / a * (1 / math.sqrt(math.pi) - inverse * _ratio(inverse, _FAR))
    size = (
        F.when(a <= 0.46875, a * _ratio(square, _NEAR))
        .when(a <= 4.0, 1 - F.exp(-square) * _ratio(a, _MIDDLE))
        .when(a <= 6.0, 1 - far)
        .otherwise(1.0)
    )
    return F.when(z.isNull(), None).otherwise(F.signum(z) * size)


def normal_cdf(x: Column, mean: Column, std: Column) -> Column:
    """Normal distribution function."""
    return (1 + erf((x - mean) / (std * math.sqrt(2)))) / 2


def uniform_pdf(x: Column, low: Column, high: Column) -> Column:
    return F.when(x.between(low, high), 1 / (high - low)).otherwise(0.0)


def uniform_cdf(x: Column, low: Column, high: Column) -> Column:
    return F.least(F.greatest((x - low) / (high - low), F.lit(0.0)), F.lit(1.0))


def parse_json(text: Column, schema: str) -> Column:
    """Struct of the wanted fields; null fields where the text is not valid JSON."""
    return F.from_json(text, schema, {"mode": "PERMISSIVE"})


def year_month(year: Column, month: Column) -> Column:
    return F.concat_ws("-", year.cast("string"), F.lpad(month.cast("string"), 2, "0"))
