"""Scalar expressions with the null rules of the features: a ratio or logarithm that is undefined is null."""

from __future__ import annotations

from decimal import Decimal, localcontext

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(a: Column, b: Column) -> Column:
    return F.try_divide(a, b)


#: ln 2 as two doubles, and 64ths between 1/sqrt(2) and sqrt(2) with their logarithms as two doubles each; the first are multiples of 2^-33, so sums of them are exact.
LEAST_64TH, MOST_64TH = 45, 91


def _split_ln(x: Decimal) -> tuple[float, float]:
    with localcontext(prec=50):
        exact = x.ln()
        high = round(exact * 2**33) / 2**33
        return high, float(exact - Decimal(high))


LN2 = _split_ln(Decimal(2))
LN_64THS = [_split_ln(Decimal(i) / 64) for i in range(LEAST_64TH, MOST_64TH + 1)]


def nearest_ln(x: Column) -> Column:
    """ln to the nearest double but for one in many: ``F.ln`` may be a last bit off, which makes or breaks ties between scores.

    x = 2^k * c * (1 + r), c in 64ths; only the last sum is rounded at the size of the result.
    """
    k = F.floor(F.log2(x) + 0.5)
    m = x * F.pow(F.lit(2.0), -k)
    i = F.floor(m * 64 + 0.5).cast("int")
    c = i / F.lit(64.0)
    high, low = (F.get(F.array(*[F.lit(v[j]) for v in LN_64THS]), i - LEAST_64TH) for j in (0, 1))
    refined = (k * LN2[0] + high) + (F.log1p((m - c) / c) + (k * LN2[1] + low))
    return F.when(x.between(1e-300, 1e300), refined).otherwise(F.ln(x))


def ln_or_null(x: Column) -> Column:
    """ln; null for 0 and below. Scores are ranked by it, so equal ones must be equal."""
    return F.when(x > 0, nearest_ln(x))


def neglog10(mantissa: Column, exponent: Column | None = None) -> Column:
    """-log10 of a p-value, or of mantissa x 10^exponent; null for 0."""
    log = F.when(mantissa > 0, F.log10(mantissa))
    return -(log if exponent is None else log + exponent)


def footprint_distance(pos: Column, start: Column, end: Column) -> Column:
    """0 inside the closed interval, else the distance to its nearer end."""
    return F.when((pos >= start) & (pos <= end), F.lit(0)).otherwise(F.least(F.abs(pos - start), F.abs(pos - end))).cast("long")


def gene_of_phenotype(phenotype: Column) -> Column:
    """The ENSG id in a phenotype id; an empty string if it holds none."""
    return F.regexp_extract(phenotype, "(ENSG[0-9]+)", 1)
