"""Special functions as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def log_gamma(z: Column) -> Column:
    """ln Γ(z) for z > 0: Stirling's series at z + 8, less the logarithms in between."""
    s = z + 8
    series = ((s - 0.5) * F.log(s) - s + 0.5 * math.log(2 * math.pi)
              + 1 / (12 * s) - 1 / (360 * s * s * s) + 1 / (1260 * F.pow(s, 5)))
    for i in range(8):
        series = series - F.log(z + i)
    return series


def chi2_upper_tail(x: Column, dof: Column) -> Column:
    """P(χ² with ``dof`` degrees of freedom > x): one minus the regularised
    incomplete gamma function, summed as the series of positive terms
    ``e^-y y^(a+n) / Γ(a+n+1)`` until far beyond the largest one."""
    a, y = dof.cast("double") / 2, F.greatest(x.cast("double"), F.lit(0.0)) / 2
    terms = F.ceil(F.greatest(y - a, F.lit(0.0)) + 20 * F.sqrt(y) + 200).cast("int")

    def add(acc: Column, n: Column) -> Column:
        term = acc["term"] + F.log(y) - F.log(a + n)
        return F.struct(term.alias("term"), (acc["sum"] + F.exp(term)).alias("sum"))
    first = -y + a * F.log(y) - log_gamma(a + 1)
    lower = F.aggregate(F.sequence(F.lit(1), terms), F.struct(first.alias("term"), F.exp(first).alias("sum")),
                        add, lambda acc: acc["sum"])
    return F.when(y <= 0, 1.0).otherwise(F.greatest(1 - lower, F.lit(0.0)))
