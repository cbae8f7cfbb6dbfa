"""Student's t distribution as column expressions (SQL engines offer none).

The two-sided tail is the regularised incomplete beta function
``I_x(df / 2, 1 / 2)`` at ``x = df / (df + t^2)``, taken by its continued
fraction where that converges fast and by ``1 - I_(1 - x)(1 / 2, df / 2)``
elsewhere.  The quantile is found from it by Newton steps.  All of it is plain
JVM expressions over one row; nothing is collected.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Steps of the continued fraction (it needs about the square root of ``df``), of Newton's method, and shifts of the gamma ratio.
FRACTION_STEPS, NEWTON_STEPS, SHIFTS = 1200, 12, 20
_TINY = 1e-300


def _log_gamma_ratio(z: Column) -> Column:
    """``ln(Gamma(z + 1/2) / Gamma(z))``: the asymptotic series, shifted to where it is exact."""
    w = z + F.lit(float(SHIFTS))
    series = (F.log(w) / 2 - 1 / (8 * w) + 1 / (192 * w ** 3) - 1 / (640 * w ** 5) + 17 / (14336 * w ** 7))
    back = sum((F.log((z + F.lit(float(i))) / (z + F.lit(i + 0.5))) for i in range(SHIFTS)), F.lit(0.0))
    return series + back


def _fraction(a: Column, b: Column, x: Column) -> Column:
    """The continued fraction of the incomplete beta function (modified Lentz steps, two terms each)."""
    safe = lambda v: F.when(F.abs(v) < _TINY, F.lit(_TINY)).otherwise(v)
    one = F.lit(1.0)

    def step(s: Column, m: Column) -> Column:
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        mid = F.struct((one / safe(one + even * s["d"])).alias("d"), safe(one + even / s["c"]).alias("c"), s["h"].alias("h"))
        return F.aggregate(F.array(mid), s, lambda _, u: F.aggregate(
            F.array(F.struct((one / safe(one + odd * u["d"])).alias("d"), safe(one + odd / u["c"]).alias("c"), (u["h"] * u["d"] * u["c"]).alias("h"))),
            s, lambda _, v: F.struct(v["d"].alias("d"), v["c"].alias("c"), (v["h"] * v["d"] * v["c"]).alias("h"))))

    d0 = one / safe(one - (a + b) * x / (a + 1))
    steps = F.transform(F.sequence(F.lit(1), F.lit(FRACTION_STEPS)), lambda i: i.cast("double"))
    return F.aggregate(steps, F.struct(d0.alias("d"), one.alias("c"), d0.alias("h")), step)["h"]


def two_sided_p(t: Column, df: Column) -> Column:
    """``P(|T| >= |t|)`` for ``df`` degrees of freedom; null for null."""
    t, df = t.cast("double"), df.cast("double")
    a, b = df / 2, F.lit(0.5)
    x, y = df / (df + t * t), t * t / (df + t * t)      # y = 1 - x without cancellation
    front = F.exp(a * F.log(x) + b * F.log(y) + _log_gamma_ratio(a) - math.log(math.pi) / 2)
    near = F.lit(1.0) - front * _fraction(b, a, y) / b
    far = front * _fraction(a, b, x) / a
    return F.when(t == 0, F.lit(1.0)).when(x < (a + 1) / (a + 2.5), far).otherwise(near)


def quantile(p: float, df: Column) -> Column:
    """``t`` with ``P(T <= t) = p`` for ``p`` above one half."""
    if not 0.5 < p < 1:
        raise ValueError(f"p must lie between 0.5 and 1, got {p}")
    df = df.cast("double")
    log_density = _log_gamma_ratio(df / 2) - F.log(df * math.pi) / 2
    density = lambda t: F.exp(log_density - (df + 1) / 2 * F.log1p(t * t / df))
    tail = 2 * (1 - p)
    start = F.sqrt(df * (F.pow(F.lit(tail), -2 / (df + 1)) - 1)) * 0.5 + 0.1     # below the root, where Newton's steps only rise
    steps = F.sequence(F.lit(1), F.lit(NEWTON_STEPS))
    return F.aggregate(steps, start, lambda t, _: t + (two_sided_p(t, df) - tail) / (2 * density(t)))
