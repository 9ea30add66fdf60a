"""Two-sided tail probabilities for one-row-per-test frames."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, functions as F


def _student_t():
    # Everything the tasks need is nested here and travels with the function.
    import math

    import numpy as np

    def log_gamma(x):
        return np.array([math.lgamma(v) for v in x])

    def fraction(a, b, x):
        """Continued fraction of the incomplete beta integral (modified Lentz)."""
        tiny = 1e-300
        c = np.ones_like(x)
        d = 1.0 - (a + b) * x / (a + 1.0)
        d = 1.0 / np.where(np.abs(d) < tiny, tiny, d)
        value = d.copy()
        for m in range(1, 20_000):  # some ten times the root of the larger parameter are enough
            even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
            odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
            change = np.ones_like(x)
            for term in (even, odd):
                d = 1.0 + term * d
                d = 1.0 / np.where(np.abs(d) < tiny, tiny, d)
                c = 1.0 + term / c
                c = np.where(np.abs(c) < tiny, tiny, c)
                value = value * d * c
                change = d * c
            if np.all(np.abs(change - 1.0) < 1e-15):
                return value
        raise ArithmeticError("the tail does not converge")

    def beta_tail(a, b, x, rest):
        """I_x(a, b) with ``rest`` = 1 - x given apart to keep its digits."""
        front = np.exp(log_gamma(a + b) - log_gamma(a) - log_gamma(b)
                       + a * np.log(x) + b * np.log(rest))
        direct = x < (a + 1.0) / (a + b + 2.0)
        out = np.empty_like(x)
        for side, p, q, y in ((direct, a, b, x), (~direct, b, a, rest)):
            if side.any():
                part = front[side] * fraction(p[side], q[side], y[side]) / p[side]
                out[side] = part if side is direct else 1.0 - part
        return out

    def two_sided(statistic: pd.Series, freedom: pd.Series) -> pd.Series:
        t = statistic.to_numpy(dtype=float)
        v = freedom.to_numpy(dtype=float)
        out = np.full(len(t), np.nan)
        out[(t == 0) & (v > 0)] = 1.0
        with np.errstate(all="ignore"):
            known = np.isfinite(t) & np.isfinite(v) & (v > 0) & (t != 0)
            # Wallace's normal deviate: off by some t**3 / (48 v**2), where the integral would lose digits
            large = known & (v > 1e6)
            for i in np.flatnonzero(large):
                z = math.sqrt(v[i] * math.log1p(t[i] ** 2 / v[i])) * (8 * v[i] + 1) / (8 * v[i] + 3)
                out[i] = math.erfc(z / math.sqrt(2.0))
            todo = known & ~large
            if todo.any():
                square, df = t[todo] ** 2, v[todo]
                out[todo] = beta_tail(df / 2, np.full(len(df), 0.5),
                                      df / (df + square), square / (df + square))
        return pd.Series(out).where(~np.isnan(out), None).astype("float64")

    return two_sided


def _normal():
    import math

    import numpy as np

    def two_sided(z: pd.Series) -> pd.Series:
        values = [math.erfc(v / math.sqrt(2.0)) for v in z.to_numpy(dtype=float)]
        return pd.Series(np.minimum(1.0, values), dtype="float64")

    return two_sided


def student_t_pvalue(statistic: Column, freedom: Column) -> Column:
    """P(|T| >= |statistic|); NULL where the statistic is NULL."""
    return F.nanvl(F.pandas_udf(_student_t(), "double")(statistic, freedom), F.lit(None).cast("double"))


def normal_pvalue(z: Column) -> Column:
    """min(1, P(|Z| >= z) continued below zero); NULL where ``z`` is NULL."""
    return F.nanvl(F.pandas_udf(_normal(), "double")(z), F.lit(None).cast("double"))
