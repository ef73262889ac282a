"""Lower quantile of beta distributions as Spark expressions.

The quantile is found by Newton steps inside a shrinking bracket; each step evaluates the
incomplete beta function by its continued fraction. Both iterations are folds over a
sequence whose state says when it is done, so later elements cost next to nothing.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_STIRLING = [1 / 12, -1 / 360, 1 / 1260, -1 / 1680, 1 / 1188, -691 / 360360]
_TINY = 1e-300
#: Steps of the outer fold: halving the bracket alone would need about sixty for ordinary quantiles.
_STEPS = 200
_FRACTION_END, _QUANTILE_END = 1e-15, 1e-14


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a value that is computed once."""
    return F.get(F.transform(F.array(value), body), 0)


def _away_from_zero(value: Column) -> Column:
    return _let(value, lambda v: F.when(F.abs(v) < _TINY, F.lit(_TINY)).otherwise(v))


def log_gamma(x: Column) -> Column:
    """Logarithm of the gamma function of a positive number: Stirling's series ten places up."""
    up = x + 10.0
    product = x
    for i in range(1, 10):
        product = product * (x + float(i))
    series = F.lit(0.0)
    for coefficient in reversed(_STIRLING):
        series = series / (up * up) + F.lit(coefficient)
    return (up - 0.5) * F.log(up) - up + 0.5 * math.log(2 * math.pi) + series / up - F.log(product)


def _fraction(a: Column, b: Column, x: Column) -> Column:
    """The continued fraction by the modified Lentz rule; the job fails if it does not converge."""

    def state(c: Column, d: Column, value: Column, going: Column) -> Column:
        return F.struct(c.alias("c"), d.alias("d"), value.alias("value"), going.alias("going"))

    def half(c: Column, d: Column, numerator: Column) -> Column:
        return _let(
            numerator,
            lambda n: F.struct(_away_from_zero(1.0 + n / c).alias("c"), (1.0 / _away_from_zero(1.0 + n * d)).alias("d")),
        )

    def step(s: Column, place: Column) -> Column:
        return F.when(s["going"], _let(place.cast("double"), lambda m: both_halves(s, m))).otherwise(s)

    def both_halves(s: Column, m: Column) -> Column:
        even = m * (b - m) * x / ((a + 2.0 * m - 1.0) * (a + 2.0 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2.0 * m) * (a + 2.0 * m + 1.0))
        return _let(
            half(s["c"], s["d"], even),
            lambda e: _let(
                half(e["c"], e["d"], odd),
                lambda o: state(
                    o["c"], o["d"], s["value"] * e["c"] * e["d"] * o["c"] * o["d"], F.abs(o["c"] * o["d"] - 1.0) > _FRACTION_END * 4
                ),
            ),
        )

    def finish(s: Column) -> Column:
        open_ended = F.raise_error(F.lit("continued fraction of a beta quantile does not converge")).cast("double")
        return F.when(s["going"], open_ended).otherwise(s["value"])

    first = 1.0 / _away_from_zero(1.0 - (a + b) * x / (a + 1.0))
    # Below the mean some multiple of the root of the counts is enough.
    terms = F.sequence(F.lit(1), (F.lit(60.0) + 6.0 * F.sqrt(a + b)).cast("int"))
    start = _let(first, lambda d: state(F.lit(1.0), d, d, F.lit(True)))
    return F.aggregate(terms, start, step, finish)


def regularised_beta(a: Column, b: Column, x: Column, log_norm: Column | None = None) -> Column:
    """I_x(a, b) for 0 < x < 1; ``log_norm``, if known, is the logarithm of 1 / B(a, b)."""
    norm = log_gamma(a + b) - log_gamma(a) - log_gamma(b) if log_norm is None else log_norm
    # The fraction converges fast below the mean, so above it the other tail is taken.
    mirrored = x >= (a + 1.0) / (a + b + 2.0)
    sides = F.when(mirrored, F.struct(b.alias("a"), a.alias("b"), (1.0 - x).alias("x"))).otherwise(
        F.struct(a.alias("a"), b.alias("b"), x.alias("x"))
    )
    front = F.exp(a * F.log(x) + b * F.log1p(-x) + norm)
    value = _let(sides, lambda s: front * _fraction(s["a"], s["b"], s["x"]) / s["a"])
    return F.when(mirrored, 1.0 - value).otherwise(value)


def beta_quantile_column(a: Column | str, b: Column | str, p: float) -> Column:
    """x with I_x(a, b) = p, for positive ``a`` and ``b``; null for null. The job fails if it does not converge."""
    a, b = (F.col(c) if isinstance(c, str) else c for c in (a, b))

    def solve(s: Column) -> Column:
        a, b, norm = s["a"], s["b"], s["norm"]

        def state(low: Column, high: Column, x: Column, going: Column) -> Column:
            return F.struct(low.alias("low"), high.alias("high"), x.alias("x"), going.alias("going"))

        def newton(t: Column, error: Column) -> Column:
            x = t["x"]
            density = F.exp(norm + (a - 1.0) * F.log(x) + (b - 1.0) * F.log1p(-x))
            low, high = F.when(error < 0, x).otherwise(t["low"]), F.when(error < 0, t["high"]).otherwise(x)
            moved = F.struct(low.alias("low"), high.alias("high"), (x - error / _away_from_zero(density)).alias("to"))

            def choose(m: Column) -> Column:
                inside = (m["to"] > m["low"]) & (m["to"] < m["high"])
                chosen = F.when(inside, m["to"]).otherwise((m["low"] + m["high"]) / 2.0)
                narrow = m["high"] - m["low"] <= _QUANTILE_END * m["high"]
                return _let(
                    chosen, lambda c: state(m["low"], m["high"], c, ~(narrow | (inside & (F.abs(c - x) <= _QUANTILE_END * c))))
                )

            return _let(moved, choose)

        def step(t: Column, _: Column) -> Column:
            moved = _let(regularised_beta(a, b, t["x"], norm) - p, lambda error: newton(t, error))
            return F.when(t["going"], moved).otherwise(t)

        def finish(t: Column) -> Column:
            open_ended = F.raise_error(F.lit("beta quantile does not converge")).cast("double")
            return F.when(t["going"], open_ended).otherwise(t["x"])

        start = state(F.lit(0.0), F.lit(1.0), a / (a + b), F.lit(True))
        return F.aggregate(F.sequence(F.lit(1), F.lit(_STEPS)), start, step, finish)

    given = F.struct(
        a.cast("double").alias("a"), b.cast("double").alias("b"), (log_gamma(a + b) - log_gamma(a) - log_gamma(b)).alias("norm")
    )
    return F.when(a.isNotNull() & b.isNotNull(), _let(given, solve))


def beta_quantiles(pairs: DataFrame, p: float) -> DataFrame:
    """(``a``, ``b``, ``quantile``) of each distinct pair of columns ``a`` and ``b``.

    Solving costs milliseconds a pair while the pairs are small, so that by size they would
    end in one task: they are dealt to as many tasks as shuffles have.
    """
    tasks = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    distinct = pairs.select("a", "b").distinct().repartition(tasks, "a", "b")
    return distinct.withColumn("quantile", beta_quantile_column("a", "b", p))
