"""Exact discrete distributions as column expressions: factorials, binomial tails, hypergeometric draws."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

SMALL = 16  # below it factorials are looked up, from it on Stirling's series is good to 12 digits


def let(value: Column, body) -> Column:
    """``body`` of a variable that holds ``value``: computed once, however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def ln_factorial(n: Column) -> Column:
    table = F.array(*[F.lit(math.lgamma(i + 1)) for i in range(SMALL)])

    def series(x: Column) -> Column:
        y = x * x
        return x * F.ln(x) - x + F.ln(x * (2 * math.pi)) / 2 + (1 - (1 / 30 - 1 / (105 * y)) / y) / (12 * x)

    return let(n.cast("double"), lambda x: F.when(x < SMALL, F.get(table, x.cast("int"))).otherwise(series(x)))


def ln_choose(n: Column, k: Column) -> Column:
    return ln_factorial(n) - ln_factorial(k) - ln_factorial(n - k)


def binomial_cdf(k: Column, n: Column, p: Column) -> Column:
    """P(Bin(n, p) <= k). Terms are added from ``k`` downwards; below the mean they shrink at least
    geometrically past 40 standard deviations, so the sum stops there. At or above the mean the answer
    is not needed exactly and is 1."""

    def body(v: Column) -> Column:
        k, n, p = v["k"], v["n"], v["p"]
        top = F.exp(ln_choose(n, k) + k * F.ln(p) + (n - k) * F.ln(1 - p))
        steps = F.least(k, F.ceil(40 * F.sqrt(n)) + 50).cast("int")
        down = F.aggregate(
            F.when(steps > 0, F.sequence(F.lit(1), steps)).otherwise(F.array().cast("array<int>")),
            F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum")),
            lambda a, i: let(a["term"] * (k - i + 1) / (n - k + i) * (1 - p) / p, lambda t: _next(a, t)),
            lambda a: a["sum"],
        )
        return F.when(k >= n * p, F.lit(1.0)).otherwise(top * down)

    return let(F.struct(k.cast("double").alias("k"), n.cast("double").alias("n"), p.alias("p")), body)


def _next(a: Column, term: Column) -> Column:
    return F.struct(term.alias("term"), (a["sum"] + term).alias("sum"))


def hypergeometric(population: Column, marked: Column, draws: Column, u: Column) -> Column:
    """How many of ``marked`` are among ``draws`` out of ``population``: the quantile of ``u``.

    The sum runs over 12 standard deviations around the mean; what lies beyond is below double precision.
    """

    def spread(v: Column) -> Column:
        big, good, n = v["big"], v["good"], v["n"]
        return F.when(big > 1, F.sqrt(n * good / big * (1 - good / big) * (big - n) / (big - 1))).otherwise(0.0)

    def within(v: Column) -> Column:
        big, good, n = v["big"], v["good"], v["n"]
        mean = F.when(big > 0, n * good / big).otherwise(0.0)
        return let(
            12 * spread(v) + 12,
            lambda reach: F.struct(
                big.alias("big"), good.alias("good"), n.alias("n"), v["u"].alias("u"),
                F.greatest(F.lit(0.0), n - (big - good), F.floor(mean - reach).cast("double")).alias("low"),
                F.least(good, n, F.ceil(mean + reach).cast("double")).alias("high"),
            ),
        )

    def quantile(v: Column) -> Column:
        big, good, n, low, high = v["big"], v["good"], v["n"], v["low"], v["high"]
        first = F.exp(ln_choose(good, low) + ln_choose(big - good, n - low) - ln_choose(big, n))
        zero = let(first, lambda f: F.struct(f.alias("term"), f.alias("sum"), low.alias("x")))

        def step(a: Column, i: Column) -> Column:
            x = i.cast("double")
            term = a["term"] * (good - x + 1) * (n - x + 1) / (x * (big - good - n + x))
            on = let(term, lambda t: F.struct(t.alias("term"), (a["sum"] + t).alias("sum"), x.alias("x")))
            return F.when(a["sum"] <= v["u"], on).otherwise(a)

        steps = F.when(high > low, F.sequence(low.cast("bigint") + 1, high.cast("bigint"))).otherwise(
            F.array().cast("array<bigint>")
        )
        return F.aggregate(steps, zero, step, lambda a: a["x"]).cast("bigint")

    given = F.struct(
        population.cast("double").alias("big"), marked.cast("double").alias("good"), draws.cast("double").alias("n"), u.alias("u")
    )
    return let(given, lambda v: let(within(v), quantile))
