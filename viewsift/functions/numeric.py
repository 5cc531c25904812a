"""Exact rounding of ratios, as SQL NUMERIC rounds them.

``ROUND(100.0 * a / b, 2)`` and ``ROUND(AVG(x), 2)`` run in exact numeric in the
original warehouse. Rounding a binary double can land on the other side of a
``.xx5`` tie, so these helpers round the integer ratio exactly (half away from
zero) in decimal arithmetic and only then turn the result into a double.
Everything stays a built-in expression, so it stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _exact(c: Column) -> Column:
    """An integer column as DECIMAL(28,0): products below stay exact for every BIGINT and sums of 10^9 of them."""
    return c.cast("decimal(28,0)")


def exact_round_div(num: Column, den: Column, scale: int = 2) -> Column:
    """round(num / den, scale) as a double, exact for integer inputs of any BIGINT size.

    NULL when ``den`` is 0 or NULL, like ``x / NULLIF(den, 0)``. The quotient is an
    integral division of decimals: floor((2 * p * |n| + |d|) / (2 * |d|)).
    """
    p = 10 ** scale
    n = num.cast("decimal(32,0)")
    d = F.when(_exact(den) != 0, _exact(den))
    sign = F.signum(n.cast("double")) * F.signum(d.cast("double"))
    q = F.call_function("div", F.abs(n) * (2 * p) + F.abs(d), F.abs(d) * 2)
    return (sign * q / F.lit(float(p))).cast("double")


def exact_round_avg(total: Column, count: Column, scale: int = 2) -> Column:
    """ROUND(AVG(x), scale) from SUM(x) and COUNT(x)."""
    return exact_round_div(total, count, scale)


def exact_round_pct(part: Column, whole: Column, scale: int = 2) -> Column:
    """ROUND(100.0 * part / NULLIF(whole, 0), scale)."""
    return exact_round_div(_exact(part) * 100, whole, scale)


def sql_round_div(num: str, den: str, scale: int = 2) -> str:
    """The rounded ratio as SQL text for the oracle: quotient and remainder in HUGEINT."""
    p = 10 ** scale
    n, d = f"CAST({num} AS HUGEINT)", f"NULLIF(CAST({den} AS HUGEINT), 0)"
    whole, rest = f"(abs({n}) * {p} // abs({d}))", f"(abs({n}) * {p} % abs({d}))"
    return (f"CAST(sign({n}) * sign({d}) * ({whole} + CASE WHEN 2 * {rest} >= abs({d}) THEN 1 ELSE 0 END)"
            f" AS DOUBLE) / {float(p)}")


def sql_round_pct(part: str, whole: str, scale: int = 2) -> str:
    return sql_round_div(f"CAST({part} AS HUGEINT) * 100", whole, scale)
