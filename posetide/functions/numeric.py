"""Deterministic decimal rounding shared by queries and their SQL twins.

``floor(x * 10^k + 0.5) / 10^k`` uses only IEEE-exact operations, so Spark
and DuckDB produce bit-identical doubles (their ROUND functions disagree on
binary values that sit just below a printed half)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rnd(x, k: int = 6) -> Column:
    x = F.col(x) if isinstance(x, str) else x
    s = float(10 ** k)
    return (F.floor(x * s + 0.5) / s).cast("double")


def rnd_sql(expr: str, k: int = 6) -> str:
    s = f"{10 ** k}.0"
    return f"cast(floor(({expr}) * {s} + 0.5) / {s} as double)"
