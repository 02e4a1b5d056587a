"""Random draws as expressions of a row key.

Every draw depends only on (key, slot, seed), so a row gets the same values under any partitioning
and after any retry. Uniforms come from a 32-bit integer mixer written with plain arithmetic, which
stays inside generated code and is cheap compared with a cryptographic digest.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

MASK = 0xFFFFFFFF
# Fixed values: (shift, multiplier) rounds of a published 32-bit mixer; the multipliers are below
# 2 ** 31, so products of masked values fit a signed 64-bit integer.
ROUNDS = ((16, 0x21F0AAAD), (15, 0x735A2D97))
LAST_SHIFT = 15


def mix(x: int) -> int:
    """The mixer on a Python integer, for the constants of the slots."""
    for shift, factor in ROUNDS:
        x = ((x ^ (x >> shift)) * factor) & MASK
    return x ^ (x >> LAST_SHIFT)


def slot_constants(n: int, seed: int) -> list[tuple[int, int]]:
    """Two constants per slot, one for each half of the key."""
    return [(mix((seed * 2654435761 + 2 * i + 1) & MASK), mix((seed * 2654435761 + 2 * i + 2) & MASK))
            for i in range(n)]


def with_uniforms(df: DataFrame, key: str, n: int, seed: int, prefix: str = "__u") -> DataFrame:
    """Adds ``n`` columns of uniforms strictly inside (0, 1), independent of each other.

    Each step of the mixer is one projection over all slots, because a step uses its input twice.
    """
    constants = slot_constants(n, seed)
    columns = [f"`{c}`" for c in df.columns]
    low, high = f"(CAST(`{key}` AS BIGINT) & {MASK}L)", f"shiftrightunsigned(CAST(`{key}` AS BIGINT), 32)"

    def each(rows: DataFrame, make) -> DataFrame:
        return rows.selectExpr(*columns, *[f"{make(f'{prefix}{i}', i)} AS {prefix}{i}" for i in range(n)])

    def mixed(rows: DataFrame) -> DataFrame:
        for shift, factor in ROUNDS:
            rows = each(rows, lambda x, i: f"(({x} ^ shiftright({x}, {shift})) * {factor}L) & {MASK}L")
        return each(rows, lambda x, i: f"{x} ^ shiftright({x}, {LAST_SHIFT})")

    rows = mixed(each(df, lambda x, i: f"{low} ^ {constants[i][0]}L"))
    rows = mixed(each(rows, lambda x, i: f"{x} ^ ({high} ^ {constants[i][1]}L)"))
    return each(rows, lambda x, i: f"({x} + 0.5D) / {float(MASK + 1)!r}D")


def normal(u1: Column, u2: Column) -> Column:
    """Standard normal by Box-Muller."""
    return F.sqrt(F.log(u1) * -2.0) * F.cos(u2 * (2.0 * math.pi))


def half_chi_square(z: Column) -> Column:
    """Gamma with shape 1/2; k added exponentials (-log of a uniform) make the shape k + 1/2."""
    return z * z / 2.0


def order_statistic(uniforms: list[Column], rank: int) -> Column:
    """Beta(rank, n - rank + 1) as the ``rank``-th smallest (1-based) of n uniforms."""
    return F.element_at(F.sort_array(F.array(*uniforms)), rank)


def choice(u: Column, values: list, weights: list[float]) -> Column:
    """Weighted choice by cumulative weights."""
    acc, out = 0.0, None
    for value, weight in list(zip(values, weights))[:-1]:
        acc = round(acc + weight, 12)
        out = F.when(u < acc, F.lit(value)) if out is None else out.when(u < acc, F.lit(value))
    return out.otherwise(F.lit(values[-1]))


def uniform_int(u: Column, low: int, high: int) -> Column:
    """Integer in low..high, both included."""
    return (F.floor(u * (high - low + 1)) + low).cast("int")


def pick(u: Column, values: list[str]) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), uniform_int(u, 1, len(values)))
