"""Repeatable noise from keys.

The same key and seed give the same number on any cluster, in any order and in
any SQL engine with 64-bit integers, so nothing here uses ``rand()``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# A prime modulus below 2^31 keeps every product inside 64 bits; one
# multiplier per key position.
MODULUS = 2147483647
MULTIPLIERS = [1103515245, 1664525, 22695477, 134775813, 69069]
STEP = 48271
OFFSET = 12345


def mix(*keys: Column | int, seed: int = 42) -> Column:
    """Hash up to five non-negative integer keys to an integer in [0, 2^31 - 1).

    Keys are combined linearly, then scrambled by two quadratic rounds; the
    expression stays short enough to be generated inline several times.
    """
    h = F.lit((seed * STEP + OFFSET) % MODULUS).cast("long")
    for k, a in zip(keys, MULTIPLIERS, strict=False):
        k = k if isinstance(k, Column) else F.lit(k)
        h = h + ((k.cast("long") % F.lit(MODULUS)) * F.lit(a)) % F.lit(MODULUS)
    h = h % F.lit(MODULUS)
    for c in (OFFSET, OFFSET + 1):
        h = (h * (h + F.lit(STEP)) + F.lit(c)) % F.lit(MODULUS)
    return h


def uniform(*keys: Column | int, seed: int = 42) -> Column:
    """A double in (0, 1)."""
    return (mix(*keys, seed=seed) + F.lit(0.5)) / F.lit(float(MODULUS))


def normal(*keys: Column | int, seed: int = 42) -> Column:
    """A standard normal double (Box-Muller on two hashed uniforms)."""
    u = uniform(*keys, seed=seed)
    v = uniform(*keys, seed=seed + 1)
    return F.sqrt(F.lit(-2.0) * F.log(u)) * F.cos(F.lit(2.0 * math.pi) * v)


def mix_sql(*keys: str, seed: int = 42) -> str:
    """The same hash as SQL text, for other engines."""
    h = f"CAST({(seed * STEP + OFFSET) % MODULUS} AS BIGINT)"
    for k, a in zip(keys, MULTIPLIERS, strict=False):
        h = f"{h} + ((CAST({k} AS BIGINT) % {MODULUS}) * {a}) % {MODULUS}"
    h = f"(({h}) % {MODULUS})"
    for c in (OFFSET, OFFSET + 1):
        h = f"(({h} * ({h} + {STEP}) + {c}) % {MODULUS})"
    return h


def uniform_sql(*keys: str, seed: int = 42) -> str:
    return f"(({mix_sql(*keys, seed=seed)} + 0.5) / {float(MODULUS)!r}::DOUBLE)"


def normal_sql(*keys: str, seed: int = 42) -> str:
    return (
        f"(sqrt(-2.0::DOUBLE * ln({uniform_sql(*keys, seed=seed)})) "
        f"* cos({2.0 * math.pi!r}::DOUBLE * {uniform_sql(*keys, seed=seed + 1)}))"
    )
