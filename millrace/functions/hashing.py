"""Deterministic randomness: every random choice is a function of (seed, row key).

md5 is used so that the same choice can be restated in any SQL engine.
"""

from __future__ import annotations

import math
from typing import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import col

UNIT_DIGITS = 13
UNIT_SCALE = float(16**UNIT_DIGITS)


def hash_hex(key: str | Column | Sequence[str], seed: object) -> Column:
    """md5 of ``seed:key`` as 32 hex digits; sorting by it is a random permutation of the keys."""
    if isinstance(key, Column):
        text = key.cast("string")
    elif isinstance(key, str):
        text = col(key).cast("string")
    else:
        text = F.concat_ws("|", *[col(k).cast("string") for k in key])
    return F.md5(F.concat(F.lit(f"{seed}:"), text))


def hash_unit(key: str | Column | Sequence[str], seed: object) -> Column:
    """Uniform number in [0, 1) drawn from the first 52 bits of the hash."""
    return F.conv(F.substring(hash_hex(key, seed), 1, UNIT_DIGITS), 16, 10).cast("bigint").cast("double") / F.lit(
        UNIT_SCALE
    )


def hash_int(key: str | Column | Sequence[str], seed: object, modulus: int | Column) -> Column:
    value = F.conv(F.substring(hash_hex(key, seed), 1, UNIT_DIGITS), 16, 10).cast("bigint")
    return value % (F.lit(modulus) if isinstance(modulus, int) else modulus)


def poisson_times(u: Column, mean: float = 1.0) -> Column:
    """Poisson number for a uniform draw: how many cumulative probabilities it reaches.

    Terms are taken until they are below the resolution of :func:`hash_unit`.
    """
    total, term, k, times = 0.0, math.exp(-mean), 0, F.lit(0)
    while k < mean or term > 2.0**-53:
        total += term
        times = times + (u >= F.lit(total)).cast("int")
        k += 1
        term *= mean / k
    return times


def hash_normal(key: str | Column | Sequence[str], seed: object) -> Column:
    """Standard normal draw by the Box-Muller transform of two uniform draws."""
    u = F.lit(1.0) - hash_unit(key, f"{seed}a")
    v = hash_unit(key, f"{seed}b")
    return F.sqrt(F.lit(-2.0) * F.log(u)) * F.cos(F.lit(6.283185307179586) * v)
