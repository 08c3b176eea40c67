"""Deterministic per-row randomness.

Every random draw is a function of (seed, salt, row id) only, so a
generated table does not depend on partitioning, task retries or executor
loss, and any SQL engine with ``md5`` can recompute it. One digest
``md5("seed:salt:id")`` holds four independent 32-bit draws (hex characters
1–8, 9–16, 17–24, 25–32), so a row needs one digest per four draws.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def digest(seed: str, salt: str, row_id: Column) -> Column:
    """The hex digest ``md5("seed:salt:id")`` (four draws)."""
    return F.md5(F.concat_ws(":", F.lit(seed), F.lit(salt), row_id.cast("string")))


def draw(digest_hex: Column, index: int) -> Column:
    """Draw ``index`` (0–3) of a digest: a uniform integer in [0, 2**32)."""
    if not 0 <= index < 4:
        raise ValueError("a digest holds four draws")
    return F.conv(F.substring(digest_hex, 8 * index + 1, 8), 16, 10).cast("bigint")


def hash32(seed: str, salt: str, row_id: Column) -> Column:
    """Uniform integer in [0, 2**32) for (seed, salt, id): draw 0 of its digest."""
    return draw(digest(seed, salt, row_id), 0)


def uniform_slot(h: Column, k: int) -> Column:
    """Uniform integer in [0, k) from a 32-bit draw: (h·k) >> 32, exact."""
    if not 0 < k < (1 << 31):
        raise ValueError(f"slot count out of range: {k}")
    return F.shiftright(h * F.lit(k).cast("bigint"), 32)


def weighted_pick(h: Column, values: list[str], weights_pct: list[int]) -> Column:
    """Categorical pick with integer per-cent weights (they must sum to 100)."""
    if sum(weights_pct) != 100 or len(values) != len(weights_pct):
        raise ValueError("weights must be per-cent integers summing to 100, one per value")
    u = uniform_slot(h, 100)
    pick = None
    cumulative = 0
    for value, weight in zip(values, weights_pct):
        cumulative += weight
        cond = u < F.lit(cumulative)
        pick = F.when(cond, F.lit(value)) if pick is None else pick.when(cond, F.lit(value))
    return pick
