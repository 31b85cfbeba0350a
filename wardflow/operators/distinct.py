"""Mergeable distinct counts: sketches per fine group, stored once, united for any roll-up."""

from __future__ import annotations

from collections.abc import Sequence
from math import sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Base-two logarithm of the registers of a sketch: 16,384 registers, about 0.8 % standard error.
LG_REGISTERS = 14
#: Standard errors that the stated bound of an estimate covers.
CONFIDENCE = 3.0


def relative_error(lg_registers: int = LG_REGISTERS) -> float:
    """Bound of the relative error of an estimate, at ``CONFIDENCE`` standard errors."""
    return CONFIDENCE * 1.04 / sqrt(1 << lg_registers)


def distinct_sketches(
    df: DataFrame, keys: Sequence[str], value: str, lg_registers: int = LG_REGISTERS
) -> DataFrame:
    """``keys``, ``rows`` and ``sketch`` (binary) of the distinct values of each group.

    Sketches are built map-side and merge in the shuffle, so a heavy group ships one sketch per
    task; NULL values count as no value.  The result is small, is meant to be stored, and grows by
    appending the groups of new days: :func:`roll_up` unites several sketches of one group.
    """
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"), F.hll_sketch_agg(F.col(value), lg_registers).alias("sketch")
    )


def roll_up(
    sketches: DataFrame, keys: Sequence[str | Column], name: str, lg_registers: int = LG_REGISTERS
) -> DataFrame:
    """Estimated distinct values per coarser group, with the bound of their relative error."""
    united = sketches.groupBy(*keys).agg(
        F.sum("rows").alias("rows"), F.hll_union_agg("sketch").alias("sketch")
    )
    estimate = F.hll_sketch_estimate("sketch").alias(name)
    return united.select(*[c for c in united.columns if c != "sketch"], estimate, F.lit(relative_error(lg_registers)).alias("relative_error"))
