"""Column-wise feature transforms: P17/X2 formula templates, A12/L9 standardisation."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def transform_features(df: DataFrame, cols: list[str], fn: Callable[[Column], Column]) -> DataFrame:
    """Apply ``fn`` to every listed column in one projection (one codegen stage)."""
    targets = set(cols)
    return df.select(*[fn(F.col(f"`{c}`")).alias(c) if c in targets else F.col(f"`{c}`") for c in df.columns])


def log1p10(c: Column) -> Column:
    """F13 ``log10(1 + x)``. Spark (like SQL) gives NULL for x ≤ −1; such values map to 0
    (semantics note 9) and ``log_domain_violations`` counts them for the run log."""
    return F.when(c > -1, F.log10(F.lit(1.0) + c)).otherwise(F.lit(0.0))


def log_features(df: DataFrame, cols: list[str]) -> DataFrame:
    return transform_features(df, cols, log1p10)


def log_domain_violations(df: DataFrame, cols: list[str]) -> DataFrame:
    """One row: number of rows with some value ≤ −1 among ``cols``."""
    cond = F.lit(False)
    for c in cols:
        cond = cond | (F.col(f"`{c}`") <= -1)
    return df.agg(F.count(F.when(cond, 1)).alias("rows_below_minus_one"))


def column_moments(df: DataFrame, cols: list[str]) -> dict[str, tuple[float, float]]:
    """Per-column mean and population standard deviation in one aggregate.

    The result is one row of 2·len(cols) numbers, whatever the row count."""
    aggs = []
    for i, c in enumerate(cols):
        aggs.append(F.avg(F.col(f"`{c}`")).alias(f"m{i}"))
        aggs.append(F.stddev_pop(F.col(f"`{c}`")).alias(f"s{i}"))
    row = df.agg(*aggs).first()
    return {c: (row[f"m{i}"], row[f"s{i}"]) for i, c in enumerate(cols)}


def standardize(df: DataFrame, cols: list[str], moments: dict | None = None) -> DataFrame:
    """``(x - mean) / std_pop``; a zero (or undefined) spread divides by 1, so a constant
    column becomes 0 (sklearn's StandardScaler convention, semantics note 15)."""
    moments = moments or column_moments(df, cols)

    def scale(name: str, c: Column) -> Column:
        mean, std = moments[name]
        mean = 0.0 if mean is None else mean
        std = 1.0 if not std else std
        return (c - F.lit(mean)) / F.lit(std)

    targets = set(cols)
    return df.select(
        *[scale(c, F.col(f"`{c}`")).alias(c) if c in targets else F.col(f"`{c}`") for c in df.columns]
    )
