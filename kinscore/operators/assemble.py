"""Feature assembly: J6/J7 left joins onto the population, P14/P15 zero fill, X1 feature hook.

Every feature frame is keyed by ``user_id`` (one row per user: each is a ``groupBy`` or a
``distinct`` on it), so the chain of left joins keeps one row per population user. All
joins are on the same key: the population is shuffled once and each feature frame arrives
already hash-partitioned on ``user_id`` by its own final aggregate.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY_COLUMNS = ("user_id", "external_id")
LABEL_COLUMNS = ("is_asd", "was_asd", "asd_others")


@dataclass(frozen=True)
class FeatureSpec:
    """A user-defined feature. ``builder(tables, cfg, population)`` returns
    ``(user_id, <name>)`` with at most one row per user."""

    name: str
    builder: Callable

    def __post_init__(self):
        if not isinstance(self.name, str) or not self.name:
            raise ValueError("feature name must be a non-empty string")
        if not callable(self.builder):
            raise ValueError("feature builder must be callable")

    def build(self, tables, cfg, population) -> DataFrame:
        df = self.builder(tables, cfg, population)
        if not isinstance(df, DataFrame):
            raise TypeError(f"feature {self.name}: builder must return a DataFrame")
        cols = df.columns
        if sorted(cols) != sorted(["user_id", self.name]):
            raise ValueError(f"feature {self.name}: expected columns (user_id, {self.name}), got {cols}")
        if not duplicate_keys(df).isEmpty():
            raise ValueError(f"feature {self.name}: more than one row for a user")
        return df.select("user_id", F.col(self.name).cast("double").alias(self.name))


def duplicate_keys(df: DataFrame, key: str = "user_id") -> DataFrame:
    """Invariant check: keys occurring more than once (empty when the frame is keyed)."""
    return df.groupBy(key).count().where("count > 1")


@dataclass
class DatasetSpec:
    """Role of every dataset column, so consumers select by name, never by position."""

    keys: list[str]
    labels: list[str]
    features: list[str]  # every feature, in dataset order
    click_features: list[str]

    @property
    def columns(self) -> list[str]:
        return [*self.keys, *self.labels, *self.features]

    @property
    def non_click_features(self) -> list[str]:
        clicks = set(self.click_features)
        return [f for f in self.features if f not in clicks]

    def model_features(self, exclude=()) -> list[str]:
        ex = set(exclude)
        return [f for f in self.features if f not in ex]


def left_join_features(base: DataFrame, frames: list[DataFrame]) -> DataFrame:
    """``base left join f using (user_id)`` for each frame."""
    out = base
    for f in frames:
        out = out.join(f, "user_id", "left")
    return out


def zero_fill(df: DataFrame, columns: list[str]) -> DataFrame:
    """Null → 0.0 for the given columns, cast to double (every feature is a float)."""
    targets = set(columns)
    return df.select(
        *[
            F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)).alias(c) if c in targets else F.col(f"`{c}`")
            for c in df.columns
        ]
    )
