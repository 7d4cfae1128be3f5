"""The feature frame: one builder for training and scoring."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numbers import to_double
from tidemark.functions.text import OTHER, UNKNOWN, clean_category, keep_categories
from tidemark.operators.profiles import top_categories

MAX_CATEGORIES = 200


@dataclass(frozen=True)
class FeatureSpec:
    """Columns of the model.

    ``logs`` maps a numeric feature to the column it is the ``log1p`` of.
    """

    entity: str
    period: str
    target: str
    numeric: Sequence[str]
    categorical: Sequence[str]
    logs: Mapping[str, str] = field(default_factory=dict)
    barred: Sequence[str] = ()

    @property
    def features(self) -> list[str]:
        return [*self.numeric, *self.categorical]

    @property
    def sources(self) -> list[str]:
        """Columns the builder reads."""
        return [*[self.logs.get(c, c) for c in self.numeric], *self.categorical]

    def check(self, columns: Sequence[str]) -> None:
        """Contract: all inputs exist, and no feature leaks the future or the calendar."""
        needed = [self.entity, self.period, self.target, *self.sources]
        missing = [c for c in needed if c not in columns]
        if missing:
            raise ValueError(f"columns missing from the modelling table: {missing}")
        leaking = sorted(set(self.barred) & (set(self.features) | set(self.sources)))
        if leaking:
            raise ValueError(f"columns barred as leakage among the features: {leaking}")


def build_features(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Numerics as doubles (bad values null), logs, cleaned categories; other columns stay."""
    numeric = {c: F.log1p(to_double(F.col(spec.logs[c]))) if c in spec.logs
               else to_double(F.col(c)) for c in spec.numeric}
    categorical = {c: clean_category(F.col(c)) for c in spec.categorical}
    return df.withColumns({**numeric, **categorical})


def freeze_categories(train: DataFrame, spec: FeatureSpec, n: int = MAX_CATEGORIES) \
        -> dict[str, list[str]]:
    """Allowed values per category column, as plain lists (at most ``n`` + 2 each)."""
    if not spec.categorical:
        return {}
    kept = {c: {OTHER, UNKNOWN} for c in spec.categorical}
    for row in top_categories(train, spec.categorical, n).toLocalIterator():
        kept[row["column"]].add(row["value"])
    return {c: sorted(values) for c, values in kept.items()}


def apply_categories(df: DataFrame, categories: Mapping[str, Sequence[str]]) -> DataFrame:
    if not categories:
        return df
    return df.withColumns({c: keep_categories(F.col(c), allowed)
                           for c, allowed in categories.items()})
