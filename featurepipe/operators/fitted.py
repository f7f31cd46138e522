"""What every feature generator has in common.

A generator is fitted on a frame, which costs a fixed number of passes whatever the
number of columns, and keeps only small statistics. Applying it is a projection
(or a projection after small joins), so it can be applied to other frames and to streams.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class FeatureRule:
    """Which features came from which source columns, and by which rule."""

    source: tuple[str, ...]
    features: tuple[str, ...]
    rule: str
    details: dict | None = None


class FittedFeatures(Protocol):
    rules: list[FeatureRule]

    def transform(self, frame: DataFrame) -> DataFrame:
        """The frame with the feature columns added."""


def feature_names(rules: list[FeatureRule]) -> list[str]:
    return [name for rule in rules for name in rule.features]
