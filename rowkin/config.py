"""Settings of the record-linkage plans, passed explicitly."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

SOURCE_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ("entity_id", "business_name", "business_address", "country")])
TRUTH_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ("source1_entity_id", "matched_entity_ids")])


@dataclass(frozen=True)
class BlockingConfig:
    """Largest bucket per strategy (None: any), weight per strategy, candidates per anchor."""

    caps: dict = field(default_factory=lambda: {"B1": None, "B2": 150, "B3": 150, "B4": 100, "B5": 100, "B6": 60, "B7": 80})
    weights: dict = field(default_factory=lambda: {"B1": 6, "B2": 4, "B3": 3, "B4": 3, "B5": 4, "B6": 2, "B7": 2})
    top_k: int = 50


@dataclass(frozen=True)
class LinkageConfig:
    blocking: BlockingConfig = field(default_factory=BlockingConfig)
    seed: int = 42
    validation_pct: int = 20
    threshold: float = 0.95
    #: Thresholds of a first sweep and of a fine one.
    thresholds: tuple = (0.3, 0.35, 0.4, 0.45, 0.5, 0.55, 0.6, 0.65, 0.7, 0.75, 0.8, 0.85, 0.9, 0.95)
    fine_thresholds: tuple = (0.9, 0.91, 0.92, 0.93, 0.94, 0.95, 0.96, 0.97, 0.98, 0.99)
    beta: float = 0.5
