"""Time-series feature operators for Spark tables and streams."""

from tidemark.client import FeatureClient
from tidemark.operators.lookup import PitOptions, key_lookup, pit_lookup
from tidemark.operators.tables import FeatureTable, KeyViolation, latest_snapshot
from tidemark.operators.training import FeatureLookup, TrainingSet, create_training_set
from tidemark.operators.windows import Measure, windowed_features

__all__ = [
    "FeatureClient",
    "FeatureLookup",
    "FeatureTable",
    "KeyViolation",
    "Measure",
    "PitOptions",
    "TrainingSet",
    "create_training_set",
    "key_lookup",
    "latest_snapshot",
    "pit_lookup",
    "windowed_features",
]
