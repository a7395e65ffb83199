"""Opinara: labelled-text analytics and classification on Spark DataFrames."""

from opinara.config import (
    CleaningConfig,
    FeatureConfig,
    ProfileConfig,
    SplitConfig,
    TrainingConfig,
    subset_size,
)
from opinara.session import build_session

__all__ = [
    "CleaningConfig",
    "FeatureConfig",
    "ProfileConfig",
    "SplitConfig",
    "TrainingConfig",
    "build_session",
    "subset_size",
]
