"""Job parameters."""

from __future__ import annotations

import json
from dataclasses import dataclass, field, fields
from typing import Any

#: Named subset sizes; ``None`` keeps every row.
SUBSETS: dict[str, int | None] = {"dev": 2000, "medium": 10000, "full": None}

#: Label names and their codes.
LABEL_CODES: dict[str, int] = {"negative": 0, "positive": 1}


def subset_size(name: str) -> int | None:
    if name not in SUBSETS:
        raise ValueError(f"Unknown subset {name!r}; choose one of {sorted(SUBSETS)}")
    return SUBSETS[name]


# Names and defaults of the cleaning parameters.
@dataclass(frozen=True)
class CleaningConfig:
    strategy: str = "standard"
    lowercase: bool = True
    remove_html: bool = True
    remove_punctuation: bool = True
    remove_numbers: bool = False
    normalize_whitespace: bool = True
    remove_stopwords: bool = True
    lemmatize: bool = True


# Names and defaults of the feature parameters.
@dataclass(frozen=True)
class FeatureConfig:
    strategy: str = "tfidf"
    max_features: int = 20000
    ngram_range: tuple[int, int] = (1, 2)
    min_df: int | float = 2
    max_df: int | float = 0.9
    sublinear_tf: bool = True


@dataclass(frozen=True)
class SplitConfig:
    test_size: float = 0.15
    val_size: float = 0.15
    seed: int = 42


@dataclass(frozen=True)
class ProfileConfig:
    top_n_words: int = 25
    top_n_ngrams: int = 20
    ngram_range: tuple[int, int] = (2, 3)
    class_terms: int = 150
    histogram_bins: int = 50
    sample_rows: int = 5
    snippet_chars: int = 300
    seed: int = 42


# Default parameters per model. Trees are at most 30 deep, the deepest MLlib grows.
DEFAULT_MODEL_PARAMS: dict[str, dict[str, Any]] = {
    "logistic_regression": {"C": 1.0, "max_iter": 2000, "class_weight": "balanced"},
    "linear_svm": {"C": 1.0, "max_iter": 5000, "class_weight": "balanced"},
    "multinomial_nb": {"alpha": 1.0},
    "random_forest": {"n_estimators": 300, "max_depth": 30, "class_weight": "balanced"},
    "sgd_linear": {"alpha": 0.0001, "max_iter": 2000},
}

#: Models trained unless the caller names others, in tie-breaking order.
DEFAULT_ACTIVE_MODELS = ("logistic_regression", "linear_svm", "multinomial_nb", "random_forest")


@dataclass(frozen=True)
class TrainingConfig:
    cleaning: CleaningConfig = field(default_factory=CleaningConfig)
    features: FeatureConfig = field(default_factory=FeatureConfig)
    active_models: tuple[str, ...] = DEFAULT_ACTIVE_MODELS
    model_params: dict[str, dict[str, Any]] = field(default_factory=dict)
    primary_metric: str = "f1"
    seed: int = 42

    def params_for(self, name: str) -> dict[str, Any]:
        return {**DEFAULT_MODEL_PARAMS.get(name, {}), **self.model_params.get(name, {})}


@dataclass(frozen=True)
class JobConfig:
    """Everything a job may be told; a configuration file sets any part of it."""

    split: SplitConfig = field(default_factory=SplitConfig)
    profile: ProfileConfig = field(default_factory=ProfileConfig)
    training: TrainingConfig = field(default_factory=TrainingConfig)


_PARTS = {
    "split": SplitConfig,
    "profile": ProfileConfig,
    "training": TrainingConfig,
    "cleaning": CleaningConfig,
    "features": FeatureConfig,
}


def filled(kind: type, values: dict[str, Any]) -> Any:
    """``kind`` with ``values``; parts may be given as dictionaries, and unknown names are refused."""
    known = {f.name for f in fields(kind)}
    unknown = sorted(set(values) - known)
    if unknown:
        raise ValueError(f"unknown parameter(s) {unknown}; choose from {sorted(known)}")
    return kind(
        **{
            name: filled(_PARTS[name], value) if name in _PARTS else tuple(value) if isinstance(value, list) else value
            for name, value in values.items()
        }
    )


def read_config(path: str | None) -> JobConfig:
    """The configuration in a JSON file on the driver; the defaults without one."""
    if path is None:
        return JobConfig()
    with open(path, encoding="utf-8") as source:
        return filled(JobConfig, json.load(source))
