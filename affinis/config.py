"""Settings: defaults, a YAML file over them, and three environment variables over that; importing has no effects."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, field, fields, is_dataclass, replace
from typing import Any


@dataclass(frozen=True)
class Paths:
    train_dir: str = "dataset/train"
    test_dir: str = "dataset/test"
    output_dir: str = "output"
    artifacts_dir: str = "artifacts"


@dataclass(frozen=True)
class Blocking:
    max_block_size: int = 2500
    top_k_per_entity: int = 100


@dataclass(frozen=True)
class Boosting:
    n_estimators: int = 2000
    learning_rate: float = 0.05
    num_leaves: int = 63
    min_child_samples: int = 20
    scale_pos_weight: float = 1.0


@dataclass(frozen=True)
class Features:
    tfidf_max_features: int = 100_000


@dataclass(frozen=True)
class Threshold:
    min_tau: float = 0.3
    max_tau: float = 0.99
    step: float = 0.01


@dataclass(frozen=True)
class Training:
    neg_sample_ratio: int = 10
    val_size: float = 0.15
    val_min_entities: int = 5000


@dataclass(frozen=True)
class Config:
    """All settings."""

    seed: int = 42
    paths: Paths = field(default_factory=Paths)
    blocking: Blocking = field(default_factory=Blocking)
    model: Boosting = field(default_factory=Boosting)
    features: Features = field(default_factory=Features)
    threshold: Threshold = field(default_factory=Threshold)
    training: Training = field(default_factory=Training)


def merged(base: Any, over: Mapping[str, Any]) -> Any:
    """base with the values of over, deeply; None overrides nothing; unknown names are ignored."""
    known = {f.name for f in fields(base)}
    values = {}
    for name, value in over.items():
        if value is None or name not in known:
            continue
        own = getattr(base, name)
        values[name] = merged(own, value) if is_dataclass(own) and isinstance(value, Mapping) else value
    return replace(base, **values)


def load_config(path: str | None = None, environ: Mapping[str, str] = os.environ) -> Config:
    """The settings of a YAML file over the defaults; TRAIN_DIR, TEST_DIR and OUTPUT_DIR win."""
    config = Config()
    if path and os.path.exists(path):
        import yaml

        with open(path, encoding="utf-8") as file:
            config = merged(config, yaml.safe_load(file) or {})
    named = {n.lower(): environ[n] for n in ("TRAIN_DIR", "TEST_DIR", "OUTPUT_DIR") if environ.get(n)}
    return replace(config, paths=replace(config.paths, **named))
