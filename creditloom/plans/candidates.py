"""The published candidates, imbalance strategies and ablation as model specs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import functions as F

from ..functions import HashOrder
from ..operators import models, sampling
from ..operators.models import ModelSpec
from ..operators.neighbour_index import indexed_neighbour_lists
from ..operators.neighbours import smote
from . import loan_columns as names


def baselines(max_iter: int = 1000) -> list[ModelSpec]:
    """Majority class, and logistic regression on the three external scores."""
    return [
        ModelSpec("majority", None),
        ModelSpec("lr_external", models.logistic(1.0, max_iter), names.EXTERNAL_SCORES),
    ]


def candidates(
    columns: Sequence[str], trees: int = 100, rounds: int = 300, depth: int = 5, max_iter: int = 1000
) -> list[ModelSpec]:
    """Logistic regression on all and on engineered columns, random forest and boosted trees."""
    engineered = [c for c in names.ENGINEERED if c in columns]
    return [
        ModelSpec("lr_full", models.logistic(0.1, max_iter)),
        ModelSpec("lr_engineered", models.logistic(0.1, max_iter), engineered),
        ModelSpec("random_forest", models.random_forest(trees, depth), weight="balanced"),
        ModelSpec("boosted", models.boosted(rounds, 0.05, depth), weight="positive"),
    ]


def tuned(max_rounds: int | None = None, max_depth: int | None = None) -> ModelSpec:
    """Boosted trees with the published settings; the bounds serve quick runs."""
    params = dict(names.TUNED)
    if max_depth is not None:
        params["max_depth"] = min(params["max_depth"], max_depth)
    return ModelSpec("boosted_tuned", models.boosted_from(params, max_rounds), weight="positive")


def imbalance_strategies(
    rounds: int = 200, depth: int = 5, seed: int = 42, order: HashOrder | None = None
) -> list[ModelSpec]:
    """The same boosted model under each rebalancing of its training rows."""
    learner = models.boosted(rounds, 0.05, depth, seed=seed)

    def oversampled(df, label, key):
        return sampling.oversample(df, label, key, 1.0, seed, order)

    def balanced(df, label, key):
        return sampling.undersample(df, label, key, 1.0, seed, order)

    def thinned(df, label, key):
        return sampling.undersample(df, label, key, 0.3, seed, order)

    def synthesised(df, label, key):
        # New rows have no key; the learner needs none.
        made = smote(df, label, key, "x", 0.3, 5, seed, order=order, search=indexed_neighbour_lists)
        return made.select(key, label, F.col("x"))

    return [
        ModelSpec("none", learner),
        ModelSpec("class_weight", learner, weight="positive"),
        ModelSpec("oversample", learner, resample=oversampled),
        ModelSpec("undersample_balanced", learner, resample=balanced),
        ModelSpec("undersample", learner, resample=thinned),
        ModelSpec("smote", learner, resample=synthesised),
    ]
