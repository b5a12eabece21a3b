"""Preparation and decision of applications as they arrive.

Cleaning with fitted medians, feature engineering, alignment and banding hold no aggregate, so a
streaming DataFrame goes through the very plans a batch one does: no state and no watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.decisions import tier
from ..plans.application import FittedParams, prepare_application


def prepare_stream(applications: DataFrame, params: FittedParams) -> DataFrame:
    """Feature columns of arriving applications, by parameters fitted on the training table."""
    if not applications.isStreaming:
        raise ValueError("not a streaming DataFrame: use prepare_application")
    return prepare_application(applications, params, is_train=False)[0]


def decide_stream(scored: DataFrame, score: str, low: float, high: float, out: str = "BAND") -> DataFrame:
    """Add the approve / review / deny band."""
    return scored.withColumn(out, tier(score, low, high))
