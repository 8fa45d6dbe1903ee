"""Classifier inference by batches, with any scorer, and the focal loss of a score."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def length_scorer() -> Callable[[pd.Series], pd.Series]:
    """A deterministic stand-in for a model."""
    return lambda texts: (texts.str.len() % 7) / 7


def classify(df: DataFrame, key: str, texts: list[Column], load: Callable[[], Callable[[pd.Series], pd.Series]], threshold: float) -> DataFrame:
    """Add ``prob`` and ``positive``: texts are joined by a space; the model is loaded once a worker."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load()
        for batch in batches:
            yield model(batch.fillna("")).astype("float64")

    prob = df.select(key, F.concat_ws(" ", *texts).alias("_text")).select(key, score("_text").alias("prob"))
    return prob.withColumn("positive", F.round("prob", 12) >= F.round(F.lit(threshold), 12))


def focal_loss(prob: Column, label: Column, alpha: float = 0.25, gamma: float = 2.0) -> Column:
    """Cross entropy weighted down where the score is sure and right."""
    right = F.greatest(F.least(F.when(label == 1, prob).otherwise(1 - prob), F.lit(0.999999)), F.lit(0.000001))
    return -alpha * F.pow(1 - right, gamma) * F.log(right)
