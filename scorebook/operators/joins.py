"""Joins (J1, J2): inner equi-joins USING the key column(s).

No hint is given: Catalyst/AQE picks broadcast (it checks the measured size against
``spark.sql.autoBroadcastJoinThreshold``) or a sort-merge join on the keys; skewed keys are split by AQE.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame

from scorebook.config import normalize_keys


def _shared_non_keys(left: DataFrame, right: DataFrame, keys: list[str]) -> list[str]:
    return [c for c in left.columns if c in right.columns and c not in keys]


def keyed_join(left: DataFrame, right: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Inner join USING ``keys``: key columns once, then the left's, then the right's columns. A shared non-key
    column would come out twice, so it raises instead. Duplicate keys fan out; null keys never match."""
    keys = normalize_keys(keys)
    for side, frame in (("left", left), ("right", right)):
        missing = [k for k in keys if k not in frame.columns]
        if missing:
            raise ValueError(f"key column(s) {missing} missing from the {side} frame")
    shared = _shared_non_keys(left, right, keys)
    if shared:
        raise ValueError(f"non-key column(s) {shared} exist on both sides of the join")
    return left.join(right, on=keys, how="inner")


def training_join(labels: DataFrame, features: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Labels joined to features."""
    return keyed_join(labels, features, keys)


def score_join(inputs: DataFrame, features: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Scoring input joined to features; input rows without features vanish."""
    return keyed_join(inputs, features, keys)
