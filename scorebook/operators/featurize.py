"""Featurization (P1-P9): label encoding, one-hot indicator columns, name cleaning, missing-row drop.

Everything is one lazy projection over the input except the category discovery for one-hot, which needs the
set of values up front (one distinct pass whose result reaching the driver is bounded by ``max_categories``).
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scorebook.config import DEFAULT_LABEL_MAP, FeaturizerConfig, normalize_keys
from scorebook.functions.expressions import cleaned_names, encode_label, indicator


def process_label(df: DataFrame, label_col: str, mapping=DEFAULT_LABEL_MAP, rename_to: str | None = None) -> DataFrame:
    """Label text -> int class (unmapped -> null), renamed in place."""
    if label_col not in df.columns:
        raise ValueError(f"label column {label_col!r} not in {df.columns}")
    out = rename_to or label_col
    if out != label_col and out in df.columns:
        raise ValueError(f"cannot rename label to {out!r}: the column exists")
    return df.select(*[encode_label(c, mapping).alias(out) if c == label_col else F.col(f"`{c}`") for c in df.columns])


def category_values(df: DataFrame, cat_cols: Sequence[str], max_categories: int = 1000) -> dict[str, list]:
    """Sorted distinct non-null values per column, in one pass: distinct (column, value) pairs are found with
    a shuffle (map-side partial aggregation keeps it small), and at most ``len(cols) * max_categories + 1``
    of them reach the driver, which is enough to prove whether a column (an id, a date) is too wide."""
    cat_cols = list(cat_cols)
    if not cat_cols:
        return {}
    pairs = df.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("col"), F.col(f"`{c}`").cast("string").alias("value")) for i, c in enumerate(cat_cols)
    ])).alias("p")).select("p.col", "p.value").where(F.col("value").isNotNull()).distinct()
    rows = pairs.limit(len(cat_cols) * max_categories + 1).collect()
    found: dict[int, list] = {i: [] for i in range(len(cat_cols))}
    for r in rows:
        found[r["col"]].append(r["value"])
    wide = [cat_cols[i] for i, v in found.items() if len(v) > max_categories]
    if wide:
        raise ValueError(f"column(s) {wide} have more than max_categories={max_categories} categories")
    # Numeric categories go back to their type, so they sort (and name) as numbers.
    types = {f.name: f.dataType for f in df.schema.fields}
    out = {}
    for i, c in enumerate(cat_cols):
        t = types[c]
        if isinstance(t, T.IntegralType):
            out[c] = sorted(int(v) for v in found[i])
        elif isinstance(t, T.FractionalType):
            out[c] = sorted(float(v) for v in found[i])
        else:
            out[c] = sorted(found[i])
    return out


def one_hot(df: DataFrame, cat_cols: Sequence[str], values: Mapping[str, Sequence] | None = None,
            max_categories: int = 1000) -> DataFrame:
    """Each categorical column becomes ``<col>_<value>`` long indicators, values ascending, appended after
    the other columns; the source column is removed; null gives all zeros."""
    cat_cols = list(cat_cols)
    unknown = [c for c in cat_cols if c not in df.columns]
    if unknown:
        raise ValueError(f"categorical column(s) {unknown} not in the frame")
    values = values if values is not None else category_values(df, cat_cols, max_categories)
    keep = [F.col(f"`{c}`") for c in df.columns if c not in cat_cols]
    dummies = [indicator(f"`{c}`", v).alias(f"{c}_{v}") for c in cat_cols for v in values[c]]
    return df.select(*keep, *dummies)


def clean_column_names(df: DataFrame) -> DataFrame:
    """P5: drop spaces, ``(`` -> ``_``, drop ``)``; two names cleaning to one raise."""
    return df.toDF(*cleaned_names(df.columns))


def drop_missing(df: DataFrame) -> DataFrame:
    """Drop rows with a null (or NaN) in any column."""
    return df.na.drop(how="any")


def featurize(df: DataFrame, cfg: FeaturizerConfig) -> DataFrame:
    """Label -> [one-hot -> clean names] -> [drop missing]."""
    out = process_label(df, cfg.label_col, cfg.label_map, cfg.label_out)
    if cfg.ohe:
        if not cfg.cat_cols:
            raise RuntimeError("one-hot encoding needs the names of its columns: set cat_cols")
        out = clean_column_names(one_hot(out, cfg.cat_cols, max_categories=cfg.max_categories))
    if cfg.drop_missing:
        out = drop_missing(out)
    return out


def feature_frame(df: DataFrame, label_col: str) -> DataFrame:
    """The feature table is everything but the label."""
    return df.drop(label_col)


def labels_frame(df: DataFrame, keys: str | Sequence[str], label_col: str) -> DataFrame:
    """Key column(s) and the label."""
    return df.select(*normalize_keys(keys), label_col)
