"""Configuration records for the three jobs (plain frozen dataclasses; no YAML or env-file parsing)."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any, Mapping, Sequence

# The label text the booking data uses, mapped to the positive and negative class.
DEFAULT_LABEL_MAP: tuple[tuple[str, int], ...] = (("Canceled", 1), ("Not_Canceled", 0))

PRODUCTION = "Production"
ARCHIVED = "Archived"
NO_STAGE = "None"


def normalize_keys(keys: str | Sequence[str]) -> list[str]:
    """Key columns as a list: one name or a list of names; anything else is an error."""
    if isinstance(keys, str):
        return [keys]
    if isinstance(keys, (list, tuple)) and keys and all(isinstance(k, str) for k in keys):
        return list(keys)
    raise TypeError(f"primary keys must be a column name or a list of names, got {keys!r}")


def qualified(database: str | None, table: str) -> str:
    return f"{database}.{table}" if database else table


@dataclass(frozen=True)
class FeaturizerConfig:
    label_col: str = "booking_status"
    ohe: bool = False
    cat_cols: tuple[str, ...] | None = None
    drop_missing: bool = True
    rename_to: str | None = None  # defaults to label_col
    label_map: tuple[tuple[str, int], ...] = DEFAULT_LABEL_MAP
    max_categories: int = 1000  # one-hot width guard per column
    input_table: str | None = None  # the raw table the features job starts from, when it is given no frame

    @property
    def label_out(self) -> str:
        return self.rename_to or self.label_col


@dataclass(frozen=True)
class FeatureTableConfig:
    database_name: str
    table_name: str
    primary_keys: str | tuple[str, ...]
    description: str | None = None
    format: str = "parquet"
    location: str | None = None  # root folder for the table's snapshots
    # Bucket by the keys (later joins on them skip shuffling this table): a count, or "auto" for one bucket per
    # ``rows_per_bucket`` rows of the written frame (at least ``min_buckets``).
    buckets: int | str | None = None
    rows_per_bucket: int = 5_000_000
    min_buckets: int = 8

    @property
    def name(self) -> str:
        return qualified(self.database_name, self.table_name)

    @property
    def keys(self) -> list[str]:
        return normalize_keys(self.primary_keys)


@dataclass(frozen=True)
class LabelsTableConfig:
    database_name: str
    table_name: str
    label_col: str
    primary_keys: str | tuple[str, ...] | None = None
    path: str | None = None
    format: str = "parquet"

    @property
    def name(self) -> str:
        return qualified(self.database_name, self.table_name)


@dataclass(frozen=True)
class SplitConfig:
    test_size: float | int = 0.2
    random_state: int = 42


@dataclass(frozen=True)
class TrainConfig:
    feature_table: FeatureTableConfig
    labels_table: LabelsTableConfig
    split: SplitConfig = SplitConfig()
    model_params: Mapping[str, Any] = field(default_factory=dict)
    model_name: str | None = None
    include_keys: bool = False  # reference parity: keys become features when True
    fit_partitions: int | None = None  # fixed layout for a reproducible fit
    run_name: str | None = None
    max_categories: int | None = None  # a wider text column is an error; None: any width
    max_classes: int | None = None  # more classes are an error; None: any number
    conf: Mapping[str, Any] | None = None
    logged_conf_keys: tuple[str, ...] = ("pipeline_params", "model_params", "run_name")


@dataclass(frozen=True)
class InferenceConfig:
    model_name: str
    input_table: str
    feature_table: str
    lookup_keys: str | tuple[str, ...]
    output_table: str | None = None
    output_location: str | None = None
    stage: str = PRODUCTION
    mode: str = "overwrite"
    format: str = "parquet"
    batch_id: str | None = None  # with mode append: a repeated run of one batch replaces its own rows
