"""Sources (tables, paths, CSV, ranges) and sinks (feature, labels and predictions tables)."""

from scorebook.sources.catalog import (  # noqa: F401
    comment_table,
    drop_table,
    ensure_database,
    point_table,
    write_feature_table,
    write_labels_table,
    write_path,
    write_predictions,
)
from scorebook.sources.tables import id_range, read_csv, read_parquet_table, read_path, read_table  # noqa: F401
