"""Column expressions: label encoding, indicators, name cleaning, safe ratios, split order hash."""

from scorebook.functions.expressions import (  # noqa: F401
    clean_name,
    cleaned_names,
    encode_label,
    indicator,
    missing,
    ratio_or_zero,
    split_order_hash,
)
