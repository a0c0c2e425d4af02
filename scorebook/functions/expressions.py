"""Column expressions shared by the operators. All are built-in Spark functions (codegen, JVM side)."""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def encode_label(col: str | Column, mapping: Iterable[tuple[str, int]]) -> Column:
    """Map label text to its class; unmapped text and null stay null (no ``otherwise``). Result is int."""
    c = F.col(col) if isinstance(col, str) else col
    out = None
    for text, cls in mapping:
        out = (F.when(c == F.lit(text), F.lit(cls)) if out is None else out.when(c == F.lit(text), F.lit(cls)))
    if out is None:
        raise ValueError("label mapping is empty")
    return out.cast("int")


def indicator(col: str, value) -> Column:
    """1 where the column equals the value, else 0 (null included), as a long."""
    return F.when(F.col(col) == F.lit(value), F.lit(1)).otherwise(F.lit(0)).cast("long")


def clean_name(name: str) -> str:
    """Column-name cleaning: drop spaces, ``(`` becomes ``_``, drop ``)``."""
    return name.replace(" ", "").replace("(", "_").replace(")", "")


def cleaned_names(names: Sequence[str]) -> list[str]:
    out = [clean_name(n) for n in names]
    seen: dict[str, str] = {}
    for old, new in zip(names, out):
        if new in seen:
            raise ValueError(f"column names {seen[new]!r} and {old!r} both clean to {new!r}")
        seen[new] = old
    return out


def missing(col: str, numeric: bool) -> Column:
    """True where the value is null, or NaN for floating columns."""
    c = F.col(col)
    return (c.isNull() | F.isnan(c)) if numeric else c.isNull()


def ratio_or_zero(num: Column, den: Column) -> Column:
    """num / den as double, 0.0 where den is 0 (ANSI mode makes a bare x/0 raise)."""
    return F.when(den == 0, F.lit(0.0)).otherwise(num.cast("double") / den.cast("double"))


def split_order_hash(keys: Sequence[str], seed: int) -> Column:
    """Deterministic, engine-independent row order for the split: md5 of the keys and the seed."""
    parts = [F.col(k).cast("string") for k in keys] + [F.lit(str(seed))]
    return F.md5(F.concat_ws("|", *parts))
