"""Binding a frame to a declared table: by name, with explicit casts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillmart import schemas


def conform(df: DataFrame, ddl: str, *, keep: Sequence[str] = ()) -> DataFrame:
    """Select the declared columns by name and cast each to its declared type.

    A missing column raises; extra columns are dropped unless named in ``keep``.
    """
    declared = [f"CAST(`{name}` AS {kind}) AS `{name}`" for name, kind in schemas.fields(ddl)]
    return df.selectExpr(*declared, *keep)


def enforce_not_null(df: DataFrame, columns: Sequence[str], *, metric: str | None = None) -> DataFrame:
    """Drop rows with a NULL key column; ``metric`` names an observed count of the dropped rows."""
    if metric:
        missing = F.lit(False)
        for column in columns:
            missing = missing | F.col(column).isNull()
        df = df.observe(metric, F.count_if(missing).alias("dropped_rows"))
    return df.na.drop(subset=list(columns))


def protect(df: DataFrame, columns: Sequence[str], *, how: str = "drop") -> DataFrame:
    """Remove sensitive columns, or replace them by their SHA-256 (``how="hash"``)."""
    present = [c for c in columns if c in df.columns]
    if how == "drop":
        return df.drop(*present)
    if how == "hash":
        return df.withColumns({c: F.sha2(F.col(c).cast("string"), 256) for c in present})
    raise ValueError(f"unknown protection: {how!r}")
