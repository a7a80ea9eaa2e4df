"""Projection helpers (P01–P06): mapping-driven rename/recast, type resolution,
null handling.  All are single projections or one aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rename_cast(df: DataFrame, mapping: list[tuple[str, str, str]], safe: bool = False) -> DataFrame:
    """``[(source, type, target), ...]`` -> one select of casts.
    ``safe=True`` uses try_cast (bad values become null instead of failing)."""
    cols = []
    for src, typ, dst in mapping:
        c = F.col(f"`{src}`")
        cols.append((c.try_cast(typ) if safe else c.cast(typ)).alias(dst))
    return df.select(*cols)


def resolve_choice(df: DataFrame, column: str, to_type: str = "double", flag_col: str | None = None) -> DataFrame:
    """A column with mixed text/number content resolved to one type with
    ``try_cast``; optional flag marks values that did not convert."""
    out = df.withColumn(f"__{column}", F.col(column).cast("string").try_cast(to_type))
    if flag_col:
        out = out.withColumn(flag_col, F.col(column).isNotNull() & F.col(f"__{column}").isNull())
    return out.drop(column).withColumnRenamed(f"__{column}", column)


def drop_all_null_columns(df: DataFrame) -> DataFrame:
    """Drop columns that are null in every row (one aggregate, one row back)."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns]).first()
    keep = [c for c in df.columns if counts[c] > 0]
    return df.select(*[F.col(f"`{c}`") for c in keep])


def fill_and_drop(df: DataFrame, fill: dict | None = None, required: list[str] | None = None) -> DataFrame:
    """Dropna on required columns, then fillna defaults."""
    out = df.dropna(subset=required) if required else df
    return out.fillna(fill) if fill else out
