"""Column-level operators: tolerant selection, type split, renames, casts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F, types as T


def select_existing(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """The wanted columns that exist, in the wanted order."""
    present = set(df.columns)
    return df.select(*[c for c in wanted if c in present])


def drop_columns(df: DataFrame, *columns: str) -> DataFrame:
    return df.drop(*columns)


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def cast_columns(df: DataFrame, columns: Sequence[str], dtype: str = "int") -> DataFrame:
    return df.withColumns({c: F.col(c).cast(dtype) for c in columns})


def split_by_type(df: DataFrame, exclude: Sequence[str] = ()) -> tuple[list[str], list[str]]:
    """Names of the text columns and of all other columns, in table order."""
    text, other = [], []
    for field in df.schema.fields:
        if field.name not in exclude:
            (text if isinstance(field.dataType, T.StringType) else other).append(field.name)
    return text, other


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def split_target(df: DataFrame, target: str) -> tuple[list[str], str]:
    """Feature columns and the target, both kept in the one DataFrame."""
    if target not in df.columns:
        raise ValueError(f"no column {target!r}")
    return [c for c in df.columns if c != target], target
