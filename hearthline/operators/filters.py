"""Optional dashboard filters: an empty value keeps every row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def by_month(df: DataFrame, col: str, month: str | None) -> DataFrame:
    """Rows of one ``YYYY-MM``, as a date range so that partition pruning and pushdown apply."""
    if not month:
        return df
    first = F.lit(f"{month}-01").cast("date")
    return df.filter((F.col(col) >= first) & (F.col(col) < F.add_months(first, 1)))


def by_guild(df: DataFrame, name: str | None, col: str = "guild_name") -> DataFrame:
    return df.filter(F.col(col) == name) if name else df


def by_categories(df: DataFrame, names: Sequence[str] | None, col: str = "category_name") -> DataFrame:
    """Rows in one of the categories; a NULL category counts as the empty name."""
    return df.filter(F.coalesce(F.col(col), F.lit("")).isin(*names)) if names else df


def exclude_categories(df: DataFrame, names: Sequence[str] | None, col: str = "category_name") -> DataFrame:
    """Rows outside the categories, those without category included."""
    return df.filter(F.col(col).isNull() | ~F.col(col).isin(*names)) if names else df


def param_filter(df: DataFrame, col: str, value: object, all_value: object = "All") -> DataFrame:
    return df if value == all_value else df.filter(F.col(col) == F.lit(value))
