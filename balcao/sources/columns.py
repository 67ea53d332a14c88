"""Finding columns by what their names contain, and checking that they are there.

Works on column names only; no rows are read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def trimmed(df: DataFrame) -> DataFrame:
    names = df.columns
    stripped = [name.strip() for name in names]
    return df if names == stripped else df.toDF(*stripped)


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    return [name for name in required if name not in df.columns]


def require(df: DataFrame, required: Sequence[str], table: str) -> DataFrame:
    missing = missing_columns(df, required)
    if missing:
        raise ValueError(f"{table} lacks columns {missing}")
    return df


def empty_text_table(spark, columns: Sequence[str]) -> DataFrame:
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.createDataFrame([], schema)


def optional(df: DataFrame | None, required: Sequence[str], spark) -> DataFrame:
    """The table, or an empty one if it is absent or lacks a required column."""
    if df is None:
        return empty_text_table(spark, required)
    df = trimmed(df)
    return empty_text_table(spark, required) if missing_columns(df, required) else df


def find_column(df: DataFrame, terms: Sequence[str]) -> str | None:
    """First column containing the first term that any column contains, ignoring case."""
    for term in terms:
        for name in df.columns:
            if term.lower() in name.lower():
                return name
    return None


def pick_columns(df: DataFrame, wanted: dict[str, Sequence[str]], table: str) -> DataFrame:
    """Select ``{new name: search terms}``; a column that cannot be found is an error."""
    found = {new: find_column(df, terms) for new, terms in wanted.items()}
    missing = [new for new, name in found.items() if name is None]
    if missing:
        raise ValueError(f"{table} lacks columns {missing}")
    return df.select(*[F.col(f"`{name}`").alias(new) for new, name in found.items()])


def in_order(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exactly ``columns``, in that order; absent ones are added as null text."""
    return df.select(
        *[
            F.col(f"`{c}`") if c in df.columns else F.lit(None).cast("string").alias(c)
            for c in columns
        ]
    )
