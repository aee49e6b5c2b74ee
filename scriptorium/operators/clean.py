"""Row cleaning: required fields, first row per key, whitespace."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from scriptorium.functions.text import normalize_ws
from scriptorium.operators.skew import first_per_key
from scriptorium.schemas import STAGING


def drop_incomplete(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Drop rows with a null in any required column; empty strings stay."""
    return df.na.drop(how="any", subset=list(required))


def clean(
    df: DataFrame,
    required: Sequence[str] = ("arxiv_id", "title", "abstract"),
    key: str = "arxiv_id",
    order: Sequence[Column] = (),
    text_cols: Sequence[str] = ("title", "abstract"),
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Required fields, then the first row per key, then whitespace.

    The order matters: two titles that differ only in whitespace become equal
    after the key was made unique, which ``split_conflicts`` deals with.
    """
    columns = list(columns or STAGING.fieldNames())
    kept = drop_incomplete(df, required)
    kept = first_per_key(kept, [key], order) if order else kept.dropDuplicates([key])
    return kept.select(
        *[normalize_ws(F.col(c)).alias(c) if c in text_cols else F.col(c) for c in columns]
    )
