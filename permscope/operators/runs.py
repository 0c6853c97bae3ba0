"""Columns that tell runs apart: per-folder results never mix the runs of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame

RUN_COLUMNS = ("run_id", "snapshot")


def run_keys(df: DataFrame) -> list[str]:
    return [c for c in RUN_COLUMNS if c in df.columns]
