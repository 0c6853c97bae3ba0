"""The full query catalogue (imports every ``q_*`` module so it registers)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from permscope.plans import q_reports  # noqa: F401
from permscope.plans.registry import REGISTRY

for _mod in ("q_rules", "q_finders", "q_metrics", "q_fingerprints", "q_identity", "q_drift",
             "q_patterns", "q_ingest"):
    try:
        __import__(f"permscope.plans.{_mod}")
    except ModuleNotFoundError as e:  # module not written yet
        if f"permscope.plans.{_mod}" not in str(e):
            raise


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v.build for k, v in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v.oracle for k, v in REGISTRY.items() if v.oracle}
