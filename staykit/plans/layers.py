"""Derived layers written once per session and read back by later stages.

The original job hands each stage a written table (raw → star → kpi).
The registered queries do the same: a layer derived from the driver tables
is written once per Spark application under the shared checkpoint root, and
every later query reads it back instead of recomputing the upstream stages.
This also cuts lineage between stages, so a lost executor only re-runs the
stage it was working on.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path

_WRITTEN: dict[tuple[str, str, str], str] = {}


def _key(spark: SparkSession, sf_dir: str, name: str) -> tuple[str, str, str]:
    return spark.sparkContext.applicationId, sf_dir.rstrip("/"), name


def materialized(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The layer ``name`` for ``sf_dir``: written on first use, then read back."""
    key = _key(spark, sf_dir, name)
    path = _WRITTEN.get(key)
    if path is None:
        path = scratch_path(spark, f"layer-{name}")
        build().write.mode("overwrite").option("compression", "zstd").parquet(path)
        _WRITTEN[key] = path
    return spark.read.parquet(path)


def written_once(spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], object]) -> str:
    """A folder produced by ``write(path)`` once per application (e.g. exported files)."""
    key = _key(spark, sf_dir, name)
    path = _WRITTEN.get(key)
    if path is None:
        path = scratch_path(spark, f"files-{name}")
        write(path)
        _WRITTEN[key] = path
    return path
