"""What Python workers need."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import SparkSession

ROOT = str(Path(__file__).resolve().parents[2])


def importable(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver has it, if it is not installed."""
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "")
    if ROOT not in known.split(":"):
        environment["PYTHONPATH"] = f"{ROOT}:{known}" if known else ROOT
