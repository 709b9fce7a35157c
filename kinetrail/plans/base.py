"""Helpers of the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, so that the order of sums does not show."""
    return df.select(*[F.round(F.col(c).cast("double"), digits).alias(c) if t in ("double", "float") else F.col(c) for c, t in df.dtypes])
