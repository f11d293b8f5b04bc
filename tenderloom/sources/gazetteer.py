"""Gazetteer of municipalities: name;lat;lon without a header."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderloom.functions import text as tx


def read_gazetteer(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.csv(path, sep=";", schema="name string, lat string, lon string", mode="PERMISSIVE")
    return parse_gazetteer(raw)


def parse_gazetteer(raw: DataFrame) -> DataFrame:
    """Rows with fewer than three fields or unreadable numbers are dropped."""
    return raw.select(
        tx.blank_to_null("name").alias("name"), F.col("lat").try_cast("double").alias("lat"),
        F.col("lon").try_cast("double").alias("lon"),
    ).where("name IS NOT NULL AND lat IS NOT NULL AND lon IS NOT NULL")
