"""A Spark session with what the vote tables need."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(name: str = "seatloom") -> SparkSession:
    """Parties may differ in letter case alone, so column names are case sensitive; times are UTC. The master and sizes are
    the submitter's."""
    spark = SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC").getOrCreate()
    spark.conf.set("spark.sql.caseSensitive", "true")
    return spark
