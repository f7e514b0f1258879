"""Boundary collections (GeoJSON). Geometries are carried as text and never looked into."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "struct<features:array<struct<type:string,properties:map<string,string>,geometry:string>>>"


def features_of(texts: DataFrame, column: str = "value", *carried: str) -> DataFrame:
    """(feature_pos, raw_name, properties, geometry) of each collection, with the columns named: where there are several,
    they tell features apart. raw_name is the property cst_n: 'None' if null, '' if missing."""
    rows = texts.select(*carried, F.posexplode(F.from_json(column, SCHEMA)["features"]).alias("feature_pos", "f"))
    props = F.coalesce(F.col("f.properties"), F.create_map().cast("map<string,string>"))
    name = F.when(F.map_contains_key(props, "cst_n"), F.coalesce(F.element_at(props, "cst_n"), F.lit("None"))).otherwise(F.lit(""))
    return rows.select(*carried, "feature_pos", name.alias("raw_name"), props.alias("properties"), F.col("f.geometry").alias("geometry"))


def read_boundaries(spark: SparkSession, path: str) -> DataFrame:
    return features_of(spark.read.text(path, wholetext=True))
