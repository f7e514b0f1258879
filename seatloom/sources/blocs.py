"""Bloc configuration: a JSON object, code to {display_name, keywords, color_scale}, in its own order."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seatloom.functions.colors import DEFAULT_GRADIENT

# Blocs whose share is one bloc's part of two blocs' shares, where the configuration doesn't say so itself.
DERIVED = {"bnp_vs_eleven_party_alliance": ("bnp", "eleven_party_alliance")}


@dataclass(frozen=True)
class Bloc:
    code: str
    display_name: str
    keywords: tuple[str, ...] = ()
    gradient: tuple[str, str] = DEFAULT_GRADIENT
    #: (part, other): the share is part / (part + other)
    pair: tuple[str, str] | None = None


def bloc(code: str, meta: dict) -> Bloc:
    """Keywords in lower case, none if missing; a gradient that is missing or not of two colours is the default."""
    scale, pair = meta.get("color_scale") or (), meta.get("derived") or DERIVED.get(code)
    words = tuple(k.lower() for k in meta.get("keywords") or ())
    return Bloc(code, meta.get("display_name", code), words, tuple(scale) if len(scale) == 2 else DEFAULT_GRADIENT, tuple(pair) if pair else None)


def parse_blocs(text: str) -> list[Bloc]:
    return [bloc(code, meta) for code, meta in json.loads(text).items()]


def read_blocs(spark: SparkSession, path: str) -> list[Bloc]:
    """A handful of entries that shape the plans, so they live on the driver; read by Spark from any file system."""
    return parse_blocs(spark.read.text(path, wholetext=True).first().value)


_CONFIG = "map<string,struct<display_name:string,keywords:array<string>,color_scale:array<string>,derived:array<string>>>"


def bloc_rows(texts: DataFrame, *carried: str) -> DataFrame:
    """Configurations (value) as a table, for blocs that are too many to live on the driver: the columns named, place (in the
    configuration), code, display_name, keywords, low, high, pair; with bloc()'s defaults."""
    rows = texts.select(*carried, F.posexplode(F.map_entries(F.from_json("value", _CONFIG))).alias("place", "e"))
    two = F.coalesce(F.size("e.value.color_scale") == 2, F.lit(False))
    end = lambda i: F.when(two, F.get("e.value.color_scale", F.lit(i))).otherwise(DEFAULT_GRADIENT[i])
    known = F.lit(None).cast("array<string>")
    for code, pair in DERIVED.items():
        known = F.when(F.col("e.key") == code, F.array(*map(F.lit, pair))).otherwise(known)
    words = F.transform(F.coalesce("e.value.keywords", F.array().cast("array<string>")), lambda k: F.lower(k))
    return rows.select(*carried, "place", F.col("e.key").alias("code"), F.coalesce("e.value.display_name", "e.key").alias("display_name"), words.alias("keywords"), end(0).alias("low"), end(1).alias("high"), F.coalesce("e.value.derived", known).alias("pair"))
