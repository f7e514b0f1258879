"""Pages: fetched, or read from files."""

from __future__ import annotations

import logging
import urllib.request

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger(__name__)

# A page of no more characters is an error page; seconds to wait.
LEAST_CHARACTERS, TIMEOUT = 10_000, 20
HEADERS = {"User-Agent": "Mozilla/5.0 (X11; Linux x86_64) seatloom", "Accept-Language": "en-US,en;q=0.9"}


def long_enough(html: Column) -> Column:
    return F.length(html) > LEAST_CHARACTERS


def fetch(url: str) -> str | None:
    """The page's text, or None if it can't be had or is too short. Two attempts; errors are only logged."""
    for _ in range(2):
        try:
            with urllib.request.urlopen(urllib.request.Request(url, headers=HEADERS), timeout=TIMEOUT) as answer:
                text = answer.read().decode(answer.headers.get_content_charset() or "utf-8", "replace")
                if 200 <= answer.status < 400 and len(text) > LEAST_CHARACTERS:
                    return text
        except Exception as error:  # noqa: BLE001 - any failure means: no page
            log.debug("fetching %s failed: %s", url, error)
    return None


def as_page(spark: SparkSession, url: str, html: str) -> DataFrame:
    return spark.createDataFrame([(url, html)], "url string, html string")


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """(url, html) of each file under path, read whole; bytes that aren't UTF-8 are dropped."""
    raw = spark.read.format("binaryFile").load(path)
    text = F.replace(F.make_valid_utf8(F.col("content").cast("string")), F.lit("�"), F.lit(""))
    return raw.select(F.col("path").alias("url"), text.alias("html"))
