"""Text expressions with the exact semantics that vote pages' consumers rely on. No UDFs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings of districts on vote pages and on boundary maps, in order of replacement.
SPELLINGS = [
    ("chattogram", "chittagong"),
    ("barishal", "barisal"),
    ("chapai nawabganj", "chapai nababganj"),
    ("jhalakathi", "jhalokathi"),
    ("moulvibazar", "maulvibazar"),
    ("netrokona", "netrakona"),
    ("khagrachhari", "khagrachari"),
]
# Fixed value: names with this prefix are single-seat districts.
SINGLE_SEAT_PREFIX = "parbatya "


def strip(s: Column) -> Column:
    """Drop white space at both ends, all of Unicode's and U+001C to U+001F."""
    return F.regexp_replace(s, "(?U)^[\\s\\x1c-\\x1f]+|[\\s\\x1c-\\x1f]+$", "")


def one_decimal(x: Column) -> Column:
    """x with one decimal, rounded from its exact binary value."""
    return F.format_number(x, 1)


def thousands(n: Column) -> Column:
    return F.format_number(n, 0)


def seat_key(name: Column) -> Column:
    """Join key of a seat's name; '' for none. Characters other than a-z, 0-9, - and blank are deleted, not spaced."""
    s = F.lower(strip(name))
    s = reduce(lambda acc, pair: F.replace(acc, F.lit(pair[0]), F.lit(pair[1])), SPELLINGS, s)
    bare = F.substring(s, len(SINGLE_SEAT_PREFIX) + 1, 1 << 30)
    s = F.when(s.startswith(SINGLE_SEAT_PREFIX), F.when(bare.contains("-"), bare).otherwise(F.concat(bare, F.lit("-1")))).otherwise(s)
    s = F.regexp_replace(F.regexp_replace(s, "[^a-z0-9\\- ]", ""), " +", " ")
    return F.coalesce(s, F.lit(""))


def first_filled(*names: Column, default: str) -> Column:
    """The first name that isn't null or '', stripped; else the default. One of white space alone counts and gives ''."""
    return F.coalesce(*[strip(F.nullif(n.cast("string"), F.lit(""))) for n in names], F.lit(default))
